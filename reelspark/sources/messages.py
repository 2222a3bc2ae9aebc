"""Job messages, from the environment or from JSON files."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.schemas import MESSAGE

#: The environment's names of the fields.
FIELDS = {"matchId": "MATCH_ID", "streamUrl": "STREAM_URL", "streamStatus": "STREAM_STATUS", "league": "LEAGUE", "lang": "LANG_CODE"}


def from_environment(spark: SparkSession, env: Mapping[str, str] | None = None) -> DataFrame:
    """One row; a status that isn't set is 'started', other fields that aren't set are null."""
    env = os.environ if env is None else env
    row = {k: env.get(v) for k, v in FIELDS.items()}
    row["streamStatus"] = row["streamStatus"] or "started"
    row |= {k: {"id": env.get(f"{k.upper()}_ID"), "name": env.get(f"{k.upper()}_NAME")} for k in ("game", "tournament")}
    return spark.createDataFrame([row], MESSAGE)


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a JSON file; a path that isn't there or a malformed file fails."""
    return spark.read.schema(MESSAGE).option("multiLine", True).option("mode", "FAILFAST").json(path)


def started(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("streamStatus") == "started")
