"""Frame times from recorded probe output, numbered across the segments of a match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.numeric import frame_rate, total_frames
from reelspark.functions.text import basename, segment_number
from reelspark.operators.frames import number_frames
from reelspark.schemas import PROBE, STREAMS


def probed_frames(probes: DataFrame) -> DataFrame:
    """match_id, segment, arrival, json -> rows of the frame table.

    A frame without a time keeps its place in the segment, and gets no number. A probe that failed (null or no JSON) gives no rows and leaves the count as it is.
    """
    found = F.from_json("json", PROBE)["frames"]
    rows = probes.select("match_id", basename(F.col("segment")).alias("segment"), "arrival", F.posexplode(F.coalesce(found, F.array().cast("array<struct<pkt_pts_time:string>>"))).alias("at", "frame"))
    rows = rows.withColumn("ptstime", F.col("frame.pkt_pts_time").try_cast("decimal(18,6)"))
    numbered = number_frames(rows, "match_id", "arrival", ["arrival", "at"], F.col("ptstime").isNotNull())
    return numbered.select("match_id", "segment", "ptstime", "ts_frame", "frame_number", segment_number(F.col("segment")).alias("segment_number"))


def failed_probes(probes: DataFrame) -> DataFrame:
    """match_id, segment, reason of the segments that ``probed_frames`` skips: no output, or output that is no JSON or has no list of frames."""
    reason = F.when(F.col("json").isNull(), "no output").when(F.from_json("json", PROBE)["frames"].isNull(), "no frames")
    return probes.select("match_id", basename(F.col("segment")).alias("segment"), reason.alias("reason")).where("reason is not null")


def stream_probe(probes: DataFrame, json: str = "json") -> DataFrame:
    """probes with width, height and fps of the first stream of the probe's JSON; null where it lacks them, fps 0 for a zero denominator."""
    first = F.get(F.from_json(json, STREAMS)["streams"], F.lit(0))
    return probes.withColumns({"width": first["width"], "height": first["height"], "fps": frame_rate(first["r_frame_rate"])})


def media_info(probes: DataFrame, duration: str, json: str = "json") -> DataFrame:
    """probes with fps of the first stream and total_frames: whole frames in the duration (a column, in seconds)."""
    return stream_probe(probes, json).drop("width", "height").withColumn("total_frames", total_frames(F.col(duration), F.col("fps")))
