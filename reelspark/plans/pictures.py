"""Queries over pixels: frames of 8 x 8 pixels made from the embeddings, written as raw files of a hundred frames and read back."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.folders import fresh_folder, stored
from reelspark.functions.numeric import hamming, sparse_correlation
from reelspark.operators import cuts
from reelspark.operators.ordered import with_previous
from reelspark.operators.pictures import frame_features
from reelspark.sources.raw_frames import RawFrames, write_frames

SIDE = 8


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """A file for each hundred vectors, in the order of their ids; each ends in half a frame, as a recording that was cut off. Pixel i is made of values i, i + 1 and i + 2."""
    folder = fresh_folder(spark, "frames")
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.expr("vec_id div 100").alias("part"), "vec_id", "embedding")

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = [np.clip(np.floor((np.asarray(x, np.float64) + 1) * 128), 0, 255).astype(np.uint8) for x in rows.sort_values("vec_id").embedding]
        frames = [np.stack([np.roll(x, -k) for k in range(3)], 1).tobytes() for x in values]
        name = f"s_{key[0]:08}.bgr"
        return pd.DataFrame({"part": [key[0]], "bytes": [write_frames(key, [*frames, frames[0][: 3 * SIDE]], folder, name)]})

    e.groupBy("part").applyInPandas(write, "part bigint, bytes bigint").write.format("noop").mode("overwrite").save()
    return folder


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.dataSource.register(RawFrames)
    rows = spark.read.format("raw_frames").option("width", SIDE).option("height", SIDE).option("framesPerPartition", 40).option("rangesPerPartition", 30).option("suffix", ".bgr").load(raw_folder(spark, sf_dir))
    return rows.withColumn("part", F.regexp_extract("segment", "s_([0-9]+)", 1).cast("bigint"))


PIXELS_SQL = """
WITH e AS (SELECT vec_id // 100 AS part, (row_number() OVER (PARTITION BY vec_id // 100 ORDER BY vec_id) - 1)::INT AS ts_frame,
    list_transform(embedding, lambda x: greatest(0, least(255, floor((x::DOUBLE + 1) * 128)))::INT) AS v FROM embeddings),
p AS (SELECT part, ts_frame, i, v[i] AS b, v[i % len(v) + 1] AS g, v[(i + 1) % len(v) + 1] AS r FROM e, unnest(range(1, len(v) + 1)) AS t(i))"""


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("part", "ts_frame", F.md5(F.lower(F.hex("frame")).cast("binary")).alias("pixels"))


RAW_SQL = PIXELS_SQL + " SELECT part, ts_frame, md5(string_agg(printf('%02x%02x%02x', b, g, r), '' ORDER BY i)) AS pixels FROM p GROUP BY part, ts_frame"

HSV_SQL = PIXELS_SQL + """,
d AS (SELECT *, greatest(b, g, r) AS v, greatest(b, g, r) - least(b, g, r) AS d FROM p),
h AS (
  SELECT part, ts_frame, v, CASE WHEN v = 0 THEN 0 ELSE (510 * d + v) // (2 * v) END AS s,
    CASE WHEN d = 0 THEN 0 WHEN v = r THEN ((60 * (g - b + 6 * d) + d) // (2 * d)) % 180 WHEN v = g THEN ((60 * (b - r + 8 * d) + d) // (2 * d)) % 180 ELSE ((60 * (r - g + 10 * d) + d) // (2 * d)) % 180 END AS h FROM d),
hist AS (SELECT part, ts_frame, ((h * 50 // 256) * 50 + s * 50 // 256) * 50 + v * 50 // 256 AS bin, count(*) AS count FROM h GROUP BY ALL)"""


def picture_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = frame_features(frames(spark, sf_dir), side=SIDE)
    return found.select("part", "ts_frame", F.explode(F.arrays_zip("bins", "counts")).alias("x")).select("part", "ts_frame", F.col("x.bins").alias("bin"), F.col("x.counts").alias("count"))


HASH_SQL = """,
y AS (SELECT part, ts_frame, (i - 1) // 8 AS y, (i - 1) % 8 AS x, (114 * b + 587 * g + 299 * r) / 1000.0::DOUBLE AS grey FROM p),
band AS (
  SELECT part, ts_frame, u, w, sum(grey * 4 * cos(pi() * u * (2 * y + 1) / 16) * cos(pi() * w * (2 * x + 1) / 16)) AS c FROM y, unnest(range(8)) AS t(u), unnest(range(8)) AS s(w) GROUP BY ALL),
bits AS (SELECT part, ts_frame, list(c > m ORDER BY u, w) AS bits FROM (SELECT *, median(c) OVER (PARTITION BY part, ts_frame) AS m FROM band) GROUP BY part, ts_frame)"""


def picture_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = frame_features(frames(spark, sf_dir), side=SIDE)
    return found.select("part", "ts_frame", F.lpad(F.conv(F.hex("bits"), 16, 2), 64, "0").alias("bits"))


def picture_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut candidates from pixels: hashes that differ in 20 bits, and histograms that don't agree."""
    found = stored(frame_features(frames(spark, sf_dir), side=SIDE).select("part", "ts_frame", "bits", "bins", "counts"), "features")  # with_previous reads it three times
    pairs = with_previous(found, ["part"], "ts_frame", {"bits_0": "bits", "bins_0": "bins", "counts_0": "counts"})
    both = pairs.withColumns({"hamming": hamming(F.col("bits_0"), F.col("bits")), "correlation": sparse_correlation(F.col("bins_0"), F.col("counts_0"), F.col("bins"), F.col("counts"), 50**3)})
    return both.select("part", "ts_frame", F.coalesce("hamming", F.lit(-1)).alias("hamming"), F.round("correlation", 5).alias("correlation"), cuts.is_cut().alias("is_cut"))


CUTS_SQL = HSV_SQL + HASH_SQL + """,
sums AS (SELECT part, ts_frame, sum(count)::DOUBLE AS s, sum(count * count)::DOUBLE AS ss FROM hist GROUP BY ALL),
both_have AS (SELECT a.part, a.ts_frame, sum(a.count * b.count)::DOUBLE AS xy FROM hist a JOIN hist b ON a.part = b.part AND a.bin = b.bin AND b.ts_frame = a.ts_frame - 1 GROUP BY ALL),
c AS (
  SELECT q.part, q.ts_frame, list_sum(list_transform(range(1, 65), lambda i: (l.bits[i] <> q.bits[i])::INT))::INT AS hamming,
    (coalesce(xy, 0) - a.s * b.s / 125000) / sqrt((a.ss - a.s * a.s / 125000) * (b.ss - b.s * b.s / 125000)) AS correlation
  FROM bits q LEFT JOIN bits l ON l.part = q.part AND l.ts_frame = q.ts_frame - 1 JOIN sums a ON a.part = q.part AND a.ts_frame = q.ts_frame LEFT JOIN sums b ON b.part = q.part AND b.ts_frame = q.ts_frame - 1
  LEFT JOIN both_have h ON h.part = q.part AND h.ts_frame = q.ts_frame)
SELECT part, ts_frame, coalesce(hamming, -1) AS hamming, round(correlation, 5) AS correlation, coalesce(hamming >= 20 AND correlation < 0.9, false) AS is_cut FROM c"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (raw_frames, picture_histogram, picture_hash, picture_cuts)}


def oracle_sql() -> dict[str, str]:
    hashes = " SELECT part, ts_frame, array_to_string(list_transform(bits, lambda x: CASE WHEN x THEN '1' ELSE '0' END), '') AS bits FROM bits"
    return {"raw_frames": RAW_SQL, "picture_histogram": HSV_SQL + " SELECT part, ts_frame, bin, count FROM hist", "picture_hash": PIXELS_SQL + HASH_SQL + hashes, "picture_cuts": CUTS_SQL}
