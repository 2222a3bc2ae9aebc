"""Frame numbering and the position to resume from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.operators.ordered import free_names


def number_frames(frames: DataFrame, match: str, segment: str, order: list[str], present: Column) -> DataFrame:
    """ts_frame: 0-based place in the segment, of all frames. frame_number: 1-based place in the match, of the frames that are ``present``; the others go.

    Segments of a match follow one another in ``order``. Frames are numbered within their segment, and a scan over the segments' counts tells what came before each: no task holds more than a segment.
    """
    inside, before, first = free_names(frames, "inside", "before", "first")
    in_segment = Window.partitionBy(match, segment).orderBy(*order)
    placed = frames.withColumns({"ts_frame": (F.row_number().over(in_segment) - 1).cast("int"), inside: F.sum(present.cast("bigint")).over(in_segment.rowsBetween(Window.unboundedPreceding, 0))}).where(present)
    counts = frames.where(present).groupBy(match, segment).agg(F.min(F.struct(*order)).alias(first), F.count("*").alias(before))
    earlier = Window.partitionBy(match).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(match).alias("of_match"), F.col(segment).alias("of_segment"), F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    joined = placed.join(offsets, placed[match].eqNullSafe(offsets["of_match"]) & placed[segment].eqNullSafe(offsets["of_segment"]))
    return joined.withColumn("frame_number", (F.col(before) + F.col(inside)).cast("bigint")).drop("of_match", "of_segment", before, inside)


def newest(rows: DataFrame, match: str, order: list[str], n: int) -> DataFrame:
    """The n newest rows of each match; ``order`` must be total. rank 1 is the newest."""
    latest = Window.partitionBy(match).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("rank", F.row_number().over(latest)).where(F.col("rank") <= n)


def resume_latest(rows: DataFrame, match: str) -> DataFrame:
    """First frame of the greatest segment among the rows."""
    top = rows.groupBy(match).agg(F.max(F.struct(F.col("segment_number"), (-F.col("frame_number")).alias("f"))).alias("_top"))
    return top.select(match, F.col("_top.segment_number").alias("segment_number"), (-F.col("_top.f")).alias("frame_number"))


def resume_before_latest(rows: DataFrame, match: str) -> DataFrame:
    """Last frame of the second greatest distinct segment (of the only one, if there is one), and both numbers one on."""
    segments = rows.groupBy(match, "segment_number").agg(F.max("frame_number").alias("last"))
    two = segments.withColumn("r", F.row_number().over(Window.partitionBy(match).orderBy(F.col("segment_number").desc()))).where("r <= 2")
    chosen = two.groupBy(match).agg(F.max_by(F.struct("segment_number", "last"), "r").alias("_top"))
    return chosen.select(match, (F.col("_top.segment_number") + 1).alias("segment_number"), (F.col("_top.last") + 1).alias("frame_number"))


def with_default(matches: DataFrame, positions: DataFrame, match: str, live: Column, segment: int = 1, frame: int = 1) -> DataFrame:
    """Positions of live matches; (segment, frame) for those that aren't live or have no rows."""
    joined = matches.join(positions, match, "left")
    pick = lambda c, d: F.when(live, F.coalesce(c, F.lit(d))).otherwise(F.lit(d)).cast("bigint").alias(c)
    return joined.select(match, pick("segment_number", segment), pick("frame_number", frame))


def assign_batches(frames: DataFrame, frame: str, batch_size: int, queues: int) -> DataFrame:
    batch = F.floor(F.col(frame) / batch_size).cast("bigint")
    return frames.withColumns({"batch_id": batch, "queue_id": (batch % queues).cast("int")})
