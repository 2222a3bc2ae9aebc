"""Camera cuts: candidates, debouncing, shots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions.numeric import correlation, hamming, timecode
from reelspark.operators.ordered import greatest_up_to, sums_up_to, with_previous

#: A cut has at least this Hamming distance and less than this correlation.
LEAST_HAMMING, CORRELATION = 20, 0.90


def compared(frames: DataFrame, match: str = "match_id", order: str = "frame_number", bits: str = "bits", vector: str = "vector") -> DataFrame:
    """hamming and correlation of each frame with the one before; null for the first. ``order``: whole numbers, one frame for each; a match is compared in pieces of it."""
    with_last = with_previous(frames, [match], order, {"_bits": bits, "_vector": vector})
    out = with_last.withColumns({"hamming": hamming(F.col("_bits"), F.col(bits)), "correlation": correlation(F.col("_vector"), F.col(vector))})
    return out.drop("_bits", "_vector")


def is_cut(least: int = LEAST_HAMMING, below: float = CORRELATION) -> Column:
    """A null or NaN correlation counts as different; a frame without a predecessor is no cut."""
    r = F.col("correlation")
    return F.coalesce((F.col("hamming") >= least) & (r.isNull() | F.isnan(r) | (r < below)), F.lit(False))


def change_records(kept: DataFrame, fps: float, match: str = "match_id", order: str = "frame_number", form: str = "HH:MM:SS.mmm") -> DataFrame:
    """change_id, idx, tc, sim for the change log: cuts numbered from 1 in each match, with the frame, its timecode and the correlation."""
    number = F.row_number().over(Window.partitionBy(match).orderBy(order)).cast("bigint")
    return kept.select(match, number.alias("change_id"), F.col(order).alias("idx"), timecode(F.col(order), F.lit(fps), form).alias("tc"), F.col("correlation").alias("sim"))


def histogram_3d(pixels: DataFrame, keys: list[str], channels: tuple[str, str, str], bins: int = 50, limit: float = 256.0) -> DataFrame:
    """keys, bin, count: the filled bins of each picture's three-dimensional histogram of [0, limit) in each channel; bin is (first * bins + second) * bins + third.

    Values outside (and null ones) are not counted. One aggregate over pixels, with partial counts in each task.
    """
    at = [F.floor(F.col(c).cast("double") * bins / limit).cast("int") for c in channels]
    inside = at[0].between(0, bins - 1) & at[1].between(0, bins - 1) & at[2].between(0, bins - 1)
    return pixels.where(inside).groupBy(*keys, ((at[0] * bins + at[1]) * bins + at[2]).alias("bin")).agg(F.count("*").alias("count"))


def normalised(histogram: DataFrame, keys: list[str], count: str = "count") -> DataFrame:
    """histogram with ``share``: counts over the root of their sum of squares, so that each picture's vector has length 1."""
    total = F.sqrt(F.sum(F.col(count).cast("double") * F.col(count)).over(Window.partitionBy(*keys)))
    return histogram.withColumn("share", F.col(count) / total)


def debounce(rows: DataFrame, key: str, order: str, gap: int) -> DataFrame:
    """Greedy: a row is kept if it is at least ``gap`` after the last kept row of its key.

    A row at least ``gap`` after its predecessor is kept whatever went before, so keys fall into bursts that are folded apart; no task holds more than a burst, or 1024 gaps of a key.
    Rows of one key with equal ``order`` count once.
    """
    rows, width = rows.select(key, F.col(order).cast("bigint").alias(order)).distinct(), 1024 * gap
    before = with_previous(rows, [key], order, {"_before": order}, width)
    starts = before.withColumn("_starts", F.coalesce((F.col(order) - F.col("_before") >= gap).cast("int"), F.lit(1)))
    bursts = sums_up_to(starts, [key], order, {"_burst": "_starts"}, width)
    step = lambda kept, x: F.when((F.size(kept) == 0) | (x - F.element_at(kept, -1) >= gap), F.array_append(kept, x)).otherwise(kept)
    fold = F.aggregate(F.sort_array(F.collect_list(order)), F.array().cast("array<bigint>"), lambda kept, x: F.when(F.size(kept) == 0, F.array(x)).otherwise(step(kept, x)))
    return bursts.groupBy(key, "_burst").agg(fold.alias("_kept")).select(key, F.explode("_kept").alias(order))


def shots(frames: DataFrame, cuts: DataFrame, match: str, order: str, initial: int = 1) -> DataFrame:
    """shot_id of each frame: ``initial`` and one more from each cut on. ``order``: whole numbers; a match is added up in pieces of it."""
    marked = frames.join(cuts.select(match, order, F.lit(1).alias("_cut")), [match, order], "left").withColumn("_cut", F.coalesce("_cut", F.lit(0)))
    return sums_up_to(marked, [match], order, {"shot_id": "_cut"}).withColumn("shot_id", F.col("shot_id") + initial).drop("_cut")


def latest_cut(frames: DataFrame, cuts: DataFrame, match: str, order: str) -> DataFrame:
    """As-of join: each frame with the last cut at or before it. ``order``: whole numbers; a match is searched in pieces of it, each with the last cut of those before."""
    both = frames.select(match, order, F.lit(None).cast("bigint").alias("_cut"), F.lit(1).alias("_frame")).unionByName(cuts.select(match, order, F.col(order).cast("bigint").alias("_cut"), F.lit(0).alias("_frame")))
    seat = both.groupBy(match, order).agg(F.max("_cut").alias("_cut"), F.sum("_frame").alias("_frames"))
    found = greatest_up_to(seat, [match], order, {"cut_frame": "_cut"}).where("_frames > 0")
    return found.select(match, order, "cut_frame", F.explode(F.sequence(F.lit(1), F.col("_frames")))).select(match, order, "cut_frame")
