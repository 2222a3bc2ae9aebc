"""A stream that goes on from what a table holds, without the checkpoint of the query that wrote it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.folders import stored
from reelspark.operators.frames import resume_latest
from reelspark.operators.ordered import free_names
from reelspark.streaming.state import number_rows


def resumed(rows: DataFrame, results: DataFrame | None, match: str, segment: str, order: list[str], name: str = "frame_number") -> DataFrame:
    """rows of a stream with running numbers, from each match's greatest stored segment on.

    ``results`` (match, ``segment``, ``name``; None before anything is stored) is read once, at the start. The segment that was being written when the last query ended may
    lack rows, so it is numbered again, from its first stored number on: into a table with one row for each frame this gives what one uninterrupted run gives. A source that begins behind it goes
    on after the last stored number. Earlier segments are passed over, whether the source offers them again or not; matches that aren't stored start with 1. Segments are ordered by ``segment`` and come in that order.
    """
    if results is None:
        return number_rows(rows, match, order, name)
    known, start, until, first, past = free_names(rows, "known", "start", "until", "first", "past")
    least = results.select(match, F.col(segment).alias("segment_number"), F.col(name).alias("frame_number"))
    last = least.groupBy(F.col(match).alias(known)).agg(F.max("frame_number").alias(past))
    latest = resume_latest(least, match).select(F.col(match).alias(known), F.col("segment_number").alias(until), (F.col("frame_number") - 1).alias(first))
    at = stored(latest.join(last, known), "resume")
    joined = rows.join(at, rows[match] == at[known], "left").where(F.col(until).isNull() | (F.col(segment) >= F.col(until)))
    placed = joined.withColumn(start, F.when(F.col(segment) > F.col(until), F.col(past)).otherwise(F.col(first)))
    return number_rows(placed.drop(known, until, first, past), match, order, name, start).drop(start)
