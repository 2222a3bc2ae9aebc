"""Expressions over parallel arrays of detections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelspark.functions.numeric import decimal2


def zipped(boxes: str, confidences: str, classes: str) -> Column:
    return F.arrays_zip(F.col(boxes).alias("box"), F.col(confidences).alias("conf"), F.col(classes).alias("cls"))


def keep_classes(detections: Column, allowed: list[int]) -> Column:
    """Detections whose class, cut to an integer, is allowed."""
    return F.filter(detections, lambda d: d["cls"].cast("int").isin(allowed))


def unzipped(detections: Column) -> dict[str, Column]:
    return {k: _field(detections, k) for k in ("box", "conf", "cls")}


def _field(detections: Column, name: str) -> Column:
    return F.transform(detections, lambda d: d[name])


def remap(classes: Column, mapping: dict[int, int]) -> Column:
    """Mapped classes; null for one that the mapping lacks."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform(classes, lambda c: F.try_element_at(table, c.cast("int")))


def decimals(values: Column) -> Column:
    return F.transform(values, decimal2)


def nested_decimals(boxes: Column) -> Column:
    return F.transform(boxes, lambda b: F.transform(b, decimal2))


def at_least(detections: Column, confidence: float) -> Column:
    """Detections of this confidence or more."""
    return F.filter(detections, lambda d: d["conf"] >= confidence)


def counts_by_bin(values: Column, bins: int, limit: float) -> Column:
    """Counts of values in ``bins`` equal bins of [0, limit)."""
    at = F.transform(values, lambda v: F.floor(v.cast("double") * bins / limit).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(at, lambda x: x == b)))
