"""Running sums, running numbers and predecessors along an order, in two levels: no task holds all rows of a key.

Rows are cut into pieces of the sorted order. Each piece adds up its own rows, a scan over the pieces' totals (a row for each key and piece) gives what came before
each of them, and these offsets are joined back. A match of any length is spread over as many tasks as it has pieces.

Null keys make one key. Rows that are equal in all of ``order`` follow one another in an unspecified order. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.folders import stored

#: Width of a piece where places are whole numbers known beforehand.
PIECE = 4096


def free_names(df: DataFrame, *names: str) -> Iterator[str]:
    """Names like these that df lacks, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        yield name


def _joined_back(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of small, whose first columns are the keys under names of their own."""
    names = [f"key{i}" for i in range(len(keys))]
    renamed = small.toDF(*names, *small.columns[len(keys) :])
    return rows.join(renamed, reduce(lambda a, b: a & b, [rows[k].eqNullSafe(renamed[n]) for k, n in zip(keys, names, strict=True)])).drop(*names)


def _up_to_here(rows: DataFrame, keys: list[str], piece: str, seat: str, values: dict[str, str], how: Callable = F.sum, reverse: bool = False) -> DataFrame:
    """rows with the sum (or, with ``how``, the greatest) of each value (result name -> column) of the key's rows up to this one."""
    along = F.desc if reverse else F.asc
    inside = Window.partitionBy(*keys, piece).orderBy(along(seat)).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(along(piece)).rowsBetween(Window.unboundedPreceding, -1)
    own, before = ([*free_names(rows, *[f"{kind}{k}" for k in range(len(values))])] for kind in ("own", "before"))
    totals = rows.groupBy(*keys, piece).agg(*[how(c).alias(o) for c, o in zip(values.values(), own, strict=True)])
    offsets = totals.select(*keys, piece, *[how(o).over(earlier).alias(b) for o, b in zip(own, before, strict=True)])
    added = rows.select("*", *[how(c).over(inside).alias(o) for c, o in zip(values.values(), own, strict=True)])
    both = (lambda o, b: F.col(o) + F.coalesce(b, F.lit(0))) if how is F.sum else F.greatest
    out = _joined_back(added, offsets, [*keys, piece])
    return out.withColumns({name: both(o, b).cast("bigint") for name, o, b in zip(values, own, before, strict=True)}).drop(*own, *before)


def running(rows: DataFrame, keys: list[str], order: list[str | Column], sums: dict[str, Column]) -> DataFrame:
    """rows with the running sums (result name -> value of a row, whole numbers) of each key along ``order``.

    The rows are sorted by range and stored once, because the pieces (the tasks of the sort) must be the same for the totals and for the rows.
    """
    seat, piece, *parts = free_names(rows, "seat", "piece", *[f"part{k}" for k in range(len(sums))])
    valued = rows.withColumns(dict(zip(parts, sums.values(), strict=True)))
    along = [*map(F.col, keys), *[F.col(c) if isinstance(c, str) else c for c in order]]
    sorted_rows = stored(valued.repartitionByRange(*along).sortWithinPartitions(*along).withColumn(seat, F.monotonically_increasing_id()), "sorted")
    pieces = sorted_rows.withColumn(piece, F.shiftrightunsigned(seat, 33))
    return _up_to_here(pieces, keys, piece, seat, dict(zip(sums, parts, strict=True))).drop(seat, piece, *parts)


def numbered(rows: DataFrame, keys: list[str], order: list[str | Column], name: str) -> DataFrame:
    """rows with ``name``: 1-based place in the key along ``order``."""
    return running(rows, keys, order, {name: F.lit(1)})


def _in_pieces(rows: DataFrame, at: str, width: int) -> tuple[DataFrame, str]:
    (piece,) = free_names(rows, "piece")
    return rows.withColumn(piece, F.floor(F.col(at) / width).cast("bigint")), piece


def sums_up_to(rows: DataFrame, keys: list[str], at: str, values: dict[str, str], width: int = PIECE) -> DataFrame:
    """rows with the sums of the values (result name -> column) over the key's rows up to this one, in the order of ``at``, a whole number; a piece is ``width`` of its values wide."""
    pieces, piece = _in_pieces(rows, at, width)
    return _up_to_here(pieces, keys, piece, at, values).drop(piece)


def sums_from_here(rows: DataFrame, keys: list[str], at: str, values: dict[str, str], width: int = PIECE) -> DataFrame:
    """As ``sums_up_to``, over the rows from this one on."""
    pieces, piece = _in_pieces(rows, at, width)
    return _up_to_here(pieces, keys, piece, at, values, reverse=True).drop(piece)


def greatest_up_to(rows: DataFrame, keys: list[str], at: str, values: dict[str, str], width: int = PIECE) -> DataFrame:
    """As ``sums_up_to``, with the greatest value in place of the sum; null before the first value."""
    pieces, piece = _in_pieces(rows, at, width)
    return _up_to_here(pieces, keys, piece, at, values, how=F.max).drop(piece)


def with_previous(rows: DataFrame, keys: list[str], at: str, columns: dict[str, str], width: int = PIECE) -> DataFrame:
    """rows with columns (result name -> column) of the key's row before this one in the order of ``at`` (whole numbers, one row for each, gaps allowed); null for the first.

    Each piece gets a copy of the last row of the piece before it.
    """
    pieces, piece = _in_pieces(rows, at, width)
    last, following, copy = free_names(pieces, "last", "following", "copy")
    lasts = pieces.groupBy(*keys, piece).agg(F.max(at).alias(last))
    lasts = lasts.select(*keys, last, F.lead(piece).over(Window.partitionBy(*keys).orderBy(piece)).alias(following)).where(F.col(following).isNotNull())
    copies = _joined_back(pieces, lasts, [*keys, at]).withColumn(piece, F.col(following)).drop(following)
    both = pieces.withColumn(copy, F.lit(False)).unionByName(copies.withColumn(copy, F.lit(True)))
    before = Window.partitionBy(*keys, piece).orderBy(at)
    return both.withColumns({name: F.lag(c).over(before) for name, c in columns.items()}).where(~F.col(copy)).drop(piece, copy)
