"""Two-level running numbers, sums and predecessors against plain Python, with keys that reach over many pieces."""

import random

import pytest
from pyspark.sql import functions as F

from reelspark.operators import ordered

SCHEMA = "k string, x long, v long, seat string"


def table(n=300):
    r = random.Random(3)
    return [(r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(40)]) if i % 5 else 7, r.randrange(9), f"{i:04}") for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_running(spark, partitions):
    rows = table()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ordered.running(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"], ["x", "seat"], {"n": F.lit(1), "s": F.col("v")}).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = []
    for k in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[3]))
        want += [(*r, i + 1, sum(x[2] for x in own[: i + 1])) for i, r in enumerate(own)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_running_of_nothing_and_clashing_names(spark):
    df = spark.createDataFrame(table(20), SCHEMA).withColumns({"piece": F.lit("p"), "part0": F.lit(1)})
    got = ordered.numbered(df, ["k"], [F.desc("x"), "seat"], "n")
    assert got.columns == [*df.columns, "n"] and got.count() == 20 and {r.piece for r in got.collect()} == {"p"}
    assert ordered.numbered(df.limit(0), ["k"], ["x"], "n").count() == 0


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_pieces_of_known_places(spark, width):
    r = random.Random(4)
    rows = [(k, i * step, r.randrange(100)) for k, n, step in (("a", 50, 1), ("b", 1, 1), ("c", 9, 7), (None, 5, 2)) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "k string, at long, v long").withColumns({"piece": F.lit("p"), "own0": F.lit(1), "copy": F.lit(2), "last": F.lit(3)})
    value = {(k, i): v for k, i, v in rows}
    of = lambda k, i, side: [v for (q, j), v in sorted(value.items(), key=str) if q == k and side(j, i)]
    for how, want in (
        (ordered.sums_from_here, lambda k, i: sum(of(k, i, int.__ge__))),
        (ordered.sums_up_to, lambda k, i: sum(of(k, i, int.__le__))),
        (ordered.greatest_up_to, lambda k, i: max(of(k, i, int.__le__))),
        (ordered.with_previous, lambda k, i: value.get((k, max((j for q, j in value if q == k and j < i), default=0)))),
    ):
        got = how(df, ["k"], "at", {"s": "v"}, width)
        assert got.columns == [*df.columns, "s"]
        got = got.collect()
        assert {(x.k, x.at): x.s for x in got} == {(k, i): want(k, i) for k, i in value} and len(got) == len(rows), how
