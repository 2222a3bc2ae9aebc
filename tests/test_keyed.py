"""The keyed table over restarts, repeated batches, kills between data and manifest, and many versions."""

import pytest
from pyspark.sql import functions as F

from reelspark.streaming import keyed

SCHEMA = "k string, seq int, v string"


def rows(spark, *what):
    return spark.createDataFrame(list(what), SCHEMA)


def state(spark, path):
    return {r.k: r.v for r in keyed.KeyedTable(spark, path, ["k"]).read().collect()}


def test_a_restart_goes_on_from_the_last_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    assert keyed.KeyedTable(spark, path, ["k"]).read() is None and keyed.KeyedTable(spark, path, ["k"]).rejected() is None
    assert keyed.KeyedTable(spark, path, ["k"]).upsert(rows(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n")), 0, ["seq"])
    assert keyed.KeyedTable(spark, path, ["k"]).upsert(rows(spark, ("c", 1, "w"), (None, 2, "m")), 1, ["seq"])
    assert state(spark, path) == {"a": "y", "b": "z", "c": "w", None: "m"}
    assert not keyed.KeyedTable(spark, path, ["k"]).upsert(rows(spark, ("c", 9, "again")), 1, ["seq"])  # run again after its commit
    assert not keyed.KeyedTable(spark, path, ["k"]).upsert(rows(spark, ("c", 9, "again")), 0, ["seq"])
    assert keyed.KeyedTable(spark, path, ["k"]).upsert(rows(spark, ("b", 1, "other query")), 0, ["seq"], "second")
    assert state(spark, path) == {"a": "y", "b": "other query", "c": "w", None: "m"}


def test_a_kill_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table = keyed.KeyedTable(spark, path, ["k"], F.col("v") != "bad")
    table.upsert(rows(spark, ("a", 1, "x")), 0, ["seq"])

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(table.files, "publish", killed)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(rows(spark, ("a", 2, "y"), ("b", 1, "bad")), 1, ["seq"])
    assert state(spark, path) == {"a": "x"}
    again = keyed.KeyedTable(spark, path, ["k"], F.col("v") != "bad")
    assert again.upsert(rows(spark, ("a", 2, "y"), ("b", 1, "bad")), 1, ["seq"])
    assert state(spark, path) == {"a": "y"} and [r.k for r in keyed.KeyedTable(spark, path, ["k"], F.col("v") != "bad").rejected().collect()] == ["b"]


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    table.upsert(rows(spark, *[(f"k{i}", 1, "x") for i in range(100)]), 0, ["seq"])
    first = table.manifest()
    table.upsert(rows(spark, ("k5", 2, "y")), 1, ["seq"])
    second = table.manifest()
    assert len(first["folders"]) == 8 and sum(first["folders"][b] != second["folders"][b] for b in first["folders"]) == 1
    assert table.read().count() == 100 and table.read(0).where("v = 'y'").count() == 0
    for n in range(2, 6):
        table.upsert(rows(spark, (f"k{n}", 2, "z")), n, ["seq"])
    assert table.vacuum(1) > 0 and table.versions() == [5] and table.read().count() == 100 and {r.v for r in table.read().where("k in ('k2', 'k5')").collect()} == {"z"}
    table.upsert(spark.createDataFrame([("new", 1, "w", 7)], SCHEMA + ", extra int"), 6, ["seq"])
    table.upsert(rows(spark, ("k1", 3, "narrow")), 7, ["seq"])
    assert {r.extra for r in table.read().collect()} == {None, 7} and table.read().count() == 101


def test_two_writers_of_one_version(spark, tmp_path):
    one = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"])
    one.upsert(rows(spark, ("a", 1, "x")), 0, ["seq"])
    one.manifest = lambda *_: {"version": -1, "buckets": 4, "folders": {}, "done": {}, "rejected": False, "schema": None}  # as it was before the other's commit
    with pytest.raises(RuntimeError):
        one.upsert(rows(spark, ("a", 2, "y")), 1, ["seq"])
    assert state(spark, str(tmp_path / "t")) == {"a": "x"}


def test_a_killed_query_starts_again(spark, tmp_path):
    """The second query finds the first one's checkpoint: batches that are in the table already change nothing."""
    path, source = str(tmp_path / "t"), str(tmp_path / "in")
    for n in range(3):
        rows(spark, (f"k{n}", n, "x"), ("all", n, str(n))).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        keyed.upsert_stream(stream, keyed.KeyedTable(spark, path, ["k"]), ["seq"], str(tmp_path / "c")).awaitTermination()
    assert state(spark, path) == {"k0": "x", "k1": "x", "k2": "x", "all": "2"} and keyed.KeyedTable(spark, path, ["k"]).versions() == [0, 1, 2]
