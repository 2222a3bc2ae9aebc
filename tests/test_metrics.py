"""Progress, counts, staged starts, and playlists that lead to others."""

import time

import pytest
from pyspark.sql import functions as F

from reelspark.operators import playlist
from reelspark.streaming import metrics


def source(spark, path, n, files=2):
    for k in range(files):
        spark.range(k * n, (k + 1) * n, 1, 1).write.mode("append").parquet(path)
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)


def test_progress_and_order(spark, tmp_path):
    stream = source(spark, str(tmp_path / "in"), 10)
    started = []

    def start(name):
        def begin():
            started.append((name, time.time()))
            rows = metrics.counted(stream, name, even=F.col("id") % 2 == 0)
            return rows.writeStream.queryName(name).format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"c{name}")).trigger(availableNow=True).start()

        return begin

    with metrics.ProgressTable(spark, str(tmp_path / "progress"), each=1) as table:
        first, second = metrics.staged(start("one"), start("two"), timeout=60)
        first.awaitTermination(), second.awaitTermination()
        assert metrics.settled(table, 2, 30)
    got = table.read().where("input_rows > 0").collect()
    assert sorted((r.name, r.input_rows, r.counts["rows"], r.counts["even"]) for r in got) == [(n, 10, 10, 5) for n in ("one", "one", "two", "two")]
    assert [n for n, _ in started] == ["one", "two"] and min(r.at.timestamp() for r in got if r.name == "two") >= min(r.at.timestamp() for r in got if r.name == "one")


def test_a_first_query_that_fails_starts_no_other(spark, tmp_path):
    stream = source(spark, str(tmp_path / "in"), 3, 1).withColumn("bad", F.raise_error(F.lit("broken")).cast("string"))
    start = lambda: stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).queryName("broken").trigger(availableNow=True).start()

    def never():
        raise AssertionError

    with metrics.ProgressTable(spark, str(tmp_path / "progress")) as table:
        with pytest.raises(Exception, match="broken"):
            metrics.staged(start, never, timeout=60)
        assert metrics.settled(table, 1, 30)
    assert [(r.name, "broken" in r.error) for r in table.read().where("error is not null").collect()] == [("broken", True)]


def test_live_through_any_number_of_lists(spark):
    master = "#EXT-X-STREAM-INF:RESOLUTION=9x9\n{}"
    rows = [(f"m{i}", f"http://h/m{i}", master.format(f"m{i + 1}")) for i in range(21)] + [("m21", "http://h/m21", "#EXT-X-PLAYLIST-TYPE:EVENT")]
    rows += [(f"r{i}", f"http://h/r{i}", master.format(f"r{(i + 1) % 5}")) for i in range(5)] + [("self", "http://h/self", master.format("self")), ("in", "http://h/in", master.format("r2"))]
    rows += [("gone", "http://h/gone", master.format("nowhere")), ("none", "http://h/none", None), ("plain", "http://h/plain", "a.ts"), ("over", "http://h/over", "a.ts\n#EXT-X-ENDLIST"), ("to", "http://h/to", master.format("over"))]
    rows += [("z", "http://h/plain", "#EXT-X-ENDLIST"), ("dup", "http://h/dup", master.format("plain"))]
    df = spark.createDataFrame(rows, "k string, url string, body string")
    got = {r.k: r.is_live for r in playlist.is_live_resolved(playlist.lines(df, "k", "body"), df, "k", "url").collect()}
    live = {f"m{i}" for i in range(22)} | {"plain", "dup"}
    assert got == {k: k in live for k, _, _ in rows}
    assert playlist.is_live_resolved(playlist.lines(df, "k", "body").limit(0), df.limit(0), "k", "url").count() == 0
