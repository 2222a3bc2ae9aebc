"""Streams over tables of many files, whose times of modification are in no order."""

import random
from pathlib import Path

import pytest

from reelspark.plans import catalogue
from reelspark.streaming import sinks
from reelspark.streaming.source import in_order


@pytest.mark.parametrize("name,table,order", [("stream_cuts", "embeddings", "vec_id"), ("stream_cuts_strict", "embeddings", "vec_id"), ("stream_debounce", "events", "ts"), ("stream_frame_numbering", "events", "ts")])
def test_a_folder_of_files_gives_what_one_file_gives(spark, sf_dir, tmp_path, name, table, order):
    """Ten files, the last rows written first: the source takes eight a batch."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").toPandas().sort_values(order, ascending=False)
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    for k in range(10):
        spark.createDataFrame(rows.iloc[k * len(rows) // 10 : (k + 1) * len(rows) // 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"{table}.parquet"))
    run = catalogue.queries()[name]
    got, want = (sorted(map(tuple, run(spark, str(folder)).collect())) for folder in (tmp_path, Path(sf_dir)))
    assert got == want and got


def test_batches_are_ranges_in_order(spark):
    r = random.Random(5)
    rows = [(k, "x") for k in range(100)] + [(7, "again")] * 5 + [(None, "null")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k long, batch string")
    seen = []
    for n, each in enumerate((10, 1000)):
        seen.append([])
        query = in_order(df, df.k, each).writeStream.foreachBatch(lambda b, _, n=n: seen[n].append(b.collect())).trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted((x.k is not None, x.k or 0, x.batch) for b in seen[n] for x in b) == sorted((k is not None, k or 0, b) for k, b in rows)
        numbers = [[-1 if x.k is None else x.k for x in b] for b in seen[n]]
        assert all(max(a) < min(b) for a, b in zip(numbers, numbers[1:]))
    assert len(seen[0]) >= 8 and len(seen[1]) == 2
    assert sinks.collected(in_order(df.limit(0), df.k), spark).count() == 0
