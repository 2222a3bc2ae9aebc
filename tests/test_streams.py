"""Streams that are put together, flushed and taken up again."""

import random
import time

from pyspark.sql import functions as F

from reelspark.operators import detections
from reelspark.operators.detections import MODELS
from reelspark.streaming import keyed, resume, sinks, sync

FRAME = "match_id string, frame_number long, at timestamp"
ANSWER = FRAME + ", model string, boxes array<array<double>>, confidences array<double>, classes array<double>"


def in_files(spark, path, rows, schema, files):
    """A stream that gives one file a batch, in order."""
    for k in range(files):
        spark.createDataFrame(rows[k * len(rows) // files : (k + 1) * len(rows) // files], schema).coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def seconds(n):
    from datetime import datetime, timedelta

    return datetime(2024, 1, 1) + timedelta(seconds=n)


def test_synchronised_models(spark, tmp_path):
    r = random.Random(6)
    frames = [("m", f, seconds(f)) for f in range(40)]
    answers = [("m", f, seconds(f), model, [[float(f), float(k)]], [0.5], [float(k)]) for f in range(45) for k, model in enumerate(MODELS) if (f + k) % 4]
    answers += [(*a[:4], [[9.0]], [0.1], [9.0]) for a in answers[:10]] + [("m", 3, seconds(3), "unknown", [[1.0]], [1.0], [1.0])]
    first = answers[:-11]
    r.shuffle(frames)
    r.shuffle(first)
    far = [("m", 10_000, seconds(10_000))]
    wide = sync.synchronised(in_files(spark, tmp_path / "f", frames + far, FRAME, 4), in_files(spark, tmp_path / "a", first + answers[-11:], ANSWER, 3), ["match_id", "frame_number"], "at", 1000, lateness="60 seconds")
    got = {row.frame_number: row for row in sinks.collected(wide, spark).collect()}
    plain = detections.merge_models(spark.createDataFrame(frames, FRAME), spark.createDataFrame(first, ANSWER), ["match_id", "frame_number"]).collect()
    assert sorted(got) == list(range(40)) and len(plain) == 40
    for want in plain:
        have = got[want.frame_number]
        assert all(have[c] == want[c] for c in want.asDict()) and have.complete == bool(want.cricket_model_boxes)
    assert {row.complete for row in got.values()} == {True, False}


def test_an_answer_later_than_the_wait_changes_nothing(spark, tmp_path):
    frames = [("m", 1, seconds(0)), ("m", 2, seconds(100)), ("m", 3, seconds(200)), ("m", 4, seconds(1000))]
    answers = [("m", 1, seconds(0), m, [[1.0]], [1.0], [1.0]) for m in MODELS[:2]] + [("m", 9, seconds(0), MODELS[0], [], [], [])] * 2
    answers = answers[:2] + [answers[2], ("m", 1, seconds(0), MODELS[2], [[1.0]], [1.0], [1.0])]
    wide = sync.synchronised(in_files(spark, tmp_path / "f", frames, FRAME, 4), in_files(spark, tmp_path / "a", [*answers[:2], *answers[2:3] * 5, answers[3]], ANSWER, 8), ["match_id", "frame_number"], "at", 1000)
    assert sorted((row.frame_number, row.complete) for row in sinks.collected(wide, spark).collect()) == [(1, False), (2, False), (3, False)]


ROWS = "k string, x long, last boolean"


def test_flushes_by_count_and_at_the_end(spark, tmp_path):
    rows = [(k, i, i == n - 1) for k, n in (("a", 30), ("b", 12), ("c", 1), (None, 5)) for i in range(n)]
    rows.sort(key=lambda row: row[1])
    got = sinks.collected(sync.flushed(in_files(spark, tmp_path, rows, ROWS, 5), "k", ["x"], every_ms=None, last="last"), spark).collect()
    sizes = {}
    for row in got:
        sizes.setdefault((row.k, row.flush, row.why), []).append(row.x)
    assert {k: len(v) for k, v in sizes.items()} == {("a", 1, "count"): 12, ("a", 2, "count"): 12, ("a", 3, "end"): 6, ("b", 1, "count"): 12, ("c", 1, "end"): 1, (None, 1, "end"): 5}
    assert sorted(sizes["a", 2, "count"]) == list(range(12, 24))


def test_an_idle_buffer_is_flushed(spark, tmp_path):
    stream = in_files(spark, tmp_path / "in", [("a", i, False) for i in range(14)], ROWS, 1)
    got = []
    query = sync.flushed(stream, "k", ["x"], every_ms=250).writeStream.foreachBatch(lambda b, _: got.extend((r.x, r.flush, r.why) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()
    began = time.time()
    while len(got) < 14 and time.time() - began < 60:
        time.sleep(0.2)
    query.stop()
    assert sorted(got) == [(i, 1, "count") for i in range(12)] + [(i, 2, "time") for i in (12, 13)]


def test_a_stream_goes_on_from_the_table(spark, tmp_path):
    schema = "m string, s int, x long"
    rows = [(m, x // 5, x) for x in range(23) for m in ("a", "b")] + [("new", 0, 0)]
    table = lambda: keyed.KeyedTable(spark, str(tmp_path / "t"), ["m", "x"], buckets=4)
    for k, n in enumerate((7, 26, 27, len(rows))):  # each life ends in the middle of a segment, and the next has an empty checkpoint
        stream = in_files(spark, tmp_path / f"in{k}", rows[:n], schema, 2)
        keyed.upsert_stream(resume.resumed(stream, table().read(), "m", "s", ["x"]), table(), ["frame_number"], str(tmp_path / f"c{k}")).awaitTermination()
    assert {(r.m, r.x): r.frame_number for r in table().read().collect()} == {(m, x): x + 1 for m, _, x in rows}
    late = resume.resumed(in_files(spark, tmp_path / "late", [("a", 5, 25), ("a", 5, 26)], schema, 2), table().read(), "m", "s", ["x"])
    assert {(r.x, r.frame_number) for r in sinks.collected(late, spark).collect()} == {(25, 24), (26, 25)}
