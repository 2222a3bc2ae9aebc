"""Frames of a stream held in groups: as many calls of Python as groups, whatever the number of frames."""

import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from reelspark.operators.detections import MODELS
from reelspark.streaming import sync

FRAME = "match_id string, f int, t timestamp, at timestamp"


def test_state_is_kept_for_groups_and_gives_all_frames(spark, tmp_path):
    """Keys that are null, times of a microsecond, doubles that JSON has no number for; half of the answers come a batch later, one frame's never."""
    start = datetime(2024, 1, 1)
    frames = [("m" if f % 9 else None, f if f % 7 else None, start + timedelta(microseconds=f), start + timedelta(seconds=f)) for f in range(2000)]
    answer = lambda row, k: (*row, MODELS[k], [[0.1 + row[2].microsecond, math.inf], None], [None, -0.0], None if k else [math.nan])
    answers = [answer(row, k) for row in frames[1:] for k in range(len(MODELS))]
    kinds = FRAME + ", model string, boxes array<array<double>>, confidences array<double>, classes array<double>"
    far = [("m", 1, start, start + timedelta(days=9))]
    for name, schema, files in (("f", FRAME, (frames[:1000], frames[1000:], far)), ("a", kinds, (answers[::2], answers[1::2]))):
        for rows in files:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    wide = sync.synchronised(read("f", FRAME), read("a", kinds), ["match_id", "f", "t"], "at", 1000, lateness="1 day", buckets=10)
    query = wide.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) == 10
    got = spark.read.schema(wide.schema).parquet(str(tmp_path / "out"))
    rows = {r.t: r for r in got.collect()}
    assert len(rows) == got.count() == 2000 and sorted(t for t, r in rows.items() if not r.complete) == [start]
    for match, f, t, _ in frames[1:]:
        r = rows[t]
        assert (r.match_id, r.f) == (match, f)
        for k, m in enumerate(MODELS):
            assert r[f"{m}_boxes"] == [[0.1 + t.microsecond, math.inf], None] and r[f"{m}_confidences"][0] is None and math.copysign(1, r[f"{m}_confidences"][1]) == -1
            assert r[f"{m}_classes"] is None if k else math.isnan(r[f"{m}_classes"][0])
    assert all(rows[start][f"{m}_boxes"] == [] for m in MODELS) and got.where(F.size(f"{MODELS[0]}_boxes") == 0).count() == 1
