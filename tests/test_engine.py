"""Functions and operators on the fixtures, streaming twins, the registered queries against DuckDB, and the entry without its optional parts."""

import random
import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelspark import analyzers, folders
from reelspark.functions import arrays as A
from reelspark.functions import numeric as N
from reelspark.functions import text as T
from reelspark.operators import cuts, detections, frames, playlist
from reelspark.plans import catalogue
from reelspark.sources import messages, playlists, probes
from reelspark.streaming import sinks, state

ROOT = Path(__file__).resolve().parents[1]


def values(spark, column, rows, kind):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}").orderBy("i").select(column(F.col("x"))).collect()]


def test_text(spark):
    assert values(spark, T.segment_number, ["v_480p_00012.ts", "12.ts", "x_y.ts", None], "string") == [12, 12, None, None]
    assert values(spark, T.base_url, ["http://h/a/b.m3u8", "b", ""], "string") == ["http://h/a", "b", ""]
    assert values(spark, T.resolution, ["#X:RESOLUTION=854x480", "#X", None], "string") == [854 * 480, None, None]
    join = lambda x: T.url_join(F.lit("https://h.tv/a/b.m3u8?t=1/2"), x)
    assert values(spark, join, ["c.ts", "/c.ts", "http://x/c.ts", "//x/c.ts", "", "../d/./c.ts", "../../..", None], "string") == ["https://h.tv/a/c.ts", "https://h.tv/c.ts", "http://x/c.ts", "https://x/c.ts", "https://h.tv/a/b.m3u8?t=1/2", "https://h.tv/d/c.ts", "https://h.tv/", None]
    assert values(spark, lambda x: T.naive_join(F.lit("b"), x), ["c", "http://d"], "string") == ["b/c", "http://d"]
    assert values(spark, T.queue_region, ["https://sqs.eu-west-1.example.com/q", "x"], "string") == ["eu-west-1", None]


def test_numbers(spark):
    assert values(spark, N.frame_rate, ["25/1", "30000/1001", "0/0", "x"], "string") == [25.0, 29.97003, 0.0, None]
    assert values(spark, N.half_even, [2.675, 0.125, 0.375, -0.125, 1.005], "float") == [2.67, 0.12, 0.38, -0.12, 1.0]
    code = lambda form, fps=25: values(spark, lambda x: N.timecode(x, F.lit(fps), form), [0, 90137], "bigint")
    assert code("HH:MM:SS.mmm") == ["00:00:00.000", "01:00:05.480"] and code("HH:MM:SS") == ["00:00:00", "01:00:05"] and code("Seconds") == ["0.000", "3605.480"]
    assert code("HH_MM_SS") == ["00_00_00", "01_00_05"] and code("HH_MM_SS_mmm") == ["00_00_0.000", "01_00_5.480"] and code("other") == [None, None] and code("Seconds", 0) == ["00:00:00.000"] * 2
    one = spark.sql("select array(1f, 2f, 3f) a, array(2f, 4f, 6.5f) b, array(1f, 1f, 1f) c")
    row = one.select(N.correlation(F.col("a"), F.col("b")).alias("x"), N.correlation(F.col("a"), F.col("c")).alias("y"), N.hamming(F.lit(5), F.lit(6)).alias("h")).first()
    assert 0.99 < row.x < 1 and row.y is None and row.h == 2


def test_arrays(spark):
    df = spark.sql("select array(array(1f), array(2f), array(3f)) boxes, array(.5f, .6f, .7f) confidences, array(0f, 2f, 0f) classes")
    row = detections.person_only(df).first()
    assert row.boxes == [[1.0], [3.0]] and row.classes == [0.0, 0.0]
    assert df.select(A.remap(F.array(F.lit(0), F.lit(17), F.lit(32), F.lit(5)), detections.REMAP)).first()[0] == [1, 2, 0, None]


MASTER = "#EXTM3U\n#EXT-X-STREAM-INF:RESOLUTION=854x480\nv_480p.m3u8\n#EXT-X-STREAM-INF:BANDWIDTH=1,RESOLUTION=1920x1080\nv_1080p.m3u8\n#EXT-X-STREAM-INF:RESOLUTION=1080x1920\nlast.m3u8\n#EXT-X-STREAM-INF:RESOLUTION=9x9"


def test_playlists(spark):
    rows = [("m", MASTER), ("live", "#EXTINF:6.006,\r\ns_1.ts\r\n#EXTINF:4,\n#EXTINF:5.5,"), ("event", "#EXT-X-PLAYLIST-TYPE:EVENT"), ("vod", "#EXT-X-PLAYLIST-TYPE:EVENT\n#EXT-X-ENDLIST"), ("none", ""), ("null", None)]
    df = spark.createDataFrame(rows, "k string, body string")
    lines = playlist.lines(df, "k", "body")
    assert [tuple(r) for r in playlist.best_variant(lines, "k").collect()] == [("m", 1920 * 1080, "v_1080p.m3u8")]
    assert {r.k: r.is_live for r in playlist.is_live(lines, "k").collect()} == {"m": None, "live": True, "event": True, "vod": False, "none": True}
    total = {r.k: (r.seconds, r.segments) for r in playlist.total_duration(df, "k", "body").collect()}
    assert total["live"] == (pytest.approx(15.506), 3) and total["none"] == (0.0, 0)
    assert {r.k: r.url for r in playlist.with_suffix(lines, "k", "_480p.m3u8").collect()}["m"] == "v_480p.m3u8"


def greedy(xs, gap):
    kept = []
    for x in sorted(set(xs)):
        if not kept or x - kept[-1] >= gap:
            kept.append(x)
    return kept


def test_debounce(spark):
    r = random.Random(1)
    data = {"a": [1, 5, 26, 27, 60], "b": [r.randrange(3000) for _ in range(400)], "c": [7, 7, 7]}
    df = spark.createDataFrame([(k, x) for k, v in data.items() for x in v], "k string, x long")
    got = cuts.debounce(df, "k", "x", 25).collect()
    assert {k: sorted(g.x for g in got if g.k == k) for k in data} == {k: greedy(v, 25) for k, v in data.items()}
    assert greedy(data["a"], 25) == [1, 26, 60] and cuts.debounce(df.limit(0), "k", "x", 25).count() == 0


def test_cut_predicate(spark):
    rows = [(None, None), (19, 0.1), (20, 0.9), (20, 0.899), (20, None), (20, float("nan"))]
    got = spark.createDataFrame(rows, "hamming int, correlation double").select(cuts.is_cut()).collect()
    assert [g[0] for g in got] == [False, False, False, True, True, True]


def test_shots_and_latest_cut(spark):
    f = spark.createDataFrame([("m", i) for i in range(1, 7)], "match_id string, frame_number long")
    c = spark.createDataFrame([("m", 3), ("m", 5)], "match_id string, frame_number long")
    assert [r.shot_id for r in cuts.shots(f, c, "match_id", "frame_number").orderBy("frame_number").collect()] == [1, 1, 2, 2, 3, 3]
    assert [r.cut_frame for r in cuts.latest_cut(f, c, "match_id", "frame_number").orderBy("frame_number").collect()] == [None, None, 3, 3, 5, 5]


def test_probed_frames(spark):
    rows = [("m", "http://h/v_480p_00001.ts", 1, '{"frames":[{"pkt_pts_time":"0.00"},{},{"pkt_pts_time":"0.08"}]}'), ("m", "v_480p_00002.ts", 2, None), ("m", "v_480p_00003.ts", 3, '{"frames":[{"pkt_pts_time":"0.16"},{"pkt_pts_time":"0.20"}]}'), ("m", "v_480p_00004.ts", 4, "no json")]
    got = probes.probed_frames(spark.createDataFrame(rows, "match_id string, segment string, arrival int, json string")).orderBy("frame_number").collect()
    assert [(r.segment_number, r.ts_frame, r.frame_number) for r in got] == [(1, 0, 1), (1, 2, 2), (3, 0, 3), (3, 1, 4)]


def test_resume(spark):
    rows = spark.createDataFrame([("m", s, f) for s, f in [(1, 1), (1, 2), (1, 3), (2, 4), (2, 5), (2, 6), (3, 7), (3, 8)]], "m string, segment_number int, frame_number long")
    first = lambda df: tuple(df.select("segment_number", "frame_number").first())
    assert first(frames.resume_latest(rows, "m")) == (3, 7) and first(frames.resume_before_latest(rows, "m")) == (3, 7)
    one = rows.where("segment_number = 1")
    assert first(frames.resume_latest(one, "m")) == (1, 1) and first(frames.resume_before_latest(one, "m")) == (2, 4)
    newest = frames.newest(rows, "m", ["frame_number"], 2)
    assert first(frames.resume_latest(newest, "m")) == (3, 7) and first(frames.resume_before_latest(newest, "m")) == (4, 9)
    match = rows.select("m").distinct()
    assert first(frames.with_default(match, frames.resume_latest(rows.limit(0), "m"), "m", F.lit(True), 0)) == (0, 1)
    assert first(frames.with_default(match, frames.resume_latest(rows, "m"), "m", F.lit(False), 0)) == (0, 1)


def test_merge_models(spark):
    rows = [("m", 1, x, [[1.0]], [0.5], [0.0]) for x in detections.MODELS] + [("m", 2, detections.MODELS[0], [[2.0]], [0.5], [0.0])]
    d = spark.createDataFrame(rows, "match_id string, frame_number long, model string, boxes array<array<float>>, confidences array<float>, classes array<float>")
    every = spark.createDataFrame([("m", 1), ("m", 2), ("m", 3)], "match_id string, frame_number long")
    got = {r.frame_number: r for r in detections.merge_models(every, d, ["match_id", "frame_number"]).collect()}
    assert got[1].cricket_model_boxes == [[1.0]] and got[2].cricket_model_boxes == [] and got[3].person_head_model_classes == []


def batches(spark, tmp_path, rows, schema, n):
    for k in range(n):
        spark.createDataFrame(rows[k::n] if n == 1 else rows[k * len(rows) // n : (k + 1) * len(rows) // n], schema).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in"))


@pytest.mark.parametrize("n", [1, 4])
def test_streaming_state_equals_batch(spark, tmp_path, n):
    rows = [("ab"[i % 2], i * 7 % 13 + 13 * (i // 13)) for i in range(104)]
    stream = batches(spark, tmp_path, rows, "k string, x long", n)
    kept = sinks.collected(state.debounce(stream, "k", "x", 9), spark).collect()
    assert {k: sorted(r.x for r in kept if r.k == k) for k in "ab"} == {k: greedy([x for j, x in rows if j == k], 9) for k in "ab"}
    numbered = sinks.collected(state.number_rows(stream, "k", ["x"]), spark).collect()
    assert {(r.k, r.frame_number, r.x) for r in numbered} == {(k, i + 1, x) for k in "ab" for i, x in enumerate(sorted(x for j, x in rows if j == k))}


def test_keyed_upserts_are_idempotent(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), ["k"])
    one = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, seq int, v string")
    for _ in range(2):
        table.upsert(one, 0, ["seq"])
    for _ in range(2):
        table.upsert(spark.createDataFrame([("b", 5, "w")], "k string, seq int, v string"), 1, ["seq"])
    assert {r.k: r.v for r in table.read().collect()} == {"a": "y", "b": "w"}


def test_growing_playlist(spark, tmp_path):
    path = tmp_path / "list.m3u8"
    spark.dataSource.register(playlists.PlaylistStream)

    def step():
        query = spark.readStream.format("playlist").load(str(path)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start()
        query.processAllAvailable() if query.isActive else None
        query.awaitTermination()

    path.write_text("#EXTINF:1,\na.ts\nb.ts\n")
    step()
    path.write_text("#EXTINF:1,\nb.ts\nc.ts\n")  # a has left the top of the list
    step()
    path.write_text("#EXTINF:1,\nb.ts\nc.ts\nd.ts\n#EXT-X-ENDLIST\ne.ts\n")
    step()
    step()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("position").collect()
    assert [(r.position, r.segment) for r in got] == list(enumerate(["a.ts", "b.ts", "c.ts", "d.ts"])) and got[0].url == str(tmp_path / "a.ts")


def test_playlist_offsets_and_idle_timeout(tmp_path):
    path = tmp_path / "list.m3u8"
    path.write_text("a.ts\nhttp://x/b.ts\n")
    reader = playlists.PlaylistReader(str(path), "http://h/live/list.m3u8", idle=1000)
    rows, end = reader.read(reader.initialOffset())
    assert [r[3] for r in rows] == ["http://h/live/a.ts", "http://x/b.ts"]
    path.write_text("")
    assert [r[1:3] for r in reader.readBetweenOffsets(reader.initialOffset(), end)] == [(0, "a.ts"), (1, "http://x/b.ts")]  # run again after the list has gone
    assert list(reader.read(end)[0]) == [] and reader.read(end)[1] == end
    reader.latest -= 1001
    with pytest.raises(TimeoutError):
        reader.read(end)
    path.write_text("c.ts")
    assert [r[2] for r in reader.read(end)[0]] == ["c.ts"]


def polls(tmp_path, texts, **how):
    """Segments given by each poll of a list that changes."""
    path, given, end = tmp_path / "list.m3u8", [], None
    reader = playlists.PlaylistReader(str(path), "http://h/live/list.m3u8", **how)
    end = reader.initialOffset()
    for text in texts:
        path.unlink(missing_ok=True) if text is None else path.write_text(text)
        rows, end = reader.read(end)
        given.append([(r[1], r[2]) if r[4] is None else "error" for r in rows])
    return given, end


def test_a_url_is_given_once(tmp_path):
    given, _ = polls(tmp_path, ["a.ts\nb.ts", "b.ts\nc.ts", "a.ts\n../live/c.ts\nd.ts"])
    assert given == [[(0, "a.ts"), (1, "b.ts")], [(2, "c.ts")], [(3, "d.ts")]]


def test_admission_keeps_the_rest(tmp_path):
    given, end = polls(tmp_path, ["a.ts\nb.ts\nc.ts\nd.ts\ne.ts", "e.ts", "", "f.ts\n#EXT-X-ENDLIST", ""], most=2)
    assert given == [[(0, "a.ts"), (1, "b.ts")], [(2, "c.ts"), (3, "d.ts")], [(4, "e.ts")], [(5, "f.ts")], []] and end["ended"]


def test_an_ended_playlist_is_no_timeout(tmp_path):
    given, end = polls(tmp_path, ["a.ts\n#EXT-X-ENDLIST", None, None], idle=-1)
    assert given == [[(0, "a.ts")], [], []] and end["ended"] and not end["left"]


def test_polls_that_fail(tmp_path):
    with pytest.raises(OSError):
        polls(tmp_path, [None])
    given, end = polls(tmp_path, ["a.ts", None, "b.ts"], errors=True)
    assert given == [[(0, "a.ts")], ["error"], [(1, "b.ts")]] and end["failed"] == 1


def test_a_playlist_after_what_is_known(tmp_path):
    assert polls(tmp_path, ["a.ts\nb.ts\nc.ts", "c.ts\nd.ts"], after=2)[0] == [[(2, "c.ts")], [(3, "d.ts")]]


def test_a_query_stops_at_the_end(spark, tmp_path):
    path = tmp_path / "list.m3u8"
    path.write_text("a.ts\nb.ts\nc.ts\n#EXT-X-ENDLIST")
    spark.dataSource.register(playlists.PlaylistStream)
    stream = spark.readStream.format("playlist").option("maxSegments", 2).option("idleTimeout", 0).load(str(path))
    sizes = []
    query = stream.writeStream.foreachBatch(lambda b, _: sizes.append(sorted(r.segment for r in b.collect()))).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()
    assert playlists.until_end(query, timeout=60) and query.exception() is None
    assert [x for x in sizes if x] == [["a.ts", "b.ts"], ["c.ts"]]


def test_json_messages(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"matchId": "1", "streamUrl": "u", "streamStatus": "started",\n "game": {"id": "g"}}')
    row = messages.from_json(spark, str(tmp_path / "m.json")).first()
    assert row.matchId == "1" and row.game.id == "g" and row.league is None
    (tmp_path / "bad.json").write_text("{")
    for bad in ("bad.json", "gone.json"):
        with pytest.raises(Exception):
            messages.from_json(spark, str(tmp_path / bad)).collect()


def test_camera_cuts_carry_their_state(spark, tmp_path):
    rows = [("ab"[i % 2], i, None if i % 11 == 5 else (-1 if i // 6 % 2 else 0), [float(i % 5), 1.0, float(i // 6 % 2)]) for i in range(96)]
    schema = "k string, at long, bits long, vector array<double>"
    got = []
    for n in (1, 4):
        (tmp_path / str(n)).mkdir()
        stream = batches(spark, tmp_path / str(n), rows, schema, n)
        got.append(sorted(map(tuple, sinks.collected(state.camera_cuts(stream, "k", "at", 4), spark).collect())))
    frames_ = spark.createDataFrame([r for r in rows if r[2] is not None], schema)
    numbered = frames.number_frames(frames_.withColumn("s", F.lit(1)), "k", "s", ["at"], F.lit(True))
    kept = cuts.debounce(cuts.compared(numbered, "k").where(cuts.is_cut()), "k", "frame_number", 4)
    assert got[0] == got[1] == sorted((r.k, r.frame_number - 1, r.frame_number) for r in kept.collect()) and got[0]


def test_batches_keep_their_size():
    made = [pd.DataFrame({"x": range(a, b)}) for a, b in ((0, 3), (3, 4), (4, 13), (13, 13))]
    got = [b.x.tolist() for b in analyzers.of_size(iter(made), 5)]
    assert [len(b) for b in got] == [5, 5, 3] and sum(got, []) == list(range(13))


def test_folders_need_the_setting_on_a_cluster(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**{k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(ValueError):
        folders.shared_root(Session(spark_master="yarn"))
    assert folders.shared_root(Session(spark_master="local[2]")) and folders.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_messages(spark):
    row = messages.from_environment(spark, {"MATCH_ID": "1", "STREAM_URL": "u"}).first()
    assert row.streamStatus == "started" and row.game.id is None
    assert messages.started(messages.from_environment(spark, {"STREAM_STATUS": "ended"})).count() == 0


class Count(analyzers.Analyzer):
    def transform(self, frames):
        return frames.groupBy("match_id").agg(F.count("*").alias("n"))


def test_analyzers(spark):
    f = spark.createDataFrame([("m", i) for i in range(10)], "match_id string, frame_number long")

    class Fake(analyzers.InferenceAnalyzer):
        def load(self):
            return lambda b: pd.DataFrame({"match_id": b.match_id, "frame_number": b.frame_number, "object_label": "ball", "confidence": b.frame_number / 10, "bbox": [[1, 2, 3, 4]] * len(b)})

    registry = {"OD": Fake, "N": Count}
    got = analyzers.run([{"analyzer_type": "OD", "streamUrl": "u", "matchId": "m", "threshold": "0.5"}, {"analyzer_type": "N", "streamUrl": "u", "matchId": 5}], registry, f).collect()
    assert [r.frame_number for r in got if r.request == 0] == [5, 6, 7, 8, 9] and [r.n for r in got if r.request == 1] == [10]
    for bad in ({"analyzer_type": "x", "streamUrl": "u", "matchId": 1}, {"analyzer_type": "OD", "streamUrl": "", "matchId": 1}, {"analyzer_type": "OD", "streamUrl": "u", "matchId": 0}):
        with pytest.raises(ValueError):
            analyzers.run([bad], registry, f)


def rows_of(df):
    tidy = df.copy()
    for c in tidy:
        if tidy[c].dtype.kind == "f":
            tidy[c] = tidy[c].round(5)
    return sorted(map(str, tidy.astype(object).where(tidy.notna(), None)[sorted(tidy)].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_duckdb(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {t.stem} as select * from '{t}'")
    got, want = catalogue.queries()[name](spark, sf_dir).toPandas(), con.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got) == sorted(want) and rows_of(got) == rows_of(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_optional_parts(tmp_path):
    for p in ("__spark_entry__.py", "reelspark"):
        subprocess.run(["cp", "-r", str(ROOT / p), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "reelspark/llm")], check=True)
    code = "import __spark_entry__ as e; assert e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
