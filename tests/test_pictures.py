"""Raw frames, picture arithmetic and model files against plain Python."""

import colorsys
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.analyzers import models
from reelspark.functions import pictures as P
from reelspark.functions.numeric import correlation, sparse_correlation
from reelspark.operators.pictures import frame_features
from reelspark.sources.raw_frames import FrameReader, RawFrames


def image(r, h, w):
    return np.array([[[r.randrange(256) for _ in range(3)] for _ in range(w)] for _ in range(h)], np.uint8)


@pytest.mark.parametrize("each", [1, 3, 100])
def test_raw_frames(spark, tmp_path, each):
    r = random.Random(each)
    frames = {f"s_{k}.bgr": [bytes(r.randrange(256) for _ in range(2 * 3 * 3)) for _ in range(n)] for k, n in enumerate((7, 0, 1))}
    for name, own in frames.items():
        (tmp_path / name).write_bytes(b"".join(own) + b"short"[: len(own)])
    (tmp_path / "other.txt").write_bytes(bytes(100))
    (tmp_path / "folder.bgr").mkdir()
    spark.dataSource.register(RawFrames)
    read = spark.read.format("raw_frames").option("width", 3).option("height", 2).option("framesPerPartition", each).option("suffix", ".bgr")
    got = sorted((x.segment, x.ts_frame, bytes(x.frame)) for x in read.load(str(tmp_path)).collect())
    assert got == [(name, i, f) for name, own in sorted(frames.items()) for i, f in enumerate(own)]
    assert read.load(str(tmp_path / "s_0.bgr")).count() == 7
    assert len(FrameReader(str(tmp_path), 3, 2, each, ".bgr").partitions()) == sum(math.ceil(len(own) / each) for own in frames.values())
    with pytest.raises(ValueError):
        FrameReader(str(tmp_path), 0, 2, 1, "")


def test_hsv():
    r = random.Random(1)
    picture = np.concatenate((image(r, 20, 20), np.array([[[k, k, k] for k in range(0, 200, 10)]], np.uint8), np.array([[[255 * (k & 1), 255 * (k >> 1 & 1), 255 * (k >> 2)] for k in range(8)] + [[0, 0, 1]] * 12], np.uint8)))
    for (b, g, red), got in zip(picture.reshape(-1, 3).tolist(), P.hsv(picture).reshape(-1, 3).tolist(), strict=True):
        h, s, v = colorsys.rgb_to_hsv(red / 255, g / 255, b / 255)
        assert got[2] == v * 255 or abs(got[2] - v * 255) < 1e-9
        assert abs(got[1] - s * 255) <= 0.5 + 1e-9 and min(abs(got[0] - h * 180), 180 - abs(got[0] - h * 180)) <= 0.5 + 1e-9


@pytest.mark.parametrize("size,target", [((6, 4), (3, 2)), ((5, 7), (3, 4)), ((2, 2), (5, 6)), ((4, 4), (4, 4))])
def test_resized(size, target):
    r = random.Random(2)
    picture = image(r, *size)
    (h, w), (th, tw) = size, target
    overlap = lambda k, j, n, t: max(0.0, min((k + 1) * n / t, j + 1) - max(k * n / t, j))
    got = P.resized(picture, tw, th)
    for y in range(th):
        for x in range(tw):
            area = [(overlap(y, i, h, th) * overlap(x, j, w, tw), picture[i, j]) for i in range(h) for j in range(w)]
            assert np.allclose(got[y, x], sum(a * p.astype(float) for a, p in area) / sum(a for a, _ in area))


def test_perceptual_hash_and_bins():
    r = random.Random(3)
    picture = image(r, 12, 10)
    grey = P.resized((picture[..., 0] * 114.0 + picture[..., 1] * 587.0 + picture[..., 2] * 299.0) / 1000, 8, 8)
    band = [sum(grey[y, x] * math.cos(math.pi * u * (2 * y + 1) / 16) * math.cos(math.pi * w * (2 * x + 1) / 16) for y in range(8) for x in range(8)) for u in range(8) for w in range(8)]
    middle = sum(sorted(band)[31:33]) / 2
    bits = int("".join(str(int(c > middle)) for c in band), 2)
    assert P.perceptual_hash(picture, 8) % (1 << 64) == bits
    at, count = P.bins(picture, 5)
    want = {}
    for p in picture.reshape(-1, 3).tolist():
        k = (p[0] * 5 // 256 * 5 + p[1] * 5 // 256) * 5 + p[2] * 5 // 256
        want[k] = want.get(k, 0) + 1
    assert dict(zip(at.tolist(), count.tolist(), strict=True)) == want


def test_features_of_odd_frames(spark):
    r = random.Random(4)
    small, large = image(r, 4, 4), image(r, 8, 8)
    rows = [(0, 4, 4, bytearray(small.tobytes())), (1, 8, 8, bytearray(large.tobytes())), (2, 4, 4, bytearray(b"short")), (3, 4, 4, None), (4, None, 4, bytearray(small.tobytes()))]
    df = spark.createDataFrame(rows, "i int, width int, height int, frame binary")
    got = {x.i: x for x in frame_features(df, 4, 4).collect()}
    assert [got[k].bits is None for k in range(5)] == [False, False, True, True, True] and sum(got[1].counts) == 16
    assert got[1].bits == P.perceptual_hash(P.as_bytes(P.resized(large, 4, 4))) and frame_features(df.limit(0)).count() == 0


def test_sparse_correlation(spark):
    df = spark.sql("select array(1L, 3L) ka, array(2L, 5L) va, array(0L, 3L) kb, array(7L, 4L) vb, array(0d, 2d, 0d, 5d, 0d) a, array(7d, 0d, 0d, 4d, 0d) b")
    row = df.select(sparse_correlation(F.col("ka"), F.col("va"), F.col("kb"), F.col("vb"), 5).alias("x"), correlation(F.col("a"), F.col("b")).alias("y")).first()
    assert row.x == pytest.approx(row.y)


def test_model_files(spark):
    rows = [(i, "ab"[i % 2], [float(i % 2) + i / 100, 1.0, None if i == 3 else 0.5]) for i in range(10)] + [(10, None, [9.0, 9.0, 9.0]), (11, "a", None)]
    df = spark.createDataFrame(rows, "i long, label string, vector array<double>")
    content = models.fit_centroids(df, "label", "vector")
    labels, means = models.read_centroids(content)
    want = np.array([[np.mean([v[k] for _, x, v in rows if x == label and v and v[k] is not None]) for k in range(3)] for label in "ab"])
    assert labels == ["a", "b"] and np.allclose(means, want / np.linalg.norm(want, axis=1, keepdims=True))
    one, other = models.shipped(spark, content, "m.npz"), models.shipped(spark, content + b"x", "m.npz")
    assert one == models.shipped(spark, content, "m.npz") and one.name != other.name

    def reads(batches):
        opened = []
        for b in batches:
            opened += [len(one.opened(noted)), len(one.opened(noted)), len(other.opened(noted))]
            yield b.assign(size=opened[0], other=opened[2], times=len(calls))

    calls = []

    def noted(data):
        calls.append(1)
        return data

    got = spark.range(0, 30, 1, 3).mapInPandas(reads, "id long, size long, other long, times long").collect()
    assert {(x.size, x.other) for x in got} == {(len(content), len(content) + 1)} and {x.times for x in got} == {2}
    false = models.ModelFile(one.name, "0" * 64)
    with pytest.raises(ValueError):
        false.opened(noted)


def test_ranges_of_many_files_share_a_task(spark, tmp_path):
    for k in range(9):
        (tmp_path / f"s_{k}.bgr").write_bytes(bytes([k]) * (3 * 5 + 1))
    assert [len(p.ranges) for p in FrameReader(str(tmp_path), 1, 1, 2, "", 4).partitions()] == [4] * 6 + [3]
    spark.dataSource.register(RawFrames)
    read = spark.read.format("raw_frames").option("width", 1).option("height", 1).option("framesPerPartition", 2).option("rangesPerPartition", 4).load(str(tmp_path))
    assert sorted((x.segment, x.ts_frame, bytes(x.frame)) for x in read.collect()) == [(f"s_{k}.bgr", i, bytes([k]) * 3) for k in range(9) for i in range(5)]
    assert read.rdd.getNumPartitions() == 7


def test_picture_cuts_reads_its_pixels_once(spark, sf_dir):
    from reelspark.plans import pictures

    assert pictures.picture_cuts(spark, sf_dir)._jdf.queryExecution().toString().count("raw_frames") == 0
    assert "raw_frames" in pictures.raw_frames(spark, sf_dir)._jdf.queryExecution().toString()


#: Vectors as bytes, each pixel made of three as in ``plans.pictures``: two cosines in the middle are equal by arithmetic, and rounding alone decides. The first is one of 4,000,000 at random.
TIED = """6c7d84875e678e77879c75829a78809aa264827d806e77828192786b6d6581847987799489808db2938c96708b94888c7f859a7b817675736a7f897f827c7889
75729689867275757f797a7d6d8c936a78986a6f829c7070a1818e8292787591798094716b95a35b6384867b8897859374637b858375879385848b7d7a7c879d
72677d9e8d75888a767589798a7070748990796c6795736e767f787687718a7c8774989a8b758b7a63979c7183938d767d6f6c996a885f7981808184626d759d
79797e79796d789f7c8c9d8e7c8a788986738d897f996c83957d7677a47c6e6d986977817163837b9268897e86798278746b7270938d7898778f867275988852""".split()


@pytest.mark.parametrize("size", [8, 3, 16])
def test_cosines_are_added_from_the_last_pixel(size):
    r = random.Random(size)
    for grey in (np.array([[r.randrange(255001) / 1000 for _ in range(size)] for _ in range(size)]), np.full((size, size), 77.7)):
        wave = lambda u, k: math.cos(math.pi * u * (2 * k + 1) / (2 * size))
        want = [0.0] * 9
        for y in reversed(range(size)):
            for x in reversed(range(size)):
                want = [c + float(grey[y, x]) * 4 * wave(k // 3, y) * wave(k % 3, x) for k, c in enumerate(want)]
        assert P.slowest(grey, 3).tolist() == want


def test_picture_hash_of_equal_cosines(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from reelspark.plans import pictures

    vectors = [list(bytes.fromhex(x)) for x in TIED] + [[k] * 64 for k in range(0, 256, 5)] + [[200 * (i % 8 in (2, 5)) for i in range(64)]]
    spark.createDataFrame([(95 + i, [(x + 0.5) / 128 - 1 for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.sql("SET threads = 1")  # more may split a sum, and then its order is open
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("picture_hash", "picture_cuts"):
        got = sorted(map(tuple, pictures.queries()[name](spark, str(tmp_path)).collect()))
        assert got == sorted(con.sql(pictures.oracle_sql()[name]).fetchall()) and len(got) == len(vectors)
