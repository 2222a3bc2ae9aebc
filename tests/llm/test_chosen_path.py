"""The chosen-path join against brute force: leaves, great nodes, what is still great at the last level, and the odds that it promises."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import chosen_path

SCHEMA = "doc_id long, text string"


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes_by_force(rows, n=3, percent=85):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    ids = [least.get(top(i), k) for i, (k, _) in enumerate(rows)]
    return sorted(((k, len(s), c, k == c) for (k, _), s, c in zip(rows, sets, ids, strict=True)), key=str)


def corpus(seed, families=12, each=9):
    """Families of edited copies about the threshold, a frequent passage, one large family that no path parts, and odd rows."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(4000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(r.randrange(40, 160))] + (passage if r.random() < 0.5 else [])
        for _ in range(each):
            copy = base[:]
            for _ in range(r.randrange(5)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    large = [word() for _ in range(120)]
    texts += [" ".join([*large[: 120 - k % 3], f"end{k}"]) for k in range(60)]
    texts += [" ".join([*passage, *[word() for _ in range(8)]]) for _ in range(40)]  # nearly alike, few of them linked
    texts += [None, "", " \n\t", "one", "one", "ONE two", "one TWO", "é" * 500, " ".join(word() for _ in range(5000)), texts[0], texts[0].upper()]
    rows = [(10 * i % 997, t) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, texts[1]), (None, None), (None, "only null")]


@pytest.mark.parametrize("limit,levels,block", [(512, 8, 1024), (16, 8, 64), (8, 2, 16), (16, 1, 1024)])
def test_components_equal_brute_force(spark, limit, levels, block):
    rows = corpus(limit + levels)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit(1), "node": F.lit("clash"), "tokens": F.lit(2), "path": F.lit(3)}).repartition(5)
    got = sorted((tuple(r) for r in chosen_path.report(df, limit=limit, levels=levels, block=block).collect()), key=str)
    assert got == classes_by_force(rows)


def test_deduplicate_keeps_columns_and_null_ids(spark):
    rows = corpus(5, families=4)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("x"))
    got = chosen_path.deduplicate(df).collect()
    want = {r[0] for r in classes_by_force(rows, 5, 80) if r[3] and r[0] is not None}
    assert {r.doc_id for r in got if r.doc_id is not None} == want and sum(r.doc_id is None for r in got) == 3 and got[0].kept == "x"
    assert len(got) == len(want) + 3 and chosen_path.report(df.limit(0)).count() == 0


def test_tokens_agree_as_often_as_the_sets():
    r = np.random.default_rng(1)
    pool = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    for share in (0.5, 0.85):
        shared = int(1000 * 2 * share / (1 + share))
        a, b = np.sort(pool[:1000]), np.sort(pool[1000 - shared : 2000 - shared])
        x, y = chosen_path.minwise_tokens([a, b])
        assert abs(float((x == y).mean()) - share) < 0.13
    assert (chosen_path.minwise_tokens([pool[:5], pool[5:6]])[1] == chosen_path.minwise_tokens([pool[5:6]])[0]).all()


def test_pairs_survive_as_promised():
    """Pairs that agree in 85 of 100 places, through trees of six levels: no less often than ``survival`` says."""
    r = np.random.default_rng(2)
    n = 3000
    x = r.integers(0, 1 << 32, (n, chosen_path.WIDTH)).astype(np.uint32)
    y = np.where(r.random((n, chosen_path.WIDTH)) < 0.85, x, r.integers(0, 1 << 32, (n, chosen_path.WIDTH)).astype(np.uint32))
    path, pair = r.integers(-(1 << 62), 1 << 62, n), np.arange(n)
    for _ in range(6):
        at, below = chosen_path.children(path, x[pair])
        there, other = chosen_path.children(path, y[pair])
        assert (at == there).all()
        same = below == other
        path, pair = below[same], pair[at[same]]
    met = len(np.unique(pair)) / n
    assert met >= chosen_path.survival(85) - 0.03 and chosen_path.trees_for(85) == 10
    assert chosen_path.least_agreement(85) == 87 and chosen_path.least_agreement(100) == 128
