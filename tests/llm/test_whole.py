"""What a cut would lose: sets and texts behind a saturated filter."""

import random

import numpy as np

from reelspark.llm import ngram_join, passages, toxicity


def words(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def test_ngram_join_with_a_saturated_filter(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "membership_filter", lambda nodes: np.full(1 << 17, 255, np.uint8))
    r = random.Random(5)
    one = words(r, 200)
    other = one + " end"
    df = spark.createDataFrame([(i, one if i % 2 else other) for i in range(9, 0, -1)], "doc_id long, text string").coalesce(1)
    assert {x.component_id for x in ngram_join.classes(df).collect()} == {1}


def test_passages_with_a_saturated_filter(spark, monkeypatch):
    monkeypatch.setattr(passages, "membership_filter", lambda nodes: np.full(1 << 17, 255, np.uint8))
    r = random.Random(6)
    shared = words(r, 60)
    one, other = shared + " " + words(r, 40), words(r, 40) + " " + shared
    df = spark.createDataFrame([(i, one if i % 2 else other) for i in range(9, 0, -1)], "doc_id long, text string").coalesce(1)
    got = {(x.doc_id, x.partner_id) for x in passages.find(df).collect()}
    assert got >= {(i, 2 if i % 2 else 1) for i in range(1, 10)}


def test_passage_that_stands_twice_in_a_document(spark):
    # two functions whose windows begin at different tokens of the lead, at two places of the other text: both places are ranges
    hits = np.array([(0, 5, 70, 0, 65), (1, 9, 75, 4, 70), (0, 5, 70, 300, 365), (1, 9, 75, 304, 370)])
    assert sorted(passages.agreeing(hits, 46, 2)) == [(5, 75, 0, 70), (5, 75, 300, 370)]
    r = random.Random(7)
    shared = words(r, 60)
    texts = [words(r, 50) + " " + shared + " " + words(r, 200) + " " + shared + " " + words(r, 50), words(r, 30) + " " + shared + " " + words(r, 30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [x for x in passages.find(df).collect() if x.doc_id == 0]
    assert any(x.start_word <= 52 and x.end_word >= 108 for x in got) and any(x.start_word <= 312 and x.end_word >= 368 for x in got)


def test_an_edit_at_every_position_is_verified():
    r = np.random.default_rng(8)
    for n in (46, 56, 66, 96):  # tokens of passages of 50 to 100 words
        for k in range(n + 4):
            a, b = (r.integers(0, 1 << 60, n + 80).astype(np.uint64) for _ in "ab")
            b[25 : 25 + n] = a[40 : 40 + n]
            b[25 + max(0, k - 4) : 25 + min(n, k + 1)] = r.integers(0, 1 << 60, min(n, k + 1) - max(0, k - 4))
            got = passages.verified(a, b, 46, 80)
            assert got and all(x[1] - x[0] >= 46 and x[3] - x[2] >= 46 and x[4] >= 0.8 for x in got), (n, k)


def test_toxic_words_behind_the_first_60_bytes_of_a_run_are_scored():
    for n in (0, 5, 60, 61, 75, 76, 200):
        got = toxicity.windows(b"a " + bytes(range(100, 100 + n)) if n <= 100 else b"b" * n)
        assert max(map(len, got)) <= 60 and (n <= 60 or sum(map(len, got)) >= n)
    r = random.Random(9)
    ordinary = [words(r, 30) for _ in range(80)]
    toxic = [words(r, 15) + " vilebadword hatefulthing " + words(r, 15) for _ in range(80)]
    scorer = toxicity.Scorer(toxicity.train([(t.encode(), 0) for t in ordinary] + [(t.encode(), 1) for t in toxic]))
    for blank in ("\u3000", "\u00a0", "_", "\u3002"):
        clean, bad = (blank.join(t.split()).encode() for t in (toxic[0].replace("vilebadword hatefulthing ", ""), toxic[0]))
        assert clean[:60] == bad[:60] and scorer.score(bad) > scorer.score(clean)
