"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import chat, components, decontaminate, fingerprint, language, ngram_join, pack, quality, queries, suffix_dedup, toxicity
from reelspark.llm.shingles import shingle_sets, set_signature

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n, size=400):
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))


def corpus():
    """Texts with exact and near copies, shared passages, nulls, empties, one very long text and repeated rows."""
    r = random.Random(5)
    base = [words(r, r.randrange(3, 160), 3000) for _ in range(40)]
    passage = words(r, 90, 3000)
    texts = [*base, base[0], base[0], passage + " " + base[1], base[2][:40] + passage, None, "", " \n ", "one", "é" * 700, "x" * 900, words(r, 4000, 3000)]
    near = base[3].split()
    near[5] = "changed"
    texts += [" ".join(near), base[4] + " tail", base[5].upper()]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, base[6], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).withColumns({"h": F.lit(1), "node": F.lit("clash"), "_copies": F.lit(1), "_spans": F.lit("s"), "_toxicity": F.lit(2), "kept": F.lit(3)}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def removed_by_force(texts, n=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(x[i : i + n] for x in data for i in range(len(x) - n + 1))
    out = []
    for x in data:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - n + 1):
            if seen[x[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        out.append((len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(docs, empty):
    rows = corpus()
    want = Counter((r[0], *x) for r, x in zip(rows, removed_by_force([r[1] for r in rows]), strict=True))
    got = Counter(tuple(r) for r in suffix_dedup.report(docs).collect())
    assert got == want
    assert suffix_dedup.report(empty).count() == 0


def test_suffix_dedup_of_strings_that_any_polynomial_hash_confuses(spark):
    """Differences that are products of x^k - 1 vanish modulo 2^64 for any odd x: such strings differ, and nothing of them may go."""
    change = np.array([1])
    for k in (1, 2, 4, 8, 16, 32, 64, 128, 64, 32, 16):
        factor = np.zeros(k + 1, int)
        factor[0], factor[-1] = -1, 1
        change = np.convolve(change, factor)
    assert len(change) <= 400 and abs(change).max() <= 11
    change = np.concatenate((change, np.zeros(400 - len(change), int)))
    texts = []
    for k, letter in enumerate((110, 109, 111)):
        texts += [f"{'ab'[k % 2]}{k} start " * 5 + "".join(map(chr, letter + part)) + f" end {k}{n} " * 5 for n, part in enumerate((change * 0, change))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(df).collect()}
    assert [got[k] for k in range(len(texts))] == removed_by_force(texts) and sum(x[1] for x in got.values()) == 0


def test_suffix_dedup_keeps_columns_and_nulls(docs):
    out = suffix_dedup.clean(docs)
    assert out.columns == docs.columns and out.count() == len(corpus())
    assert sum(r.text is None for r in out.collect()) == sum(r[1] is None for r in corpus())


def test_suffix_dedup_chains_of_partial_matches(spark):
    """Contexts that are repeated elsewhere still answer for strings that only end in them."""
    r = random.Random(7)
    long = "".join(r.choice("abcdefgh ") for _ in range(3000))
    texts = [long[a:b] + "".join(r.choice("xyz") for _ in range(r.randrange(200))) for a in range(0, 2000, 173) for b in (a + 430, a + 700, a + 990)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(df).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_force(texts)


@pytest.mark.parametrize("length,most,contexts", [(400, 60, 1), (400, 2000, 4), (200, 500, 2)])
def test_suffix_dedup_of_many_outboxes(spark, monkeypatch, length, most, contexts):
    """Passages of all lengths, some in many texts, dealt in many small outboxes over several files and 211 partitions."""
    monkeypatch.setattr(suffix_dedup, "MOST_ITEMS", most)
    monkeypatch.setattr(suffix_dedup, "CONTEXTS", contexts)
    r = random.Random(length + most)
    passages = [words(r, n, 3000) for n in (28, 45, 52, 60, 75, 90, 200)]
    hot = words(r, 85, 3000)
    texts = [" ".join(x for k in range(3) for x in (words(r, r.randrange(1, 40), 3000), r.choice([hot, r.choice(passages)])) if r.random() < 0.8) + words(r, r.randrange(9), 3000) for _ in range(70)]
    texts += [hot * 3, texts[1], texts[1], passages[6] + "é", "é" * 450, None, ""]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 211)
    try:
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(12)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(df, length=length).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [got[k] for k in range(len(texts))] == removed_by_force(texts, length)


def test_cover_and_minima():
    assert {(a - b) % 91 for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(91))
    h = np.random.default_rng(0).integers(0, 30, 300).astype(np.uint64)
    for w in (1, 5, 37, 128):
        want = {j for i in range(len(h) - w + 1) for j in range(i, i + w) if h[j] == h[i : i + w].min()}
        assert set(suffix_dedup.window_minima(h, w).tolist()) == want


def grams(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes_by_force(rows, n, percent):
    sets = [grams(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    least = {k: min((rows[i][0] for i in v if rows[i][0] is not None), default=None) for k, v in groups.items()}
    return Counter((r[0], len(s), least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("n,percent,block", [(4, 85, 256), (5, 80, 3), (1, 60, 2)])
def test_ngram_join(docs, empty, n, percent, block):
    got = Counter(tuple(r) for r in ngram_join.classes(docs, words=n, percent=percent, block=block).collect())
    assert got == classes_by_force(corpus(), n, percent)
    assert ngram_join.classes(empty, words=n, percent=percent).count() == 0


@pytest.mark.parametrize("block", [2, 5, 64])
def test_ngram_join_of_groups_of_several_blocks(spark, block):
    """Chains of near copies of which the ends aren't alike, and of which most aren't like the group's least node."""
    r = random.Random(21)
    rows = []
    for k in range(6):
        text = words(r, 60, 4000).split()
        for step in range(9):
            rows.append((len(rows), " ".join(text)))
            for _ in range(r.randrange(1, 3)):
                text[r.randrange(60)] = f"new{len(rows)}x{r.random()}"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(x) for x in ngram_join.classes(df, words=1, percent=85, block=block).collect())
    assert got == classes_by_force(rows, 1, 85)


def test_deduplicate(docs):
    out = ngram_join.deduplicate(docs)
    assert out.columns == docs.columns
    want = {d for d, _, c in classes_by_force(corpus(), 5, 80) if d is not None and d == c}
    ids = [r.doc_id for r in out.collect()]
    assert {i for i in ids if i is not None} == want and ids.count(None) == 2 and len([i for i in ids if i is not None]) == len(want)


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100, 101), (101, 100), (7, 7)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}


def test_shingles():
    a, b, c, d = shingle_sets([b"A b  C\td e", b"", b"one", b"a b c d e"], 4)
    assert len(a) == 2 and len(b) == 0 and len(c) == 1 and a.tolist() == d.tolist()
    assert set_signature(a) == set_signature(d) != set_signature(c)


BENCH = [("3", "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"), ("10", "short Item"), ("7", None), (None, "nameless one"), ("4", ""), ("10", "short item")]


def hits_by_force(text, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, items = cut(text), set(), set()
    for item, t in BENCH:
        v = cut(t)
        for i in range(max(1, len(v) - window + 1) if v else 0):
            p = v[i : i + window]
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hit |= set(range(k, k + len(p)))
                    items |= {item} - {None}
    return len(w), len(hit), len(items), decontaminate.sha256_of(list(items)), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 10])
def test_decontamination(spark, empty, block_bytes):
    full = BENCH[0][1]
    texts = [full, "x " + full.upper() + " y", " ".join(full.split()[1:11]), " ".join(full.split()[:9]), "a SHORT--item b short item", "shorter items nameless one", None, "", "ü short item", "short\nitem", (full + " word ") * 300, "shortitem"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id string, text string")
    got = {r[0]: tuple(r[1:]) for r in decontaminate.report(df, bench, block_bytes=block_bytes).collect()}
    assert got == {i: hits_by_force(t) for i, t in enumerate(texts)}
    kept = decontaminate.clean(df, bench, block_bytes=block_bytes)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if not hits_by_force(t)[4]}
    clash = df.withColumns({"n_words": F.lit("mine"), "hit_runs": F.lit(1), "hit_items": F.lit(None).cast("string"), "h": F.lit("h"), "runs": F.lit("r")})
    cleaned = decontaminate.clean(clash, bench, block_bytes=block_bytes)
    assert cleaned.columns == clash.columns and {(r.doc_id, r.n_words, r.hit_runs, r.h) for r in cleaned.collect()} == {(r.doc_id, "mine", 1, "h") for r in kept.collect()}
    with pytest.raises(ValueError):
        decontaminate.hits(clash, bench)
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.clean(df, none).count() == len(texts)
    assert decontaminate.report(empty, bench).count() == 0


def test_best_fit():
    lengths = np.sort(np.random.default_rng(2).integers(1, 33, 500))[::-1]
    sequence, offset = pack.best_fit(lengths, 32)
    room = []
    for k, x in enumerate(lengths):  # the plain way: the tightest open window
        fits = [(r, i) for i, r in enumerate(room) if r >= x]
        if not fits:
            room.append(32 - x)
            assert sequence[k] == len(room) - 1 and offset[k] == 0
        else:
            tight = min(r for r, _ in fits)
            assert room[sequence[k]] == tight and offset[k] == 32 - tight
            room[sequence[k]] -= x


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    rows = [r.asDict() for r in pack.pack(docs, path, window=64, shard_rows=20, with_ids=True).collect()]
    want = Counter()
    for r in corpus():
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), 64):
            part = np.array(ids[a : a + 64], "<u4").tobytes()
            want[(r[0], a, len(part) // 4, zlib.crc32(part), len(ids), part)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], bytes(r["ids"])) for r in rows) == want
    full = defaultdict(list)
    for r in rows:
        full[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in full.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert pack.pack(empty, path).count() == 0


def test_tokens_equal_the_tokenizers():
    known = pack.Words(queries.tokenizer_path())
    r = random.Random(3)
    pools = ["".join(map(chr, range(1, 0x180))), "".join(map(chr, range(1, 0x3000))), "abc d'sÄé́ΣςİIıß½²1 \x1c\x85\xa0_-.,<|endoftext|>"]
    for _ in range(3000):
        p = r.choice(pools)
        s = "".join(r.choice(p) for _ in range(r.randrange(25)))
        assert known.ids(s.encode()) == np.array(known.whole.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), s


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who"), (2, 0, "ann", "<|end|>"), (None, 1, "bob", "x"), (3, 0, "system", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective, r.turn): (r.segment, r.mask_start, r.mask_end) for r in chat.rotate(df).collect()}
    assert len(got) == 4 * 2 + 1 + 1
    assert got[(1, "ann", 1)] == ("<|assistant|>\nhi<|end|>\n", 14, 24) and got[(1, "bob", 1)] == ("<|user name=ann|>\nhi<|end|>\n", 0, 0)
    assert got[(1, "ann", 0)][0] == "<|system|>\nbe kind<|end|>\n" and got[(1, "ann", 3)][0] == "<|user|>\nwho<|end|>\n"
    assert got[(2, "ann", 0)][0] == "<|assistant|>\n< |end|><|end|>\n"
    tied = spark.createDataFrame([(1, 1, "bob", "b"), (1, 1, "ann", "z"), (1, 1, "ann", "a"), (1, 1, None, None), (1, 0, "bob", "first"), (1, 1, "ann", "a")], "conv_id long, turn long, role string, text string")
    one = {r.perspective: r for r in chat.dialogues(chat.rotate(tied)).collect()}
    say = lambda who, what: f"<|{who}|>\n{what}<|end|>\n"
    want = say("user name=bob", "first") + say("user", "") + say("assistant", "a") * 2 + say("assistant", "z") + say("user name=bob", "b")
    assert one["ann"].text == want and "".join(want[m.start : m.past] for m in one["ann"].masks) == "a<|end|>\na<|end|>\nz<|end|>\n" and len(one) == 2
    assert chat.rotate(df.limit(0)).count() == 0


def test_fingerprints(docs, empty):
    rows = sorted(corpus(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]

    def runs(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def likeness(a, b):
        return len(runs(a) & runs(b)) / len(runs(a) | runs(b)) if runs(a) | runs(b) else 1.0

    for size in (2000, 5):
        got = fingerprint.report(docs, k=64, rows=size).collect()
        prints = defaultdict(list)
        for r in got:
            prints[(r.doc_id, r.n_chars, r.edited_sha256)].append(r)
        assert len(got) == len(rows)
        for i, t in enumerate(texts):
            after, c = texts[(i + 1) % len(texts)], len(t) // 4
            edited = t[: len(t) - c] + after[:c]
            r = prints[(rows[i][0], len(t), hashlib.sha256(edited.encode()).hexdigest())].pop()
            near = 0.25 if len(runs(t) | runs(edited)) > 64 else 1e-9
            assert abs(r.near_edited - likeness(t, edited)) <= near and abs(r.near_next - likeness(t, after)) <= 0.25
    assert fingerprint.report(empty).count() == 0


def test_sketches_are_the_smallest_hashes(spark):
    """The k smallest of all distinct shingle hashes, one by one through Spark's xxhash64; resemblance from them, exactly."""
    r = random.Random(14)
    texts = [words(r, n, 300) for n in (4, 5, 6, 300, 2000)] + ["", "one", "A a  A\ta\na a a", "é" * 70 + " b c d e f"]
    texts += [texts[3].replace("w7", "x")]
    long = lambda t: [tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4)) if w]
    every = sorted({s for t in texts for s in long(t)})
    one = spark.createDataFrame([(list(s),) for s in every], "s array<string>")
    each = one.select("s", F.xxhash64(*[F.xxhash64(F.get("s", i)) for i in range(5)]).alias("h"), F.xxhash64(F.transform("s", lambda w: F.xxhash64(w))).alias("short")).collect()
    hashed = {tuple(x.s): x.h if len(x.s) == 5 else x.short for x in each}
    want = [sorted({hashed[s] for s in long(t)})[:64] for t in texts]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fingerprint.sketch(F.col("t"), 5, 64).alias("s")).orderBy("i").collect()
    assert [x.s for x in got] == want
    pairs = spark.createDataFrame([(a, b) for a in want for b in want], "a array<bigint>, b array<bigint>").select("a", "b", fingerprint.resemblance(F.col("a"), F.col("b"), 64).alias("x")).collect()
    for p in pairs:
        both = sorted({*p.a, *p.b})[:64]
        assert p.x == (len({*both} & {*p.a} & {*p.b}) / len(both) if both else 1.0)


def test_fingerprints_of_text_ids(spark):
    rows = [(k, f"t {k}") for k in ("b", "a", "zebra-10", "zebra-2", "", "é", "aa", "zebra-10-and-more")] + [(None, "none")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode()))
    for size in (2, 2000):
        got = {r.doc_id: r.next_text for r in fingerprint.neighbours(df, rows=size).collect()}
        assert got == {a[0]: b[1] for a, b in zip(order, [*order[1:], order[0]], strict=True)}
    numbers = [-(1 << 63), -(1 << 60), -5, 0, 3, 1 << 51, (1 << 53) + 1, (1 << 62) + 1, (1 << 62) + 2, (1 << 63) - 1]
    for schema, ids in (("doc_id long, text string", numbers), ("doc_id double, text string", [-1e300, -2.5, 0.1, 0.2, 7.0, 1e18, 1e19])):
        df = spark.createDataFrame([(k, f"t {k}") for k in ids], schema).repartition(3)
        got = {r.doc_id: r.next_text for r in fingerprint.neighbours(df, rows=2).collect()}
        assert got == {a: f"t {b}" for a, b in zip(ids, [*ids[1:], ids[0]], strict=True)}


def test_ranges_of_text_ids_with_one_beginning(spark):
    """Ids that differ in their last letters only, and ids of two families, fall into ranges of about the size asked for."""
    for ids in ([f"doc-{k:08}" for k in range(10_000)], [f"{'ab'[k % 2]}-common-beginning-{k:08}" for k in range(10_000)]):
        df = spark.createDataFrame([(k, f"t {k}") for k in ids], "doc_id string, text string").repartition(3)
        near = fingerprint.neighbours(df, rows=2000)
        order = sorted(ids)
        assert {r.doc_id: r.next_text for r in near.collect()} == {a: f"t {b}" for a, b in zip(order, [*order[1:], order[0]], strict=True)}
        some = df.select(F.col("doc_id").alias("place"))
        cuts = sorted(fingerprint.quantiles(some, 5, df.schema["doc_id"].dataType))
        sizes = [sum(a <= k < b for k in ids) for a, b in zip(["", *cuts], [*cuts, "z"], strict=True)]
        assert len(cuts) >= 4 and max(sizes) <= 2500


def test_results_beside_columns_of_their_names(spark):
    rows = [(i, t, "kept") for i, t in enumerate(["some text", None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string").withColumns({"score": F.lit("mine"), "lang_pred": F.lit("own"), "toxicity": F.lit(7), "Rejected": F.lit(1)})
    found = language.identify(df, None)
    assert found.columns == [*df.columns, "_lang_pred", "_score", "_rejected"] and {(r.score, r._lang_pred) for r in found.collect()} == {("mine", "und")}
    assert {(r.score, r._score) for r in quality.score(df, None).collect()} == {("mine", 0.5)}
    model = toxicity.train([(b"good words here", 0)] * 3 + [(b"bad words here", 1)] * 3)
    assert {r.toxicity for r in toxicity.score(df, model).collect()} == {7} and "_toxicity" in toxicity.score(df, model).columns


def test_sketches_merge(spark):
    r = random.Random(4)
    a, b = [f"{i}x{r.random()}" for i in range(900)], [f"{i}y{r.random()}" for i in range(600)]
    one = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a + ["|"] + b))], "a string, b string, c string")
    s = lambda c: fingerprint.sketch(F.col(c), 1)
    row = one.select(fingerprint.merge(s("a"), s("b")).alias("m"), F.slice(F.array_sort(F.array_distinct(F.concat(s("a"), s("b")))), 1, 128).alias("w"), fingerprint.distinct_shingles(s("a")).alias("n"), fingerprint.containment(s("a"), s("c")).alias("in"), fingerprint.from_text(fingerprint.as_text(s("a"))).alias("back"), s("a").alias("a")).first()
    assert row.m == row.w and abs(row.n - 900) < 300 and row["in"] > 0.75 and row.back == row.a


def test_language(spark, empty):
    r = random.Random(6)
    kinds = {"aa": ["the", "thing", "then", "with"], "bb": ["und", "schon", "ächzt", "nicht"]}
    make = lambda k: " ".join(r.choice(kinds[k]) for _ in range(30))
    rows = [(i, make(k), k) for i, k in enumerate(["aa", "bb"] * 60)] + [(200, None, "aa"), (201, "12 34 !", "bb"), (202, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    got = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert all(got[i].lang_pred == k and 0 <= got[i].score <= 1 for i, _, k in rows[:120])
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert language.fit(empty) is None and {r.lang_pred for r in language.identify(df, None).collect()} == {"und"}
    long = ("the thing " * 60_000).encode()
    assert sum(map(len, language.subwords(long))) == sum(map(len, language.subwords(long[: len(long) // 2]))) * 2


def test_toxicity(spark, empty):
    r = random.Random(8)
    clean = lambda: words(r, 60, 500)
    foul = lambda: " ".join(x if r.random() > 0.05 else r.choice(["blockhead", "nitwit"]) for x in clean().split()) + " nitwit"
    rows = [(i, foul() if i % 4 == 0 else clean(), int(i % 4 == 0)) for i in range(400)] + [(900, None, 0), (901, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df)
    fresh = spark.createDataFrame([(0, foul()), (1, clean()), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in toxicity.score(fresh, model).collect()}
    assert got[0] >= 0.3 > got[1] and all(0 <= x <= 1 for x in got.values()) and got[2] == got[3]
    assert [r.doc_id for r in toxicity.drop_toxic(fresh, model).orderBy("doc_id").collect()][:1] == [1]
    assert toxicity.score(fresh, toxicity.fit(df.limit(0))).where("toxicity = 0").count() == 4
    assert toxicity.score(fresh.limit(0), model).count() == 0


def test_quality(spark, empty):
    r = random.Random(9)
    rows = [(i, words(r, 50) + ("." if i % 3 else " $$$ %%% $$$ |"), int(i % 3 > 0)) for i in range(240)] + [(900, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(df, df)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows[:240]]) > 0.95 and 0 <= got[900] <= 1
    total, n = quality.document_frequencies(df)
    assert n == len(rows) and total.max() <= n
    assert quality.fit(df.limit(0), empty) is None and quality.score(df.limit(0), model).count() == 0
    assert quality.score(df, None).where("score = 0.5").count() == len(rows)
    assert [quality.vote(model, [t.encode()])[0] for _, t, _ in rows[:240]] == pytest.approx([got[i] for i, _, _ in rows[:240]], abs=1e-5)
    x = quality.unit(quality.weighted(quality.term_counts([b"some text."]), model.idf) @ model.axes)
    near = (model.vectors @ x[0]).astype(float)
    last = np.sort(near)[-quality.NEIGHBOURS]
    w = np.where(near >= last, np.maximum(near, 1e-3) ** quality.SHARPNESS, 0)
    assert abs(quality.vote(model, [b"some text."])[0] - (w @ model.labels) / w.sum()) < 1e-3


def test_pipeline(spark, sf_dir, tmp_path):
    """Each stage on its own input against brute force, and run() against the stages one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(v[i : i + 10]) for _, t in bench for v in [cut(t)] if v for i in range(max(1, len(v) - 9))}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
        rows = [(r.doc_id, r.text) for r in before.collect()]
        kept = {r.doc_id: r for r in docs.collect()}
        if k == 0:
            known = [(t.encode(), labels[d]) for d, t in rows if t is not None and labels.get(d) in (0, 1) and zlib.crc32(str(d).encode()) % 4 != 2 and len(t) <= toxicity.SAMPLE_CHARS]
            scorer = toxicity.Scorer(toxicity.train(known))
            assert set(kept) == {d for d, t in rows if scorer.score((t or "").encode()) < toxicity.THRESHOLD}
        elif k == 1:
            assert set(kept) == {d for d, _, c in classes_by_force(rows, 5, 80) if d == c}
        elif k == 2:
            want = removed_by_force([t for _, t in rows], corpus_pipeline.REPEAT_BYTES)
            assert len(kept) == len(rows)
            for (d, t), x in zip(rows, want, strict=True):
                assert x[1] or kept[d].text == t
                assert kept[d].n_chars == len(kept[d].text) and len(kept[d].text.encode()) <= x[0] - x[1] and len(kept[d].text.encode()) >= x[0] - x[1] - 6 * x[2]
        elif k == 3:
            hit = lambda w: any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
            assert set(kept) == {d for d, t in rows if not hit(cut(t))}
        else:
            assert set(kept) == {d for d, _ in rows}
    one = sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in docs.collect())
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in corpus_pipeline.run(spark, sf_dir).collect()) == one and one
