"""Operators 12 and 13 against plain Python on small tables with nulls, ties, repeated rows, long texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reelspark.llm import prefix_trie, queries, source_audit


def trie_by_force(rows, rebuild=True):
    """rows: conv_id, turn, role, text."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            who, says = r or "", x or ""
            by[c].append(((t is not None, t or 0), hashlib.sha256(f"{len(who.encode())} {who}{says}".encode()).digest(), who, says))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    head = {c: zlib.crc32(str(c).encode()) % 4 if rebuild else 0 for c in own}
    made = {c: own.get(c - c % 20, [])[: head[c]] + v[head[c] :] for c, v in own.items()}
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in sorted(made.items()):
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    leaves, spared = {}, {}
    for n in sorted(members, key=len, reverse=True):
        if n:
            kids[n[:-1]].append(n)
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        spared[n] = sum(spared[k] for k in kids[n]) + ((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0)
    ends = lambda n: hashlib.sha256(",".join(str(c) for c in members[n] if len(made[c]) == len(n)).encode()).hexdigest()
    return Counter((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(kids[n]), leaves[n], spared[n], ends(n)) for n, m in list(members.items()))


TURNS = "conv_id long, turn long, role string, text string"


def conversations():
    r = random.Random(11)
    lines = ["", "hi", "one two  three", "\u00a0 x\ty ", None, "long " * 400]
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(lines)) for c in range(70) for t in range(r.randrange(1, 7))]
    rows += [(c, t, "user", f"line {t % 5}") for c in (100, 101, 102, 140) for t in range(75)]  # long ones that part late
    rows += [(101, 75, "user", "end"), (102, 74, "user", "other"), (7, None, "system", "first"), (7, None, None, "also first"), (7, 1, "user", "tie"), (7, 1, "user", "tie")]
    rows += [(c, 0, "user", "the same") for c in range(200, 240)] + [(250, 0, "user", "a"), (261, 0, "user", "turnless when taken"), (None, 0, "user", "nobody's"), (-3, 0, "user", "x"), (-3, 1, "user", "y")]
    return rows


def test_prefix_trie(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).withColumns({"depth": F.lit("d"), "key": F.lit(1), "at": F.lit(2)}).repartition(5)
    whole = prefix_trie.trie(df)
    assert Counter(map(tuple, whole.collect())) == trie_by_force(rows, rebuild=False)
    assert whole.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # ids below zero: the remainder has the sign of the id in SQL, so those are left out of the comparison with Python's
    ours = [r for r in rows if r[0] is None or r[0] >= 0]
    assert Counter(map(tuple, prefix_trie.report(spark.createDataFrame(ours, TURNS)).collect())) == trie_by_force(ours)


def test_prefix_trie_of_little(spark):
    assert prefix_trie.report(spark.createDataFrame([], TURNS)).count() == 0
    one = [(3, 5, None, None)]
    assert Counter(map(tuple, prefix_trie.trie(spark.createDataFrame(one, TURNS)).collect())) == trie_by_force(one, rebuild=False)
    text_ids = [(str(c), 0, "user", "x") for c in range(3)]
    got = prefix_trie.trie(spark.createDataFrame(text_ids, TURNS.replace("conv_id long", "conv_id string"))).collect()
    assert [(r.conv_id, r.depth, r.n_convs) for r in sorted(got)] == [("0", 0, 3), ("0", 1, 3)]


@pytest.mark.parametrize("rows", [1, 3])
def test_listed_ids_go_through_one_hash_in_batches(spark, rows):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        ends = spark.createDataFrame([(d, 5 * d, m) for d in range(3) for m in range(100, 90 - d, -1)], "depth long, conv_id long, member long").repartition(4)
        got = {r.depth: r.ends_sha256 for r in prefix_trie.listed_ids(ends).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {d: hashlib.sha256(",".join(map(str, range(91 - d, 101))).encode()).hexdigest() for d in range(3)}


def test_dense_names_have_no_gaps(spark):
    got = prefix_trie.dense(spark.range(0, 500, numPartitions=7).where("id % 3 = 0").repartition(9)).collect()
    assert sorted(r.name for r in got) == list(range(len(got)))


def audit_by_force(rows, least=3, top=200):
    """rows: text, lang, source."""
    read = [(x or "", g or "", s or "") for x, g, s in rows]
    found = [(re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))), g, s) for x, g, s in read]
    out = Counter()
    for lang in {g for _, g, _ in read}:
        have = Counter(t for w, g, _ in found if g == lang for t in set(w))
        kept = {t for t, n in have.items() if n >= least}
        counts = {s: Counter() for _, g, s in found if g == lang}
        for w, g, s in found:
            if g == lang:
                counts[s].update(t for t in w if t in kept)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept}
        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        far = lambda p, q, t: (p[t] - q[t]) ** 2 // q[t]
        for s, p in shares.items():
            pairs = sorted((-sum(far(p, r, t) for t in kept), o.encode()) for o, r in shares.items() if o != s)
            terms = sorted((-far(p, q, t), t) for t in kept if counts[s][t] and p[t] > q[t])[:top]
            out.update((lang, s, part, k.decode(), -v, i + 1) for part, ranked in (("pair", pairs), ("term", terms)) for i, (v, k) in enumerate(ranked))
    return out


def audited(r):
    words = ["the", "The", "of", "\u00fcber", "caf\u00e9", "x1y", "don't", "\u4e2d\u6587", "a-b", "\u2028", "Z"] + [f"w{chr(97 + i)}" for i in range(20)]
    text = lambda: " ".join(r.choice(words) for _ in range(r.randrange(30)))
    rows = [(text(), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "s3", None])) for _ in range(60)]
    rows += [rows[0], rows[0], (None, "en", "none"), ("", "en", "empty"), ("only here", "xx", "a"), (None, "xx", "b"), ("twice twice", "xx", "c"), (None, None, None), ("big words " * 5000, "en", "s1"), ("fr " * 3, "fr", "alone")]
    return rows


@pytest.mark.parametrize("entries,shard_rows,top", [(300_000, 500_000, 200), (20, 15, 3)])
def test_source_audit(spark, monkeypatch, entries, shard_rows, top):
    for name, value in (("MOST_ENTRIES", entries), ("SHARD_ROWS", shard_rows), ("PART_BYTES", 1000)):
        monkeypatch.setattr(source_audit, name, value)
    rows = audited(random.Random(entries))
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"term": F.lit(1), "n": F.lit("n"), "shard": F.lit(0)}).repartition(6)
    assert Counter(map(tuple, source_audit.audit(df, top=top).collect())) == audit_by_force(rows, top=top)
    assert source_audit.audit(df.limit(0)).count() == 0


def test_terms_of_long_texts():
    text = b"Ab1c " * 1000 + b"end"
    assert [t for part in source_audit.terms_in(text) for t in part] == [b"ab", b"c"] * 1000 + [b"end"] and list(source_audit.terms_in(b"")) == []


@pytest.mark.parametrize("name", ["op12_source_audit", "op13_prefix_trie"])
def test_queries_equal_duckdb(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = queries.queries()[name](spark, sf_dir)
    want = con.sql(queries.oracle_sql()[name])
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(want.fetchall())
