"""Substring dedup against a plain window table, and the suffix automaton."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stakeflow.llm import substring_dedup as S
from stakeflow.llm.suffix_automaton import SuffixAutomaton

SF = "/root/testdata/sf0.01"


def brute(rows, size):
    """doc_id -> (words, removed, kept text); rows in corpus order."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i:i + size])
            if window in seen:
                gone[i:i + size] = [True] * size
            seen.add(window)
        out[doc] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def check(spark, rows, size=20):
    df = spark.createDataFrame([(d, t, d, 0) for d, t in rows], "doc_id bigint, text string, start bigint, th int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in S.substring_dedup(df, size).collect()}
    assert got == brute(rows, size)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(spark, rows)


def test_periodic_and_planted(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh")
    shared = " ".join(word() + word() for _ in range(60))
    rows = [(i, " ".join(word() + word() for _ in range(rng.randrange(80)))) for i in range(40)]
    rows += [(100 + i, f"x{i} {shared[:rng.randrange(20, 170)]} y{i}") for i in range(60)]
    rows += [(200, "and " * 100), (201, "and " * 30), (202, "a b " * 60), (203, None), (204, ""), (205, shared + " " + shared),
             (206, " \t\n"), (207, "é" * 30 + " " + shared), (208, "word " + "long " * 20_000)]
    check(spark, rows)
    check(spark, rows, size=6)


def test_repeated_rows_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, "few words")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in S.substring_dedup(df).collect())
    assert got == [(0, 2, 0), (1, 30, 0), (1, 30, 0), (2, 30, 30)]
    assert S.substring_dedup(df.limit(0)).count() == 0


def test_repeated_rows_share_a_part(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words)),
            (2, " ".join([f"a{i}" for i in range(15)] + words[20:] + [f"b{i}" for i in range(15)]))]
    rng = random.Random(5)
    for i in range(10, 40):
        at = rng.randrange(30)
        own = [f"d{i}_{j}" for j in range(25)] + words[at:at + 30] + [f"e{i % 7}_{j}" for j in range(25)]
        rows += [(i, " ".join(own))] * rng.randrange(1, 4)
    want = brute(dict(rows).items(), 20)
    assert want[1][1] == 0 and want[2][1] == 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in S.substring_dedup(df).collect())
    assert got == sorted((i, *want[i]) for i, _ in rows)


def test_rows_of_one_id_with_colliding_short_hashes(spark):
    """Texts of one id differ although their 32-bit hashes are equal."""
    words = " ".join(f"w{i}" for i in range(5, 30))
    texts = spark.range(300_000).selectExpr(f"concat('n', id, ' {words} end tail more last') as t")
    pair = texts.groupBy(F.hash("t")).agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").first()
    other = " ".join(f"z{i}" for i in range(30))
    for doc in (7, None):
        rows = [(doc, pair.a), (doc, other), (9, pair.b)]
        got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in S.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
        assert got == [(doc or 0, 30, 0), (doc or 0, 30, 0), (9, 30, 29)]
    rows = [(7, pair.a), (7, pair.b)]
    got = sorted((r.n_words, r.n_removed) for r in S.substring_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(30, 0), (30, 29)]


def test_bounds_of_the_broadcast_reference(spark, monkeypatch):
    rng = random.Random(11)
    shared = [" ".join(rng.choice("abcdefgh") + rng.choice("abcdefgh") for _ in range(25 + 10 * i)) for i in range(6)]
    rows = [(i, f"x{i} {shared[i % 6]} y{i} {shared[(i * 5 + 1) % 6]}") for i in range(150)]
    monkeypatch.setattr(S, "COMMON_IN_SAMPLE", 4)
    prepared = spark.createDataFrame([(d, d, t) for d, t in rows], "doc_id bigint, th bigint, text string")
    whole = S.broadcast_reference(prepared, 20)
    held = sum(len(t.encode()) for t in shared)
    for reference_bytes, anchors in ((held // 2, 10**6), (0, 3), (10**6, 0)):
        monkeypatch.setattr(S, "REFERENCE_BYTES", reference_bytes)
        monkeypatch.setattr(S, "COMMON_ANCHORS", anchors)
        small = S.broadcast_reference(prepared, 20)
        assert small is None or (len(small.anchors) <= anchors and len(small.hashes) <= len(whole.hashes) * (reference_bytes > 0))
        check(spark, rows)


def test_given_reference(spark, monkeypatch):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(12)]
    reference = [" ".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(30)] + [None, "", "short one"]
    windows = {tuple(t.split()[i:i + 6]) for t in reference if t for i in range(len(t.split()) - 5)}
    rows = [(1, None), (2, ""), (3, "word " * 40)]
    for i in range(40):
        words = [rng.choice(pool) for _ in range(rng.randrange(40))]
        words[5:5] = (rng.choice(reference) or "").split()[3:20]
        rows.append((10 + i, "  ".join(words)))
    want = {}
    for i, t in rows:
        words = (t or "").split()
        gone = {j for k in range(len(words) - 5) if tuple(words[k:k + 6]) in windows for j in range(k, k + 6)}
        want[i] = (len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone))
    assert sum(n for _, n, _ in want.values()) > 300
    monkeypatch.setattr(S, "SHARD_WORDS", 200)  # several shards
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, n_words int")
    refs = spark.createDataFrame([(t,) for t in reference], "text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in S.remove_reference(docs, refs, 6).collect()}
    assert got == want
    with pytest.raises(ValueError):
        S.remove_reference(docs, refs, 6, max_bytes=100)
    assert S.remove_reference(docs, refs.limit(0), 6).where("n_removed > 0").count() == 0


def test_automaton():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randrange(30))] for _ in range(4)]
        automaton, held = SuffixAutomaton(), set()
        for text in texts:
            lengths = [n for _, n in automaton.match(text)]
            for end in range(len(text)):
                best = max((n for n in range(end + 2) if tuple(text[end + 1 - n:end + 1]) in held or n == 0))
                assert lengths[end] == best
            states = {}
            for start, state in automaton.windows(text, 3):
                assert states.setdefault(state, tuple(text[start:start + 3])) == tuple(text[start:start + 3])
            automaton.add(text)
            held |= {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}
