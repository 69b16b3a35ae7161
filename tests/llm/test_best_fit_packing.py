"""Packing: every id in its place, no fuller plan by placing pieces one by one."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stakeflow.llm import best_fit_packing as P
from stakeflow.llm import bpe

SF = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(bpe.public_path())


def one_by_one(lengths, capacity):
    """Gaps of the sequences when each piece is placed by itself."""
    third = capacity // 3
    large = sorted((x for x in lengths if x > third), reverse=True)
    gaps = []
    while large:
        a = large.pop(0)
        b = next((x for x in large if a + x <= capacity), 0)
        if b:
            large.remove(b)
        gaps.append(capacity - a - b)
    for x in sorted((x for x in lengths if x <= third), reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps[gaps.index(min(fits))] -= x
        else:
            gaps.append(capacity - x)
    return sorted(gaps)


def filled(plan):
    used = defaultdict(list)
    for length, _, n, first, each, offset in plan.runs:
        for i in range(n):
            used[first + i // each].append((offset + i % each * length, length))
    return used


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_the_one_by_one_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 7, 30, 64])
    lengths = [min(capacity, max(1, int(rng.expovariate(rng.choice([1, 3, 8]) / capacity)))) for _ in range(rng.randrange(1, 300))]
    plan = P.plan_sequences(Counter(lengths), capacity)
    used = filled(plan)
    assert sorted(capacity - sum(n for _, n in u) for u in used.values()) == one_by_one(lengths, capacity)
    assert sorted(used) == list(range(plan.sequences))
    for u in used.values():
        at = 0
        for offset, n in sorted(u):
            assert offset == at
            at += n
        assert at <= capacity
    placed = defaultdict(list)
    for length, rank, n, *_ in plan.runs:
        placed[length] += range(rank, rank + n)
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}


def test_plan_does_not_grow_with_the_input():
    rng = random.Random(1)
    lengths = Counter(min(2048, 1 + int(rng.lognormvariate(5, 1.3))) for _ in range(100_000))
    small = P.plan_sequences(lengths)
    large = P.plan_sequences({k: n * 1_000_003 for k, n in lengths.items()})
    assert len(large.runs) < 40_000
    total = sum(k * n for k, n in lengths.items())
    assert small.sequences <= 1.001 * -(-total // 2048) + 1
    assert large.sequences <= 1.001 * total * 1_000_003 / 2048


def check(rows, docs, capacity=2048):
    """Every document's ids come back from the sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = Counter()
    for i, text in docs:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k:k + capacity], "<u4")
            want[i, k // capacity, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(by_sequence)


def test_query_packs_every_document(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = P.op12_best_fit_packing(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                                "sequence_id": "bigint", "offset": "bigint"}
    rows = out.collect()
    n = check(rows, docs)
    assert n == len(one_by_one([r.length for r in rows], 2048))
    assert n <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_odd_rows(spark):
    rows = [(1, "one two three", 5), (1, "one two three", 6), (1, "another text", 7), (2, None, 8), (3, "", 9), (None, "no id", 1), (4, "word " * 9000, 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, length int").repartition(3)
    packed = P.pack(df, bpe.PUBLIC, with_ids=True).cache()
    got = packed.collect()
    check(got, [r[:2] for r in rows])
    of = {r.sequence_id: r for r in P.sequences(packed).collect()}
    for r in got:
        s = of[r.sequence_id]
        assert s.ids[r.offset:r.offset + r.length] == r.ids and r.offset in s.doc_starts
    assert P.pack(df.limit(0), bpe.PUBLIC).collect() == []


def test_plan_in_shares(spark, monkeypatch):
    df = spark.createDataFrame([(i, "word " * (i % 37)) for i in range(500)], "doc_id bigint, text string")
    want = check(P.pack(df, bpe.PUBLIC, 16).collect(), [(r.doc_id, r.text) for r in df.collect()], 16)
    monkeypatch.setattr(P, "PLAN_ROWS", 3)
    assert check(P.pack(df, bpe.PUBLIC, 16).collect(), [(r.doc_id, r.text) for r in df.collect()], 16) == want
