"""Lexical search against brute force over all documents."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stakeflow.llm import ball_tree_search as S

TERM = re.compile(S.TERM)
DOCS, ITEMS = "doc_id bigint, text string, score string", "item_id bigint, text string, rank int"


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(S._UPPER, S._LOWER)))


def brute(docs, items, k):
    words = [(i, terms(t)) for i, t, *_ in docs]
    words = [(i, w) for i, w in words if w]
    count, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    asked = defaultdict(set)
    for i, t, *_ in items:
        asked[i] |= set(terms(t))
    out = []
    for item, query in asked.items():
        scored = []
        for doc, w in words:
            tf, m = Counter(w), 100 - 50 + 50 * len(w) * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in query if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k=5):
    got = S.search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute(docs, items, k)
    return got


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeñö") for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    topics = [rng.sample(vocabulary, 40) for _ in range(6)]
    return [" ".join(rng.choice(rng.choice(topics) if rng.random() < 0.1 else topics[i % 6]) for _ in range(int(rng.lognormvariate(3, 1)))) for i in range(n)]


def test_trees_and_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_DOCS", 64)
    monkeypatch.setattr(S, "LEAF_DOCS", 4)
    docs = [(i, t, "") for i, t in enumerate(texts(600, 1))]
    items = [(i, t[:60], 0) for i, t in enumerate(texts(30, 2))]
    assert len(run(spark, docs, items)) > 100


def test_groups_of_items(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_ITEMS", 3)
    monkeypatch.setattr(S, "GROUP_PAIRS", 40)
    run(spark, [(i, t, "") for i, t in enumerate(texts(80, 3))], [(i, t, 0) for i, t in enumerate(texts(12, 4))])


def test_odd_rows(spark):
    docs = [(1, "One one TWO", ""), (1, "one two", ""), (1, "one two", ""), (None, "one two", ""), (None, "one two", ""), (2, None, ""), (3, "", ""), (4, "!?|\x00", ""),
            (5, "Émile É é ONE/2 two_three\x7ffour", ""), (6, "漢字 two " * 4000, ""), (7, "one two " + "x" * 70000, ""), (8, "ünique", "")]
    items = [(1, "ONE two", 0), (1, "ünique", 1), (2, None, 0), (3, "", 0), (4, "absent", 0), (None, "É é 漢字 2 x", 0), (5, "x" * 70000 + " two", 0), (6, "one", 0), (6, "one", 0)]
    assert len(run(spark, docs, items)) > 15
    assert S.search(spark.createDataFrame(docs, DOCS).limit(0), spark.createDataFrame(items, ITEMS)).collect() == []
    assert S.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS).limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_prune(seed):
    rng = np.random.default_rng(seed)
    width, count = 60, 500
    rows = [np.unique(rng.integers(t := 10 * (i % 5), t + 14, rng.integers(1, 12))) for i in range(count)]
    first = np.append(0, np.cumsum([len(r) for r in rows]))
    value = rng.integers(1, 900_000, first[-1])
    docs = S.Sparse(first, np.concatenate(rows) % width, value)
    tree = S.BallTree.of(docs, width, 8)
    assert sorted(tree.order) == list(range(count))
    items = [np.unique(rng.integers(t := 10 * (i % 5), t + 10, 6)) for i in range(20)]
    q = S.Queries(None, [b"t"] * width, np.repeat(np.arange(20), [len(i) for i in items]), np.concatenate(items))
    q.items = list(range(20))
    weight = rng.integers(0, 20_000, width)
    search = S.Search(q, weight, 5)
    dense = np.zeros((count, width), np.int64)
    for i in range(count):
        dense[i, docs.term[first[i]:first[i + 1]]] = value[first[i]:first[i + 1]]
    asked = np.zeros((20, width), np.int64)
    for i, t in enumerate(items):
        asked[i, t] = weight[t]
    exact = asked @ dense.T
    bounds = search.bounds(tree)
    for node in range(len(tree.start)):
        assert (exact[:, tree.order[tree.start[node]:tree.end[node]]].max(1) <= bounds[:, node]).all()
    search.shard(np.arange(count), np.zeros(count, bool), tree)
    for i in range(20):
        want = [(-s, d) for s, d in sorted((-int(s), d) for d, s in enumerate(exact[i]) if s > 0)[:5]]
        assert list(zip(search.pool[i][0].tolist(), search.pool[i][2].tolist())) == want
    assert search.scored < 0.8 * 20 * count
