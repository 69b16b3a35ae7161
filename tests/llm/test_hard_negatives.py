"""Hard negatives against brute force."""

import math
from collections import Counter

import numpy as np
import pytest

from stakeflow.llm import hard_negatives as H

SCHEMA = "vec_id bigint, label int, embedding array<float>, score int"


def usable(row):
    i, label, v, *_ = row
    return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every):
    rows = [(i, c, [math.floor(256 * float(np.float32(x))) for x in v]) for i, c, v, *_ in filter(usable, rows)]
    out = Counter()
    for a, label, u in rows:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(u, v)), i, c == label) for i, c, v in rows if i != a and len(v) == len(u)]
        for p, pid, _ in sorted(s for s in scored if s[2])[:5]:
            hard = sorted(s for s in scored if not s[2] and -80 * p <= -100 * s[0] <= -100 * p)[:5]
            for rank, (n, nid, _) in enumerate(hard, 1):
                out[a, pid, rank, nid, -p, -n] += 1
    return out


def check(spark, rows, every):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = Counter(map(tuple, H.hard_negatives(df, f"vec_id % {every} = 0").collect()))
    assert got == brute(rows, every)
    return got


def clustered(n, dim, seed, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    v *= rng.uniform(0.2, 3, (n, 1)) / np.sqrt(dim)
    return [(i, int(rng.integers(0, 4)), v[i].astype(np.float32).tolist(), 1) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_clusters_of_unequal_norm(spark, monkeypatch, seed):
    monkeypatch.setattr(H, "SMALL_SHARE_ROWS", 100)
    monkeypatch.setattr(H, "BLOCK_ROWS", 16)
    monkeypatch.setattr(H, "GROUP_ROWS", 20)
    monkeypatch.setattr(H, "FIRST_STEP", 8)
    assert len(check(spark, clustered(600, 16, seed), 7)) > 300


def test_ties_nulls_repeats_and_lengths(spark):
    v, w = [0.5, -0.25, 1.0], [0.5, 0.5, 0.5]
    rows = [(i, i % 2, v, 0) for i in range(40)] + [(100 + i, i % 3, w, 0) for i in range(10)]
    rows += [(0, 0, v, 1), (0, 0, w, 1), (0, 1, v, 1), (7, 1, v, 2), (200, None, v, 0), (None, 1, v, 0), (300, 1, None, 0), (400, 1, [1.0, None, 0.0], 0),
             (500, 1, [1.0, float("nan"), 0.0], 0), (510, 1, [1.0, float("inf"), 0.0], 0), (520, 0, [0.0, 0.0, 0.0], 0), (530, 1, [], 0), (540, 0, [], 0), (550, 0, [], 0),
             (560, 0, [2.0], 0), (570, 0, [2.0], 0), (571, 1, [2.0], 0), (580, 1, [-1.0, -1.0, -1.0], 0), (590, 1, [3e6, 2e6, 1e6], 0), (591, 1, [3e6, 2e6, 1e6], 0), (592, 0, [3e6, 2e6, 1e6], 0)]
    got = check(spark, rows, 10)
    assert {a for a, *_ in got} >= {0, 10, 100, 540, 560, 590}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert H.hard_negatives(df).collect() == []
    assert check(spark, [(0, 1, [1.0], 0)], 1) == {}


def test_walks_end_early():
    """Tight clusters are certified long before the end of the list."""
    rows = clustered(4000, 24, 9, 0.05)
    q = np.floor(256 * np.array([r[2] for r in rows])).astype(np.int64)
    every = H.Rows(np.arange(4000), np.zeros(4000, np.int64), q, *H._units(q))
    own = np.flatnonzero((every.unit @ every.unit[0]) > 0.9)[:50]
    centre = every.unit[own].sum(0)
    centre /= np.sqrt((centre ** 2).sum())
    radius = float(np.arccos(np.clip(every.unit[own] @ centre, -1, 1)).max())
    order, bound = H.shared_list(every, centre, radius)
    assert (q[own] @ q[order].T <= every.norm[own][:, None] * bound * (1 + 1e-9) + 1).all()
    low, high = np.full((50, 1), H.LOWEST), np.full((50, 1), H.HIGHEST)
    m, _, s, i = H.walk(every, order, bound, own, np.zeros(50, np.int64), q[own], low, high, True, 5)
    need = np.array([s[m == k].min() for k in range(50)])
    steps = (every.norm[own][:, None] * bound >= need[:, None]).sum(1)
    assert steps.max() < 2000  # half of the list is never scored
