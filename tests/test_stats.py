"""Distributed quantiles, ranks, indexes and buckets against pandas / numpy."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stakeflow.operators import stats as ST


def test_quantiles_match_numpy(spark):
    rnd = random.Random(1)
    vals = [rnd.random() * 100 for _ in range(1001)] + [5.0] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    got = ST.quantiles(df, "x", [0.0, 0.33, 0.5, 0.66, 0.95, 1.0])
    exp = np.quantile(vals, [0.0, 0.33, 0.5, 0.66, 0.95, 1.0])
    assert np.allclose(got, exp, rtol=0, atol=1e-12)


def test_quantiles_narrow_their_brackets(spark):
    """With room for few values, sketches of the brackets narrow them until the values fit."""
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.normal(size=30_000), np.full(20_000, 0.25), rng.integers(0, 50, 10_000) / 10.0, [-1e300, 1e300]])
    df = spark.createDataFrame([(float(v), None if v > 2 else 1) for v in vals], "x double, y int").repartition(6)
    probs = [0.0, 0.001, 0.25, 0.5, 0.65, 0.9999, 1.0]
    exp = np.quantile(vals, probs)
    for limit in (100_000, 300, 40):
        assert np.allclose(ST.quantiles(df, "x", probs, limit=limit), exp, rtol=0, atol=1e-12)
    assert ST.quantiles(df, "y", [0.1, 0.9]) == [1.0, 1.0]
    assert ST.quantiles(df.where("x is null"), "x", [0.5]) == [None]
    sketch = ST.quantiles(df, "x", [0.25, 0.65], exact=False)
    ranks = [(vals < v).mean() for v in sketch], [(vals <= v).mean() for v in sketch]
    assert all(lo - 0.02 <= p <= hi + 0.02 for p, lo, hi in zip([0.25, 0.65], *ranks))


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    monkeypatch.setattr(ST, "BRACKET", -0.2)  # every bracket lies beside its rank
    vals = [float(i * i % 997) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert np.allclose(ST.quantiles(df, "x", [0.3, 0.7]), np.quantile(vals, [0.3, 0.7]))


def test_distinct_counts_do_not_copy_rows(spark):
    rows = [(f"u{i % 3}", f"g{i % 7}", None if i % 2 else f"p{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "u string, g string, p string")
    out = df.groupBy("u").agg(ST.distinct_in_group("g").alias("g"), ST.distinct_in_group("p").alias("p"), F.count("*").alias("n"))
    want = pd.DataFrame(rows, columns=["u", "g", "p"]).groupby("u").agg(g=("g", "nunique"), p=("p", "nunique"), n=("g", "size"))
    assert {r.u: (r.g, r.p, r.n) for r in out.collect()} == {u: tuple(r) for u, r in want.iterrows()}
    assert dict(out.dtypes)["g"] == "bigint"


def test_user_features_plan_has_no_expand(spark):
    import __spark_entry__ as E
    for name in ("user_features", "game_features", "provider_features"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan, name


def test_cumulative_sums_in_one_written_sort(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 9)), float(rng.normal())) for i in range(777)]
    df = spark.createDataFrame(rows, "i int, n int, v double").repartition(5)
    got = ST.cumulative_sums(df, ["v", "i"], ["n", "v"]).orderBy("__pos").collect()
    want = sorted(rows, key=lambda r: (r[2], r[0]))
    assert [r["__pos"] for r in got] == list(range(777)) and [r.i for r in got] == [w[0] for w in want]
    assert [r.cum_n for r in got] == np.cumsum([w[1] for w in want]).tolist()
    assert np.allclose([r.cum_v for r in got], np.cumsum([w[2] for w in want]))
    assert ST.cumulative_sums(df.limit(0), ["v"], ["n"]).count() == 0


def test_grouped_quantiles_hot_group(spark):
    rnd = random.Random(2)
    rows = [("hot", rnd.random()) for _ in range(3000)] + [(f"g{i % 5}", rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    got = {r["g"]: (r["q25"], r["q50"], r["q75"]) for r in
           ST.grouped_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, s in pdf.groupby("g")["v"]:
        assert np.allclose(got[g], s.quantile([0.25, 0.5, 0.75]).to_numpy(), atol=1e-12)


def test_dense_index_contiguous(spark):
    df = spark.createDataFrame([(str(i % 97),) for i in range(1000)], "k string")
    idx = ST.dense_index(df, "k").toPandas().sort_values("k")
    assert list(idx["idx"]) == list(range(97))
    assert list(idx["k"]) == sorted(idx["k"])


def test_average_ranks(spark):
    vals = [3, 1, 3, 2, 3, 5, 1]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, v double")
    got = {r["id"]: r["r"] for r in ST.average_ranks(df, "id", "v", "r").collect()}
    exp = pd.Series(vals).rank(method="average")
    assert [got[i] for i in range(len(vals))] == list(exp)


def test_quantile_bucket_matches_qcut(spark):
    labels = ["cold", "warm", "hot", "blockbuster"]
    for n in range(1, 15):
        vals = [float((i * 7) % 5) for i in range(n)]
        df = spark.createDataFrame([(f"{i:03d}", v) for i, v in enumerate(vals)], "id string, v double")
        got = [r["b"] for r in ST.quantile_bucket(df, "id", "v", labels, "b").orderBy("id").collect()]
        ranked = pd.Series(vals).rank(method="first")
        q = min(4, n)
        exp = [labels[0]] * n if q == 1 else list(pd.qcut(ranked, q=q, labels=labels[:q]).astype(str))
        assert got == exp, n


def test_prefix_share(spark):
    rows = [(f"u{i}", float(v)) for i, v in enumerate([5, 1, 3, 3, 10])]
    df = spark.createDataFrame(rows, "id string, v double").repartition(3)
    got = ST.prefix_share(df, "id", "v").orderBy("position").toPandas()
    s = np.sort([5, 1, 3, 3, 10]).astype(float)
    assert np.allclose(got["cum_value"], np.cumsum(s) / s.sum())
    assert np.allclose(got["cum_users"], np.arange(1, 6) / 5)


def test_half_of_all_rows_share_a_value(spark):
    rnd = random.Random(9)
    vals = [0.0] * 600 + [rnd.random() for _ in range(601)]
    rnd.shuffle(vals)
    df = spark.createDataFrame([(f"r{i:04d}", v, "ab"[i % 7 == 0]) for i, v in enumerate(vals)], "id string, x double, g string").repartition(5)
    probs = [0.0, 0.33, 0.5, 0.66, 0.95, 1.0]
    assert np.allclose(ST.quantiles(df, "x", probs), np.quantile(vals, probs))
    got = {r["g"]: (r["q50"], r["q95"]) for r in ST.grouped_quantiles(df, ["g"], "x", [0.5, 0.95]).collect()}
    for g in "ab":
        assert np.allclose(got[g], np.quantile([v for i, v in enumerate(vals) if "ab"[i % 7 == 0] == g], [0.5, 0.95]))
    ranks = {r["id"]: r["rk"] for r in ST.average_ranks(df, "id", "x", "rk").collect()}
    want = pd.Series(vals).rank()
    assert all(ranks[f"r{i:04d}"] == want[i] for i in range(len(vals)))
    # the shared value is one counted row: no range partition holds more than its share of the distinct values
    parts = ST.value_counts(df, "x").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == len(set(vals))


def test_dense_index(spark):
    keys = spark.createDataFrame([(str(i % 61),) for i in range(400)], "k string").repartition(4)
    idx = {r.k: r.idx for r in ST.dense_index(keys, "k").collect()}
    assert [k for k, _ in sorted(idx.items(), key=lambda x: x[1])] == sorted(idx) and sorted(idx.values()) == list(range(61))
