"""Explanations: unknown ids, diverse picks, permutation, PCA against numpy; schema coverage."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as E
from stakeflow.errors import DataValidationError
from stakeflow.operators import analytics as A
from stakeflow.operators import explain as X
from stakeflow.operators.events import schema_coverage
from stakeflow.plans.catalog import tables
from stakeflow.plans.queries_explain import fixture_model

SF = "/root/testdata/sf0.001"


def features(spark):
    u = spark.createDataFrame([("u1", "a", 0.5, True), ("u1", "id:u1", 0.5, False), ("u2", "id:u2", 1.0, False)],
                              "userId string, feature string, value double, is_token boolean")
    i = spark.createDataFrame([("g1", "id:g1", 1.0, False)], "gameId string, feature string, value double, is_token boolean")
    return u, i


def test_unknown_ids_are_an_error(spark):
    u, i = features(spark)
    good = spark.createDataFrame([("u1", "g1")], "userId string, gameId string")
    assert X.require_known(good, u, i) is good
    for pair in (("u9", "g1"), ("u1", "g9")):
        with pytest.raises(DataValidationError):
            X.require_known(spark.createDataFrame([pair], "userId string, gameId string"), u, i)


def test_diverse_pick_prefers_games_not_taken(spark):
    cand = spark.createDataFrame([("u1", "g1", 3.0, 1), ("u1", "g2", 2.0, 2), ("u2", "g1", 5.0, 1), ("u2", "g2", 4.0, 2), ("u2", "g3", 1.0, 3),
                                  ("u3", "g1", 1.0, 1)], "userId string, gameId string, score double, rank int")
    counts = spark.createDataFrame([("u1", 9), ("u2", 7), ("u3", 7), ("u4", 1)], "userId string, n int")
    picks = X.diverse_pick(cand, counts, 3)
    assert [(p["userId"], p["gameId"]) for p in picks] == [("u1", "g1"), ("u2", "g2"), ("u3", "g1")]


def test_permutation_moves_columns_whole(spark):
    rows = [(f"u{i:02d}", "t", 0.5, True) for i in range(0, 20, 2)] + [(f"u{i:02d}", "s", 1 / (i + 2), True) for i in range(5)]
    ef = spark.createDataFrame(rows, "userId string, feature string, value double, is_token boolean")
    index = spark.createDataFrame([(f"u{i:02d}", i) for i in range(20)], "userId string, idx long")
    changes = {r.userId: r.changes for r in X.permuted_changes(ef, index, "userId", ["t", "s"]).collect()}
    assert len(changes) == 20
    for k, f in enumerate(["t", "s"]):
        old = {u: next((v for x, g, v, _ in rows if x == u and g == f), 0.0) for u in changes}
        by_hash = sorted(old, key=lambda u: (hashlib.md5(f"{u}/{f}/42".encode()).hexdigest(), u))
        for u, source in zip(sorted(old), by_hash):
            assert abs(old[u] + changes[u][k] - old[source]) < 1e-12
        assert any(c[k] for c in changes.values())


def test_permuted_models_equal_models_derived_anew(spark):
    """Scores of the variant with one more dimension are those of representations built from the shuffled column."""
    rng = np.random.default_rng(3)
    u_fv = spark.createDataFrame([(f, rng.normal(size=4).tolist(), 0.1) for f in ("a", "b")], "feature string, embedding array<double>, bias double")
    i_fv = spark.createDataFrame([("c", rng.normal(size=4).tolist(), 0.2)], "feature string, embedding array<double>, bias double")
    users = spark.createDataFrame([(f"u{i}", i) for i in range(6)], "userId string, idx long")
    items = spark.createDataFrame([(f"g{i}", i) for i in range(5)], "gameId string, idx long")
    u_ef = spark.createDataFrame([(f"u{i}", "ab"[i % 2], 0.5) for i in range(5)], "userId string, feature string, value double")
    i_ef = spark.createDataFrame([("g0", "c", 1.0), ("g3", "c", 0.25)], "gameId string, feature string, value double")
    P, Q = rng.normal(size=(6, 4)), rng.normal(size=(5, 4))
    u_rep = spark.createDataFrame([(f"u{i}", P[i].tolist()) for i in range(6)], "userId string, embedding array<double>")
    i_rep = spark.createDataFrame([(f"g{i}", Q[i].tolist()) for i in range(5)], "gameId string, embedding array<double>")
    top = [("user", "b"), ("item", "c"), ("user", "a")]
    u, i = X.permuted_models(u_rep, i_rep, u_ef, i_ef, u_fv, i_fv, users, items, top)
    got = {(r.feature, r.userId): np.array(r.embedding) for r in u.collect()}
    item = {r.gameId: np.array(r.embedding) for r in i.collect()}
    assert len(got) == 24 and len(item) == 5
    fv = {r.feature: (np.array(r.embedding), r.bias) for r in u_fv.union(i_fv).collect()}
    du = {r.userId: r.changes for r in X.permuted_changes(u_ef, users, "userId", ["b", "a"]).collect()}
    di = {r.gameId: r.changes for r in X.permuted_changes(i_ef, items, "gameId", ["c"]).collect()}
    for k in range(6):
        for j in range(5):
            x, y = f"u{k}", f"g{j}"
            base = P[k] @ Q[j]
            want = {"": base, "b": base + du[x][0] * (fv["b"][0] @ Q[j] + 0.1), "a": base + du[x][1] * (fv["a"][0] @ Q[j] + 0.1),
                    "c": base + di[y][0] * (fv["c"][0] @ P[k] + 0.2)}
            for f, w in want.items():
                assert abs(got[f, x] @ item[y] - w) < 1e-9


def test_pca_matches_numpy(spark):
    got = E.queries()["pca_projection"](spark, SF).collect()
    rep = {r.userId: r.embedding for r in fixture_model(tables(spark, SF))["u_rep"].collect()}
    x = np.array([rep[r.userId] for r in got])
    values, vectors = np.linalg.eigh(np.cov((x - x.mean(0)).T))
    share = values[::-1] / values.sum()
    assert abs(got[0].explained_var_1 - share[0]) < 1e-5 and abs(got[0].explained_var_2 - share[1]) < 1e-5
    axis = (x - x.mean(0)) @ vectors[:, -1]
    pc = np.array([r.pc1 for r in got])
    assert min(abs(pc - axis).max(), abs(pc + axis).max()) < 1e-5
    order = sorted(got, key=lambda r: (r.pc1, r.userId))
    assert [r.pc1_tertile for r in order][0] == "low" and [r.pc1_tertile for r in order][-1] == "high"


def test_schema_coverage(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "userId string, gameId int")
    got = {r.column: (r.present, r.rows_filled) for r in schema_coverage(df, ["userId", "gameId", "timestamp"]).collect()}
    assert got == {"userId": (True, 2), "gameId": (True, 1), "timestamp": (False, 0)}


def test_cohorts_keep_late_weeks(spark):
    plays = spark.createDataFrame([("u", "2024-01-01 10:00:00"), ("u", "2024-03-01 10:00:00")], "userId string, t string").selectExpr(
        "userId", "cast(t as timestamp_ntz) as timestamp")
    joined = spark.createDataFrame([("u", "2023-12-25 10:00:00")], "userId string, t string").selectExpr(
        "userId", "cast(t as timestamp_ntz) as joined_at")
    got = sorted((str(r.cohort_week), str(r.activity_week), r.n_users) for r in A.cohort_matrix(plays, joined).collect())
    assert got == [("2023-12-25", "2024-01-01", 1), ("2023-12-25", "2024-02-26", 1)]


def test_raw_cut(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 3, 9, 30]], "x double")
    got = [r.b for r in A.raw_cut(df, "x", ["low", "mid", "high"], "b").orderBy("x").collect()]
    assert got == ["low", "low", "low", "mid", "mid", "high", "high"]
