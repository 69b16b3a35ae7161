"""Weighted sums of feature vectors: the same numbers as by component, without a row per component."""

from pyspark.sql import functions as F

from stakeflow.operators import explain as X


def by_component(rows, key):
    e = rows.select(key, "w", F.posexplode("embedding").alias("i", "x")).groupBy(key, "i").agg(F.sum(F.col("w") * F.col("x")).alias("s"))
    return {r[0]: [v for _, v in sorted((x.i, x.s) for x in r[1])] for r in e.groupBy(key).agg(F.collect_list(F.struct("i", "s"))).collect()}


def test_sums_equal_those_by_component(spark):
    rows = spark.createDataFrame(
        [("a", 0.5, [1.0, 2.0, None]), ("a", 2.0, [3.0, None, 1.0]), ("b", 1.0, [1.0]), ("b", 3.0, [1.0, 4.0]), ("c", 1.0, None), ("d", 1.0, [])],
        "k string, w double, embedding array<double>")
    got = {r.k: r.embedding for r in X.sum_vectors(rows, "k", "w").collect()}
    assert got == by_component(rows, "k") == {"a": [6.5, 1.0, 2.0], "b": [4.0, 12.0]}


def test_representations_make_no_row_per_component(spark):
    index = spark.createDataFrame([("u1", 0), ("u2", 1), ("u3", 2)], "userId string, idx long")
    tokens = spark.createDataFrame([("u1", ["x", "y"]), ("u2", ["x"])], "userId string, tokens array<string>")
    vectors = spark.createDataFrame([("id:u1", [1.0, 0.0], 1.0), ("id:u2", [0.0, 1.0], 0.0), ("id:u3", [2.0, 2.0], None), ("x", [3.0, 3.0], 3.0), ("y", [0.0, 6.0], 0.0)],
                                    "feature string, embedding array<double>, bias double")
    rep = X.representations(X.entity_features(index, "userId", tokens), vectors, "userId")
    got = {r.userId: ([round(x, 9) for x in r.embedding], round(r.bias, 9)) for r in rep.collect()}
    assert got == {"u1": ([round(4 / 3, 9), 3.0], round(4 / 3, 9)), "u2": ([1.5, 2.0], 1.5), "u3": ([2.0, 2.0], 0.0)}
    assert "posexplode" not in rep._jdf.queryExecution().optimizedPlan().toString()
