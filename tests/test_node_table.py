"""Node table by bucket: updates in place, untouched buckets stay, readers see whole versions."""

import uuid

from pyspark.sql import functions as F

from stakeflow.operators import explain as X
from stakeflow.session import shared_path
from stakeflow.sources import sinks as K


def test_copy_on_write(spark):
    path = shared_path(spark, f"nodes-{uuid.uuid4().hex}")
    nodes = spark.createDataFrame([(f"n{i}", "seg", None, 1.0) for i in range(200)], "id string, segment string, embedding array<double>, bias double")
    K.write_node_table(nodes, path, buckets=16)
    assert K.read_node_table(spark, path).count() == 200
    new = spark.createDataFrame([("n3", [1.0], None), ("n77", [2.0], 5.0), ("gone", [9.0], 9.0)], "id string, embedding array<double>, bias double")
    before = {r.id: (r.bucket, r.version) for r in K.read_node_table(spark, path, True).collect()}
    assert K.update_node_table(spark, path, new) in (1, 2)
    rows = {r.id: r for r in K.read_node_table(spark, path, True).collect()}
    assert len(rows) == 200 and "gone" not in rows
    assert (rows["n3"].embedding, rows["n3"].bias) == ([1.0], None) and (rows["n77"].embedding, rows["n77"].bias) == ([2.0], 5.0)
    assert all(r.embedding is None and r.bias == 1.0 and r.segment == "seg" for k, r in rows.items() if k not in ("n3", "n77"))
    touched = {before["n3"][0], before["n77"][0]}
    assert all((r.version == 1) == (r.bucket in touched) for r in rows.values())
    assert K.update_node_table(spark, path, new.where("id = 'gone'")) == 0
    assert K.update_node_table(spark, path, new.where("id = 'n3'").withColumn("bias", F.lit(7.0))) == 1
    again = {r.id: r for r in K.read_node_table(spark, path, True).collect()}
    assert again["n3"].bias == 7.0 and again["n3"].version == 2 and again["n77"].bias == 5.0 and len(again) == 200
    K.remove_path(spark, path)


def test_samples_have_their_exact_size(spark):
    for n in (0, 1, 9, 10, 1003):
        rows = spark.range(n).select(F.col("id").cast("string").alias("u"), F.lit("g").alias("g"))
        cuts = X.sample_cutoffs(rows, ["u", "g"], 3)
        for s, cut in enumerate(cuts):
            kept = 0 if cut is None else rows.where(X.sample_key(["u", "g"], s) <= cut).count()
            assert kept == -(-7 * n // 10)
