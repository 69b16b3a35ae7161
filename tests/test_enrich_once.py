"""The device cascade reads the activity once, however many pairs of keys it tries."""

from pyspark.sql import functions as F

from stakeflow.operators.enrich import enrich_device


def test_activity_is_read_once(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    ids = F.col("id").cast("string")
    activity = spark.range(7).select(F.when(F.col("id") < 3, ids).alias("loginId"), F.when(F.col("id") >= 3, ids).alias("user_id"),
                                     F.lit(None).cast("string").alias("playerId"), at.alias("_activity_ts"),
                                     F.concat(F.lit("d"), ids).alias("deviceType_raw"), F.col("id").alias("actId"))
    tx = spark.range(9).select(F.col("id").alias("txnId"), ids.alias("userId"), at.alias("timestamp"))
    out = enrich_device(tx, None, activity, activity_tie="actId", id_col="txnId")
    assert out._jdf.queryExecution().analyzed().toString().count("Range (0, 7") == 1
    assert {r.txnId: r.deviceType_raw for r in out.collect()} == {i: f"d{i}" if i < 7 else None for i in range(9)}
