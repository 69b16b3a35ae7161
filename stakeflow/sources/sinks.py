"""Sinks: model bundle, feature-store rows, graph node rows and reports.

Everything is written with the DataFrame writer (Parquet / CSV / JSON lines) so
it scales with the data and survives executor loss (task retries re-write
their own files; ``mode('overwrite')`` makes a re-run idempotent).  Network
stores of the source system (key-value store, graph database) are re-aimed as
the rows they would receive.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import ArtifactError, DataValidationError
from stakeflow.functions.mappers import round_to
from stakeflow.session import at_once

BUNDLE_PARTS = ["interactions", "user_features_matrix", "item_features_matrix", "user_id_map", "item_id_map",
                "game_metadata", "popularity_ranking"]


def write_bundle(path: str, parts: dict[str, DataFrame], check: bool = True) -> str:
    """Write every bundle part as Parquet under ``path``; refuses an empty
    interaction table."""
    missing = [p for p in BUNDLE_PARTS if p not in parts]
    if missing:
        raise ArtifactError(f"bundle parts missing: {missing}")
    if check and parts["interactions"].isEmpty():
        raise DataValidationError("the bundle would hold no interactions")
    at_once(parts["interactions"].sparkSession, lambda name: parts[name].write.mode("overwrite").parquet(os.path.join(path, name)), BUNDLE_PARTS)
    return path


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read all parts; a missing part raises ``ArtifactError``."""
    out = {}
    for name in BUNDLE_PARTS:
        try:
            out[name] = spark.read.parquet(os.path.join(path, name))
        except Exception as exc:  # AnalysisException: path does not exist
            raise ArtifactError(f"bundle part {name} missing at {path}") from exc
    return out


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: number of rows of ``a``, and of rows that only one of the two tables holds."""
    both = a.select(F.xxhash64(F.to_json(F.struct(*a.columns))).alias("h"), F.lit(1).alias("n")).unionByName(
        b.select(F.xxhash64(F.to_json(F.struct(*[F.col(c).cast(t).alias(c) for c, t in a.dtypes]))).alias("h"), F.lit(-1).alias("n")))
    per_row = both.groupBy("h").agg(F.sum("n").alias("d"), F.count_if(F.col("n") > 0).alias("rows"))
    return per_row.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.abs("d")), F.lit(0)).alias("differing"))


def id_map_check(id_map: DataFrame, key: str, idx: str = "idx") -> DataFrame:
    """One row: n, max idx, distinct idx and whether ids are 0..n-1."""
    distinct = [id_map.agg(F.count_distinct(c)).scalar().alias(n) for c, n in ((idx, "n_distinct_idx"), (key, "n_distinct_keys"))]
    return id_map.agg(F.count("*").alias("n"), F.max(idx).alias("max_idx")).select("n", "max_idx", *distinct).withColumn(
        "contiguous", (F.col("max_idx") + 1 == F.col("n")) & (F.col("n") == F.col("n_distinct_idx"))
        & (F.col("n") == F.col("n_distinct_keys")))


def _s(c):
    return F.col(c).cast("string")


def _r(c, n):
    return round_to(c, n).cast("string")


# fixed values: the fields written per user / game and their rounding
USER_STORE_FIELDS = [("total_sessions", None), ("avg_duration_sec", 2), ("unique_games", None),
                     ("unique_providers", None), ("quick_exit_rate", 4), ("return_10m_rate", 4),
                     ("positive_outcome_rate", 4), ("avg_engagement_intensity", 4), ("preferred_time_of_day", None),
                     ("preferred_day_of_week", None), ("preferred_device", None), ("preferred_entry_point", None),
                     ("recency_days", 2)]
GAME_STORE_FIELDS = [("gameId", None), ("game_type", None), ("provider", None), ("game_sessions", None),
                     ("unique_users", None), ("popularity_score", 4), ("popularity_bucket", None),
                     ("return_10m_rate", 4), ("positive_outcome_rate", 4)]
GAME_STORE_NAMES = {"game_type": "gameType"}


def feature_store_rows(df: DataFrame, key_prefix: str, key_col: str, fields, run_ts, settings: Settings = DEFAULT,
                       names: dict | None = None) -> DataFrame:
    """(key, field, value, expires_at) rows of a string hash per entity with
    key ``<prefix>:<id>:features`` and expiry ``run_ts + ttl``."""
    names = names or {}
    kv = F.array(*[F.struct(F.lit(names.get(c, c)).alias("field"),
                            (_r(c, n) if n is not None else _s(c)).alias("value")) for c, n in fields])
    return df.select(F.concat(F.lit(f"{key_prefix}:"), F.col(key_col).cast("string"), F.lit(":features")).alias("key"),
                     F.explode(kv).alias("kv"),
                     (run_ts + F.expr(f"INTERVAL {settings.feature_ttl_seconds} SECONDS"))
                     .alias("expires_at")).select("key", "kv.field", "kv.value", "expires_at")


def graph_node_rows(rep: DataFrame, id_col: str, key: str = "id", updated_at=None) -> DataFrame:
    """A10: (key, embedding, bias, updated_at) node rows; the key column name is configurable."""
    ts = updated_at if updated_at is not None else F.current_timestamp()
    return rep.select(F.col(id_col).cast("string").alias(key), "embedding", "bias", ts.alias("updated_at"))


def matched_update(nodes: DataFrame, new_rows: DataFrame, key: str = "id", batch_size: int = DEFAULT.graph_batch_size):
    """Update existing nodes only (unmatched input rows are skipped).
    Returns (updated nodes, matched count per batch).  Batches number the input
    rows by their position in key order (distributed positions)."""
    from stakeflow.operators.stats import positions
    matched = new_rows.join(nodes.select(key), key, "left_semi")
    upd = nodes.join(new_rows.select(key, F.col("embedding").alias("__e"), F.col("bias").alias("__b"),
                                     F.col("updated_at").alias("__u")), key, "left")
    cols = [c for c in nodes.columns if c not in ("embedding", "bias", "updated_at")]
    updated = upd.select(*cols, F.coalesce("__e", *( [F.col("embedding")] if "embedding" in nodes.columns else []))
                         .alias("embedding"),
                         F.coalesce("__b", *( [F.col("bias")] if "bias" in nodes.columns else [])).alias("bias"),
                         F.coalesce("__u", *( [F.col("updated_at")] if "updated_at" in nodes.columns else []))
                         .alias("updated_at"))
    batches = positions(new_rows.select(key), [key], "__pos").withColumn(
        "batch_id", F.floor(F.col("__pos") / batch_size))
    per_batch = batches.join(matched.select(key), key, "left_semi").groupBy("batch_id").agg(
        F.count("*").alias("matched"))
    return updated, per_batch


#: Hash buckets of a written node table.
NODE_BUCKETS = 64


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def write_node_table(nodes: DataFrame, path: str, key: str = "id", buckets: int = NODE_BUCKETS) -> None:
    """A node table that can be updated in part: files by hash bucket of the key, and a manifest with the
    version of each bucket.  Version 0 holds all buckets."""
    nodes.withColumn("bucket", _bucket(key, buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/version=0")
    nodes.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("version")).write.parquet(
        f"{path}/manifest/number=0")


def _manifest(spark, path: str) -> tuple[int, DataFrame]:
    """(number, rows ``bucket, version``) of the newest manifest."""
    all_ = spark.read.parquet(f"{path}/manifest")
    number = all_.agg(F.max("number")).first()[0]
    return number, all_.where(F.col("number") == number).select("bucket", "version")


def read_node_table(spark, path: str, with_place: bool = False) -> DataFrame:
    """The newest version of every bucket; with ``with_place`` also ``bucket`` and ``version``."""
    _, manifest = _manifest(spark, path)
    # one row per bucket: the broadcast is bounded and prunes the partitions that are read
    rows = spark.read.parquet(f"{path}/data").join(F.broadcast(manifest), ["bucket", "version"], "left_semi")
    return rows if with_place else rows.drop("bucket", "version")


def update_node_table(spark, path: str, new_rows: DataFrame, key: str = "id") -> int:
    """A11 as a write: copy on write by bucket.  ``new_rows`` replace the like-named columns of existing nodes;
    keys without a node are skipped.  Only buckets with a match are written again, under a new version; the
    new manifest is written last, so readers see the old table or the new one.  Returns the buckets rewritten."""
    number, manifest = _manifest(spark, path)
    buckets = manifest.count()
    fresh = new_rows.withColumn("bucket", _bucket(key, buckets))
    now = read_node_table(spark, path, True)
    touched = now.select(key, "bucket").join(fresh.select(key, "bucket"), [key, "bucket"], "left_semi").select("bucket").distinct()
    touched = [r.bucket for r in touched.collect()]  # at most one row per bucket
    if not touched:
        return 0
    news = [c for c in new_rows.columns if c != key and c in now.columns]
    new = fresh.where(F.col("bucket").isin(touched)).select(key, F.struct(*news).alias("__new"))
    out = now.where(F.col("bucket").isin(touched)).join(new, key, "left")
    hit = F.col("__new").isNotNull()
    out = out.select(*[F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in news else F.col(c)
                       for c in now.columns if c not in ("version", "bucket")], "bucket")
    version = number + 1
    out.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/version={version}")
    manifest.select("bucket", F.when(F.col("bucket").isin(touched), version).otherwise(F.col("version")).alias("version")).write.parquet(
        f"{path}/manifest/number={version}")
    return len(touched)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Diagnostics table as CSV (header) or JSON lines."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(fmt)
    return path
