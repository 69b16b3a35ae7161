"""Enrichment: dimension lookup, as-of session and device joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M
from stakeflow.operators.asof import asof_join


def dedup_first(df: DataFrame, key: str | list[str], order: list) -> DataFrame:
    """One row per key, the first by ``order`` (an explicit, total order).

    Aggregation with ``min_by`` on a struct: partial aggregation runs map-side,
    so a key with a third of all rows is pre-reduced before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order)
    return df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), ordering).alias("__r")
    ).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others])


def lookup_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    columns: list[str],
    order: list | None = None,
    check_inflation: bool = False,
) -> DataFrame:
    """Left join a dimension deduplicated to one row per key.

    Because the dimension is deduplicated first, the join cannot add rows; with
    ``check_inflation`` the row counts are still compared (two actions).  Spark
    broadcasts the dimension below its own byte threshold, at planning or, by
    its measured size, at run time.
    """
    d = dim.select(F.col(dim_key).alias("__dk"), *columns).where(F.col("__dk").isNotNull())
    d = dedup_first(d, "__dk", order or [F.col(c) for c in columns])
    out = fact.join(d, fact[fact_key] == d["__dk"], "left").drop("__dk")
    if check_inflation:
        before, after = fact.count(), out.count()
        if before != after:
            raise DataValidationError(f"the lookup changed the number of rows from {before} to {after}")
    return out


def clean_and_merge(
    transactions: DataFrame,
    games: DataFrame,
    key: str = "gameName",
    games_key: str | None = None,
    settings: Settings = DEFAULT,
    check_inflation: bool = False,
) -> DataFrame:
    """B6 + C1 + B7 + B8: normalise names, attach gameId/vendor/limits, provider
    fallback to the vendor, binary win flag."""
    tx = transactions
    if "gameName" in tx.columns and settings.game_name_map:
        tx = tx.replace(dict(settings.game_name_map), subset=["gameName"])
    cols = [c for c in ["gameId", "gamevendor", "minBet", "maxBet", "gameType_raw"] if c in games.columns]
    merged = lookup_dimension(tx, games, key, games_key or key, cols,
                              check_inflation=check_inflation)
    raw_provider = F.col("providerName_raw") if "providerName_raw" in merged.columns else F.lit(None).cast("string")
    merged = merged.withColumn("providerName", F.coalesce(raw_provider, F.col("gamevendor"))).drop("gamevendor")
    return merged.withColumn("win", M.win_flag("result"))


def enrich_sessions(
    transactions: DataFrame,
    sessions: DataFrame | None,
    tx_keys: tuple[str, str] = ("userId", "gameId"),
    session_keys: tuple[str, str] = ("userId", "gameId"),
    tolerance_minutes: float | None = None,
    settings: Settings = DEFAULT,
    session_tie: str | None = None,
) -> DataFrame:
    """C2 + C3: ``session_duration_sec`` and ``entryPoint_raw`` from the latest
    session (by ``updated_at``) of the same user and game, at most the tolerance
    before the bet.  The game key is compared as text before the first '.'."""
    tol = settings.session_join_tolerance_min if tolerance_minutes is None else tolerance_minutes
    tx = transactions.drop("session_duration_sec", "entryPoint_raw")
    if sessions is None or sessions.isEmpty():
        return (tx.withColumn("session_duration_sec", F.lit(None).cast("double"))
                .withColumn("entryPoint_raw", F.lit(None).cast("string")))
    ukey, gkey = tx_keys
    tx = tx.withColumn("__gid", M.id_before_dot(gkey)).withColumn("__uid", M.clean_id(ukey))
    s = sessions.withColumn("__suid", M.clean_id(session_keys[0])).withColumn(
        "__sgid", M.clean_id(session_keys[1]))
    out = asof_join(
        tx, s, "timestamp", "updated_at",
        by=[("__uid", "__suid"), ("__gid", "__sgid")],
        payload={"session_duration_sec": "session_duration_sec", "entryPoint_raw": "entryPoint_raw"},
        tolerance_seconds=tol * 60.0, right_tie=session_tie,
    )
    return out.drop("__gid", "__uid")


DEVICE_CASCADE = [
    # fixed values: (transaction key, activity key) in priority order
    ("userId", "playerId"),
    ("playerId_bridge", "playerId"),
    ("userId", "loginId"),
    ("userId", "user_id"),
    ("userId", "userId"),
]


def device_pairs(tx_columns, activity_columns) -> list[tuple[str, str]]:
    """The cascade pairs whose columns exist on both sides."""
    return [(t, a) for t, a in DEVICE_CASCADE if t in tx_columns and a in activity_columns]


def enrich_device(
    transactions: DataFrame,
    users: DataFrame | None,
    activity: DataFrame | None,
    tolerance_hours: float | None = None,
    settings: Settings = DEFAULT,
    activity_tie: str | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """C4 + C5: ``deviceType_raw`` by a cascade of backward as-of joins.

    Each pair fills only rows still without a device value; a match whose
    device is NULL leaves the row open for the next pair.  Because a match
    never depends on other rows, the cascade equals "first non-NULL match in
    priority order".  With a unique row id (``id_col``) it runs as ONE as-of
    join: every transaction contributes one narrow row per applicable pair
    (id, pair, key, time), activity rows are tagged with their pair, the join
    is keyed by (pair, key), ``min_by(device, pair)`` per id picks the first
    non-NULL match, and one join brings it back.  The wide transaction rows are
    shuffled once instead of once per pair.  Without an id the pairs are
    chained (one as-of join each).
    ``activity`` is the output of ``load_activity`` (``_activity_ts``,
    ``deviceType_raw`` and the id columns present in the source).
    """
    tol = settings.device_join_tolerance_hours if tolerance_hours is None else tolerance_hours
    tx = transactions.drop("deviceType_raw")
    if activity is None:
        return tx.withColumn("deviceType_raw", F.lit(None).cast("string"))
    tx = tx.withColumn("userId", M.clean_id("userId"))
    if users is not None and {"userId", "playerId"}.issubset(users.columns):
        bridge = users.select(M.clean_id("userId").alias("__bu"),
                              M.clean_id("playerId").alias("playerId_bridge"))
        bridge = dedup_first(bridge, "__bu", [F.col("playerId_bridge")])
        tx = tx.join(bridge, tx["userId"] == bridge["__bu"], "left").drop("__bu")
    pairs = device_pairs(tx.columns, activity.columns)
    tie_cols = [activity_tie] if activity_tie else []
    if not pairs:
        return tx.withColumn("deviceType_raw", F.lit(None).cast("string")).drop("playerId_bridge")

    def key(c):
        return F.when(~M.is_null_like(c), M.clean_id(c))

    if id_col is not None:
        narrow = tx.select(F.col(id_col).alias("__id"), "timestamp", F.explode(F.array(*[
            F.struct(F.lit(i).alias("p"), key(tk).alias("k")) for i, (tk, _) in enumerate(pairs)])).alias("__pk"))
        narrow = narrow.select("__id", "timestamp", F.col("__pk.p").alias("__p"), F.col("__pk.k").alias("__k"))
        # one pass over the activity for all pairs
        right = activity.select("_activity_ts", "deviceType_raw", *tie_cols, F.explode(F.array(*[
            F.struct(F.lit(i).alias("p"), key(ak).alias("k")) for i, (_, ak) in enumerate(pairs)])).alias("__pk"))
        right = right.select(F.col("__pk.p").alias("__rp"), F.col("__pk.k").alias("__rk"), "_activity_ts", "deviceType_raw", *tie_cols)
        m = asof_join(narrow, right, "timestamp", "_activity_ts", by=[("__p", "__rp"), ("__k", "__rk")],
                      payload={"deviceType_raw": "__dev"}, tolerance_seconds=tol * 3600.0,
                      right_tie=activity_tie)
        first = (m.where(F.col("__dev").isNotNull()).groupBy("__id")
                 .agg(F.min_by("__dev", "__p").alias("deviceType_raw")))
        out = tx.join(first, tx[id_col] == first["__id"], "left").drop("__id")
        return out.drop("playerId_bridge")

    fills = []
    for i, (tk, ak) in enumerate(pairs):
        tx = tx.withColumn(f"__k{i}", key(tk))
        act = activity.select(key(ak).alias("__ak"), "_activity_ts", "deviceType_raw", *tie_cols)
        tx = asof_join(tx, act, "timestamp", "_activity_ts", by=[(f"__k{i}", "__ak")],
                       payload={"deviceType_raw": f"__dev{i}"},
                       tolerance_seconds=tol * 3600.0, right_tie=activity_tie).drop(f"__k{i}")
        fills.append(F.col(f"__dev{i}"))
    out = tx.withColumn("deviceType_raw", F.coalesce(*fills))
    return out.drop(*[f"__dev{i}" for i in range(len(pairs))], "playerId_bridge")


def key_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Number of distinct non-sentinel keys present on both sides (one row)."""
    l = left.select(M.clean_id(left_key).alias("k")).where(~M.is_null_like("k")).distinct()
    r = right.select(M.clean_id(right_key).alias("k")).where(~M.is_null_like("k")).distinct()
    return l.join(r, "k", "inner").agg(F.count("*").alias("overlap"))


def enrichment_coverage(tx: DataFrame) -> DataFrame:
    """Matched / total and percentage for duration, entry point and device,
    plus the count of quick-exit candidates (< 30 s)."""
    aggs = [F.count("*").alias("total")]
    for c, name in [("session_duration_sec", "duration"), ("entryPoint_raw", "entry_point"),
                    ("deviceType_raw", "device")]:
        if c in tx.columns:
            aggs.append(F.count(c).alias(f"{name}_matched"))
    if "session_duration_sec" in tx.columns:
        aggs.append(F.count_if(F.col("session_duration_sec") < 30).alias("quick_exit_candidates"))
    out = tx.agg(*aggs)
    for name in ["duration", "entry_point", "device"]:
        if f"{name}_matched" in out.columns:
            out = out.withColumn(f"{name}_pct", M.round_to(F.col(f"{name}_matched") * 100.0 / F.col("total"), 4))
    return out
