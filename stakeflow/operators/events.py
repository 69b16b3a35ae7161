"""Alignment of enriched bets to the fixed 17-column event schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M
from stakeflow.operators.asof import next_event_gap
from stakeflow.operators.stats import quantiles

EVENT_COLUMNS = [
    "eventType", "userId", "sessionId", "gameId", "gameType", "provider", "timestamp",
    "durationSeconds", "roundsPlayed", "stakeLevelCategory", "outcome", "exitType",
    "returnedWithin10mins", "deviceType", "timeOfDay", "dayOfWeek", "entryPoint",
]

EVENT_SCHEMA = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("sessionId", T.StringType()),
    T.StructField("gameId", T.StringType()),
    T.StructField("gameType", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("durationSeconds", T.DoubleType()),
    T.StructField("roundsPlayed", T.IntegerType()),
    T.StructField("stakeLevelCategory", T.StringType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("exitType", T.StringType()),
    T.StructField("returnedWithin10mins", T.BooleanType()),
    T.StructField("deviceType", T.StringType()),
    T.StructField("timeOfDay", T.StringType()),
    T.StructField("dayOfWeek", T.StringType()),
    T.StructField("entryPoint", T.StringType()),
])


def stake_cutoffs(tx: DataFrame, stake_col: str = "betAmount", settings: Settings = DEFAULT):
    """The 0.33 / 0.66 quantiles of the lenient stake (NULL -> 0), taken over
    all rows before any row is dropped."""
    stake = tx.select(F.coalesce(F.col(stake_col).try_cast("double"), F.lit(0.0)).alias("s"))
    return quantiles(stake, "s", [0.33, 0.66])


def align_to_schema(
    tx: DataFrame,
    id_col: str | None = None,
    game_type_col: str | None = None,
    settings: Settings = DEFAULT,
    check: bool = False,
) -> DataFrame:
    """Map enriched transactions to the canonical events table.

    * sessionId = ``sess_<_id>`` (or ``sess_<id_col>``); rows need a stable id.
    * gameId = the ``gameId`` column when present, else the slug of ``gameName``.
    * invalid user / game ids (NULL or text sentinels) and NULL times are dropped.
    * returnedWithin10mins: the same user's next event (by time, then
      sessionId) is at most 10 minutes later.
    """
    if check and tx.isEmpty():
        raise DataValidationError("no transactions to build events from")
    cols = tx.columns
    ts = F.col("timestamp") if dict(tx.dtypes)["timestamp"].startswith("timestamp") \
        else F.col("timestamp").cast("string").try_cast("timestamp_ntz")
    ident = "_id" if "_id" in cols else id_col
    if ident is None:
        raise DataValidationError("align_to_schema needs a stable row id column (_id or id_col).")
    sess = M.session_id(ident)
    game = M.clean_id("gameId") if "gameId" in cols else M.game_slug("gameName")
    duration = F.coalesce(F.col("session_duration_sec").try_cast("double"), F.lit(0.0)) \
        if "session_duration_sec" in cols else F.lit(0.0)
    q1, q2 = stake_cutoffs(tx, settings=settings)
    stake = F.coalesce(F.col("betAmount").try_cast("double"), F.lit(0.0))
    gcol = game_type_col or next((c for c in ["categoryName", "gameType", "gameType_raw"] if c in cols), None)
    gtype = M.map_game_type(gcol) if gcol else F.lit("unknown")
    provider = M.map_provider("providerName") if "providerName" in cols else F.lit("unknown")
    outcome = M.map_outcome(F.col("result")) if "result" in cols else F.lit("break_even")
    device = M.map_device_type("deviceType_raw") if "deviceType_raw" in cols else F.lit("unknown")
    entry = M.map_entry_point("entryPoint_raw") if "entryPoint_raw" in cols else F.lit("unknown")

    base = tx.select(
        F.lit("game_session").alias("eventType"),
        M.clean_id("userId").alias("userId"),
        sess.alias("sessionId"),
        game.alias("gameId"),
        gtype.alias("gameType"),
        provider.alias("provider"),
        ts.alias("timestamp"),
        duration.alias("durationSeconds"),
        F.lit(1).alias("roundsPlayed"),
        (M.stake_tier(stake, q1, q2) if q1 is not None else F.lit("low")).alias("stakeLevelCategory"),
        outcome.alias("outcome"),
        device.alias("deviceType"),
        entry.alias("entryPoint"),
    ).where(~M.is_null_like("userId") & ~M.is_null_like("gameId") & F.col("timestamp").isNotNull())

    flagged = next_event_gap(base, "userId", "timestamp", "sessionId", "returnedWithin10mins",
                             max_gap_seconds=600, bucket_seconds=settings.window_bucket_seconds)
    out = (
        flagged.withColumn("exitType", M.exit_type("durationSeconds", "returnedWithin10mins"))
        .withColumn("timeOfDay", M.map_time_of_day("timestamp"))
        .withColumn("dayOfWeek", M.map_day_of_week("timestamp"))
    )
    return out.select(*EVENT_COLUMNS)


def enum_violations(events: DataFrame) -> DataFrame:
    """Values present in events but outside the allowed sets
    (``kind`` = invalid for game type / provider / device, extra for entry point)."""
    spark = events.sparkSession
    parts = []
    for col, allowed, kind in [("gameType", M.VALID_GAME_TYPES, "invalid"),
                               ("provider", M.VALID_PROVIDERS, "invalid"),
                               ("deviceType", M.VALID_DEVICE_TYPES, "invalid"),
                               ("entryPoint", M.VALID_ENTRY_POINTS, "extra")]:
        present = events.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
        ok = spark.createDataFrame([(v,) for v in allowed], "value string")
        parts.append(present.join(F.broadcast(ok), "value", "left_anti")
                     .select(F.lit(col).alias("column"), F.lit(kind).alias("kind"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_columns(df: DataFrame, expected=EVENT_COLUMNS) -> list[str]:
    """Expected schema columns absent from ``df`` (driver-side schema check)."""
    return [c for c in expected if c not in df.columns]


def schema_coverage(df: DataFrame, expected=EVENT_COLUMNS) -> DataFrame:
    """G6 over the rows: for every expected column whether the table has it and how many rows fill it."""
    filled = df.agg(*[(F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in expected])
    present = F.col("column").isin([c for c in expected if c in df.columns])
    return filled.unpivot([], list(expected), "column", "rows_filled").select("column", present.alias("present"), "rows_filled")
