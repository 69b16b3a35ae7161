"""Loaders for the raw source collections.

Each loader takes the raw collection as a DataFrame (read with an explicit
schema by ``read_collection``) and returns the cleaned table.  Predicates are
plain column comparisons so Catalyst pushes them into the Parquet scan; only
the needed columns are selected, so nested pruning reaches ``betParts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M

BET_PART = T.StructType([
    T.StructField("sportName", T.StringType()),
    T.StructField("categoryName", T.StringType()),
    T.StructField("tournamentName", T.StringType()),
    T.StructField("tournamentId", T.StringType()),
])

BET_TRANSACTIONS_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("loginId", T.StringType()),
    T.StructField("stake", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("createdDate", T.StringType()),
    T.StructField("gameType", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("betParts", T.ArrayType(BET_PART)),
])

GAME_DETAILS_SCHEMA = T.StructType([
    T.StructField("gameId", T.StringType()),
    T.StructField("gameName", T.StringType()),
    T.StructField("minBet", T.DoubleType()),
    T.StructField("maxBet", T.DoubleType()),
    T.StructField("category", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("gamevendor", T.StringType()),
    T.StructField("gameStatus", T.StringType()),
])

PLAYERS_SCHEMA = T.StructType([
    T.StructField("playerId", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("contactNo", T.StringType()),
    T.StructField("activeStatus", T.BooleanType()),
])

ACTIVITY_TIME_PRIORITY = ["updated_at", "created_at", "timestamp", "event_time"]
ACTIVITY_KEYS = ["playerId", "loginId", "user_id", "userId"]

TRANSACTION_COLUMNS = ["userId", "gameName", "categoryName", "providerName_raw", "tournamentId",
                       "betAmount", "result", "timestamp", "hourOfDay", "dayOfWeek"]


def require_columns(df: DataFrame, columns, what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataValidationError(f"Expected column(s) {missing} missing from {what}.")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise DataValidationError(f"No rows in {what}.")
    return df


def load_transactions(raw: DataFrame, settings: Settings = DEFAULT, check: bool = True) -> DataFrame:
    """A1 + B1 + B2 + B3 + B4 + B5: settled bets of one game type with a
    non-empty ``betParts`` array, first part flattened, renamed, cleaned."""
    require_columns(raw, ["betParts"], "bet transactions")
    df = raw.where(
        (F.col("gameType") == settings.game_type_filter)
        & (F.col("status") == settings.bet_status_filter)
        & (F.size("betParts") > 0)
    )
    if check:
        require_rows(df, "bet transactions for the configured filters")
    ts = F.col("createdDate").cast("string").try_cast("timestamp_ntz")
    first = F.get(F.col("betParts"), 0)
    out = df.select(
        F.col("loginId").alias("userId"),
        first.getField("sportName").alias("gameName"),
        first.getField("categoryName").alias("categoryName"),
        first.getField("tournamentName").alias("providerName_raw"),
        first.getField("tournamentId").alias("tournamentId"),
        F.col("stake").alias("betAmount"),
        F.col("result"),
        ts.alias("timestamp"),
    ).withColumn("hourOfDay", F.hour("timestamp")).withColumn("dayOfWeek", M.day_name("timestamp"))
    return out.dropna(subset=["userId", "gameName", "betAmount"]).select(*TRANSACTION_COLUMNS)


def load_game_details(raw: DataFrame, check: bool = True) -> DataFrame:
    """A2: active games, six columns, first category name or 'Unknown'."""
    require_columns(raw, ["category"], "game details")
    df = raw.where(F.col("gameStatus") == "ON")
    if check:
        require_rows(df, "active game details")
    return df.select(
        "gameId", "gameName",
        F.coalesce(F.get(F.col("category"), 0).getField("name"), F.lit("Unknown")).alias("gameType"),
        "gamevendor", "minBet", "maxBet",
    )


def load_users(raw: DataFrame) -> DataFrame:
    """A3: active players; contactNo becomes userId.  Empty input -> empty typed table."""
    return raw.where(F.col("activeStatus") == F.lit(True)).select(
        F.col("contactNo").alias("userId"), "playerId", "activeStatus")


def load_sessions(raw: DataFrame, source: str | None = "livecasino", closed_only: bool = True,
                  user_col: str = "user_id", game_col: str = "game_id", keep=()) -> DataFrame:
    """A4 + B11: closed sessions of one source with their duration in seconds
    (``keep`` names extra pass-through columns, e.g. a row id)."""
    df = raw
    if closed_only and "status" in raw.columns:
        df = df.where(F.col("status") == "Closed")
    if source is not None:
        df = df.where(F.col("source") == source)
    return df.select(
        *keep,
        M.clean_id(user_col).alias("userId"),
        M.clean_id(game_col).alias("gameId"),
        F.col("source").alias("entryPoint_raw"),
        F.col("created_at"), F.col("updated_at"),
        M.seconds_between("created_at", "updated_at").alias("session_duration_sec"),
    )


def activity_time_column(df: DataFrame) -> str | None:
    """A5: the first existing column of the priority list (a schema choice)."""
    return next((c for c in ACTIVITY_TIME_PRIORITY if c in df.columns), None)


def load_activity(raw: DataFrame, keep=()) -> DataFrame | None:
    """A5: device activity with one event-time column and the id columns present
    (``keep`` names extra pass-through columns, e.g. a row id)."""
    tcol = activity_time_column(raw)
    if tcol is None:
        return None
    keys = [c for c in ACTIVITY_KEYS if c in raw.columns]
    device = F.col("device_type") if "device_type" in raw.columns else F.lit(None).cast("string")
    ts = F.col(tcol) if dict(raw.dtypes)[tcol].startswith("timestamp") else F.col(tcol).cast("string").try_cast("timestamp_ntz")
    return raw.select(*keep, *keys, ts.alias("_activity_ts"), device.alias("deviceType_raw"))
