"""User, game, provider and user x game feature tables.

All tables are single ``groupBy`` aggregations with map-side partial
aggregation, so a user holding a third of all events is pre-reduced inside
each input task before anything is shuffled.  Scalars shared by all rows (the
global max time) are lazy scalar subqueries, evaluated once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M
from stakeflow.operators.stats import distinct_in_group, quantiles
from stakeflow.session import cut_lineage

# fixed values: defaults for modes of empty groups
USER_MODE_DEFAULTS = {"preferred_time_of_day": "late_night", "preferred_day_of_week": "friday",
                      "preferred_device": "unknown", "preferred_entry_point": "unknown"}


def mode_or(col: str, default: str):
    """Most frequent non-NULL value, ties -> smallest, none -> default."""
    return F.coalesce(F.mode(F.col(col), True), F.lit(default))


def days_between(later, earlier):
    return M.seconds_between(earlier, later) / F.lit(86400.0)


def with_flags(events: DataFrame) -> DataFrame:
    """B25 + B26: quick-exit / positive flags and engagement intensity."""
    return (
        events.withColumn("is_quick_exit", (F.col("exitType") == "quick_exit").cast("int"))
        .withColumn("is_positive_outcome", (F.col("outcome") == "net_positive").cast("int"))
        .withColumn("engagement_intensity",
                    M.engagement_intensity("durationSeconds", "roundsPlayed", "stakeLevelCategory"))
    )


def max_time(events: DataFrame, col: str = "timestamp"):
    """D3 helper: the global max time as a lazy scalar subquery Column."""
    return events.agg(F.max(col)).scalar()


def user_features(fe: DataFrame, max_ts=None) -> DataFrame:
    """D1 + D3."""
    max_ts = max_ts if max_ts is not None else max_time(fe)
    out = fe.groupBy("userId").agg(
        F.count("sessionId").alias("total_sessions"),
        distinct_in_group("gameId").alias("unique_games"),
        distinct_in_group("provider").alias("unique_providers"),
        distinct_in_group("gameType").alias("unique_game_types"),
        F.avg("durationSeconds").alias("avg_duration_sec"),
        F.avg("roundsPlayed").alias("avg_rounds"),
        F.avg("is_quick_exit").alias("quick_exit_rate"),
        F.avg(F.col("returnedWithin10mins").cast("double")).alias("return_10m_rate"),
        F.avg("is_positive_outcome").alias("positive_outcome_rate"),
        F.avg("engagement_intensity").alias("avg_engagement_intensity"),
        mode_or("timeOfDay", USER_MODE_DEFAULTS["preferred_time_of_day"]).alias("preferred_time_of_day"),
        mode_or("dayOfWeek", USER_MODE_DEFAULTS["preferred_day_of_week"]).alias("preferred_day_of_week"),
        mode_or("deviceType", USER_MODE_DEFAULTS["preferred_device"]).alias("preferred_device"),
        mode_or("entryPoint", USER_MODE_DEFAULTS["preferred_entry_point"]).alias("preferred_entry_point"),
        F.max("timestamp").alias("last_event_ts"),
    )
    return out.withColumn("recency_days", days_between(max_ts, F.col("last_event_ts")))


def game_features(fe: DataFrame) -> DataFrame:
    """D4."""
    out = fe.groupBy("gameId").agg(
        F.count("sessionId").alias("game_sessions"),
        F.count_distinct("userId").alias("unique_users"),
        mode_or("gameType", "live_dealer").alias("game_type"),
        mode_or("provider", "unknown").alias("provider"),
        F.avg("durationSeconds").alias("avg_duration_sec"),
        F.avg("roundsPlayed").alias("avg_rounds"),
        F.avg("is_quick_exit").alias("quick_exit_rate"),
        F.avg(F.col("returnedWithin10mins").cast("double")).alias("return_10m_rate"),
        F.avg("is_positive_outcome").alias("positive_outcome_rate"),
    )
    return out.withColumn("popularity_score", F.log1p(F.col("game_sessions")))


def provider_features(fe: DataFrame) -> DataFrame:
    """D5."""
    return fe.groupBy("provider").agg(
        F.count("sessionId").alias("provider_sessions"),
        F.count_distinct("userId").alias("provider_unique_users"),
        F.avg("engagement_intensity").alias("provider_avg_engagement"),
    )


def user_game_base(fe: DataFrame, max_ts=None) -> DataFrame:
    """D6 without the implicit score."""
    max_ts = max_ts if max_ts is not None else max_time(fe)
    out = fe.groupBy("userId", "gameId").agg(
        F.count("sessionId").alias("interaction_count"),
        F.avg("durationSeconds").alias("avg_duration_sec"),
        F.avg("roundsPlayed").alias("avg_rounds"),
        F.avg("is_positive_outcome").alias("positive_outcome_rate"),
        F.avg(F.col("returnedWithin10mins").cast("double")).alias("return_10m_rate"),
        F.avg("engagement_intensity").alias("avg_engagement_intensity"),
        F.max("timestamp").alias("last_interaction_ts"),
        mode_or("gameType", "live_dealer").alias("dominant_game_type"),
        mode_or("provider", "unknown").alias("dominant_provider"),
    )
    return out.withColumn("recency_days", days_between(max_ts, F.col("last_interaction_ts")))


def with_implicit_score(user_game: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """B27 + B28: implicit preference score; the engagement cap is the 0.95
    quantile of the pair-level engagement (exact, distributed)."""
    user_game = cut_lineage(user_game)  # read for the cap and by every use of the scores
    (p95,) = quantiles(user_game, "avg_engagement_intensity", [0.95])
    return user_game.withColumn(
        "implicit_score",
        M.implicit_score("interaction_count", "avg_engagement_intensity", p95 or 0.0,
                         "positive_outcome_rate", "recency_days"),
    )


@dataclass
class FeatureTables:
    fe: DataFrame
    users: DataFrame
    games: DataFrame
    providers: DataFrame
    user_game: DataFrame


def build_feature_tables(events: DataFrame, settings: Settings = DEFAULT, check: bool = False) -> FeatureTables:
    """All four feature tables from one events table (lazy except the p95 cut)."""
    if check and events.isEmpty():
        raise DataValidationError("no events to build features from")
    fe = with_flags(events)
    max_ts = max_time(fe)
    return FeatureTables(
        fe=fe,
        users=user_features(fe, max_ts),
        games=game_features(fe),
        providers=provider_features(fe),
        user_game=with_implicit_score(user_game_base(fe, max_ts), settings),
    )
