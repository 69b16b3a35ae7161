"""Behavioural analytics and diagnostics tables.

Inputs are a "plays" table (userId, gameId, betAmount, sessionDuration in
minutes, timestamp, gameType, hourOfDay, dayOfWeek, days_ago, segment ...) or
the canonical events.  Every report is an aggregation with map-side partial
aggregation; quantiles, ranks, buckets and cumulative shares over users use the
distributed helpers of ``stats`` (no single-partition window over users).
Global windows appear only over bounded tables (days, hours, a handful of
buckets).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.functions import mappers as M
from stakeflow.operators import stats as ST

# fixed values: bucket edges and labels
RECENCY_EDGES = [-1, 7, 30, 90, math.inf]
RECENCY_LABELS = ["recent", "moderate", "old", "stale"]
USER_RECENCY_EDGES = [-1, 1, 7, 30, 90, math.inf]
USER_RECENCY_LABELS = ["d0_1", "d2_7", "d8_30", "d31_90", "d90_plus"]
DIVERSITY_EDGES = [-0.01, 0.2, 0.5, 0.8, 1.0]
LOYALTY_EDGES = [-0.01, 0.25, 0.5, 0.75, 1.0]
LEVEL_LABELS = ["very_low", "low", "medium", "high"]
QUARTILE_LABELS = ["low", "mid_low", "mid_high", "high"]
BET_TIER_LABELS = ["tier1", "tier2", "tier3", "tier4"]
TIER_ORDER = {"1_5": 0, "6_20": 1, "21_plus": 2}
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def days_since(ts, ref) -> F.Column:
    """Whole days from ``ts`` to ``ref`` (floor), as pandas ``.dt.days``."""
    return F.floor(F.timestamp_diff("MICROSECOND", ts, ref) / F.lit(86400000000.0))


# ---------------------------------------------------------------------------
# pair and user tables
# ---------------------------------------------------------------------------
def interaction_agg(plays: DataFrame) -> DataFrame:
    """B29 + B30: per (user, game) counts, bets, session minutes, recency,
    the simple implicit score and the recency bucket."""
    g = plays.groupBy("userId", "gameId").agg(
        F.count("betAmount").alias("play_count"),
        F.sum("betAmount").alias("total_bet"),
        F.avg("betAmount").alias("avg_bet"),
        F.avg("sessionDuration").alias("avg_session_min"),
        F.min("days_ago").alias("last_played_days_ago"),
    )
    rec = M.recency_weight("last_played_days_ago")
    score = M.round_to(
        0.35 * F.least(F.col("play_count") / 20.0, F.lit(1.0))
        + 0.25 * F.least(F.col("total_bet") / 500000.0, F.lit(1.0))
        + 0.20 * F.least(F.col("avg_session_min") / 60.0, F.lit(1.0))
        + 0.20 * rec, 4)
    return g.withColumn("implicit_score", score).withColumn(
        "recency_bucket", M.right_closed_bucket("last_played_days_ago", RECENCY_EDGES, RECENCY_LABELS))


def preferred_value(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Per key the value with the most rows (ties: smallest value).
    Counted per (key, value) first, then reduced with ``min_by`` - no window."""
    c = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count("*").alias("__n"))
    return c.groupBy(key).agg(F.min_by(col, F.struct(-F.col("__n"), F.col(col))).alias(out))


def user_behaviour(plays: DataFrame) -> DataFrame:
    """D30 + D31 + D37: user table with conditional counts over 7 / 30 days."""
    u = plays.groupBy("userId").agg(
        F.count("betAmount").alias("total_sessions"),
        F.avg("betAmount").alias("avg_bet"),
        F.sum("betAmount").alias("total_bet"),
        F.avg("sessionDuration").alias("avg_session_duration"),
        F.count_distinct("gameId").alias("unique_games_played"),
        F.mode("hourOfDay", True).alias("preferred_hour"),
        F.mode("dayOfWeek", True).alias("preferred_day"),
        F.min("days_ago").alias("last_active_days_ago"),
        F.count_if(F.col("days_ago") <= 7).alias("sessions_last_7d"),
        F.count_if(F.col("days_ago") <= 30).alias("sessions_last_30d"),
    )
    return u.join(preferred_value(plays, "userId", "gameType", "preferred_game_type"), "userId", "left")


def item_popularity(games: DataFrame, plays: DataFrame) -> DataFrame:
    """Catalog left join play aggregates, 0 fill, log1p popularity."""
    g = plays.groupBy("gameId").agg(
        F.count("betAmount").alias("total_plays"),
        F.count_distinct("userId").alias("unique_players"),
        F.avg("betAmount").alias("avg_bet_on_game"),
        F.avg("sessionDuration").alias("avg_session_on_game"),
    )
    out = games.select("gameId", "gameName").join(g, "gameId", "left").fillna(
        0, subset=["total_plays", "unique_players", "avg_bet_on_game", "avg_session_on_game"])
    return out.withColumn("popularity_score", F.log1p("total_plays"))


def aggressiveness_loyalty(pairs: DataFrame, games: DataFrame) -> DataFrame:
    """D33 + B31: mean bet-to-limit ratio over a user's games, mean plays per
    game and the share of games played more than once."""
    j = pairs.join(games.select("gameId", "maxBet"), "gameId", "left")
    ratio = F.col("avg_bet") / F.greatest(F.col("maxBet"), F.lit(1.0))
    return j.groupBy("userId").agg(
        F.avg(ratio).alias("bet_to_limit_ratio"),
        F.avg("play_count").alias("avg_plays_per_game"),
        F.avg((F.col("play_count") > 1).cast("double")).alias("return_rate"),
    )


def preference_entropy(plays: DataFrame, key: str = "userId", col: str = "gameType") -> DataFrame:
    """-sum p log2(p + 1e-12) over a user's type shares (two-level agg)."""
    c = plays.groupBy(key, col).agg(F.count("*").alias("n"))
    tot = c.groupBy(key).agg(F.sum("n").alias("total"))
    p = c.join(tot, key).withColumn("p", F.col("n") / F.col("total"))
    return p.groupBy(key).agg((-F.sum(F.col("p") * F.log2(F.col("p") + 1e-12))).alias("entropy"))


def rfm(plays: DataFrame, segments: DataFrame | None = None, ref=None) -> DataFrame:
    """Frequency, monetary, last time and whole days since (to the global max)."""
    ref = ref if ref is not None else plays.agg(F.max("timestamp")).scalar()
    r = plays.groupBy("userId").agg(
        F.count("betAmount").alias("frequency"),
        F.sum("betAmount").alias("monetary"),
        F.max("timestamp").alias("last_ts"),
    ).withColumn("recency_days", days_since(F.col("last_ts"), ref))
    return r.join(segments, "userId", "left") if segments is not None else r


def week_of(ts) -> F.Column:
    """Monday of the week of a time."""
    return F.to_date(F.date_trunc("week", ts))


def cohort_matrix(plays: DataFrame, joined: DataFrame) -> DataFrame:
    """D27 in long form: distinct users by join week and activity week, every activity week of
    every cohort (``cohort_week, activity_week, n_users``; absent pairs are 0).

    ``joined`` (userId, joined_at) gives the join time; one partial row per user and week moves."""
    active = plays.select("userId", week_of(F.col("timestamp")).alias("activity_week")).distinct()
    cohort = joined.groupBy("userId").agg(week_of(F.min("joined_at")).alias("cohort_week"))
    return active.join(cohort, "userId").groupBy("cohort_week", "activity_week").agg(F.count("*").alias("n_users"))


def segment_pivot(plays: DataFrame, segment: str, col: str, values: list, prefix: str) -> DataFrame:
    """Segment x fixed value list counts, 0 fill, columns in list order."""
    piv = plays.groupBy(segment).pivot(col, values).count()
    return piv.select(segment, *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"{prefix}{v}") for v in values])


def segment_box_stats(per_user: DataFrame, segment: str, value: str) -> DataFrame:
    """Per segment count, min, quartiles, max of a per-user measure
    (exact, distributed per-group quantiles)."""
    q = ST.grouped_quantiles(per_user, [segment], value, [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    a = per_user.groupBy(segment).agg(F.count(value).alias("n_users"), F.min(value).alias("min"),
                                      F.max(value).alias("max"))
    return a.join(q, segment, "left")


def daily_activity(plays: DataFrame) -> DataFrame:
    """Plays per day and their 7-row moving average (one row per day)."""
    d = plays.groupBy(F.to_date("timestamp").alias("date")).agg(F.count("*").alias("plays"))
    w = Window.orderBy("date").rowsBetween(-6, 0)  # bounded: one row per day
    return d.withColumn("moving_avg_7", F.avg("plays").over(w))


def daily_type_mix(plays: DataFrame, types: list[str], top: int = 5) -> DataFrame:
    """Daily plays of the ``top`` most played types (ties: name), pivoted
    over the fixed type list (other types stay 0)."""
    head = plays.groupBy("gameType").count().orderBy(F.desc("count"), "gameType").limit(top)
    f = plays.join(F.broadcast(head.select("gameType")), "gameType", "left_semi")  # <= top rows
    piv = f.groupBy(F.to_date("timestamp").alias("date")).pivot("gameType", types).count()
    return piv.select("date", *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in types])


def complete_counts(plays: DataFrame, col: str, values: list, name: str) -> DataFrame:
    """Counts per value of a fixed list, missing values as 0."""
    spark = plays.sparkSession
    dtype = dict(plays.dtypes)[col]
    keys = spark.createDataFrame([(v,) for v in values], f"{col} {dtype}")
    c = plays.groupBy(col).agg(F.count("*").alias(name))
    return keys.join(c, col, "left").fillna(0, subset=[name])


def equal_width_histogram(values: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), all bins
    listed.  Bin = floor((x - min) * bins / (max - min)), capped at bins - 1."""
    spark = values.sparkSession
    v = values.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    lo, hi = v.agg(F.min("x")).scalar(), v.agg(F.max("x")).scalar()
    width = hi - lo
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(((F.col("x") - lo) * bins) / width), F.lit(bins - 1))).cast("long")
    c = v.groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    grid = spark.range(bins).withColumnRenamed("id", "bin")
    out = grid.join(c, "bin", "left").fillna(0, subset=["n"])
    return out.select("bin", (lo + F.col("bin") * width / bins).alias("bin_start"),
                      (lo + (F.col("bin") + 1) * width / bins).alias("bin_end"), "n")


def histograms(measures: dict[str, DataFrame], bins: int = 10) -> DataFrame:
    """Equal-width histograms of each measure (one-column tables) and of its log1p form."""
    parts = []
    for name, df in measures.items():
        x = df.select(F.col(df.columns[0]).cast("double").alias("x"))
        for form, col in (("raw", F.col("x")), ("log1p", F.log1p("x"))):
            h = equal_width_histogram(x.select(col.alias("x")), "x", bins)
            parts.append(h.select(F.lit(name).alias("measure"), F.lit(form).alias("form"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_cut(df: DataFrame, value: str, labels: list[str], out: str) -> DataFrame:
    """E6 on raw values: edges at the equal-count quantiles of the values, bins closed on the right
    (the smallest value falls into the first)."""
    edges = ST.quantiles(df, value, [i / len(labels) for i in range(1, len(labels))])
    c = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        c = F.when(F.col(value) <= edge, F.lit(label)).otherwise(c)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), c))


def describe(df: DataFrame, col: str, digits: int = 3) -> DataFrame:
    """Count / mean / std (sample) / min / quartiles / max, rounded."""
    qs = ST.quantiles(df, col, [0.25, 0.5, 0.75])
    a = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
               F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))
    out = a.select("count", "mean", "std", "min", F.lit(qs[0]).alias("q25"), F.lit(qs[1]).alias("q50"),
                   F.lit(qs[2]).alias("q75"), "max")
    return out.select("count", *[M.round_to(c, digits).alias(c) for c in out.columns[1:]])


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column (long form)."""
    a = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return a.unpivot([], df.columns, "column", "null_count")


def activity_thresholds(plays: DataFrame) -> DataFrame:
    """Users with exactly one and with at least five plays."""
    u = plays.groupBy("userId").agg(F.count("*").alias("n"))
    return u.agg(F.count("*").alias("n_users"), F.count_if(F.col("n") == 1).alias("users_exactly_1"),
                 F.count_if(F.col("n") >= 5).alias("users_5_plus"))


def zero_duration_share(events: DataFrame) -> DataFrame:
    """Share of zero durations, and mean of the non-zero subset."""
    d = F.col("durationSeconds")
    return events.agg(F.avg((d == 0).cast("double")).alias("zero_duration_share"),
                      F.count_if(d != 0).alias("n_nonzero"),
                      F.avg(F.when(d != 0, d)).alias("mean_nonzero_duration"))


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Counts per value incl. the NULL group, by count desc then value;
    ``top`` keeps the first N (a top-N report)."""
    c = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("n"))
    if top is not None:
        c = c.orderBy(F.desc("n"), F.col("value").asc_nulls_first()).limit(top)
    return c.select(F.lit(col).alias("column"), "value", "n")


def known_rate(col: str) -> F.Column:
    """Share of values outside the unknown sentinels (trimmed, lower)."""
    v = F.lower(F.trim(F.coalesce(F.col(col).cast("string"), F.lit("nan"))))
    return F.coalesce(F.avg((~v.isin(*M.UNKNOWN_SENTINELS)).cast("double")), F.lit(0.0))


def session_stats(sessions: DataFrame, key: str, names: DataFrame | None = None) -> DataFrame:
    """Per key session count and avg / max / min duration;
    with ``names`` (key, name) the name is attached, default 'Unknown'."""
    s = sessions.groupBy(key).agg(F.count("*").alias("n_sessions"),
                                  F.avg("session_duration_sec").alias("avg_duration_sec"),
                                  F.max("session_duration_sec").alias("max_duration_sec"),
                                  F.min("session_duration_sec").alias("min_duration_sec"))
    if names is not None:
        s = s.join(names, key, "left").withColumn("name", F.coalesce("name", F.lit("Unknown")))
    return s


def group_stats(df: DataFrame, key: str, user: str, ts: str) -> DataFrame:
    """Per group row count, distinct users, first and last time."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(user).alias("n_users"),
                               F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def spearman_matrix(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """D36 + E7: Spearman correlation of every column pair (average ranks, then
    Pearson), after dropping columns with at most one distinct value.
    Long form (col_a, col_b, rho) over the upper triangle incl. the diagonal.

    All columns are unpivoted and ranked in one pass over (column, value)."""
    differ = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in columns]).first()
    keep = [c for c in columns if differ[c]]
    if not keep:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, rho double")
    long = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in keep]).unpivot(
        [id_col], keep, "column", "__v").where(F.col("__v").isNotNull())
    ranks = ST.grouped_average_ranks(long, ["column"], "__v", "__r")
    ranked = long.join(ranks, ["column", "__v"]).groupBy(id_col).pivot("column", keep).agg(F.first("__r"))
    aggs = [F.corr(a, b).alias(f"{a}|{b}") for i, a in enumerate(keep) for b in keep[i:]]
    row = ranked.agg(*aggs)
    return row.unpivot([], row.columns, "pair", "rho").select(
        F.split("pair", r"\|").getItem(0).alias("col_a"), F.split("pair", r"\|").getItem(1).alias("col_b"), "rho")


def decile_calibration(pairs: DataFrame, id_col: str, score: str, target: str, buckets: int = 10) -> DataFrame:
    """D35 + E6: rank by score (ties: id), cut into deciles, mean score, mean
    target and count per decile."""
    labels = [str(i + 1) for i in range(buckets)]
    b = ST.quantile_bucket(pairs, id_col, score, labels, "decile")
    return b.groupBy(F.col("decile").cast("int").alias("score_decile")).agg(
        F.avg(score).alias("mean_pred_score"), F.avg(target).alias("mean_implicit"), F.count("*").alias("samples"))
