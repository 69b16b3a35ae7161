"""Leak-free temporal split, matrices and vocabularies.

Scale notes:
* The per-user steps of the split (distinct games per user, last-touched
  pair) are aggregations (``count`` + ``max_by`` over a struct), not per-user
  windows, so a user with a third of all events is reduced map-side.
* Dictionaries use distributed positions of a range sort (``stats.dense_index``).
* Popularity buckets use the same positions over the catalog.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeflow.config import DEFAULT, Settings
from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M
from stakeflow.operators.features import FeatureTables, build_feature_tables, mode_or
from stakeflow.operators.stats import dense_index, quantile_bucket
from stakeflow.session import at_once, cut_lineage

ITEM_NUMERIC_COLUMNS = ["game_sessions", "unique_users", "avg_duration_sec", "avg_rounds",
                        "quick_exit_rate", "return_10m_rate", "positive_outcome_rate", "popularity_score"]


def pair_last_touch(events: DataFrame) -> DataFrame:
    return events.groupBy("userId", "gameId").agg(F.max("timestamp").alias("last_ts"))


def holdout_pairs(events: DataFrame, check_fallback: bool = True) -> DataFrame:
    """H1 (E3 + E4): per user with >= 2 distinct games, the pair touched last
    (ties: larger gameId).  Fallback when no user qualifies: the one globally
    latest pair (ties: larger userId, gameId)."""
    pairs = pair_last_touch(events)
    per_user = pairs.groupBy("userId").agg(
        F.count("*").alias("distinct_games_for_user"),
        F.max_by("gameId", F.struct("last_ts", "gameId")).alias("gameId"),
    )
    hold = per_user.where(F.col("distinct_games_for_user") >= 2).select("userId", "gameId")
    if check_fallback:
        # one row per user, read by the fallback check, both split sides and the
        # test pairs: materialise it once in the checkpoint folder
        hold = cut_lineage(hold)
    if check_fallback and hold.isEmpty():
        latest = pairs.agg(F.max_by(F.struct("userId", "gameId"), F.struct("last_ts", "userId", "gameId")).alias("p"))
        hold = latest.where(F.col("p").isNotNull()).select("p.userId", "p.gameId")
    return hold


def split_events(events: DataFrame, holdout: DataFrame, check_fallback: bool = True):
    """Events of holdout pairs are test, the rest train.  If train ends up
    empty while test is not, train := test (the source system's fallback).

    One join marks the events; the marked table is written once and read by both sides."""
    mark = holdout.select("userId", "gameId", F.lit(True).alias("__h"))
    marked = cut_lineage(events.join(mark, ["userId", "gameId"], "left"))
    train = marked.where(F.col("__h").isNull()).select(events.columns)
    test = marked.where(F.col("__h").isNotNull()).select(events.columns)
    if check_fallback and train.isEmpty() and not test.isEmpty():
        train = test
    return train, test


def test_pairs(test_events: DataFrame) -> DataFrame:
    """Held-out pairs with their event count and a constant score 1.0."""
    return (test_events.groupBy(M.clean_id("userId").alias("userId"), M.clean_id("gameId").alias("gameId"))
            .agg(F.count("*").alias("interaction_count"))
            .withColumn("implicit_score", F.lit(1.0)))


def safe_pairs(user_game: DataFrame) -> DataFrame:
    """B9 on the train pair table."""
    return (user_game.withColumn("userId", M.clean_id("userId")).withColumn("gameId", M.clean_id("gameId"))
            .where(~M.is_null_like("userId") & ~M.is_null_like("gameId")))


def static_item_meta(events: DataFrame) -> DataFrame:
    """Item type/provider modes over all events (default 'unknown')."""
    return events.groupBy("gameId").agg(
        mode_or("gameType", "unknown").alias("game_type_static"),
        mode_or("provider", "unknown").alias("provider_static"),
    )


def popularity_bucket(items: DataFrame, score: str = "popularity_score", key: str = "gameId",
                      out: str = "popularity_bucket") -> DataFrame:
    """E5: rank items by score (ties: key order), cut the ranks into
    q = min(4, n) equal-count bins labelled cold/warm/hot/blockbuster."""
    return quantile_bucket(items, key, score, M.POPULARITY_LABELS, out)


def active_ids(train_pairs: DataFrame, test: DataFrame, col: str) -> DataFrame:
    """G1: distinct union of train and test ids."""
    return train_pairs.select(col).union(test.select(col)).distinct()


def item_features(active_items: DataFrame, train_games: DataFrame, all_events: DataFrame) -> DataFrame:
    """C9 + D8 + E5: every active item with train features, static fallbacks,
    numeric NULL -> 0 and the popularity bucket."""
    static = static_item_meta(all_events)
    ife = active_items.join(train_games, "gameId", "left").join(static, "gameId", "left")
    ife = (ife.withColumn("game_type", F.coalesce("game_type", "game_type_static", F.lit("unknown")))
           .withColumn("provider", F.coalesce("provider", "provider_static", F.lit("unknown")))
           .drop("game_type_static", "provider_static"))
    ife = ife.fillna(0, subset=[c for c in ITEM_NUMERIC_COLUMNS if c in ife.columns])
    return popularity_bucket(ife)


def combine_pairs(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train pairs then test pairs, first occurrence wins (train score kept)."""
    t = train.select("userId", "gameId", "implicit_score", F.lit(0).alias("__src"))
    s = test.select("userId", "gameId", "implicit_score", F.lit(1).alias("__src"))
    return (t.unionByName(s).groupBy("userId", "gameId")
            .agg(F.min_by("implicit_score", "__src").alias("implicit_score")))


def user_token_table(ufe: DataFrame) -> DataFrame:
    """(userId, tokens) with the four user tokens."""
    return ufe.select("userId", M.tokens(M.USER_TOKEN_COLUMNS).alias("tokens"))


def item_token_table(ife: DataFrame) -> DataFrame:
    return ife.select("gameId", M.tokens(M.ITEM_TOKEN_COLUMNS).alias("tokens"))


def vocabulary(token_table: DataFrame) -> DataFrame:
    """H4: sorted distinct tokens numbered 0..n-1."""
    toks = token_table.select(F.explode("tokens").alias("token"))
    return dense_index(toks, "token", "token_idx")


def feature_matrix(entity_index: DataFrame, key: str, token_table: DataFrame, vocab: DataFrame,
                   n_entities: int | None = None) -> DataFrame:
    """H6: (entity_idx, feature_idx, value).  Features are the entity's own
    identity feature (id = entity_idx) followed by the vocabulary (id =
    n_entities + token_idx); each row is normalised to sum 1, so every active
    feature of an entity with k tokens weighs 1/(k+1); an entity without a
    feature row keeps only its identity feature with value 1."""
    if n_entities is None:
        n_entities = entity_index.count()
    toks = entity_index.join(token_table, key, "left").select(
        "idx", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    width = F.lit(1.0) / (F.size("tokens") + 1)
    ident = toks.select(F.col("idx").alias("entity_idx"), F.col("idx").alias("feature_idx"), width.alias("value"))
    side = (toks.select("idx", F.explode("tokens").alias("token"), width.alias("value"))
            .join(vocab, "token")
            .select(F.col("idx").alias("entity_idx"),
                    (F.col("token_idx") + F.lit(n_entities)).alias("feature_idx"), "value"))
    return ident.unionByName(side)


def triplets(pairs: DataFrame, users: DataFrame, items: DataFrame, weight: str = "implicit_score") -> DataFrame:
    """H5: (user_idx, item_idx, weight) for a pair table."""
    return (pairs.join(users.withColumnRenamed("idx", "user_idx"), "userId")
            .join(items.withColumnRenamed("idx", "item_idx"), "gameId")
            .select("user_idx", "item_idx", F.col(weight).cast("double").alias("weight")))


@dataclass
class Dataset:
    holdout: DataFrame
    train_events: DataFrame
    test_events: DataFrame
    train: FeatureTables
    train_pairs: DataFrame          # safe train user x game (with implicit_score)
    test_pairs: DataFrame
    full_pairs: DataFrame
    active_users: DataFrame
    active_items: DataFrame
    ufe: DataFrame
    ife: DataFrame
    user_index: DataFrame           # userId, idx
    item_index: DataFrame           # gameId, idx
    user_tokens: DataFrame
    item_tokens: DataFrame
    user_vocab: DataFrame           # token, token_idx
    item_vocab: DataFrame


def build_dataset(events: DataFrame, settings: Settings = DEFAULT, check: bool = True) -> Dataset:
    """The whole training dataset (lazy except the fallback checks, the
    quantile cut of the implicit score, the dictionary numbering and the tables
    that it and nearly every use read: test pairs, active ids and both feature
    tables are written once).  Parts that don't need each other run side by side."""
    if check and events.isEmpty():
        raise DataValidationError("no events to build a dataset from")
    hold = holdout_pairs(events, check)
    train_ev, test_ev = split_events(events, hold, check)
    train = build_feature_tables(train_ev, settings)
    tpairs = cut_lineage(test_pairs(test_ev))
    spairs = safe_pairs(train.user_game)
    spark = events.sparkSession
    users, items = at_once(spark, lambda col: cut_lineage(active_ids(spairs, tpairs, col)), ["userId", "gameId"])

    def of_users():
        ufe = cut_lineage(train.users.join(users, "userId", "left_semi"))
        tokens = user_token_table(ufe)
        return ufe, tokens, vocabulary(tokens)

    def of_items():
        ife = item_features(items, train.games, events)  # ends in a written sort
        tokens = item_token_table(ife)
        return ife, tokens, vocabulary(tokens)

    parts = [of_users, of_items, lambda: dense_index(users, "userId"), lambda: dense_index(items, "gameId")]
    (ufe, utok, uvocab), (ife, itok, ivocab), uidx, iidx = at_once(spark, lambda part: part(), parts)
    return Dataset(
        holdout=hold, train_events=train_ev, test_events=test_ev, train=train,
        train_pairs=spairs, test_pairs=tpairs, full_pairs=combine_pairs(spairs, tpairs),
        active_users=users, active_items=items, ufe=ufe, ife=ife,
        user_index=uidx, item_index=iidx, user_tokens=utok, item_tokens=itok,
        user_vocab=uvocab, item_vocab=ivocab,
    )


def join_with_suffix(left: DataFrame, right: DataFrame, on: str, right_suffix: str, left_suffix: str | None = None,
                     how: str = "left") -> DataFrame:
    """Join and rename only the colliding non-key columns (``left_suffix``
    on the left side when given, ``right_suffix`` on the right side)."""
    clash = [c for c in right.columns if c in left.columns and c != on]
    l, r = left, right
    for c in clash:
        if left_suffix:
            l = l.withColumnRenamed(c, c + left_suffix)
        r = r.withColumnRenamed(c, c + right_suffix)
    return l.join(r, on, how)
