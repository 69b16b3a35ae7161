"""Queries over ingest, enrichment, events and feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.functions import mappers as M
from stakeflow.operators import enrich as E
from stakeflow.operators.events import enum_violations
from stakeflow.operators.stats import positions
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.plans.oracle import (pipeline_ctes, sql_device, sql_entry, sql_game_type,
                                    sql_provider, with_ctes)
from stakeflow.sources.fixtures import fixture_ctes
from stakeflow.sources.ingest import load_sessions


# ---------------------------------------------------------------------------
# flagship: top games by mean implicit score
# ---------------------------------------------------------------------------
def top_games(t):
    ug = P.features(t).user_game
    g = ug.groupBy("gameId").agg(
        M.round_to(F.sum("implicit_score"), 4).alias("sum_implicit_score"),
        F.count("*").alias("n_players"),
        F.sum("interaction_count").alias("n_sessions"),
    )
    # scores carry 4 decimals, so the rounded sum is exact and the mean is the
    # same double in every engine
    g = g.withColumn("mean_implicit_score", F.col("sum_implicit_score") / F.col("n_players"))
    ranked = positions(g, [F.desc("mean_implicit_score"), F.col("gameId")], "__p")
    return ranked.withColumn("rank", (F.col("__p") + 1).cast("int")).drop("__p")


_FEATURE_CTES = pipeline_ctes("fe")
_UG_SQL_CTES = _FEATURE_CTES

TOP_GAMES_SQL = f"""with {_UG_SQL_CTES},
g as (select gameId, round(sum(implicit_score), 4) as sum_implicit_score, count(*) as n_players,
       cast(sum(interaction_count) as bigint) as n_sessions from user_game group by gameId)
select *, sum_implicit_score / n_players as mean_implicit_score,
       row_number() over (order by sum_implicit_score / n_players desc, gameId) as rank
from g"""

register("top_games_by_implicit_score", "D6 B25 B27 B28 E10 F1 (flagship)", TOP_GAMES_SQL)(top_games)


# ---------------------------------------------------------------------------
# ingest / enrichment stages
# ---------------------------------------------------------------------------
@register("merged_bets", "C1 B7 B8 B10", with_ctes(pipeline_ctes("merged"), final="""
select txnId, userId, gameId_raw, betAmount, result, timestamp, gameId, minBet, maxBet, gameType_raw,
       providerName, win, gameGroup from tx"""))
def merged_bets(t):
    return rounded(P.merged_bets(t).select(
        "txnId", "userId", "gameId_raw", "betAmount", "result", "timestamp", "gameId", "minBet", "maxBet",
        "gameType_raw", "providerName", "win", "gameGroup"))


@register("session_asof_enrichment", "C2 C3 B11", with_ctes(pipeline_ctes("enriched"), final="""
select txnId, round(session_duration_sec, 6) as session_duration_sec, entryPoint_raw from enriched"""))
def session_asof(t):
    return rounded(P.session_enriched(t).select("txnId", "session_duration_sec", "entryPoint_raw"))


_RAW_SESSIONS = """raw_sessions as (select sessId, userId as user_id, gameGroup as game_id, source,
  case when sessId % 5 = 0 then 'Open' else 'Closed' end as status, created_at, updated_at from fx_sessions)"""


@register("closed_sessions_asof_default", "A4 C2 C3 B11 (closed sessions of one source, 60 minutes)", f"""with {pipeline_ctes('merged')},
{_RAW_SESSIONS},
m as (select tx.txnId, (epoch_us(r.updated_at) - epoch_us(r.created_at)) / 1e6 as session_duration_sec, r.source as entryPoint_raw,
    row_number() over (partition by tx.txnId order by r.updated_at desc, r.sessId desc) as rn
  from tx join raw_sessions r on r.user_id = tx.userId and r.game_id = tx.gameGroup and r.updated_at <= tx.timestamp
    and r.updated_at >= tx.timestamp - interval 60 minute
  where r.status = 'Closed' and r.source = 'livecasino')
select tx.txnId, round(m.session_duration_sec, 6) as session_duration_sec, m.entryPoint_raw
from tx left join m on m.txnId = tx.txnId and m.rn = 1""")
def closed_sessions(t):
    raw = t.fx_sessions.select("sessId", F.col("userId").alias("user_id"), F.col("gameGroup").alias("game_id"), "source",
                               F.when(F.col("sessId") % 5 == 0, "Open").otherwise("Closed").alias("status"), "created_at", "updated_at")
    sessions = load_sessions(raw, keep=["sessId"])
    out = E.enrich_sessions(P.merged_bets(t), sessions, tx_keys=("userId", "gameGroup"), session_keys=("userId", "gameId"),
                            session_tie="sessId")
    return rounded(out.select("txnId", "session_duration_sec", "entryPoint_raw"))


@register("device_asof_cascade", "C4 C5 A5", with_ctes(pipeline_ctes("enriched"), final="""
select txnId, deviceType_raw from enriched"""))
def device_cascade(t):
    return P.enriched_bets(t).select("txnId", "deviceType_raw")


@register("enrichment_coverage", "D40", with_ctes(pipeline_ctes("enriched"), final="""
select count(*) as total, count(session_duration_sec) as duration_matched,
       count(entryPoint_raw) as entry_point_matched, count(deviceType_raw) as device_matched,
       count_if(session_duration_sec < 30) as quick_exit_candidates,
       round(round(count(session_duration_sec) * 100.0 / count(*), 4), 6) as duration_pct,
       round(round(count(entryPoint_raw) * 100.0 / count(*), 4), 6) as entry_point_pct,
       round(round(count(deviceType_raw) * 100.0 / count(*), 4), 6) as device_pct
from enriched"""))
def coverage(t):
    return rounded(E.enrichment_coverage(P.enriched_bets(t)))


@register("device_key_overlap", "C6", with_ctes(fixture_ctes("fx_bets", "fx_activity"), final="""
select 'loginId' as activity_key, count(*) as overlap from
  (select distinct trim(cast(userId as varchar)) as k from fx_bets where userId is not null
     and lower(trim(cast(userId as varchar))) not in ('', 'nan', 'none', 'null')) a
  join (select distinct trim(loginId) as k from fx_activity where loginId is not null
     and lower(trim(loginId)) not in ('', 'nan', 'none', 'null')) b on a.k = b.k
union all
select 'playerId' as activity_key, count(*) as overlap from
  (select distinct trim(cast(userId as varchar)) as k from fx_bets where userId is not null
     and lower(trim(cast(userId as varchar))) not in ('', 'nan', 'none', 'null')) a
  join (select distinct trim(playerId) as k from fx_activity where playerId is not null
     and lower(trim(playerId)) not in ('', 'nan', 'none', 'null')) b on a.k = b.k"""))
def overlap(t):
    a = E.key_overlap(t.fx_bets, "userId", t.fx_activity, "loginId").select(
        F.lit("loginId").alias("activity_key"), "overlap")
    b = E.key_overlap(t.fx_bets, "userId", t.fx_activity, "playerId").select(
        F.lit("playerId").alias("activity_key"), "overlap")
    return a.unionByName(b)


@register("game_catalog_mapped", "A2 B12 B13 B14 B21", with_ctes(fixture_ctes("fx_games"), final=f"""
select gameId, gameName, {sql_game_type('gameType_raw')} as game_type, {sql_provider('gamevendor')} as provider,
       coalesce(regexp_matches(lower(trim(gamevendor)), '^[0-9a-f]{{24}}$'), false) as vendor_is_objectid,
       concat('game_', regexp_replace(regexp_replace(lower(gameName), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'))
         as slug
from fx_games"""))
def game_catalog(t):
    g = t.fx_games
    return g.select("gameId", "gameName", M.map_game_type("gameType_raw").alias("game_type"),
                    M.map_provider("gamevendor").alias("provider"),
                    M.is_objectid_like("gamevendor").alias("vendor_is_objectid"),
                    M.game_slug("gameName").alias("slug"))


@register("context_mappers", "B15 B16 B17 B18 B19", with_ctes(fixture_ctes("fx_activity", "fx_sessions", "fx_bets"), final=f"""
select 'device' as kind, cast(actId as bigint) as id, device_type as raw, {sql_device('device_type')} as mapped
  from fx_activity
union all select 'entry', sessId, source, {sql_entry('source')} from fx_sessions
union all select 'outcome', txnId, result, case when upper(result) = 'WIN' then 'net_positive'
    when upper(result) in ('LOSS', 'LOSE') then 'net_negative' else 'break_even' end from fx_bets
union all select 'time_of_day', txnId, cast(hour(ts) as varchar), case when hour(ts) between 6 and 11 then 'morning'
    when hour(ts) between 12 and 17 then 'afternoon' when hour(ts) between 18 and 21 then 'evening'
    else 'late_night' end from fx_bets
union all select 'day_of_week', txnId, cast(ts as varchar), lower(dayname(ts)) from fx_bets"""))
def context_mappers(t):
    a = t.fx_activity.select(F.lit("device").alias("kind"), F.col("actId").cast("bigint").alias("id"),
                             F.col("device_type").alias("raw"), M.map_device_type("device_type").alias("mapped"))
    s = t.fx_sessions.select(F.lit("entry"), "sessId", "source", M.map_entry_point("source"))
    b = t.fx_bets
    o = b.select(F.lit("outcome"), "txnId", "result", M.map_outcome("result"))
    h = b.select(F.lit("time_of_day"), "txnId", F.hour("ts").cast("string"), M.map_time_of_day("ts"))
    d = b.select(F.lit("day_of_week"), "txnId", F.col("ts").cast("string"), M.map_day_of_week("ts"))
    return a.union(s).union(o).union(h).union(d)


# ---------------------------------------------------------------------------
# events and features
# ---------------------------------------------------------------------------
@register("events_aligned", "E1 B9 B17-B23 (17-column events)", with_ctes(pipeline_ctes("events"), final="""
select * from events"""))
def events_aligned(t):
    return P.events(t)


def _not_in(column: str, kind: str, allowed) -> str:
    values = ", ".join(f"'{v}'" for v in allowed)
    return f"""select '{column}' as "column", '{kind}' as kind, value from
  (select distinct {column} as value from events where {column} is not null) where value not in ({values})"""


@register("enum_violations", "G3", with_ctes(pipeline_ctes("events"), final=" union all ".join([
    _not_in("entryPoint", "extra", M.VALID_ENTRY_POINTS), _not_in("provider", "invalid", M.VALID_PROVIDERS),
    _not_in("gameType", "invalid", M.VALID_GAME_TYPES), _not_in("deviceType", "invalid", M.VALID_DEVICE_TYPES)])))
def violations(t):
    return enum_violations(P.events(t))


USER_FEATURES_SQL = f"""with {_FEATURE_CTES}
select userId, total_sessions, unique_games, unique_providers, unique_game_types,
  round(avg_duration_sec, 6) as avg_duration_sec, round(avg_rounds, 6) as avg_rounds,
  round(quick_exit_rate, 6) as quick_exit_rate, round(return_10m_rate, 6) as return_10m_rate,
  round(positive_outcome_rate, 6) as positive_outcome_rate,
  round(avg_engagement_intensity, 6) as avg_engagement_intensity, preferred_time_of_day, preferred_day_of_week,
  preferred_device, preferred_entry_point, last_event_ts, round(recency_days, 6) as recency_days
from user_features"""


@register("user_features", "D1 D2 D3 B25 B26", USER_FEATURES_SQL)
def user_features(t):
    return rounded(P.features(t).users)


GAME_FEATURES_SQL = f"""with {_FEATURE_CTES}
select gameId, game_sessions, unique_users, game_type, provider, round(avg_duration_sec, 6) as avg_duration_sec,
  round(avg_rounds, 6) as avg_rounds, round(quick_exit_rate, 6) as quick_exit_rate,
  round(return_10m_rate, 6) as return_10m_rate, round(positive_outcome_rate, 6) as positive_outcome_rate,
  round(popularity_score, 6) as popularity_score
from game_features"""


@register("game_features", "D4 D2", GAME_FEATURES_SQL)
def game_features(t):
    return rounded(P.features(t).games)


@register("provider_features", "D5", f"""with {_FEATURE_CTES}
select provider, count(sessionId) as provider_sessions, count(distinct userId) as provider_unique_users,
  round(avg(engagement_intensity), 6) as provider_avg_engagement from fe group by provider""")
def provider_features(t):
    return rounded(P.features(t).providers)


@register("user_game_features", "D6 B27 B28", f"""with {_UG_SQL_CTES}
select userId, gameId, interaction_count, round(avg_duration_sec, 6) as avg_duration_sec,
  round(avg_rounds, 6) as avg_rounds, round(positive_outcome_rate, 6) as positive_outcome_rate,
  round(return_10m_rate, 6) as return_10m_rate, round(avg_engagement_intensity, 6) as avg_engagement_intensity,
  last_interaction_ts, dominant_game_type, dominant_provider, round(recency_days, 6) as recency_days,
  round(implicit_score, 6) as implicit_score
from user_game""")
def user_game_features(t):
    return rounded(P.features(t).user_game)
