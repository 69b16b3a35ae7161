"""DuckDB oracle SQL for the registered queries.

Written as plain SQL with the textbook forms (range join + ``row_number`` for
as-of, ``quantile_cont``, explicit mode tie rules) so it checks the Spark
operators independently.  Mapper keyword lists are the same fixed values.
"""

from __future__ import annotations

from stakeflow.functions import mappers as M
from stakeflow.plans.stages import FIXTURE_DEVICE_TOLERANCE_H, FIXTURE_SESSION_TOLERANCE_MIN
from stakeflow.sources.fixtures import fixture_ctes


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _contains_any(v: str, keys) -> str:
    return "(" + " or ".join(f"contains({v}, {q(k)})" for k in keys) + ")"


def sql_game_type(x: str) -> str:
    v = f"lower(trim(cast({x} as varchar)))"
    parts = [f"when coalesce({_contains_any(v, keys)}, false) then {q(lab)}" for lab, keys in M.GAME_TYPE_RULES]
    return "case " + " ".join(parts) + " else 'unknown' end"


def sql_provider(x: str) -> str:
    raw = f"cast({x} as varchar)"
    v = f"lower(trim({raw}))"
    parts = [f"when {raw} is null or {v} in ('', 'nan', 'none', 'null') "
             f"or regexp_matches({v}, '^[0-9a-f]{{24}}$') then 'unknown'"]
    parts += [f"when {_contains_any(v, keys)} then {q(lab)}" for lab, keys in M.PROVIDER_RULES]
    return "case " + " ".join(parts) + f" else trim({raw}) end"


def sql_device(x: str) -> str:
    v = f"lower(trim(coalesce(cast({x} as varchar), 'unknown')))"
    parts = [f"when {_contains_any(v, keys)} then {q(lab)}" for lab, keys in M.DEVICE_RULES]
    return "case " + " ".join(parts) + " else 'unknown' end"


def sql_entry(x: str) -> str:
    v = f"replace(lower(trim(coalesce(cast({x} as varchar), 'unknown'))), ' ', '_')"
    return (f"case when {v} in ('', 'nan', 'none', 'null') then 'unknown' "
            f"when contains({v}, 'live') then 'livecasino' when contains({v}, 'sport') then 'sportsbook' "
            f"when {v} = 'home' then 'direct' when {v} in ('direct', 'lobby') then {v} "
            f"when contains({v}, 'casino') then 'casino' else {v} end")


def sql_outcome(x: str) -> str:
    v = f"upper(cast({x} as varchar))"
    return (f"case when {v} = 'WIN' then 'net_positive' when {v} in ('LOSS', 'LOSE') then 'net_negative' "
            f"else 'break_even' end")


def sql_time_of_day(ts: str) -> str:
    h = f"hour({ts})"
    return (f"case when {h} between 6 and 11 then 'morning' when {h} between 12 and 17 then 'afternoon' "
            f"when {h} between 18 and 21 then 'evening' else 'late_night' end")


def sql_null_like(x: str) -> str:
    return f"({x} is null or lower(trim(cast({x} as varchar))) in ('', 'nan', 'none', 'null'))"


def sql_micros(a: str, b: str) -> str:
    """microseconds from a to b."""
    return f"(epoch_us({b}) - epoch_us({a}))"


def sql_mode(src: str, keys: list[str], col: str, default: str, alias: str) -> str:
    """CTE body: per key the most frequent non-NULL value, ties -> smallest."""
    k = ", ".join(keys)
    return (f"select {k}, {alias} from (select {k}, {col} as {alias}, row_number() over (partition by {k} "
            f"order by count(*) desc, {col} asc) as rn from {src} where {col} is not null group by {k}, {col}) "
            f"where rn = 1")


# ---------------------------------------------------------------------------
# pipeline CTEs
# ---------------------------------------------------------------------------
def _asof_cte(name, left, right, on, lt, rt, tol_sql, payload, tie):
    sel = ", ".join(f"r.{c} as {a}" for c, a in payload.items())
    return (f"{name} as (select txnId, {', '.join(payload.values())} from (select l.txnId, {sel}, "
            f"row_number() over (partition by l.txnId order by r.{rt} desc, r.{tie} desc) as rn "
            f"from {left} l join {right} r on {on} and r.{rt} <= l.{lt} and r.{rt} >= l.{lt} - {tol_sql}) "
            f"where rn = 1)")


def pipeline_ctes(upto: str = "events") -> str:
    """CTE text for the fixture pipeline up to ``merged`` / ``enriched`` / ``events`` / ``fe``."""
    ctes = [fixture_ctes("fx_bets", "fx_games", "fx_sessions", "fx_activity", "fx_players")]
    ctes.append("""tx as (
  select b.txnId, b.userId, b.gameId_raw, b.betAmount, b.result, b.ts as timestamp,
         g.gameId, g.minBet, g.maxBet, g.gameType_raw, g.gamevendor as providerName,
         coalesce(cast(b.result = 'WIN' as int), 0) as win,
         cast(try_cast(trim(split_part(b.gameId_raw, '.', 1)) as int) % 10 as varchar) as gameGroup
  from fx_bets b left join fx_games g on b.gameId_raw = g.gameId)""")
    if upto == "merged":
        return ",\n".join(ctes)
    ctes.append(f"""sess as (
  select sessId, trim(userId) as userId, trim(gameGroup) as gameGroup, updated_at, source as entryPoint_raw,
         {sql_micros('created_at', 'updated_at')} / 1e6 as session_duration_sec
  from fx_sessions where updated_at is not null and userId is not null and gameGroup is not null)""")
    ctes.append(_asof_cte("sm", "tx", "sess", "l.userId = r.userId and l.gameGroup = r.gameGroup",
                          "timestamp", "updated_at", f"interval {FIXTURE_SESSION_TOLERANCE_MIN} minute",
                          {"session_duration_sec": "session_duration_sec", "entryPoint_raw": "entryPoint_raw"},
                          "sessId"))
    ctes.append(f"""pl as (select trim(userId) as userId, min(trim(playerId)) as playerId_bridge from fx_players
  where userId is not null group by trim(userId))""")
    ctes.append(f"""txk as (select tx.txnId, tx.timestamp,
    case when not {sql_null_like('tx.userId')} then trim(tx.userId) end as k_user,
    case when not {sql_null_like('pl.playerId_bridge')} then pl.playerId_bridge end as k_bridge
  from tx left join pl on trim(tx.userId) = pl.userId)""")
    tol = f"interval {FIXTURE_DEVICE_TOLERANCE_H} hour"
    dev_pairs = [("k_user", "playerId"), ("k_bridge", "playerId"), ("k_user", "loginId"), ("k_user", "user_id")]
    for i, (tk, ak) in enumerate(dev_pairs):
        ctes.append(f"""act{i} as (select actId, trim({ak}) as k, updated_at as ats, device_type
  from fx_activity where not {sql_null_like(ak)} and updated_at is not null)""")
        ctes.append(_asof_cte(f"dm{i}", "txk", f"act{i}", f"l.{tk} = r.k", "timestamp", "ats", tol,
                              {"device_type": f"dev{i}"}, "actId"))
    joins = " ".join(f"left join dm{i} on dm{i}.txnId = tx.txnId" for i in range(len(dev_pairs)))
    devs = ", ".join(f"dm{i}.dev{i}" for i in range(len(dev_pairs)))
    ctes.append(f"""enriched as (select tx.*, sm.session_duration_sec, sm.entryPoint_raw,
    coalesce({devs}) as deviceType_raw
  from tx left join sm on sm.txnId = tx.txnId {joins})""")
    if upto == "enriched":
        return ",\n".join(ctes)
    ctes.append("""stq as (select quantile_cont(coalesce(try_cast(betAmount as double), 0.0), 0.33) as q1,
    quantile_cont(coalesce(try_cast(betAmount as double), 0.0), 0.66) as q2 from enriched)""")
    ctes.append(f"""ev0 as (
  select 'game_session' as eventType, trim(cast(userId as varchar)) as userId,
         concat('sess_', cast(txnId as varchar)) as sessionId, trim(cast(gameId as varchar)) as gameId,
         {sql_game_type('gameType_raw')} as gameType, {sql_provider('providerName')} as provider,
         timestamp, coalesce(try_cast(session_duration_sec as double), 0.0) as durationSeconds,
         1 as roundsPlayed,
         case when coalesce(try_cast(betAmount as double), 0.0) <= stq.q1 then 'low'
              when coalesce(try_cast(betAmount as double), 0.0) <= stq.q2 then 'medium' else 'high' end
           as stakeLevelCategory,
         {sql_outcome('result')} as outcome, {sql_device('deviceType_raw')} as deviceType,
         {sql_entry('entryPoint_raw')} as entryPoint
  from enriched, stq
  where not {sql_null_like('userId')} and not {sql_null_like('gameId')} and timestamp is not null)""")
    ctes.append("""ev1 as (select *, coalesce(epoch_us(lead(timestamp) over (partition by userId
    order by timestamp, sessionId)) - epoch_us(timestamp) <= 600000000, false) as returnedWithin10mins from ev0)""")
    ctes.append(f"""events as (select eventType, userId, sessionId, gameId, gameType, provider, timestamp,
    durationSeconds, roundsPlayed, stakeLevelCategory, outcome,
    case when durationSeconds = 0 then 'unknown' when durationSeconds < 30 then 'quick_exit'
         when returnedWithin10mins then 'returned_quickly' else 'natural_end' end as exitType,
    returnedWithin10mins, deviceType, {sql_time_of_day('timestamp')} as timeOfDay,
    lower(dayname(timestamp)) as dayOfWeek, entryPoint from ev1)""")
    if upto == "events":
        return ",\n".join(ctes)
    ctes.extend(feature_ctes("events", ""))
    return ",\n".join(ctes)


def feature_ctes(src: str, p: str = "") -> list[str]:
    """Feature-table CTEs over the events CTE ``src``; names get prefix ``p``:
    {p}fe, {p}maxts, {p}user_game, {p}user_features, {p}game_features."""
    fe = f"{p}fe"
    c = [f"""{fe} as (select *, cast(exitType = 'quick_exit' as int) as is_quick_exit,
    cast(outcome = 'net_positive' as int) as is_positive_outcome,
    ln(1 + greatest(durationSeconds, 0.0)) * 0.5 + greatest(roundsPlayed, 0) * 0.3
      + (case stakeLevelCategory when 'low' then 1 when 'medium' then 2 when 'high' then 3 else 1 end) * 0.2
      as engagement_intensity
  from {src})""",
         f"{p}maxts as (select max(timestamp) as max_ts from {fe})",
         f"""{p}ug0 as (select userId, gameId, count(sessionId) as interaction_count,
    avg(durationSeconds) as avg_duration_sec, avg(roundsPlayed) as avg_rounds,
    avg(is_positive_outcome) as positive_outcome_rate, avg(cast(returnedWithin10mins as double)) as return_10m_rate,
    avg(engagement_intensity) as avg_engagement_intensity, max(timestamp) as last_interaction_ts
  from {fe} group by userId, gameId)""",
         f"{p}ug_gt as ({sql_mode(fe, ['userId', 'gameId'], 'gameType', 'live_dealer', 'dominant_game_type')})",
         f"{p}ug_pv as ({sql_mode(fe, ['userId', 'gameId'], 'provider', 'unknown', 'dominant_provider')})",
         f"""{p}ug1 as (select u.*, coalesce(g.dominant_game_type, 'live_dealer') as dominant_game_type,
    coalesce(v.dominant_provider, 'unknown') as dominant_provider,
    ((epoch_us(m.max_ts) - epoch_us(u.last_interaction_ts)) / 1e6) / 86400.0 as recency_days
  from {p}ug0 u join {p}maxts m on true
  left join {p}ug_gt g on g.userId = u.userId and g.gameId = u.gameId
  left join {p}ug_pv v on v.userId = u.userId and v.gameId = u.gameId)""",
         f"{p}p95 as (select greatest(quantile_cont(avg_engagement_intensity, 0.95), 1e-6) as p from {p}ug1)",
         f"""{p}user_game as (select u.*, round(0.40 * least(interaction_count / 20.0, 1.0)
    + 0.25 * least(avg_engagement_intensity / q.p, 1.0)
    + 0.15 * coalesce(positive_outcome_rate, 0.0)
    + 0.20 * (case when recency_days <= 7 then 1.0 when recency_days <= 30 then 0.7
                   when recency_days <= 90 then 0.4 else 0.2 end), 4) as implicit_score
  from {p}ug1 u join {p}p95 q on true)""",
         f"""{p}uf0 as (select userId, count(sessionId) as total_sessions, count(distinct gameId) as unique_games,
    count(distinct provider) as unique_providers, count(distinct gameType) as unique_game_types,
    avg(durationSeconds) as avg_duration_sec, avg(roundsPlayed) as avg_rounds,
    avg(is_quick_exit) as quick_exit_rate, avg(cast(returnedWithin10mins as double)) as return_10m_rate,
    avg(is_positive_outcome) as positive_outcome_rate, avg(engagement_intensity) as avg_engagement_intensity,
    max(timestamp) as last_event_ts from {fe} group by userId)""",
         f"{p}um1 as ({sql_mode(fe, ['userId'], 'timeOfDay', 'late_night', 'preferred_time_of_day')})",
         f"{p}um2 as ({sql_mode(fe, ['userId'], 'dayOfWeek', 'friday', 'preferred_day_of_week')})",
         f"{p}um3 as ({sql_mode(fe, ['userId'], 'deviceType', 'unknown', 'preferred_device')})",
         f"{p}um4 as ({sql_mode(fe, ['userId'], 'entryPoint', 'unknown', 'preferred_entry_point')})",
         f"""{p}user_features as (select u.userId, total_sessions, unique_games, unique_providers, unique_game_types,
    avg_duration_sec, avg_rounds, quick_exit_rate, return_10m_rate, positive_outcome_rate, avg_engagement_intensity,
    coalesce(m1.preferred_time_of_day, 'late_night') as preferred_time_of_day,
    coalesce(m2.preferred_day_of_week, 'friday') as preferred_day_of_week,
    coalesce(m3.preferred_device, 'unknown') as preferred_device,
    coalesce(m4.preferred_entry_point, 'unknown') as preferred_entry_point,
    last_event_ts, ((epoch_us(mx.max_ts) - epoch_us(last_event_ts)) / 1e6) / 86400.0 as recency_days
  from {p}uf0 u join {p}maxts mx on true left join {p}um1 m1 on m1.userId = u.userId
  left join {p}um2 m2 on m2.userId = u.userId left join {p}um3 m3 on m3.userId = u.userId
  left join {p}um4 m4 on m4.userId = u.userId)""",
         f"""{p}gf0 as (select gameId, count(sessionId) as game_sessions, count(distinct userId) as unique_users,
    avg(durationSeconds) as avg_duration_sec, avg(roundsPlayed) as avg_rounds, avg(is_quick_exit) as quick_exit_rate,
    avg(cast(returnedWithin10mins as double)) as return_10m_rate, avg(is_positive_outcome) as positive_outcome_rate
  from {fe} group by gameId)""",
         f"{p}gm1 as ({sql_mode(fe, ['gameId'], 'gameType', 'live_dealer', 'game_type')})",
         f"{p}gm2 as ({sql_mode(fe, ['gameId'], 'provider', 'unknown', 'provider')})",
         f"""{p}game_features as (select g.gameId, game_sessions, unique_users,
    coalesce(m1.game_type, 'live_dealer') as game_type, coalesce(m2.provider, 'unknown') as provider,
    avg_duration_sec, avg_rounds, quick_exit_rate, return_10m_rate, positive_outcome_rate,
    ln(1 + game_sessions) as popularity_score
  from {p}gf0 g left join {p}gm1 m1 on m1.gameId = g.gameId left join {p}gm2 m2 on m2.gameId = g.gameId)""",
         ]
    return c


def with_ctes(*bodies: str, final: str) -> str:
    return "with " + ",\n".join(b for b in bodies if b) + "\n" + final
