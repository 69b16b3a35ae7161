"""Queries over behavioural analytics and diagnostics tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.functions import mappers as M
from stakeflow.operators import analytics as A
from stakeflow.operators import stats as ST
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.plans.oracle import pipeline_ctes, sql_game_type, sql_mode
from stakeflow.plans.queries_dataset import DATASET_CTES

PLAYS_SQL = f"""plays as (select e.txnId, trim(cast(e.userId as varchar)) as userId, e.gameId,
    cast(e.betAmount as double) as betAmount, coalesce(e.session_duration_sec, 0.0) / 60.0 as sessionDuration,
    coalesce(e.session_duration_sec, 0.0) as sessionSeconds,
    e.timestamp, {sql_game_type('e.gameType_raw')} as gameType, e.gameType_raw,
    cast(hour(e.timestamp) as integer) as hourOfDay, dayname(e.timestamp) as dayOfWeek, e.maxBet, e.win,
    cast(floor((epoch_us(r.ref) - epoch_us(e.timestamp)) / 86400000000.0) as bigint) as days_ago, p.archetype
  from enriched e join (select max(timestamp) as ref from enriched where gameId is not null) r on true
  left join fx_players p on trim(p.userId) = trim(cast(e.userId as varchar))
  where e.gameId is not null)"""

PLAYS_CTES = pipeline_ctes("enriched") + ",\n" + PLAYS_SQL
IA_SQL = """ia as (select userId, gameId, count(betAmount) as play_count, sum(betAmount) as total_bet,
    avg(betAmount) as avg_bet, avg(sessionDuration) as avg_session_min, min(days_ago) as last_played_days_ago
  from plays group by userId, gameId)"""
UB_SQL = f"""ub0 as (select userId, count(betAmount) as total_sessions, avg(betAmount) as avg_bet,
    sum(betAmount) as total_bet, avg(sessionDuration) as avg_session_duration,
    count(distinct gameId) as unique_games_played, min(days_ago) as last_active_days_ago,
    count_if(days_ago <= 7) as sessions_last_7d, count_if(days_ago <= 30) as sessions_last_30d
  from plays group by userId),
mh as ({sql_mode('plays', ['userId'], 'hourOfDay', '', 'preferred_hour')}),
md as ({sql_mode('plays', ['userId'], 'dayOfWeek', '', 'preferred_day')}),
mg as ({sql_mode('plays', ['userId'], 'gameType', '', 'preferred_game_type')}),
ub as (select ub0.*, mh.preferred_hour, md.preferred_day, mg.preferred_game_type from ub0
  left join mh on mh.userId = ub0.userId left join md on md.userId = ub0.userId
  left join mg on mg.userId = ub0.userId)"""


def plays(t):
    return P.plays(t)


def ia(t):
    return P._memo(t, "ia", lambda: A.interaction_agg(plays(t)))


def ub(t):
    return P._memo(t, "ub", lambda: A.user_behaviour(plays(t)))


@register("interaction_scores", "B29 B30 B27 (pair table)", f"""with {PLAYS_CTES}, {IA_SQL}
select userId, gameId, play_count, round(total_bet, 6) as total_bet, round(avg_bet, 6) as avg_bet,
  round(avg_session_min, 6) as avg_session_min, last_played_days_ago,
  round(round(0.35 * least(play_count / 20.0, 1.0) + 0.25 * least(total_bet / 500000.0, 1.0)
    + 0.20 * least(avg_session_min / 60.0, 1.0)
    + 0.20 * (case when last_played_days_ago <= 7 then 1.0 when last_played_days_ago <= 30 then 0.7
                   when last_played_days_ago <= 90 then 0.4 else 0.2 end), 4), 6) as implicit_score,
  case when last_played_days_ago > -1 and last_played_days_ago <= 7 then 'recent'
       when last_played_days_ago > 7 and last_played_days_ago <= 30 then 'moderate'
       when last_played_days_ago > 30 and last_played_days_ago <= 90 then 'old'
       when last_played_days_ago > 90 then 'stale' else 'nan' end as recency_bucket
from ia""")
def q_ia(t):
    return rounded(ia(t))


@register("user_behaviour", "D30 D31 D37", f"""with {PLAYS_CTES}, {UB_SQL}
select ub.userId, total_sessions, round(total_bet, 2) / total_sessions as avg_bet, round(total_bet, 6) as total_bet,
  ss.s / total_sessions / 60.0 as avg_session_duration, unique_games_played, preferred_hour, preferred_day,
  last_active_days_ago, sessions_last_7d, sessions_last_30d, preferred_game_type
from ub join (select userId, round(sum(sessionSeconds), 6) as s from plays group by userId) ss on ss.userId = ub.userId""")
def q_ub(t):
    # bets carry 2 decimals: the rounded sum is exact, so the mean is the same
    # double in every engine
    # durations have at most 6 decimals of seconds: the rounded sum is exact too
    secs = plays(t).groupBy("userId").agg(M.round_to(F.sum("sessionSeconds"), 6).alias("__s"))
    u = ub(t).join(secs, "userId").withColumn(
        "avg_session_duration", F.col("__s") / F.col("total_sessions") / 60.0).drop("__s")
    return rounded(u.withColumn("avg_bet", M.round_to("total_bet", 2) / F.col("total_sessions")),
                   exclude=["avg_bet", "avg_session_duration"])


@register("item_popularity", "D32 C14", f"""with {PLAYS_CTES},
a as (select gameId, count(betAmount) as total_plays, count(distinct userId) as unique_players,
    round(sum(betAmount), 2) / count(betAmount) as avg_bet_on_game, avg(sessionDuration) as avg_session_on_game from plays group by gameId)
select g.gameId, g.gameName, coalesce(a.total_plays, 0) as total_plays, coalesce(a.unique_players, 0) as unique_players,
  coalesce(a.avg_bet_on_game, 0.0) as avg_bet_on_game,
  round(coalesce(a.avg_session_on_game, 0.0), 6) as avg_session_on_game,
  round(ln(1 + coalesce(a.total_plays, 0)), 6) as popularity_score
from fx_games g left join a on a.gameId = g.gameId""")
def q_item_pop(t):
    pop = A.item_popularity(t.fx_games, plays(t))
    sums = plays(t).groupBy("gameId").agg(M.round_to(F.sum("betAmount"), 2).alias("__s"))
    pop = pop.join(sums, "gameId", "left").withColumn(
        "avg_bet_on_game", F.coalesce(F.col("__s") / F.col("total_plays"), F.lit(0.0))).drop("__s")
    return rounded(pop, exclude=["avg_bet_on_game"])


@register("user_aggressiveness_loyalty", "D33 B31", f"""with {PLAYS_CTES}, {IA_SQL}
select ia.userId, round(avg(ia.avg_bet / greatest(g.maxBet, 1.0)), 6) as bet_to_limit_ratio,
  round(avg(ia.play_count), 6) as avg_plays_per_game, round(avg(cast(ia.play_count > 1 as double)), 6) as return_rate
from ia left join fx_games g on g.gameId = ia.gameId group by ia.userId""")
def q_aggr(t):
    return rounded(A.aggressiveness_loyalty(ia(t), t.fx_games))


@register("user_segment_buckets", "E6 B30 B31 (engagement / recency / diversity / loyalty / aggressiveness)",
          f"""with {PLAYS_CTES}, {IA_SQL}, {UB_SQL},
al as (select ia.userId, avg(ia.avg_bet / greatest(g.maxBet, 1.0)) as bet_to_limit_ratio,
    avg(cast(ia.play_count > 1 as double)) as return_rate
  from ia left join fx_games g on g.gameId = ia.gameId group by ia.userId),
u as (select ub.userId, ub.total_sessions, ub.last_active_days_ago, al.bet_to_limit_ratio, al.return_rate,
    least(greatest(ub.unique_games_played / greatest(ub.total_sessions, 1), 0.0), 1.0) as diversity_ratio,
    row_number() over (order by ub.total_sessions, ub.userId) - 1 as p1,
    row_number() over (order by al.bet_to_limit_ratio, ub.userId) - 1 as p2, count(*) over () as n
  from ub join al on al.userId = ub.userId)
select userId,
  (['low', 'mid_low', 'mid_high', 'high'])[case when least(n, 4) <= 1 then 1
     else greatest(1, cast(floor((p1 * least(n, 4) + (n - 2)) / (n - 1)) as bigint)) end] as engagement_bucket,
  case when last_active_days_ago > -1 and last_active_days_ago <= 1 then 'd0_1'
       when last_active_days_ago > 1 and last_active_days_ago <= 7 then 'd2_7'
       when last_active_days_ago > 7 and last_active_days_ago <= 30 then 'd8_30'
       when last_active_days_ago > 30 and last_active_days_ago <= 90 then 'd31_90'
       when last_active_days_ago > 90 then 'd90_plus' else 'nan' end as recency_bucket,
  round(diversity_ratio, 6) as diversity_ratio,
  case when diversity_ratio > -0.01 and diversity_ratio <= 0.2 then 'very_low'
       when diversity_ratio > 0.2 and diversity_ratio <= 0.5 then 'low'
       when diversity_ratio > 0.5 and diversity_ratio <= 0.8 then 'medium'
       when diversity_ratio > 0.8 and diversity_ratio <= 1.0 then 'high' else 'nan' end as diversity_bucket,
  case when return_rate > -0.01 and return_rate <= 0.25 then 'very_low'
       when return_rate > 0.25 and return_rate <= 0.5 then 'low'
       when return_rate > 0.5 and return_rate <= 0.75 then 'medium'
       when return_rate > 0.75 and return_rate <= 1.0 then 'high' else 'nan' end as loyalty_bucket,
  (['low', 'mid_low', 'mid_high', 'high'])[case when least(n, 4) <= 1 then 1
     else greatest(1, cast(floor((p2 * least(n, 4) + (n - 2)) / (n - 1)) as bigint)) end] as aggr_bet_bucket
from u""")
def q_buckets(t):
    u = ub(t).join(A.aggressiveness_loyalty(ia(t), t.fx_games), "userId")
    u = u.withColumn("diversity_ratio", F.least(F.greatest(
        F.col("unique_games_played") / F.greatest(F.col("total_sessions"), F.lit(1)), F.lit(0.0)), F.lit(1.0)))
    u = ST.quantile_bucket(u, "userId", "total_sessions", A.QUARTILE_LABELS, "engagement_bucket")
    u = ST.quantile_bucket(u, "userId", "bet_to_limit_ratio", A.QUARTILE_LABELS, "aggr_bet_bucket")
    return rounded(u.select(
        "userId", "engagement_bucket",
        M.right_closed_bucket("last_active_days_ago", A.USER_RECENCY_EDGES, A.USER_RECENCY_LABELS).alias("recency_bucket"),
        "diversity_ratio",
        M.right_closed_bucket("diversity_ratio", A.DIVERSITY_EDGES, A.LEVEL_LABELS).alias("diversity_bucket"),
        M.right_closed_bucket("return_rate", A.LOYALTY_EDGES, A.LEVEL_LABELS).alias("loyalty_bucket"),
        "aggr_bet_bucket"))


@register("preference_entropy", "D25", f"""with {PLAYS_CTES},
c as (select userId, gameType, count(*) as n from plays group by userId, gameType),
tt as (select userId, sum(n) as total from c group by userId)
select c.userId, round(-sum((n / total) * log2(n / total + 1e-12)), 6) as entropy
from c join tt on tt.userId = c.userId group by c.userId""")
def q_entropy(t):
    return rounded(A.preference_entropy(plays(t)))


@register("rfm_table", "D26 C14", f"""with {PLAYS_CTES},
r as (select userId, count(betAmount) as frequency, sum(betAmount) as monetary, max(timestamp) as last_ts
  from plays group by userId)
select r.userId, frequency, round(monetary, 6) as monetary, last_ts,
  cast(floor((epoch_us((select max(timestamp) from plays)) - epoch_us(last_ts)) / 86400000000.0) as bigint)
    as recency_days, p.archetype
from r left join fx_players p on trim(p.userId) = r.userId""")
def q_rfm(t):
    seg = t.fx_players.select(M.clean_id("userId").alias("userId"), "archetype")
    return rounded(A.rfm(plays(t), seg))


def joined(t):
    """Join time of each user: the first sign-up, else the first event of any kind."""
    first = t.fx_ev.groupBy(F.col("user_id").cast("string").alias("userId")).agg(
        F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("s"), F.min("ts").alias("f"))
    return first.select("userId", F.coalesce("s", "f").alias("joined_at"))


@register("cohort_matrix", "D27", f"""with {PLAYS_CTES},
jn as (select cast(user_id as varchar) as userId, coalesce(min(case when event_type = 'signup' then ts end), min(ts)) as joined_at
  from fx_ev group by 1)
select cast(date_trunc('week', jn.joined_at) as date) as cohort_week, cast(date_trunc('week', p.timestamp) as date) as activity_week,
  count(distinct p.userId) as n_users from plays p join jn on jn.userId = p.userId group by 1, 2""")
def q_cohort(t):
    return A.cohort_matrix(plays(t), joined(t))


def _hist_sql(name, expr, src):
    """Bins of one measure, raw and log1p."""
    out = []
    for form, e in (("raw", expr), ("log1p", f"ln(1 + {expr})")):
        out.append(f"""select '{name}' as measure, '{form}' as form, b.bin, s.lo + b.bin * (s.hi - s.lo) / 10 as bin_start,
  s.lo + (b.bin + 1) * (s.hi - s.lo) / 10 as bin_end,
  (select count(*) from (select cast({e} as double) as x from {src}) v where x is not null and
     case when s.hi = s.lo then 0 else least(floor((x - s.lo) * 10 / (s.hi - s.lo)), 9) end = b.bin) as n
from range(10) b(bin), (select min(x) as lo, max(x) as hi from (select cast({e} as double) as x from {src})) s""")
    return out


_HISTS = [*_hist_sql("plays_per_user", "n", "(select userId, count(*) as n from plays group by userId)"),
          *_hist_sql("games_per_user", "n", "(select userId, count(distinct gameId) as n from plays group by userId)"),
          *_hist_sql("session_seconds", "sessionSeconds", "plays"), *_hist_sql("bet_amount", "betAmount", "plays")]


@register("play_histograms", "D22 (all measures, raw and log1p)", f"""with {PLAYS_CTES}
select measure, form, bin, round(bin_start, 6) as bin_start, round(bin_end, 6) as bin_end, n from ({' union all '.join(_HISTS)})""")
def q_histograms(t):
    p = plays(t)
    return rounded(A.histograms({
        "plays_per_user": p.groupBy("userId").count().select("count"),
        "games_per_user": p.groupBy("userId").agg(F.count_distinct("gameId").alias("n")).select("n"),
        "session_seconds": p.select("sessionSeconds"), "bet_amount": p.select("betAmount")}))


@register("user_tiers", "E6 (bet tier quartiles; diversity tertiles of raw values)", f"""with {PLAYS_CTES}, {UB_SQL},
u as (select userId, total_bet, unique_games_played / total_sessions as diversity from ub),
e as (select quantile_cont(diversity, 1.0 / 3) as a, quantile_cont(diversity, 2.0 / 3) as b from u),
r as (select *, row_number() over (order by round(total_bet, 2), userId) - 1 as pos, count(*) over () as n from u)
select userId, (['tier1', 'tier2', 'tier3', 'tier4'])[cast(case when least(n, 4) <= 1 then 1 else
    greatest(1, floor((pos * least(n, 4) + (n - 2)) / (n - 1))) end as int)] as bet_tier,
  case when diversity <= e.a then 'low' when diversity <= e.b then 'mid' else 'high' end as diversity_tertile
from r, e""")
def q_tiers(t):
    u = ub(t).select("userId", M.round_to(F.col("total_bet"), 2).alias("total_bet"),
                     (F.col("unique_games_played") / F.col("total_sessions")).alias("diversity"))
    u = ST.quantile_bucket(u, "userId", "total_bet", A.BET_TIER_LABELS, "bet_tier")
    return A.raw_cut(u, "diversity", ["low", "mid", "high"], "diversity_tertile").select("userId", "bet_tier", "diversity_tertile")


@register("segment_hour_matrix", "D28", f"""with {PLAYS_CTES}
select archetype, {', '.join(f"count_if(hourOfDay = {h}) as h{h}" for h in range(24))}
from plays group by archetype""")
def q_seg_hour(t):
    return A.segment_pivot(plays(t), "archetype", "hourOfDay", list(range(24)), "h")


@register("segment_weekday_matrix", "D28", f"""with {PLAYS_CTES}
select archetype, {', '.join(f"count_if(dayOfWeek = '{d}') as d_{d}" for d in A.WEEKDAY_NAMES)}
from plays group by archetype""")
def q_seg_day(t):
    return A.segment_pivot(plays(t), "archetype", "dayOfWeek", A.WEEKDAY_NAMES, "d_")


@register("segment_box_stats", "D29", f"""with {PLAYS_CTES},
u as (select userId, archetype, sum(betAmount) as total_bet from plays group by userId, archetype)
select archetype, count(total_bet) as n_users, round(min(total_bet), 6) as min, round(max(total_bet), 6) as max,
  round(quantile_cont(total_bet, 0.25), 6) as q25, round(quantile_cont(total_bet, 0.5), 6) as median,
  round(quantile_cont(total_bet, 0.75), 6) as q75
from u group by archetype""")
def q_box(t):
    u = plays(t).groupBy("userId", "archetype").agg(F.sum("betAmount").alias("total_bet"))
    return rounded(A.segment_box_stats(u, "archetype", "total_bet"))


@register("daily_activity", "E8", f"""with {PLAYS_CTES},
d as (select cast(timestamp as date) as date, count(*) as plays from plays group by 1)
select date, plays, round(avg(plays) over (order by date rows between 6 preceding and current row), 6) as moving_avg_7
from d""")
def q_daily(t):
    return rounded(A.daily_activity(plays(t)))


_TYPES = M.VALID_GAME_TYPES


@register("daily_type_mix", "D38", f"""with {PLAYS_CTES},
top5 as (select gameType from (select gameType, count(*) as n from plays group by gameType)
  order by n desc, gameType limit 5)
select cast(timestamp as date) as date, {', '.join(f'count_if(gameType = {chr(39)}{x}{chr(39)}) as "{x}"' for x in _TYPES)}
from plays where gameType in (select gameType from top5) group by 1""")
def q_type_mix(t):
    return A.daily_type_mix(plays(t), _TYPES)


@register("hourly_activity", "D39", f"""with {PLAYS_CTES},
c as (select hourOfDay, count(*) as plays from plays group by hourOfDay)
select cast(r.range as integer) as hourOfDay, coalesce(c.plays, 0) as plays
from range(24) r left join c on c.hourOfDay = r.range""")
def q_hourly(t):
    return A.complete_counts(plays(t), "hourOfDay", list(range(24)), "plays")


@register("weekday_activity", "D39", f"""with {PLAYS_CTES},
c as (select dayOfWeek, count(*) as plays from plays group by dayOfWeek),
k as (select unnest({A.WEEKDAY_NAMES}) as dayOfWeek)
select k.dayOfWeek, coalesce(c.plays, 0) as plays from k left join c on c.dayOfWeek = k.dayOfWeek""")
def q_weekday(t):
    return A.complete_counts(plays(t), "dayOfWeek", A.WEEKDAY_NAMES, "plays")


@register("plays_per_user_histogram", "D22", f"""with {PLAYS_CTES},
u as (select userId, cast(count(*) as double) as x from plays group by userId),
mm as (select min(x) as lo, max(x) as hi from u),
b as (select case when hi - lo = 0 then 0 else cast(least(floor(((x - lo) * 10) / (hi - lo)), 9) as bigint) end as bin
  from u, mm)
select r.range as bin, round(lo + (r.range * (hi - lo)) / 10, 6) as bin_start,
  round(lo + ((r.range + 1) * (hi - lo)) / 10, 6) as bin_end, count(b.bin) as n
from range(10) r join mm on true left join b on b.bin = r.range group by r.range, lo, hi""")
def q_hist(t):
    u = plays(t).groupBy("userId").agg(F.count("*").alias("x"))
    return rounded(A.equal_width_histogram(u, "x", 10))


@register("describe_plays_per_user", "D19", f"""with {PLAYS_CTES},
u as (select userId, count(*) as x from plays group by userId)
select count(x) as count, round(avg(x), 3) as mean, round(stddev_samp(x), 3) as std, round(cast(min(x) as double), 3) as min,
  round(quantile_cont(x, 0.25), 3) as q25, round(quantile_cont(x, 0.5), 3) as q50,
  round(quantile_cont(x, 0.75), 3) as q75, round(cast(max(x) as double), 3) as max from u""")
def q_describe(t):
    u = plays(t).groupBy("userId").agg(F.count("*").alias("x"))
    return A.describe(u, "x", 3)


@register("null_counts", "D20", f"""with {pipeline_ctes('enriched')}
{' union all '.join(f"select '{c}' as {chr(34)}column{chr(34)}, count_if({c} is null) as null_count from enriched" for c in P.ENRICHED_COLUMNS)}""")
def q_nulls(t):
    return A.null_counts(P.enriched_bets(t).select(*P.ENRICHED_COLUMNS))


@register("activity_thresholds", "D21", f"""with {PLAYS_CTES},
u as (select userId, count(*) as n from plays group by userId)
select count(*) as n_users, count_if(n = 1) as users_exactly_1, count_if(n >= 5) as users_5_plus from u""")
def q_thresholds(t):
    return A.activity_thresholds(plays(t))


@register("zero_duration_share", "D23", f"""with {pipeline_ctes('events')}
select round(avg(cast(durationSeconds = 0 as double)), 6) as zero_duration_share,
  count_if(durationSeconds <> 0) as n_nonzero,
  round(avg(case when durationSeconds <> 0 then durationSeconds end), 6) as mean_nonzero_duration from events""")
def q_zero(t):
    return rounded(A.zero_duration_share(P.events(t)))


@register("win_rate_by_game", "D24", f"""with {PLAYS_CTES}
select gameId, count(*) as plays, round(avg(win), 6) as win_rate from plays group by gameId""")
def q_winrate(t):
    return rounded(plays(t).groupBy("gameId").agg(F.count("*").alias("plays"), F.avg("win").alias("win_rate")))


_SESS_SQL = """ss as (select trim(userId) as userId, trim(gameGroup) as gameId,
    (epoch_us(updated_at) - epoch_us(created_at)) / 1e6 as session_duration_sec from fx_sessions)"""


@register("session_stats_by_user", "D15", f"""with {pipeline_ctes('merged')}, {_SESS_SQL}
select userId, count(*) as n_sessions, round(avg(session_duration_sec), 6) as avg_duration_sec,
  round(max(session_duration_sec), 6) as max_duration_sec, round(min(session_duration_sec), 6) as min_duration_sec
from ss group by userId""")
def q_sess_user(t):
    return rounded(A.session_stats(P.fixture_sessions(t), "userId"))


@register("session_stats_by_game", "D16 C13", f"""with {pipeline_ctes('merged')}, {_SESS_SQL},
a as (select gameId, count(*) as n_sessions, avg(session_duration_sec) as avg_duration_sec,
    max(session_duration_sec) as max_duration_sec, min(session_duration_sec) as min_duration_sec from ss group by gameId)
select a.gameId, n_sessions, round(avg_duration_sec, 6) as avg_duration_sec, round(max_duration_sec, 6) as max_duration_sec,
  round(min_duration_sec, 6) as min_duration_sec, coalesce(g.gameName, 'Unknown') as name
from a left join fx_games g on g.gameId = a.gameId""")
def q_sess_game(t):
    names = t.fx_games.select("gameId", F.col("gameName").alias("name"))
    return rounded(A.session_stats(P.fixture_sessions(t), "gameId", names))


@register("event_type_stats", "D18", f"""with {pipeline_ctes('merged')}
select event_type, count(*) as n, count(distinct user_id) as n_users, min(ts) as first_ts, max(ts) as last_ts
from fx_ev group by event_type""")
def q_event_types(t):
    return A.group_stats(t.fx_ev, "event_type", "user_id", "ts")


@register("event_value_counts", "D9", f"""with {pipeline_ctes('events')}
select 'deviceType' as "column", deviceType as value, count(*) as n from events group by deviceType
union all select 'entryPoint', entryPoint, count(*) from events group by entryPoint
union all select 'gameType', gameType, count(*) from events group by gameType
union all select * from (select 'provider', provider, count(*) as n from events group by provider
  order by n desc, provider asc nulls first limit 10)""")
def q_value_counts(t):
    e = P.events(t)
    out = A.value_counts(e, "deviceType").unionByName(A.value_counts(e, "entryPoint")).unionByName(
        A.value_counts(e, "gameType")).unionByName(A.value_counts(e, "provider", top=10))
    return out


def _known_sql(c):
    return (f"round(coalesce(avg(case when lower(trim(coalesce(cast({c} as varchar), 'nan'))) in "
            f"('unknown', 'nan', 'none', 'null', '') then 0.0 else 1.0 end), 0.0), 6) as {c}_known_rate")


@register("known_rates", "D10", f"""with {pipeline_ctes('events')}
select {', '.join(_known_sql(c) for c in ['deviceType', 'entryPoint', 'provider', 'gameType'])} from events""")
def q_known(t):
    e = P.events(t)
    return rounded(e.agg(*[A.known_rate(c).alias(f"{c}_known_rate")
                           for c in ["deviceType", "entryPoint", "provider", "gameType"]]))


@register("game_type_mapping_audit", "D41", f"""with {PLAYS_CTES}
select gameType_raw, gameType, count(*) as n from plays group by gameType_raw, gameType
order by n desc, gameType_raw asc nulls first limit 15""")
def q_audit(t):
    return (plays(t).groupBy("gameType_raw", "gameType").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.col("gameType_raw").asc_nulls_first()).limit(15))


# ---------------------------------------------------------------------------
# dataset-level diagnostics
# ---------------------------------------------------------------------------
@register("dataset_overview", "D11 D14", f"""with {DATASET_CTES},
spu as (select userId, count(*) as n, count(distinct gameId) as g from events group by userId)
select (select count(*) from events) as n_events,
  (select count(distinct userId) from events) as n_active_users,
  (select count(distinct gameId) from events) as n_active_games,
  (select count(*) from train_pairs) as train_nnz, (select count(*) from test_pairs) as test_nnz,
  (select count(*) from full_pairs) as full_nnz,
  round((select count(*) from full_pairs) / greatest((select count(*) from active_users)
    * (select count(*) from active_items), 1) * 100.0, 6) as interaction_density_pct,
  (select count(*) from uvocab) as user_feature_vocab_size, (select count(*) from ivocab) as item_feature_vocab_size,
  round((select avg(n) from spu), 6) as avg_sessions_per_user,
  round((select quantile_cont(n, 0.5) from spu), 6) as median_sessions_per_user,
  round((select avg(g) from spu), 6) as avg_unique_games_per_user,
  round((select quantile_cont(g, 0.5) from spu), 6) as median_unique_games_per_user,
  round((select avg(implicit_score) from train_pairs), 6) as avg_implicit_score,
  round((select quantile_cont(implicit_score, 0.5) from train_pairs), 6) as median_implicit_score,
  (select min(timestamp) from events) as timestamp_min, (select max(timestamp) from events) as timestamp_max""")
def q_overview(t):
    d = P.dataset(t)
    e = P.events(t)
    spu = e.groupBy("userId").agg(F.count("*").alias("n"), ST.distinct_in_group("gameId").alias("g"))
    (med_n,) = ST.quantiles(spu, "n", [0.5])
    (med_g,) = ST.quantiles(spu, "g", [0.5])
    (med_s,) = ST.quantiles(d.train_pairs, "implicit_score", [0.5])
    cnt = lambda df: df.agg(F.count("*")).scalar()
    out = e.agg(F.count("*").alias("n_events"),
                F.min("timestamp").alias("timestamp_min"), F.max("timestamp").alias("timestamp_max"))
    full = cnt(d.full_pairs)
    out = out.select(
        "n_events", e.agg(F.count_distinct("userId")).scalar().alias("n_active_users"),
        e.agg(F.count_distinct("gameId")).scalar().alias("n_active_games"),
        cnt(d.train_pairs).alias("train_nnz"), cnt(d.test_pairs).alias("test_nnz"), full.alias("full_nnz"),
        (full / F.greatest(cnt(d.active_users) * cnt(d.active_items), F.lit(1)) * 100.0).alias("interaction_density_pct"),
        cnt(d.user_vocab).alias("user_feature_vocab_size"), cnt(d.item_vocab).alias("item_feature_vocab_size"),
        spu.agg(F.avg("n")).scalar().alias("avg_sessions_per_user"),
        F.lit(med_n).alias("median_sessions_per_user"),
        spu.agg(F.avg("g")).scalar().alias("avg_unique_games_per_user"),
        F.lit(med_g).alias("median_unique_games_per_user"),
        d.train_pairs.agg(F.avg("implicit_score")).scalar().alias("avg_implicit_score"),
        F.lit(med_s).alias("median_implicit_score"), "timestamp_min", "timestamp_max")
    return rounded(out)


_DEV = ["mobile", "desktop", "tablet", "unknown"]


@register("user_segment_summary", "D12 B35", f"""with {DATASET_CTES},
u as (select *, case when total_sessions <= 5 then '1_5' when total_sessions <= 20 then '6_20' else '21_plus' end
    as session_tier from ufe)
select session_tier, count(userId) as user_count, round(avg(total_sessions), 6) as avg_sessions,
  round(quantile_cont(total_sessions, 0.5), 6) as median_sessions, round(avg(unique_games), 6) as avg_unique_games,
  round(avg(avg_duration_sec), 6) as avg_duration_sec, round(avg(quick_exit_rate), 6) as avg_quick_exit_rate,
  round(avg(return_10m_rate), 6) as avg_return_10m_rate,
  round(avg(positive_outcome_rate), 6) as avg_positive_outcome_rate,
  {', '.join(f"round(avg(cast(preferred_device = '{x}' as double)), 6) as pct_device_{x}" for x in _DEV)},
  {', '.join(f"round(avg(cast(preferred_time_of_day = '{x}' as double)), 6) as pct_time_{x}" for x in M.TIME_BUCKETS)},
  case session_tier when '1_5' then 0 when '6_20' then 1 else 2 end as tier_order
from u group by session_tier""")
def q_segments(t):
    u = P.dataset(t).ufe.withColumn("session_tier", M.session_tier("total_sessions"))
    aggs = [F.count("userId").alias("user_count"), F.avg("total_sessions").alias("avg_sessions"),
            F.avg("unique_games").alias("avg_unique_games"), F.avg("avg_duration_sec").alias("avg_duration_sec"),
            F.avg("quick_exit_rate").alias("avg_quick_exit_rate"), F.avg("return_10m_rate").alias("avg_return_10m_rate"),
            F.avg("positive_outcome_rate").alias("avg_positive_outcome_rate")]
    aggs += [F.avg((F.col("preferred_device") == x).cast("double")).alias(f"pct_device_{x}") for x in _DEV]
    aggs += [F.avg((F.col("preferred_time_of_day") == x).cast("double")).alias(f"pct_time_{x}")
             for x in M.TIME_BUCKETS]
    g = u.groupBy("session_tier").agg(*aggs)
    med = ST.grouped_quantiles(u, ["session_tier"], "total_sessions", [0.5], ["median_sessions"])
    order = F.when(F.col("session_tier") == "1_5", 0).when(F.col("session_tier") == "6_20", 1).otherwise(2)
    return rounded(g.join(med, "session_tier", "left").withColumn("tier_order", order))


@register("item_catalog_summary", "D13", f"""with {DATASET_CTES}
select count(*) as total_games, round(avg(unique_users), 6) as avg_users_per_game,
  round(quantile_cont(unique_users, 0.5), 6) as median_users_per_game,
  round(avg(game_sessions), 6) as avg_sessions_per_game,
  round(quantile_cont(game_sessions, 0.5), 6) as median_sessions_per_game,
  count_if(popularity_bucket = 'cold') as cold_item_count from ife""")
def q_catalog(t):
    ife = P.dataset(t).ife
    (mu,) = ST.quantiles(ife, "unique_users", [0.5])
    (ms,) = ST.quantiles(ife, "game_sessions", [0.5])
    return rounded(ife.agg(
        F.count("*").alias("total_games"), F.avg("unique_users").alias("avg_users_per_game"),
        F.lit(mu).alias("median_users_per_game"), F.avg("game_sessions").alias("avg_sessions_per_game"),
        F.lit(ms).alias("median_sessions_per_game"),
        F.count_if(F.col("popularity_bucket") == "cold").alias("cold_item_count")))


@register("item_catalog_distribution", "D13 D9", f"""with {DATASET_CTES}
select 'provider' as "column", provider as value, count(*) as n from ife group by provider
union all select 'game_type', game_type, count(*) from ife group by game_type
union all select 'popularity_bucket', popularity_bucket, count(*) from ife group by popularity_bucket""")
def q_catalog_dist(t):
    ife = P.dataset(t).ife.withColumnRenamed("game_type", "game_type")
    return A.value_counts(ife, "provider").unionByName(A.value_counts(ife, "game_type")).unionByName(
        A.value_counts(ife, "popularity_bucket"))


@register("top_games_by_popularity", "F2 F1", f"""with {DATASET_CTES}
select gameId, substring(gameId, 1, 20) as game_label, round(popularity_score, 6) as popularity_score,
  popularity_bucket from ife order by popularity_score desc, gameId limit 15""")
def q_top_pop(t):
    ife = P.dataset(t).ife
    return rounded(ife.orderBy(F.desc("popularity_score"), "gameId").limit(15).select(
        "gameId", F.substring("gameId", 1, 20).alias("game_label"), "popularity_score", "popularity_bucket"))


@register("popularity_bucket_counts", "F2 E5", f"""with {DATASET_CTES},
k as (select unnest(['cold', 'warm', 'hot', 'blockbuster']) as popularity_bucket,
    unnest([0, 1, 2, 3]) as bucket_order)
select k.popularity_bucket, k.bucket_order, count(i.gameId) as n from k left join ife i
  on i.popularity_bucket = k.popularity_bucket group by k.popularity_bucket, k.bucket_order""")
def q_bucket_counts(t):
    spark = t.spark
    k = spark.createDataFrame(list(zip(M.POPULARITY_LABELS, range(4))), "popularity_bucket string, bucket_order int")
    c = P.dataset(t).ife.groupBy("popularity_bucket").agg(F.count("*").alias("n"))
    return k.join(c, "popularity_bucket", "left").fillna(0, subset=["n"])


@register("bet_concentration_lorenz", "E9", f"""with {PLAYS_CTES},
u as (select userId, round(sum(betAmount), 2) as total_bet from plays group by userId)
select userId, total_bet, row_number() over (order by total_bet, userId) as position,
  round(row_number() over (order by total_bet, userId) / count(*) over (), 6) as cum_users,
  round(sum(total_bet) over (order by total_bet, userId rows between unbounded preceding and current row)
    / sum(total_bet) over (), 6) as cum_value
from u""")
def q_lorenz(t):
    # bets carry 2 decimals: ordering on the exact rounded total keeps ties identical in every engine
    u = plays(t).groupBy("userId").agg(M.round_to(F.sum("betAmount"), 2).alias("total_bet"))
    return rounded(ST.prefix_share(u, "userId", "total_bet"), exclude=["total_bet"])


_SPEARMAN_COLS = ["total_sessions", "avg_bet", "total_bet", "avg_session_duration", "unique_games_played",
                  "last_active_days_ago", "sessions_last_30d"]


def _spearman_sql():
    ranks = ", ".join(f"rank() over (order by round({c}, 6)) + (count(*) over (partition by round({c}, 6)) - 1) / 2.0"
                      f" as r_{c}" for c in _SPEARMAN_COLS)
    pairs = []
    for i, a in enumerate(_SPEARMAN_COLS):
        for b in _SPEARMAN_COLS[i:]:
            pairs.append(f"select '{a}' as col_a, '{b}' as col_b, round(corr(r_{a}, r_{b}), 6) as rho from rk")
    return f"rk as (select userId, {ranks} from ub)\n" + "\nunion all ".join(pairs)


@register("spearman_user_behaviour", "D36 E7", f"""with {PLAYS_CTES}, {UB_SQL}, {_spearman_sql()}""")
def q_spearman(t):
    # rank 6-digit values so float noise cannot split ties differently per engine
    return rounded(A.spearman_matrix(rounded(ub(t)), "userId", _SPEARMAN_COLS))
