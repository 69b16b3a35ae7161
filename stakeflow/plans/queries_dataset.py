"""Queries over the temporal split, dictionaries and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.functions import mappers as M
from stakeflow.operators import dataset as D
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.plans.oracle import feature_ctes, pipeline_ctes, sql_mode


def _tok_sql(cols, src):
    return "list_filter([" + ", ".join(
        f"case when {src}.{c} is not null then concat('{c}:', cast({src}.{c} as varchar)) end" for c in cols
    ) + "], lambda x: x is not null)"


DATASET_CTES = ",\n".join([
    pipeline_ctes("fe"),
    "plt as (select userId, gameId, max(timestamp) as last_ts from events group by userId, gameId)",
    """pu as (select userId, gameId, count(*) over (partition by userId) as n,
    row_number() over (partition by userId order by last_ts desc, gameId desc) as rn from plt)""",
    "hold as (select userId, gameId from pu where n >= 2 and rn = 1)",
    """train_events as (select e.* from events e where not exists
    (select 1 from hold h where h.userId = e.userId and h.gameId = e.gameId))""",
    """test_events as (select e.* from events e where exists
    (select 1 from hold h where h.userId = e.userId and h.gameId = e.gameId))""",
    *feature_ctes("train_events", "tr_"),
    """test_pairs as (select trim(userId) as userId, trim(gameId) as gameId, count(*) as interaction_count,
    1.0 as implicit_score from test_events group by trim(userId), trim(gameId))""",
    """train_pairs as (select * replace (trim(userId) as userId, trim(gameId) as gameId) from tr_user_game
    where lower(trim(userId)) not in ('', 'nan', 'none', 'null') and lower(trim(gameId)) not in ('', 'nan', 'none', 'null'))""",
    "active_users as (select userId from train_pairs union select userId from test_pairs)",
    "active_items as (select gameId from train_pairs union select gameId from test_pairs)",
    "ufe as (select * from tr_user_features where userId in (select userId from active_users))",
    f"st1 as ({sql_mode('events', ['gameId'], 'gameType', 'unknown', 'game_type_static')})",
    f"st2 as ({sql_mode('events', ['gameId'], 'provider', 'unknown', 'provider_static')})",
    """ife0 as (select a.gameId, coalesce(g.game_sessions, 0) as game_sessions, coalesce(g.unique_users, 0) as unique_users,
    coalesce(g.game_type, s1.game_type_static, 'unknown') as game_type,
    coalesce(g.provider, s2.provider_static, 'unknown') as provider,
    coalesce(g.avg_duration_sec, 0) as avg_duration_sec, coalesce(g.avg_rounds, 0) as avg_rounds,
    coalesce(g.quick_exit_rate, 0) as quick_exit_rate, coalesce(g.return_10m_rate, 0) as return_10m_rate,
    coalesce(g.positive_outcome_rate, 0) as positive_outcome_rate,
    coalesce(g.popularity_score, 0) as popularity_score
  from active_items a left join tr_game_features g on g.gameId = a.gameId
  left join st1 s1 on s1.gameId = a.gameId left join st2 s2 on s2.gameId = a.gameId)""",
    """ife as (select * exclude (rn, n), (['cold', 'warm', 'hot', 'blockbuster'])[
      case when least(n, 4) <= 1 then 1 else greatest(1, ((rn - 1) * least(n, 4) + (n - 2)) // (n - 1)) end]
      as popularity_bucket
  from (select *, row_number() over (order by popularity_score asc nulls first, gameId) as rn,
        count(*) over () as n from ife0))""",
    "uidx as (select userId, row_number() over (order by userId) - 1 as idx from active_users)",
    "iidx as (select gameId, row_number() over (order by gameId) - 1 as idx from active_items)",
    f"utok as (select userId, {_tok_sql(M.USER_TOKEN_COLUMNS, 'ufe')} as tokens from ufe)",
    f"itok as (select gameId, {_tok_sql(M.ITEM_TOKEN_COLUMNS, 'ife')} as tokens from ife)",
    """uvocab as (select token, row_number() over (order by token) - 1 as token_idx
    from (select distinct unnest(tokens) as token from utok))""",
    """ivocab as (select token, row_number() over (order by token) - 1 as token_idx
    from (select distinct unnest(tokens) as token from itok))""",
    """full_pairs as (select userId, gameId, arg_min(implicit_score, src) as implicit_score from (
    select userId, gameId, implicit_score, 0 as src from train_pairs
    union all select userId, gameId, implicit_score, 1 from test_pairs) group by userId, gameId)""",
])


def ds(t):
    return P.dataset(t)


@register("holdout_pairs", "H1 E3 E4", f"with {DATASET_CTES}\nselect userId, gameId from hold")
def q_holdout(t):
    return ds(t).holdout


@register("event_split", "C7 H1", f"""with {DATASET_CTES}
select sessionId, 'train' as split from train_events union all select sessionId, 'test' from test_events""")
def q_split(t):
    d = ds(t)
    return d.train_events.select("sessionId", F.lit("train").alias("split")).unionByName(
        d.test_events.select("sessionId", F.lit("test").alias("split")))


@register("test_pairs", "D7", f"with {DATASET_CTES}\nselect * from test_pairs")
def q_test_pairs(t):
    return ds(t).test_pairs


@register("train_pair_scores", "D6 B28 (train only)", f"""with {DATASET_CTES}
select userId, gameId, interaction_count, round(avg_engagement_intensity, 6) as avg_engagement_intensity,
  round(recency_days, 6) as recency_days, round(implicit_score, 6) as implicit_score from train_pairs""")
def q_train_pairs(t):
    return rounded(ds(t).train_pairs.select("userId", "gameId", "interaction_count", "avg_engagement_intensity",
                                            "recency_days", "implicit_score"))


@register("active_user_features", "C8 D1 (train users)", f"""with {DATASET_CTES}
select userId, total_sessions, unique_games, preferred_time_of_day, preferred_day_of_week, preferred_device,
  preferred_entry_point, round(recency_days, 6) as recency_days from ufe""")
def q_ufe(t):
    return rounded(ds(t).ufe.select("userId", "total_sessions", "unique_games", "preferred_time_of_day",
                                    "preferred_day_of_week", "preferred_device", "preferred_entry_point",
                                    "recency_days"))


@register("item_catalog_features", "C9 D8 E5 G1 B34", f"""with {DATASET_CTES}
select gameId, game_sessions, unique_users, game_type, provider, round(avg_duration_sec, 6) as avg_duration_sec,
  round(positive_outcome_rate, 6) as positive_outcome_rate, round(popularity_score, 6) as popularity_score,
  popularity_bucket from ife""")
def q_ife(t):
    return rounded(ds(t).ife.select("gameId", "game_sessions", "unique_users", "game_type", "provider",
                                    "avg_duration_sec", "positive_outcome_rate", "popularity_score",
                                    "popularity_bucket"))


@register("id_maps", "H3 A7", f"""with {DATASET_CTES}
select 'user' as kind, userId as id, idx from uidx union all select 'item', gameId, idx from iidx""")
def q_id_maps(t):
    d = ds(t)
    return d.user_index.select(F.lit("user").alias("kind"), F.col("userId").alias("id"), "idx").unionByName(
        d.item_index.select(F.lit("item").alias("kind"), F.col("gameId").alias("id"), "idx"))


@register("feature_vocab", "H4 B32", f"""with {DATASET_CTES}
select 'user' as side, token, token_idx from uvocab union all select 'item', token, token_idx from ivocab""")
def q_vocab(t):
    d = ds(t)
    return d.user_vocab.select(F.lit("user").alias("side"), "token", "token_idx").unionByName(
        d.item_vocab.select(F.lit("item").alias("side"), "token", "token_idx"))


@register("interaction_triplets", "H5 G2", f"""with {DATASET_CTES}
select 'full' as matrix, u.idx as user_idx, i.idx as item_idx, round(cast(p.implicit_score as double), 6) as weight
  from full_pairs p join uidx u on u.userId = p.userId join iidx i on i.gameId = p.gameId
union all select 'train', u.idx, i.idx, round(cast(p.implicit_score as double), 6)
  from train_pairs p join uidx u on u.userId = p.userId join iidx i on i.gameId = p.gameId
union all select 'test', u.idx, i.idx, 1.0
  from test_pairs p join uidx u on u.userId = p.userId join iidx i on i.gameId = p.gameId""")
def q_triplets(t):
    d = ds(t)
    parts = [("full", d.full_pairs), ("train", d.train_pairs), ("test", d.test_pairs)]
    out = None
    for name, pairs in parts:
        tr = D.triplets(pairs, d.user_index, d.item_index).select(F.lit(name).alias("matrix"), "*")
        out = tr if out is None else out.unionByName(tr)
    return rounded(out)


@register("feature_matrices", "H6", f"""with {DATASET_CTES},
un as (select count(*) as n from active_users), inn as (select count(*) as n from active_items),
ut as (select u.idx, coalesce(t.tokens, []) as tokens from uidx u left join utok t on t.userId = u.userId),
it as (select i.idx, coalesce(t.tokens, []) as tokens from iidx i left join itok t on t.gameId = i.gameId)
select 'user' as side, idx as entity_idx, idx as feature_idx, round(1.0 / (len(tokens) + 1), 6) as value from ut
union all select 'user', idx, v.token_idx + un.n, round(1.0 / (len(tokens) + 1), 6)
  from (select idx, tokens, unnest(tokens) as token from ut) x join uvocab v on v.token = x.token join un on true
union all select 'item', idx, idx, round(1.0 / (len(tokens) + 1), 6) from it
union all select 'item', idx, v.token_idx + inn.n, round(1.0 / (len(tokens) + 1), 6)
  from (select idx, tokens, unnest(tokens) as token from it) x join ivocab v on v.token = x.token join inn on true""")
def q_feature_matrix(t):
    d = ds(t)
    u = D.feature_matrix(d.user_index, "userId", d.user_tokens, d.user_vocab)
    i = D.feature_matrix(d.item_index, "gameId", d.item_tokens, d.item_vocab)
    return rounded(u.select(F.lit("user").alias("side"), "*").unionByName(i.select(F.lit("item").alias("side"), "*")))
