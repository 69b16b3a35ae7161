"""Raw-collection loader queries (A1 - A3, B1, B5, B6, D17) and sink queries.

Raw collections with nested arrays are derived from the test tables: bets from
``events`` (``betParts`` holds one struct, or is empty / NULL for some rows),
game details from ``part`` (``category`` array), players from ``customer``.
Nested literals differ between engines, so the Spark builder and the DuckDB
text are written separately from the same rules.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stakeflow.config import DEFAULT
from stakeflow.operators import dataset as D
from stakeflow.operators import scoring as S
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, round6, rounded
from stakeflow.plans.queries_dataset import DATASET_CTES
from stakeflow.plans.queries_explain import EXPLAIN_CTES, fixture_model
from stakeflow.session import at_once, cut_lineage, shared_path
from stakeflow.sources import ingest as I
from stakeflow.sources import sinks as K
from stakeflow.sources.fixtures import fixture_ctes

_PART_T = "STRUCT(sportName VARCHAR, categoryName VARCHAR, tournamentName VARCHAR, tournamentId VARCHAR)"

RAW_SQL = f"""raw_bets as (select cast(event_id as varchar) as _id, cast(user_id as varchar) as loginId,
    cast(value as varchar) as stake,
    case event_type when 'purchase' then 'WIN' when 'error' then 'LOSS' else 'DRAW' end as result,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as createdDate,
    case when event_id % 7 = 0 then 'Sports' else 'Live Casino' end as gameType,
    case when event_id % 11 = 0 then 'OPEN' else 'SETTLED' end as status,
    case when event_id % 13 = 0 then cast([] as {_PART_T}[])
         when event_id % 17 = 0 then cast(null as {_PART_T}[])
         else [struct_pack(
           sportName := case when event_id % 19 = 0 then null when event_id % 23 = 0 then '998:baccarat'
                             else concat('game ', cast(k as varchar)) end,
           categoryName := case k % 4 when 0 then 'Live Roulette' when 1 then 'slot' when 2 then null else 'crash' end,
           tournamentName := case k % 5 when 0 then null when 1 then 'Evolution' when 2 then 'ezugi' else 'Spribe' end,
           tournamentId := cast(k as varchar))] end as betParts
  from fx_ev where event_type in ('click', 'purchase', 'error')),
raw_games as (select cast(p_partkey as varchar) as gameId, p_name as gameName, cast(p_size as double) as minBet,
    p_retailprice as maxBet,
    case p_partkey % 9 when 0 then cast([] as STRUCT(name VARCHAR)[]) when 1 then cast(null as STRUCT(name VARCHAR)[])
         else [struct_pack(name := p_type)] end as category,
    p_brand as gamevendor, case when p_partkey % 10 = 0 then 'OFF' else 'ON' end as gameStatus
  from part),
raw_players as (select cast(c_custkey + 1000000 as varchar) as playerId, c_name as username,
    cast(c_custkey as varchar) as contactNo, c_custkey % 5 <> 0 as activeStatus from customer)"""


def raw_bets(t):
    e = t.fx_ev.where(F.col("event_type").isin("click", "purchase", "error"))
    eid, k = F.col("event_id"), F.col("k")
    part = F.struct(
        F.when(eid % 19 == 0, F.lit(None).cast("string")).when(eid % 23 == 0, F.lit("998:baccarat"))
        .otherwise(F.concat(F.lit("game "), k.cast("string"))).alias("sportName"),
        F.when(k % 4 == 0, "Live Roulette").when(k % 4 == 1, "slot").when(k % 4 == 2, F.lit(None).cast("string"))
        .otherwise("crash").alias("categoryName"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 == 1, "Evolution").when(k % 5 == 2, "ezugi")
        .otherwise("Spribe").alias("tournamentName"),
        k.cast("string").alias("tournamentId"))
    arr = F.array(part)
    parts = (F.when(eid % 13 == 0, F.filter(arr, lambda x: F.lit(False)))
             .when(eid % 17 == 0, F.lit(None).cast(I.T.ArrayType(I.BET_PART)))
             .otherwise(arr))
    return e.select(
        eid.cast("string").alias("_id"), F.col("user_id").cast("string").alias("loginId"),
        F.col("value").cast("string").alias("stake"),
        F.when(F.col("event_type") == "purchase", "WIN").when(F.col("event_type") == "error", "LOSS")
        .otherwise("DRAW").alias("result"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("createdDate"),
        F.when(eid % 7 == 0, "Sports").otherwise("Live Casino").alias("gameType"),
        F.when(eid % 11 == 0, "OPEN").otherwise("SETTLED").alias("status"),
        parts.alias("betParts"))


def raw_games(t):
    p = t.part
    cat = F.array(F.struct(F.col("p_type").alias("name")))
    return p.select(
        F.col("p_partkey").cast("string").alias("gameId"), F.col("p_name").alias("gameName"),
        F.col("p_size").cast("double").alias("minBet"), F.col("p_retailprice").alias("maxBet"),
        F.when(F.col("p_partkey") % 9 == 0, F.filter(cat, lambda x: F.lit(False)))
        .when(F.col("p_partkey") % 9 == 1, F.lit(None).cast("array<struct<name:string>>")).otherwise(cat)
        .alias("category"),
        F.col("p_brand").alias("gamevendor"),
        F.when(F.col("p_partkey") % 10 == 0, "OFF").otherwise("ON").alias("gameStatus"))


def raw_players(t):
    c = t.customer
    return c.select((F.col("c_custkey") + 1000000).cast("string").alias("playerId"), F.col("c_name").alias("username"),
                    F.col("c_custkey").cast("string").alias("contactNo"),
                    (F.col("c_custkey") % 5 != 0).alias("activeStatus"))


RAW_CTES = fixture_ctes("fx_ev") + ",\n" + RAW_SQL
_NAME_MAP_SQL = " ".join(f"when gameName = '{k}' then '{v}'" for k, v in DEFAULT.game_name_map.items())


@register("raw_transactions_loaded", "A1 B1 B2 B3 B4 B5 B6", f"""with {RAW_CTES},
f as (select * from raw_bets where gameType = 'Live Casino' and status = 'SETTLED' and len(betParts) > 0),
x as (select loginId as userId, betParts[1].sportName as gameName, betParts[1].categoryName as categoryName,
    betParts[1].tournamentName as providerName_raw, betParts[1].tournamentId as tournamentId, stake as betAmount,
    result, try_cast(createdDate as timestamp) as timestamp from f)
select userId, case {_NAME_MAP_SQL} else gameName end as gameName, categoryName, providerName_raw, tournamentId,
  betAmount, result, timestamp, cast(hour(timestamp) as integer) as hourOfDay, dayname(timestamp) as dayOfWeek
from x where userId is not null and gameName is not null and betAmount is not null""")
def q_raw_tx(t):
    tx = I.load_transactions(raw_bets(t), check=False)
    return tx.replace(dict(DEFAULT.game_name_map), subset=["gameName"])


@register("raw_game_details_loaded", "A2", f"""with {RAW_CTES}
select gameId, gameName, coalesce(category[1].name, 'Unknown') as gameType, gamevendor, minBet, maxBet
from raw_games where gameStatus = 'ON'""")
def q_raw_games(t):
    return I.load_game_details(raw_games(t), check=False)


@register("raw_players_loaded", "A3", f"""with {RAW_CTES}
select contactNo as userId, playerId, activeStatus from raw_players where activeStatus""")
def q_raw_players(t):
    return I.load_users(raw_players(t))


@register("bet_parts_unnest", "D17", f"""with {RAW_CTES},
u as (select loginId, unnest(betParts) as p from raw_bets where betParts is not null)
select p.sportName as sportName, p.categoryName as categoryName, count(*) as n_parts,
  count(distinct loginId) as n_users from u group by 1, 2""")
def q_unnest(t):
    u = raw_bets(t).select("loginId", F.explode("betParts").alias("p"))
    return u.groupBy(F.col("p.sportName").alias("sportName"), F.col("p.categoryName").alias("categoryName")).agg(
        F.count("*").alias("n_parts"), F.count_distinct("loginId").alias("n_users"))


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
@register("id_map_contiguity", "A7 H3", f"""with {DATASET_CTES}
select 'user' as kind, count(*) as n, max(idx) as max_idx, count(distinct idx) as n_distinct_idx,
  count(distinct userId) as n_distinct_keys,
  max(idx) + 1 = count(*) and count(*) = count(distinct idx) and count(*) = count(distinct userId) as contiguous from uidx
union all select 'item', count(*), max(idx), count(distinct idx), count(distinct gameId),
  max(idx) + 1 = count(*) and count(*) = count(distinct idx) and count(*) = count(distinct gameId) from iidx""")
def q_idmap(t):
    d = P.dataset(t)
    return K.id_map_check(d.user_index, "userId").select(F.lit("user").alias("kind"), "*").unionByName(
        K.id_map_check(d.item_index, "gameId").select(F.lit("item").alias("kind"), "*"))


def _store_sql(src, prefix, key, fields, names=None):
    names = names or {}
    parts = []
    for c, n in fields:
        v = f"cast(round({c}, {n}) as varchar)" if n is not None else f"cast({c} as varchar)"
        parts.append(f"select concat('{prefix}:', {key}, ':features') as key, '{names.get(c, c)}' as field, {v} as value, "
                     f"(select max(timestamp) from events) + interval {DEFAULT.feature_ttl_seconds} second as expires_at "
                     f"from {src}")
    return " union all ".join(parts)


@register("feature_store_rows", "A9", f"""with {DATASET_CTES}
{_store_sql('ufe', 'user', 'userId', K.USER_STORE_FIELDS)} union all
{_store_sql('ife', 'game', 'gameId', K.GAME_STORE_FIELDS, K.GAME_STORE_NAMES)}""")
def q_store(t):
    d = P.dataset(t)
    run_ts = P.events(t).agg(F.max("timestamp")).scalar()
    u = K.feature_store_rows(d.ufe, "user", "userId", K.USER_STORE_FIELDS, run_ts)
    g = K.feature_store_rows(d.ife, "game", "gameId", K.GAME_STORE_FIELDS, run_ts, names=K.GAME_STORE_NAMES)
    return u.unionByName(g)


@register("graph_node_rows", "A10 H8", f"""with {EXPLAIN_CTES}
select 'Player' as label, userId as id, list_transform(embedding, lambda x: round(x, 6)) as embedding, bias,
  (select max(timestamp) from events) as updated_at from urep
union all select 'Game', gameId, list_transform(embedding, lambda x: round(x, 6)), bias,
  (select max(timestamp) from events) from irep""")
def q_graph(t):
    m = fixture_model(t)
    ts = P.events(t).agg(F.max("timestamp")).scalar()
    rnd = lambda df: df.withColumn("embedding", F.transform("embedding", round6))
    u = K.graph_node_rows(rnd(m["u_rep"]), "userId", updated_at=ts).select(F.lit("Player").alias("label"), "*")
    g = K.graph_node_rows(rnd(m["i_rep"]), "gameId", updated_at=ts).select(F.lit("Game").alias("label"), "*")
    return u.unionByName(g)


_UPDATES_SQL = """up as (select concat('Player:', userId) as id, embedding, bias from urep
  union all select concat('Game:', gameId), embedding, bias from irep)"""


def graph_updates(t):
    """Fresh rows of players and games; the node table below holds all customers and no game, so games don't match."""
    m = fixture_model(t)
    ts = P.events(t).agg(F.max("timestamp")).scalar()
    rows = m["u_rep"].select(F.concat(F.lit("Player:"), "userId").alias("key"), "embedding", "bias").unionByName(
        m["i_rep"].select(F.concat(F.lit("Game:"), "gameId").alias("key"), "embedding", "bias"))
    return K.graph_node_rows(rows, "key", updated_at=ts)


def graph_nodes(t):
    return t.customer.select(F.concat(F.lit("Player:"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("segment"))


@register("graph_matched_update", "A11", f"""with {EXPLAIN_CTES}, {_UPDATES_SQL},
nodes as (select concat('Player:', cast(c_custkey as varchar)) as id from customer),
b as (select id, (row_number() over (order by id) - 1) // {DEFAULT.graph_batch_size} as batch_id from up)
select batch_id, count(*) as matched from b where id in (select id from nodes) group by batch_id""")
def q_graph_update(t):
    _, per_batch = K.matched_update(graph_nodes(t), graph_updates(t))
    return per_batch


@register("graph_updated_nodes", "A11 (the node table, written by bucket, updated in place and read back)", f"""with {EXPLAIN_CTES}, {_UPDATES_SQL}
select concat('Player:', cast(c.c_custkey as varchar)) as id, c.c_mktsegment as segment, round(list_sum(u.embedding), 6) as component_sum,
  u.bias, case when u.id is not null then (select max(timestamp) from events) end as updated_at
from customer c left join up u on u.id = concat('Player:', cast(c.c_custkey as varchar))""")
def q_graph_nodes(t):
    path = shared_path(t.spark, f"nodes-{uuid.uuid4().hex}")
    fresh = graph_updates(t)
    empty = [F.lit(None).cast(k).alias(c) for c, k in fresh.dtypes if c != "id"]
    K.write_node_table(graph_nodes(t).select("*", *empty), path)
    K.update_node_table(t.spark, path, fresh)
    out = cut_lineage(K.read_node_table(t.spark, path))
    K.remove_path(t.spark, path)
    return rounded(out.select("id", "segment", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("component_sum"),
                              "bias", "updated_at"))


@register("model_bundle_roundtrip", "A7 A8 A12 F1 H23 (contents compared)", f"""with {DATASET_CTES}
select 'interactions' as part, count(*) as rows, 0 as differing from full_pairs
union all select 'user_features_matrix', sum(1 + coalesce(len(t.tokens), 0)), 0 from uidx u left join utok t on t.userId = u.userId
union all select 'item_features_matrix', sum(1 + coalesce(len(t.tokens), 0)), 0 from iidx i left join itok t on t.gameId = i.gameId
union all select 'user_id_map', count(*), 0 from uidx
union all select 'item_id_map', count(*), 0 from iidx
union all select 'game_metadata', count(*), 0 from ife
union all select 'popularity_ranking', count(*), 0 from ife
union all select 'report_csv', count(*), 0 from ife
union all select 'report_json', count(*), 0 from ife""")
def q_bundle(t):
    d = P.dataset(t)
    report = d.ife.select("gameId", "game_type", "provider", "game_sessions", "popularity_bucket")
    parts = {
        "interactions": D.triplets(d.full_pairs, d.user_index, d.item_index),
        "user_features_matrix": D.feature_matrix(d.user_index, "userId", d.user_tokens, d.user_vocab),
        "item_features_matrix": D.feature_matrix(d.item_index, "gameId", d.item_tokens, d.item_vocab),
        "user_id_map": d.user_index, "item_id_map": d.item_index,
        "game_metadata": S.game_metadata(d.ife, t.fx_games),
        "popularity_ranking": S.popularity_ranking(d.ife),
    }
    path = shared_path(t.spark, f"bundle-{uuid.uuid4().hex}")
    K.write_bundle(path, parts)
    back = K.read_bundle(t.spark, path)
    K.write_report(report, path + "/reports/csv", "csv")
    K.write_report(report, path + "/reports/json", "json")
    pairs = [(name, parts[name], back[name]) for name in K.BUNDLE_PARTS]
    pairs.append(("report_csv", report, t.spark.read.schema(report.schema).option("header", True).csv(path + "/reports/csv")))
    pairs.append(("report_json", report, t.spark.read.schema(report.schema).json(path + "/reports/json")))
    rows = at_once(t.spark, lambda x: (x[0], *K.difference(x[1], x[2]).first()), pairs)  # one row for each part
    K.remove_path(t.spark, path)
    return t.spark.createDataFrame(rows, "part string, rows long, differing long")
