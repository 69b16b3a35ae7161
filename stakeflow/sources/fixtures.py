"""Portable views over the driver's test tables that play the parts of the
source collections (bets, games, players, sessions, activity, vectors).

The SQL text runs unchanged in Spark and DuckDB.  In Spark each view is built
with ``spark.sql(text, **dataframes)``; in the oracle it is inlined as a CTE,
so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

# name -> (sql text, dependencies).  ``{x}`` marks a table or another view.
FIXTURE_SQL: dict[str, tuple[str, list[str]]] = {
    # gid: the played game, over a tenth more ids than parts (the rest stay unmatched), low ids more often
    "fx_ev": ("""
select event_id, ts, user_id, event_type, value, k,
       cast(floor(n_ids * (h * h) / 1000006000009.0) as bigint) as gid
from (select e.event_id, e.ts, e.user_id, e.event_type, e.value,
             cast(regexp_extract(e.props, '([0-9]+)', 1) as int) as k,
             cast((e.event_id * 7368787 + e.user_id) % 1000003 as double) as h, cast(p.n_ids as double) as n_ids
      from {events} e join (select count(*) + floor(count(*) / 10) as n_ids from {part}) p on true) x""",
              ["events", "part"]),
    "fx_games": ("""
select cast(p_partkey as string) as gameId,
       concat(p_name, ' ', cast(p_partkey as string)) as gameName,
       case p_partkey % 12 when 0 then 'Live Roulette' when 1 then 'Baccarat' when 2 then 'sic bo'
         when 3 then 'starburst slot' when 4 then 'Table Poker' when 5 then 'aviator'
         when 6 then 'cricket crash' when 7 then 'instant keno' when 8 then 'mystery'
         when 9 then 'Teen Patti' when 10 then 'Reel Fruit' else null end as gameType_raw,
       case p_partkey % 8 when 0 then 'EvoSW' when 1 then 'ezugi' when 2 then 'Spribe'
         when 3 then 'OnlyPlay' when 4 then 'hub88' when 5 then 'Peter & Sons'
         when 6 then 'aaaaaaaaaaaaaaaaaaaaaaaa' else p_brand end as gamevendor,
       p_size as minBet, p_retailprice as maxBet
from {part}""", ["part"]),
    "fx_players": ("""
select cast(c_custkey as string) as userId, cast(c_custkey + 1000000 as string) as playerId,
       c_mktsegment as archetype, c_nationkey as country
from {customer}""", ["customer"]),
    "fx_bets": ("""
select event_id as txnId, cast(user_id as string) as userId, cast(gid as string) as gameId_raw,
       value as betAmount,
       case event_type when 'purchase' then 'WIN'
         when 'error' then case when event_id % 2 = 0 then 'LOSS' else 'lose' end
         else 'DRAW' end as result, ts
from {fx_ev} where event_type in ('click', 'purchase', 'error')""", ["fx_ev"]),
    "fx_sessions": ("""
select event_id as sessId, cast(user_id as string) as userId, cast(gid % 10 as string) as gameGroup,
       ts as created_at, ts + cast(floor(value) as int) * interval '1' second as updated_at,
       case event_id % 4 when 0 then 'livecasino' when 1 then 'Home' when 2 then 'sports book'
         else 'promo page' end as source
from {fx_ev} where event_type = 'view'""", ["fx_ev"]),
    "fx_activity": ("""
select event_id as actId,
       case when k % 3 = 0 then cast(user_id + 1000000 as string) end as playerId,
       case when k % 3 = 1 then cast(user_id as string) end as loginId,
       case when k % 3 = 2 then cast(user_id as string) end as user_id,
       ts as updated_at,
       case k % 6 when 0 then 'Android' when 1 then 'Windows' when 2 then 'tablet' when 3 then 'iOS'
         when 4 then 'xyz' else null end as device_type
from {fx_ev} where event_type = 'signup'""", ["fx_ev"]),
    # every player and every game has a vector: its id modulo the number of vectors
    "fx_userv": ("""
select cast(p.c_custkey as string) as userId, v.embedding
from {customer} p join (select count(*) as n from {embeddings}) c on true
join {embeddings} v on v.vec_id = p.c_custkey % c.n""", ["customer", "embeddings"]),
    "fx_itemv": ("""
select cast(g.p_partkey as string) as gameId, v.embedding
from {part} g join (select count(*) as n from {embeddings}) c on true
join {embeddings} v on v.vec_id = (g.p_partkey * 7 + 3) % c.n""", ["part", "embeddings"]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazily reads base tables and builds fixture views for one scale dir."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in FIXTURE_SQL:
                text, deps = FIXTURE_SQL[name]
                self._cache[name] = self.spark.sql(text, **{d: self[d] for d in deps})
            else:
                self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n not in FIXTURE_SQL or n in order:
            return
        for d in FIXTURE_SQL[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def fixture_ctes(*names: str) -> str:
    """``name as (...)`` CTE entries (dependencies first) for DuckDB oracles."""
    parts = []
    for n in _closure(names):
        text, deps = FIXTURE_SQL[n]
        parts.append(f"{n} as ({text.format(**{d: d for d in deps})})")
    return ",\n".join(parts)
