"""Queries over scoring, recommendation and ranking metrics.

The model vectors are the fixture vectors (``fx_userv`` / ``fx_itemv``, biases
0), so scores are deterministic and checkable in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.config import DEFAULT
from stakeflow.operators import metrics as MT
from stakeflow.operators import scoring as S
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.plans.queries_dataset import DATASET_CTES
from stakeflow.sources.fixtures import fixture_ctes

K = DEFAULT.eval_k


def _memo(t, key, fn):
    return P._memo(t, key, fn)


def model(t):
    """(dataset, user vectors, item blocks) for the fixture model."""
    def build():
        d = P.dataset(t)
        users = d.user_index.join(t.fx_userv, "userId")
        items = d.item_index.join(t.fx_itemv, "gameId")
        return d, users, S.item_blocks(items)
    return _memo(t, "model", build)


def _lists(pairs, name):
    return pairs.groupBy("userId").agg(F.collect_list("gameId").alias(name))


def test_ranks(t):
    d, users, blocks = model(t)
    rows = users.join(_lists(d.test_pairs, "pos"), "userId").join(_lists(d.train_pairs, "seen"), "userId", "left")
    return _memo(t, "test_ranks", lambda: S.positive_ranks(rows, blocks, "userId", "pos", exclude="seen"))


def train_and_test_ranks(t):
    d, users, blocks = model(t)
    lists = _lists(d.train_pairs, "seen").join(_lists(d.test_pairs, "pos"), "userId", "full")
    return _memo(t, "both_ranks", lambda: S.split_ranks(users.join(lists, "userId"), blocks, "userId", "seen", "pos"))


def test_user_metrics(t):
    return _memo(t, "test_user_metrics", lambda: MT.per_user_metrics(test_ranks(t), K))


_SCORED = DATASET_CTES + ",\n" + fixture_ctes("fx_userv", "fx_itemv") + """,
sc as (select u.userId, i.gameId,
    round(list_inner_product(cast(uv.embedding as double[]), cast(iv.embedding as double[])) + 0.0 + 0.0, 6) as score
  from uidx u join fx_userv uv on uv.userId = u.userId join iidx i on true join fx_itemv iv on iv.gameId = i.gameId)"""

_RANKED = """,
cand_test as (select * from sc s where not exists
  (select 1 from train_pairs t where t.userId = s.userId and t.gameId = s.gameId)),
rk_test as ({ranked_test}),
pos_test as (select r.* from rk_test r join test_pairs p on p.userId = r.userId and p.gameId = r.gameId),
rk_all as ({ranked_all}),
pos_train as (select r.* from rk_all r join train_pairs p on p.userId = r.userId and p.gameId = r.gameId)"""


def _ranked_sql(src: str) -> str:
    """Place of each candidate, its average rank from below and its tie group's mean discount."""
    return f"""select *, same - 1 as ties, n_candidates - rk - (same - 1) / 2.0 + 1 as avg_rank,
  avg(case when rn <= {K} then 1.0 / log2(rn + 1) else 0.0 end) over (partition by userId, score) as discount
from (select userId, gameId, score, row_number() over (partition by userId order by score desc, gameId) as rn,
        rank() over (partition by userId order by score desc) as rk, count(*) over (partition by userId, score) as same,
        count(*) over (partition by userId) as n_candidates from {src})"""


SCORE_CTES = _SCORED + _RANKED.format(ranked_test=_ranked_sql("cand_test"), ranked_all=_ranked_sql("sc"))


def _per_user_sql(src: str) -> str:
    return f"""select userId, n_test, hits, n_considered, hits / {float(K)} as precision_at_k, hits > 0 as hit,
  case when n_test = 0 or n_considered - n_test <= 0 then 0.5
       else (rank_sum - n_test * (n_test + 1) / 2.0) / (n_test * (n_considered - n_test)) end as auc,
  dcg / list_sum(list_transform(range(1, least(n_test, {K}) + 1), lambda r: 1.0 / log2(r + 1))) as ndcg_at_k,
  hits as tp, least({K}, n_considered) - hits as fp, n_test - hits as fn
from (select userId, count(*) as n_test, count_if(rn <= {K}) as hits, sum(avg_rank) as rank_sum,
        max(n_candidates) as n_considered, sum(discount) as dcg
      from {src} group by userId)"""


_ROUND_PER_USER = """select userId, n_test, hits, n_considered, round(precision_at_k, 6) as precision_at_k, hit,
  round(auc, 6) as auc, round(ndcg_at_k, 6) as ndcg_at_k, tp, fp, fn from pum"""


@register("pair_scores", "H9 C11", f"""with {SCORE_CTES}
select p.userId, p.gameId, s.score from train_pairs p join sc s on s.userId = p.userId and s.gameId = p.gameId""")
def q_pair_scores(t):
    d = P.dataset(t)
    return S.pair_scores(d.train_pairs.select("userId", "gameId"), t.fx_userv, t.fx_itemv)


@register("test_positive_ranks", "C11 C12 H11 (ranks)", f"""with {SCORE_CTES}
select userId as rid, gameId, score, rk - 1 as higher, ties, rn - 1 as position, n_candidates from pos_test""")
def q_test_ranks(t):
    return test_ranks(t)


@register("user_ranking_metrics", "H11 H12 H13 H14", f"""with {SCORE_CTES},
pum as ({_per_user_sql('pos_test')})
{_ROUND_PER_USER}""")
def q_user_metrics(t):
    return rounded(test_user_metrics(t))


@register("model_metrics", "H11 H12 H13 H22", f"""with {SCORE_CTES},
te as ({_per_user_sql('pos_test')}), tr as ({_per_user_sql('pos_train')}),
m as (select (select avg(precision_at_k) from tr) as train_precision_at_k,
             (select avg(precision_at_k) from te) as test_precision_at_k,
             (select avg(auc) from tr) as train_auc, (select avg(auc) from te) as test_auc,
             (select avg(ndcg_at_k) from te) as ndcg_at_k)
select round(train_precision_at_k, 6) as train_precision_at_k, round(test_precision_at_k, 6) as test_precision_at_k,
  round(train_auc, 6) as train_auc, round(test_auc, 6) as test_auc, round(ndcg_at_k, 6) as ndcg_at_k,
  round(train_precision_at_k - test_precision_at_k, 6) as generalization_gap,
  train_precision_at_k - test_precision_at_k > 0.1 as overfit from m""")
def q_model_metrics(t):
    tr, te = (MT.mean_metrics(MT.per_user_metrics(r, K)) for r in train_and_test_ranks(t))
    out = te.select(
        tr.select("precision_at_k").scalar().alias("train_precision_at_k"),
        F.col("precision_at_k").alias("test_precision_at_k"),
        tr.select("auc").scalar().alias("train_auc"),
        F.col("auc").alias("test_auc"),
        F.col("ndcg_at_k"),
    )
    gap = F.col("train_precision_at_k") - F.col("test_precision_at_k")
    return rounded(out.withColumn("generalization_gap", gap)).withColumn("overfit", gap > 0.1)


@register("aggregate_prf", "H15", f"""with {SCORE_CTES},
pum as ({_per_user_sql('pos_test')}),
s as (select sum(tp) as tp, sum(fp) as fp, sum(fn) as fn from pum),
p as (select cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(fn as bigint) as fn,
        tp / greatest(tp + fp, 1) as precision, tp / greatest(tp + fn, 1) as recall from s)
select tp, fp, fn, round(precision, 6) as precision, round(recall, 6) as recall,
  round(case when precision + recall > 0 then 2 * precision * recall / (precision + recall) else 0.0 end, 6) as f1
from p""")
def q_prf(t):
    return rounded(MT.aggregate_prf(test_user_metrics(t)))


@register("topk_confusion", "H16", f"""with {SCORE_CTES},
pum as ({_per_user_sql('pos_test')}),
s as (select cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, cast(sum(fn) as bigint) as fn,
        cast(sum(n_considered - tp - fp - fn) as bigint) as tn from pum)
select tp, fp, fn, tn, round((tp + tn) / greatest(tp + fp + fn + tn, 1), 6) as accuracy,
  round(tp / greatest(tp + fn, 1), 6) as true_positive_rate, round(fn / greatest(tp + fn, 1), 6) as false_negative_rate,
  round(fp / greatest(fp + tn, 1), 6) as false_positive_rate, round(tn / greatest(fp + tn, 1), 6) as true_negative_rate
from s""")
def q_confusion(t):
    return rounded(MT.confusion(test_user_metrics(t)))


# ---------------------------------------------------------------------------
# batch recommendation
# ---------------------------------------------------------------------------
REQUESTS_SQL = """req as (select userId as user_id, cast(userId as int) % 23 as top_k,
    cast(userId as int) % 3 <> 0 as exclude_played from fx_players)"""


def requests(t):
    """Recommendation requests derived from the player table: every player asks
    for ``id % 23`` items (0, 21 and 22 are invalid), excluding played items
    unless ``id % 3 == 0``."""
    p = t.fx_players
    return p.select(F.col("userId").alias("user_id"),
                    (F.col("userId").cast("int") % 23).alias("top_k"),
                    ((F.col("userId").cast("int") % 3) != 0).alias("exclude_played"))


def recommendations(t):
    def build():
        d, users, blocks = model(t)
        pop = S.popularity_ranking(d.ife)
        meta = S.game_metadata(d.ife, t.fx_games)
        return S.recommend(requests(t), users, d.user_index, d.full_pairs, blocks, pop, meta)
    return _memo(t, "recs", build)


RECS_CTES = SCORE_CTES + ",\n" + REQUESTS_SQL + """,
valid as (select * from req where top_k between 1 and 20),
wc as (select w.user_id, w.top_k, w.exclude_played, s.gameId, s.score from valid w join sc s on s.userId = w.user_id
  where not (w.exclude_played and exists (select 1 from full_pairs f where f.userId = w.user_id and f.gameId = s.gameId))),
wr as (select *, row_number() over (partition by user_id, top_k, exclude_played order by score desc, gameId) as rank
  from wc),
warm_out as (select user_id, top_k, exclude_played, gameId as game_id, round(score, 4) as score, rank,
    false as is_cold_start, 'model' as source from wr where rank <= top_k),
pop as (select gameId, row_number() over (order by popularity_score desc, gameId) as pop_rank from ife),
cold_out as (select v.user_id, v.top_k, v.exclude_played, p.gameId as game_id, 0.0 as score, p.pop_rank as rank,
    true as is_cold_start, 'popularity_fallback' as source
  from valid v join pop p on p.pop_rank <= v.top_k where v.user_id not in (select userId from uidx)),
names as (select trim(split_part(gameId, '.', 1)) as gameId, max(gameName) as gameName from fx_games
  where gameId is not null group by 1),
meta as (select i.gameId, coalesce(n.gameName, i.gameId) as game_name, coalesce(i.game_type, 'unknown') as game_type,
    coalesce(i.provider, 'unknown') as provider from ife i left join names n on n.gameId = i.gameId),
recs as (select r.*, coalesce(m.game_name, r.game_id) as game_name, coalesce(m.game_type, 'unknown') as game_type,
    coalesce(m.provider, 'unknown') as provider
  from (select * from warm_out union all select * from cold_out) r left join meta m on m.gameId = r.game_id)"""


@register("recommendations", "H7 C11 C12 E10 F1 H23", f"with {RECS_CTES}\nselect * from recs")
def q_recs(t):
    return recommendations(t)[0]


@register("recommend_rejects", "H7 (invalid top_k)", f"""with {RECS_CTES}
select * from req where top_k is null or top_k not between 1 and 20""")
def q_rejects(t):
    return recommendations(t)[1]


def valid_requests(t):
    return requests(t).where(F.col("top_k").between(1, 20))


@register("serving_summary", "I1", f"""with {RECS_CTES},
a as (select user_id, top_k, exclude_played, first(source) as source from recs group by user_id, top_k, exclude_played),
pr as (select coalesce(a.source, case when u.userId is null then 'popularity_fallback' else 'model' end) as source
  from valid v left join a on a.user_id = v.user_id and a.top_k = v.top_k and a.exclude_played = v.exclude_played
  left join uidx u on u.userId = v.user_id)
select source, count(*) as requests, count_if(source = 'popularity_fallback') as cold_start_requests,
  round(count_if(source = 'popularity_fallback') / count(*), 6) as cold_start_ratio from pr group by source""")
def q_serving(t):
    d, users, _ = model(t)
    recs, _ = recommendations(t)
    valid = valid_requests(t)
    cold = valid.select(F.col("user_id").alias("userId")).join(users.select("userId"), "userId", "left_anti")
    return rounded(MT.serving_summary(recs, valid, cold))


@register("items_returned_histogram", "I2", f"""with {RECS_CTES},
n as (select v.user_id, v.top_k, v.exclude_played, coalesce(c.n_items, 0) as n_items
  from valid v left join (select user_id, top_k, exclude_played, count(*) as n_items from recs group by 1, 2, 3) c
  on c.user_id = v.user_id and c.top_k = v.top_k and c.exclude_played = v.exclude_played)
select count_if(n_items <= 0) as le_0, count_if(n_items <= 1) as le_1, count_if(n_items <= 2) as le_2,
  count_if(n_items <= 3) as le_3, count_if(n_items <= 4) as le_4, count_if(n_items <= 5) as le_5,
  count_if(n_items <= 10) as le_10, count_if(n_items <= 20) as le_20, count(*) as le_inf,
  cast(sum(n_items) as bigint) as sum_items, quantile_cont(n_items, 0.5) as p50, quantile_cont(n_items, 0.95) as p95 from n""")
def q_hist(t):
    recs, _ = recommendations(t)
    return MT.items_returned_histogram(recs, valid_requests(t))


@register("catalog_coverage", "H19", f"""with {RECS_CTES},
rn as (select game_id as gameId, count(*) as times_recommended from recs group by 1),
tn as (select gameId, count(*) as train_interactions from train_pairs group by 1),
c as (select i.gameId, coalesce(rn.times_recommended, 0) as times_recommended,
  coalesce(tn.train_interactions, 0) as train_interactions
from ife i left join rn on rn.gameId = i.gameId left join tn on tn.gameId = i.gameId)
select *, round((select count_if(times_recommended > 0) / count(*) from c), 6) as coverage from c""")
def q_coverage(t):
    d = P.dataset(t)
    recs, _ = recommendations(t)
    return rounded(MT.catalog_coverage(recs, d.ife, d.train_pairs))


@register("top5_all_users", "E10 C11 C12 (top-5 per active user, played items excluded)", f"""with {SCORE_CTES},
c as (select s.* from sc s where not exists
  (select 1 from full_pairs f where f.userId = s.userId and f.gameId = s.gameId)),
r as (select userId, gameId, score, row_number() over (partition by userId order by score desc, gameId) as rank from c)
select userId as rid, gameId, score, cast(rank as integer) as rank from r where rank <= 5""")
def q_top5(t):
    d, users, blocks = model(t)
    rows = users.join(_lists(d.full_pairs, "seen"), "userId", "left")
    return S.top_k(rows, blocks, 5, "userId", exclude="seen")
