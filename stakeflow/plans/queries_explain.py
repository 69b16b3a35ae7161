"""Explanation and feature-diagnostics queries over a deterministic fixture model.

Fixture model: token vectors are ``embeddings`` rows ``(base + token_idx) %
count``; identity vectors are the fixture user / item vectors; biases 0.  This makes every explanation checkable in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.config import DEFAULT
from stakeflow.operators import explain as X
from stakeflow.operators import scoring as S
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.plans.queries_scoring import SCORE_CTES
from stakeflow.session import cut_lineage

USER_TOKEN_VEC_BASE = 200
ITEM_TOKEN_VEC_BASE = 300


def _dbl(c):
    return F.transform(c, lambda x: x.cast("double"))


def fixture_model(t):
    def build():
        d = P.dataset(t)
        emb = t.embeddings.select("vec_id", _dbl("embedding").alias("embedding"))
        n_vec = emb.agg(F.count("*")).scalar()
        u_fv = d.user_vocab.join(emb, F.col("vec_id") == (F.col("token_idx") + USER_TOKEN_VEC_BASE) % n_vec).select(
            F.col("token").alias("feature"), "embedding", F.lit(0.0).alias("bias")).unionByName(
            t.fx_userv.select(F.concat(F.lit("id:"), "userId").alias("feature"), _dbl("embedding").alias("embedding"),
                              F.lit(0.0).alias("bias")))
        i_fv = d.item_vocab.join(emb, F.col("vec_id") == (F.col("token_idx") + ITEM_TOKEN_VEC_BASE) % n_vec).select(
            F.col("token").alias("feature"), "embedding", F.lit(0.0).alias("bias")).unionByName(
            t.fx_itemv.select(F.concat(F.lit("id:"), "gameId").alias("feature"), _dbl("embedding").alias("embedding"),
                              F.lit(0.0).alias("bias")))
        u_ef = X.entity_features(d.user_index, "userId", d.user_tokens)
        i_ef = X.entity_features(d.item_index, "gameId", d.item_tokens)
        # representations are read by every explanation: cut lineage once
        u_rep = cut_lineage(X.representations(u_ef, u_fv, "userId"))
        i_rep = cut_lineage(X.representations(i_ef, i_fv, "gameId"))
        return dict(d=d, u_fv=u_fv, i_fv=i_fv, u_ef=u_ef, i_ef=i_ef, u_rep=u_rep, i_rep=i_rep)
    return P._memo(t, "fixture_model", build)


def test_contribs(t):
    m = fixture_model(t)
    return P._memo(t, "test_contribs", lambda: X.contributions(
        m["d"].test_pairs, m["u_ef"], m["i_ef"], m["u_fv"], m["i_fv"], m["u_rep"], m["i_rep"]))


def attribution(t):
    """Weighted mean contributions of all train pairs and of the stability samples, written once."""
    m = fixture_model(t)
    return P._memo(t, "attribution", lambda: cut_lineage(X.attribution(
        m["d"].train_pairs, m["u_ef"], m["i_ef"], m["u_fv"], m["i_fv"], m["u_rep"], m["i_rep"],
        "implicit_score", DEFAULT.stability_samples)))


def _side_sql(side, vocab, base, ident_src, key, idx, tok):
    return f"""{side}fv as materialized (select v.token as feature, cast(e.embedding as double[]) as embedding, 0.0 as bias
    from {vocab} v join embeddings e on e.vec_id = (v.token_idx + {base}) % (select count(*) from embeddings)
  union all select concat('id:', {key}), cast(embedding as double[]), 0.0 from {ident_src}),
{side}ef as materialized (select x.{key}, concat('id:', x.{key}) as feature, 1.0 / (len(coalesce(t.tokens, [])) + 1) as value,
    false as is_token from {idx} x left join {tok} t on t.{key} = x.{key}
  union all select x.{key}, unnest(t.tokens), 1.0 / (len(t.tokens) + 1), true
    from {idx} x join {tok} t on t.{key} = x.{key}),
{side}rx as materialized (select ef.{key}, ef.value, unnest(fv.embedding) as x, generate_subscripts(fv.embedding, 1) as i
  from {side}ef ef join {side}fv fv on fv.feature = ef.feature),
{side}rep as materialized (select {key}, list(v order by i) as embedding, 0.0 as bias
  from (select {key}, i, sum(value * x) as v from {side}rx group by {key}, i) group by {key})"""


EXPLAIN_CTES = SCORE_CTES + ",\n" + _side_sql("u", "uvocab", USER_TOKEN_VEC_BASE, "fx_userv", "userId", "uidx", "utok") \
    + ",\n" + _side_sql("i", "ivocab", ITEM_TOKEN_VEC_BASE, "fx_itemv", "gameId", "iidx", "itok")


def _contrib_sql(pairs, weight=None):
    w = f", p.{weight}" if weight else ""
    return f"""select p.userId, p.gameId, 'user' as side, ef.feature, ef.value{w},
    ef.value * (fv.bias + list_inner_product(fv.embedding, r.embedding)) as contribution
  from {pairs} p join uef ef on ef.userId = p.userId and ef.is_token join ufv fv on fv.feature = ef.feature
  join irep r on r.gameId = p.gameId
union all select p.userId, p.gameId, 'item', ef.feature, ef.value{w},
    ef.value * (fv.bias + list_inner_product(r.embedding, fv.embedding))
  from {pairs} p join ief ef on ef.gameId = p.gameId and ef.is_token join ifv fv on fv.feature = ef.feature
  join urep r on r.userId = p.userId"""


@register("hybrid_representations_fixture", "H8", f"""with {EXPLAIN_CTES}
select userId, round(list_sum(embedding), 6) as component_sum, round(sqrt(list_inner_product(embedding, embedding)), 6)
  as l2_norm, bias from urep""")
def q_rep(t):
    m = fixture_model(t)
    r = m["u_rep"]
    return rounded(r.select("userId", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("component_sum"),
                            F.sqrt(F.aggregate(F.transform("embedding", lambda x: x * x), F.lit(0.0),
                                               lambda a, x: a + x)).alias("l2_norm"), "bias"))


@register("explain_contributions", "H24 (per-token contributions of held-out pairs)", f"""with {EXPLAIN_CTES},
c as ({_contrib_sql('test_pairs')})
select userId, gameId, side, feature, round(value, 6) as value, round(contribution, 6) as contribution from c""")
def q_contrib(t):
    return rounded(test_contribs(t))


@register("explain_summary", "H24 (score, metadata total, residual)", f"""with {EXPLAIN_CTES},
c as ({_contrib_sql('test_pairs')}),
tot as (select userId, gameId, sum(contribution) as total from c group by userId, gameId),
s as (select p.userId, p.gameId, list_inner_product(u.embedding, i.embedding) + u.bias + i.bias as score
  from test_pairs p join urep u on u.userId = p.userId join irep i on i.gameId = p.gameId)
select s.userId, s.gameId, round(score, 6) as score, round(coalesce(total, 0.0), 6) as metadata_contribution_total,
  round(score - coalesce(total, 0.0), 6) as residual
from s left join tot on tot.userId = s.userId and tot.gameId = s.gameId""")
def q_summary(t):
    m = fixture_model(t)
    return rounded(X.explain_summary(m["d"].test_pairs, test_contribs(t), m["u_rep"], m["i_rep"]))


@register("explain_top_contributions", "F3 H24 (top 6 by |contribution| per pair)", f"""with {EXPLAIN_CTES},
c as ({_contrib_sql('test_pairs')}),
r as (select *, row_number() over (partition by userId, gameId order by abs(round(contribution, 6)) desc, side, feature)
  as abs_rank from c)
select userId, gameId, side, feature, round(contribution, 6) as contribution, abs_rank from r where abs_rank <= 6""")
def q_top_contrib(t):
    c = rounded(test_contribs(t).select("userId", "gameId", "side", "feature", "contribution"))
    return X.top_by_abs(c, "contribution", DEFAULT.local_explanation_features, ["userId", "gameId"], ["side", "feature"])


GLOBAL_SQL = f"""c as ({_contrib_sql('train_pairs', 'implicit_score')}),
ga as (select side, feature, sum(implicit_score * contribution) / greatest(sum(implicit_score), 1e-9) as contribution
  from c group by side, feature)"""


@register("global_attribution", "H25", f"""with {EXPLAIN_CTES}, {GLOBAL_SQL}
select side, feature, round(contribution, 6) as contribution from ga""")
def q_global(t):
    return rounded(X.global_attribution(attribution(t)))


@register("attribution_top_features", "F3 H25 (top 8 per side and overall)", f"""with {EXPLAIN_CTES}, {GLOBAL_SQL},
g as (select side, feature, round(contribution, 6) as contribution from ga)
select 'side' as scope, side, feature, contribution, abs_rank from (select *, row_number() over
  (partition by side order by abs(contribution) desc, feature) as abs_rank from g) where abs_rank <= 8
union all select 'overall', side, feature, contribution, abs_rank from (select *, row_number() over
  (order by abs(contribution) desc, side, feature) as abs_rank from g) where abs_rank <= 8""")
def q_top_attr(t):
    g = rounded(X.global_attribution(attribution(t)))
    n = DEFAULT.top_attribution_features
    a = X.top_by_abs(g, "contribution", n, ["side"], ["feature"]).withColumn("scope", F.lit("side"))
    b = X.top_by_abs(g, "contribution", n, None, ["side", "feature"]).withColumn("scope", F.lit("overall"))
    return a.unionByName(b).select("scope", "side", "feature", "contribution", "abs_rank")


def _stability_sql(samples):
    parts = " union all ".join(
        f"select {s} as sample_id, c.* from c join (select userId, gameId from train_pairs "
        f"qualify row_number() over (order by md5(concat_ws('/', userId, gameId, '{s}'))) <= (7 * (select count(*) from train_pairs) + 9) // 10)"
        f" k on k.userId = c.userId and k.gameId = c.gameId"
        for s in range(samples))
    return f"""sp as ({parts}),
per as (select sample_id, side, feature,
    sum(implicit_score * contribution) / greatest(sum(implicit_score), 1e-9) as c from sp group by 1, 2, 3)"""


@register("attribution_stability", "H26", f"""with {EXPLAIN_CTES}, {GLOBAL_SQL},
{_stability_sql(DEFAULT.stability_samples)},
agg as (select side, feature, avg(c) as m, stddev_pop(c) as s, count(*) as samples_observed from per group by 1, 2),
sg as (select p.side, p.feature, count_if(abs(p.c) > 1e-9) as nz,
    count_if(abs(p.c) > 1e-9 and sign(p.c) = sign(a.m)) as agree
  from per p join agg a on a.side = p.side and a.feature = p.feature group by 1, 2)
select a.side, a.feature, round(m, 6) as mean_contribution, round(s, 6) as std_deviation,
  round(abs(m) / (abs(m) + s + 1e-9), 6) as stability_score,
  round(case when nz = 0 or abs(m) <= 1e-9 then 1.0 else agree / nz end, 6) as sign_consistency, samples_observed
from agg a join sg on sg.side = a.side and sg.feature = a.feature""")
def q_stability(t):
    return rounded(X.stability(attribution(t), DEFAULT.stability_samples))


@register("feature_vector_norms", "H30", f"""with {EXPLAIN_CTES}
select 'user' as side, feature, round(sqrt(list_inner_product(embedding, embedding)), 6) as l2_norm from ufv
  where not starts_with(feature, 'id:')
union all select 'item', feature, round(sqrt(list_inner_product(embedding, embedding)), 6) from ifv
  where not starts_with(feature, 'id:')""")
def q_norms(t):
    m = fixture_model(t)
    u = X.vector_norms(m["u_fv"].where(~F.col("feature").startswith("id:")), "user")
    i = X.vector_norms(m["i_fv"].where(~F.col("feature").startswith("id:")), "item")
    return rounded(u.unionByName(i))


@register("eligible_user_sample", "H32", f"""with {EXPLAIN_CTES}
select userId, interactions, sample_key from (select userId, cast(sum(interaction_count) as bigint) as interactions,
    md5(concat_ws('/', userId, '42')) as sample_key from train_pairs group by userId having sum(interaction_count) >= 20)
order by sample_key, userId limit 50""")
def q_eligible(t):
    d = P.dataset(t)
    return X.eligible_users(d.train_pairs, 20, 50, seed=42, count_col="interaction_count")


def _picks_sql(n: int) -> str:
    """Greedy picks: each user's best candidate that no earlier user took, else the best of its own."""
    parts = [f"""un as (select userId, row_number() over (order by n desc, userId) as o from (select userId, count(*) as n from full_pairs group by userId)),
cand as materialized (select s.userId, s.gameId, s.score, row_number() over (partition by s.userId order by s.score desc, s.gameId) as rank
  from sc s join un on un.userId = s.userId and un.o <= {n}
  where not exists (select 1 from full_pairs f where f.userId = s.userId and f.gameId = s.gameId)),
pick0 as (select null::varchar as userId, null::varchar as gameId, null::double as score, 0 as pick_order where false)"""]
    for k in range(1, n + 1):
        parts.append(f"""pick{k} as materialized (select * from pick{k - 1} union all
  (select c.userId, c.gameId, c.score, {k} from cand c join un on un.userId = c.userId and un.o = {k} where c.rank <= {n + 1}
   order by c.gameId in (select gameId from pick{k - 1}), c.rank limit 1))""")
    return ",\n".join(parts) + f",\npk as (select * from pick{n})"


@register("diverse_local_explanations", "F4 H24", f"""with {EXPLAIN_CTES}, {_picks_sql(DEFAULT.local_explanation_users)},
c as ({_contrib_sql('pk')}),
r as (select userId, gameId, side, feature, contribution, row_number() over (partition by userId, gameId
  order by abs(contribution) desc, side, feature) as abs_rank from c)
select pk.userId, pk.gameId, round(pk.score, 6) as score, pk.pick_order, r.side, r.feature, round(r.contribution, 6) as contribution, r.abs_rank
from pk left join r on r.userId = pk.userId and r.gameId = pk.gameId and r.abs_rank <= {DEFAULT.local_explanation_features}""")
def q_diverse(t):
    from stakeflow.plans.queries_scoring import _lists, model
    d, users, blocks = model(t)
    n = DEFAULT.local_explanation_users
    rows = users.join(_lists(d.full_pairs, "seen"), "userId", "left")
    cand = S.top_k(rows, blocks, n + 1, "userId", exclude="seen").withColumnRenamed("rid", "userId")
    counts = d.full_pairs.groupBy("userId").agg(F.count("*").alias("n"))
    picks = X.diverse_pick(cand, counts, n)
    pk = t.spark.createDataFrame(picks, "userId string, gameId string, score double, pick_order int")
    m = fixture_model(t)
    X.require_known(pk, m["u_ef"], m["i_ef"])
    c = X.contributions(pk, m["u_ef"], m["i_ef"], m["u_fv"], m["i_fv"], m["u_rep"], m["i_rep"])
    top = X.top_by_abs(c.select("userId", "gameId", "side", "feature", "contribution"), "contribution",
                       DEFAULT.local_explanation_features, ["userId", "gameId"], ["side", "feature"])
    return rounded(pk.join(top, ["userId", "gameId"], "left"))
