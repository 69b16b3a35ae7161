"""Remaining evaluation and diagnostics queries: wide model table, negative
sampling, PR curve, recommendation mix, segment precision, popularity bias,
calibration, ablation and PCA."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stakeflow.config import DEFAULT
from stakeflow.functions import mappers as M
from stakeflow.operators import analytics as A
from stakeflow.operators import dataset as D
from stakeflow.operators import explain as X
from stakeflow.operators import metrics as MT
from stakeflow.operators import scoring as S
from stakeflow.operators.asof import next_event_gap, previous_event_gap
from stakeflow.operators.events import EVENT_COLUMNS, enum_violations, missing_columns, schema_coverage
from stakeflow.operators.stats import quantile_bucket
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, round6, rounded
from stakeflow.plans.oracle import pipeline_ctes
from stakeflow.plans.queries_analytics import PLAYS_CTES, UB_SQL, ub
from stakeflow.plans.queries_explain import EXPLAIN_CTES, GLOBAL_SQL, attribution, fixture_model
from stakeflow.plans.queries_scoring import RECS_CTES, SCORE_CTES, _lists, _per_user_sql, _ranked_sql, model, recommendations
from stakeflow.plans.queries_sinks import RAW_CTES, raw_bets, raw_games
from stakeflow.plans.queries_train import test_lists
from stakeflow.session import at_once, cut_lineage

K = DEFAULT.eval_k
#: Numeric columns of a pair that are held against its predicted score.
CORRELATED = ["interaction_count", "avg_duration_sec", "positive_outcome_rate", "return_10m_rate", "avg_engagement_intensity",
              "recency_days", "implicit_score", "total_sessions", "unique_games", "popularity_score", "unique_users"]


@register("wide_model_table", "C10 B34 C14", f"""with {SCORE_CTES},
w as (select p.userId, p.gameId, p.interaction_count, p.avg_duration_sec as avg_duration_sec_ug,
    u.avg_duration_sec as avg_duration_sec, g.avg_duration_sec as avg_duration_sec_g,
    u.total_sessions, g.game_sessions, g.game_type, g.provider, p.implicit_score, u.preferred_device
  from train_pairs p left join ufe u on u.userId = p.userId left join ife g on g.gameId = p.gameId)
select userId, gameId, interaction_count, round(coalesce(avg_duration_sec_ug, 0), 6) as avg_duration_sec_ug,
  round(coalesce(avg_duration_sec, 0), 6) as avg_duration_sec, round(coalesce(avg_duration_sec_g, 0), 6) as avg_duration_sec_g,
  coalesce(total_sessions, 0) as total_sessions, coalesce(game_sessions, 0) as game_sessions,
  coalesce(game_type, 'unknown') as game_type, coalesce(provider, 'unknown') as provider,
  round(coalesce(implicit_score, 0), 6) as implicit_score, coalesce(preferred_device, 'unknown') as preferred_device
from w""")
def q_wide(t):
    d = P.dataset(t)
    pu = D.join_with_suffix(d.train_pairs, d.ufe, "userId", right_suffix="", left_suffix="_ug")
    w = D.join_with_suffix(pu, d.ife, "gameId", right_suffix="_g")
    w = M.fill_by_type(w.select("userId", "gameId", "interaction_count", "avg_duration_sec_ug", "avg_duration_sec",
                                "avg_duration_sec_g", "total_sessions", "game_sessions", "game_type", "provider",
                                "implicit_score", "preferred_device"))
    return rounded(w)


@register("recommended_and_played", "G5", f"""with {RECS_CTES}
select distinct user_id, game_id from recs where not is_cold_start
intersect select userId, gameId from full_pairs""")
def q_rec_played(t):
    d = P.dataset(t)
    recs, _ = recommendations(t)
    return recs.where(~F.col("is_cold_start")).select("user_id", "game_id").intersect(
        d.full_pairs.select(F.col("userId").alias("user_id"), F.col("gameId").alias("game_id")))


NEG_SQL = """tp_n as (select userId, count(*) as n from test_pairs group by userId),
neg as (select userId, gameId from (select u.userId, i.gameId, tp_n.n, row_number() over (partition by u.userId
    order by xor(('0x' || substr(md5(u.userId), 1, 12))::bigint,
                 ('0x' || substr(md5(concat(i.gameId, '/42')), 1, 12))::bigint), i.gameId) as rn
  from tp_n join uidx u on u.userId = tp_n.userId join iidx i on true
  where not exists (select 1 from full_pairs f where f.userId = u.userId and f.gameId = i.gameId))
  where rn <= n)"""


def negatives(t):
    def build():
        d, users, blocks = model(t)
        rows = (d.test_pairs.groupBy("userId").agg(F.count("*").alias("n"))
                .join(_lists(d.full_pairs, "seen"), "userId", "left"))
        return S.hashed_negatives(rows, blocks, "userId", "n", "seen", seed=42).withColumnRenamed("rid", "userId")
    return P._memo(t, "negatives", build)


@register("balanced_negatives", "H17 G4", f"with {SCORE_CTES},\n{NEG_SQL}\nselect userId, gameId from neg")
def q_neg(t):
    return negatives(t)


PR_SQL = NEG_SQL + """,
lab as (select userId, gameId, 1 as label from test_pairs union all select userId, gameId, 0 from neg),
scored as (select l.label, s.score from lab l join sc s on s.userId = l.userId and s.gameId = l.gameId),
g as (select score as threshold, sum(label) as tp_at, sum(1 - label) as fp_at from scored group by score),
c as (select threshold, tp_at, sum(tp_at) over (order by threshold desc rows between unbounded preceding and current row) as tp,
    sum(fp_at) over (order by threshold desc rows between unbounded preceding and current row) as fp,
    (select sum(label) from scored) as p from g)"""


def pr(t):
    def build():
        d = P.dataset(t)
        lab = d.test_pairs.select("userId", "gameId", F.lit(1).alias("label")).unionByName(
            negatives(t).select("userId", "gameId", F.lit(0).alias("label")))
        sc = S.pair_scores(lab, t.fx_userv, t.fx_itemv)
        return MT.pr_curve(sc, "score", "label")
    return P._memo(t, "pr", build)


@register("pr_curve", "H18", f"""with {SCORE_CTES},
{PR_SQL}
select threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp, round(tp / (tp + fp), 6) as precision,
  round(tp / p, 6) as recall from c""")
def q_pr(t):
    return rounded(pr(t).select("threshold", "tp", "fp", "precision", "recall"))


@register("average_precision", "H18", f"""with {SCORE_CTES},
{PR_SQL}
select round(sum((tp_at / p) * (tp / (tp + fp))), 6) as average_precision, count(*) as n_thresholds from c""")
def q_ap(t):
    return rounded(pr(t).agg(F.sum("ap_term").alias("average_precision"), F.count("*").alias("n_thresholds")))


def top20_unmasked(t):
    d, users, blocks = model(t)
    return P._memo(t, "top20_unmasked", lambda: S.top_k(users, blocks, 20, "userId").withColumnRenamed("rid", "userId"))


@register("rec_type_distribution", "H20 E10 D9 (top-20 per user, all active users)", f"""with {SCORE_CTES},
c as (select s.* from sc s where not exists (select 1 from full_pairs f where f.userId = s.userId and f.gameId = s.gameId)),
r as (select userId, gameId, row_number() over (partition by userId order by score desc, gameId) as rank from c),
j as (select i.game_type from r join ife i on i.gameId = r.gameId where rank <= 20)
select game_type, count(*) as n, round(count(*) * 100.0 / (select count(*) from j), 6) as pct from j group by game_type""")
def q_type_dist(t):
    d, users, blocks = model(t)
    rows = users.join(_lists(d.full_pairs, "seen"), "userId", "left")
    recs = S.top_k(rows, blocks, 20, "userId", exclude="seen")
    j = recs.join(d.ife.select("gameId", "game_type"), "gameId")
    total = j.agg(F.count("*")).scalar()
    return rounded(j.groupBy("game_type").agg(F.count("*").alias("n")).withColumn("pct", F.col("n") * 100.0 / total))


@register("segment_precision_at_20", "H21 H11 (hits = known items, nothing masked; all users per segment)",
          f"""with {SCORE_CTES},
r as (select userId, gameId, row_number() over (partition by userId order by score desc, gameId) as rank from sc),
h as (select r.userId, count_if(f.gameId is not null) / 20.0 as p20 from r left join full_pairs f
  on f.userId = r.userId and f.gameId = r.gameId where rank <= 20 group by r.userId),
seg as (select userId, c_mktsegment as segment from uidx u join customer c on cast(c.c_custkey as varchar) = u.userId)
select segment, count(*) as n_users, round(avg(p20), 6) as precision_at_20 from h join seg on seg.userId = h.userId
group by segment""")
def q_seg_p20(t):
    d = P.dataset(t)
    top = top20_unmasked(t)
    hits = top.join(d.full_pairs.select("userId", "gameId", F.lit(1).alias("hit")), ["userId", "gameId"], "left")
    per = hits.groupBy("userId").agg((F.count("hit") / 20.0).alias("p20"))
    seg = t.customer.select(F.col("c_custkey").cast("string").alias("userId"), F.col("c_mktsegment").alias("segment"))
    return rounded(per.join(seg, "userId").groupBy("segment").agg(
        F.count("*").alias("n_users"), F.avg("p20").alias("precision_at_20")))


@register("popularity_bias", "D34", f"""with {RECS_CTES}
select r.game_id, count(*) as n, round(sum(r.score), 4) / count(*) as mean_score,
  round(avg(i.popularity_score), 6) as mean_popularity
from recs r join ife i on i.gameId = r.game_id where not r.is_cold_start group by r.game_id""")
def q_pop_bias(t):
    d = P.dataset(t)
    recs, _ = recommendations(t)
    j = recs.where(~F.col("is_cold_start")).join(d.ife.select(F.col("gameId").alias("game_id"), "popularity_score"),
                                                 "game_id")
    # scores carry 4 decimals: the rounded sum is exact, so the mean is engine-independent
    g = j.groupBy("game_id").agg(F.count("*").alias("n"), M.round_to(F.sum("score"), 4).alias("__s"),
                                 F.avg("popularity_score").alias("mean_popularity"))
    return rounded(g.withColumn("mean_score", F.col("__s") / F.col("n")).drop("__s"), exclude=["mean_score"])


@register("score_calibration_deciles", "D35 E6", f"""with {SCORE_CTES},
p as (select t.userId, t.gameId, concat(t.userId, '|', t.gameId) as pid, s.score, t.implicit_score
  from train_pairs t join sc s on s.userId = t.userId and s.gameId = t.gameId),
b as (select *, row_number() over (order by score, pid) - 1 as pos, count(*) over () as n from p)
select cast(greatest(1, floor((pos * least(n, 10) + (n - 2)) / (n - 1))) as integer) as score_decile,
  round(avg(score), 6) as mean_pred_score, round(avg(implicit_score), 6) as mean_implicit, count(*) as samples
from b group by 1""")
def q_calib(t):
    d = P.dataset(t)
    sc = S.pair_scores(d.train_pairs.select("userId", "gameId", "implicit_score"), t.fx_userv, t.fx_itemv)
    sc = sc.withColumn("pid", F.concat_ws("|", "userId", "gameId"))
    return rounded(A.decile_calibration(sc, "pid", "score", "implicit_score"))


_ABLATED = """top3 as (select feature from ga order by abs(contribution) desc, side, feature limit 3),
uef2 as (select * from uef where feature not in (select feature from top3)),
ief2 as (select * from ief where feature not in (select feature from top3)),
urx2 as (select ef.userId, ef.value, unnest(fv.embedding) as x, generate_subscripts(fv.embedding, 1) as i
  from uef2 ef join ufv fv on fv.feature = ef.feature),
irx2 as (select ef.gameId, ef.value, unnest(fv.embedding) as x, generate_subscripts(fv.embedding, 1) as i
  from ief2 ef join ifv fv on fv.feature = ef.feature),
urep2 as (select userId, list(v order by i) as embedding from (select userId, i, sum(value * x) as v from urx2 group by 1, 2) group by 1),
irep2 as (select gameId, list(v order by i) as embedding from (select gameId, i, sum(value * x) as v from irx2 group by 1, 2) group by 1)"""


def _variant_sql(n, u, i):
    """Test metrics of a variant, by place and average rank as in ``queries_scoring``."""
    return f"""s{n} as (select u.userId, i.gameId, round(list_inner_product(u.embedding, i.embedding), 6) as score
  from {u} u join {i} i on true where not exists (select 1 from train_pairs t where t.userId = u.userId and t.gameId = i.gameId)),
r{n} as ({_ranked_sql(f's{n}')}),
p{n} as (select r.* from r{n} r join test_pairs p on p.userId = r.userId and p.gameId = r.gameId),
m{n} as (select avg(precision_at_k) as p, avg(auc) as a from ({_per_user_sql(f'p{n}')}))"""


@register("ablation_check", "H28 F5", f"""with {EXPLAIN_CTES}, {GLOBAL_SQL}, {_ABLATED},
{_variant_sql(1, 'urep', 'irep')}, {_variant_sql(2, 'urep2', 'irep2')},
d as (select string_agg(feature, ',' order by abs(contribution) desc, side, feature) as dropped from (select * from ga
  order by abs(contribution) desc, side, feature limit 3))
select 'full' as variant, dropped, round(m1.p, 6) as precision_at_k, round(m1.a, 6) as auc, 0.0 as precision_drop, 0.0 as auc_drop from m1, d
union all select 'ablated', dropped, round(m2.p, 6), round(m2.a, 6), round(m1.p - m2.p, 6), round(m1.a - m2.a, 6) from m1, m2, d""")
def q_ablation(t):
    """Drop the top-3 attributed features (no re-normalisation), recompute the
    representations and report the drops of test P@K / AUC (full - ablated)."""
    m = fixture_model(t)
    g = X.global_attribution(attribution(t))
    top = [r["feature"] for r in X.top_by_abs(g, "contribution", DEFAULT.ablation_top_features, None,
                                              ["side", "feature"]).orderBy("abs_rank").collect()]
    full = _eval_variant(t, m["u_ef"], m["i_ef"])
    abl = _eval_variant(t, X.ablate(m["u_ef"], top), X.ablate(m["i_ef"], top))
    rows = [("full", ",".join(top), full["precision_at_k"], full["auc"], 0.0, 0.0),
            ("ablated", ",".join(top), abl["precision_at_k"], abl["auc"],
             full["precision_at_k"] - abl["precision_at_k"], full["auc"] - abl["auc"])]
    return rounded(t.spark.createDataFrame(
        rows, "variant string, dropped string, precision_at_k double, auc double, precision_drop double, auc_drop double"))


@register("score_correlations", "F5 (strongest positive and negative correlations with the predicted score)", f"""with {SCORE_CTES},
p as (select s.score, t.interaction_count, t.avg_duration_sec, t.positive_outcome_rate, t.return_10m_rate, t.avg_engagement_intensity,
    t.recency_days, t.implicit_score, u.total_sessions, u.unique_games, i.popularity_score, i.unique_users
  from train_pairs t join sc s on s.userId = t.userId and s.gameId = t.gameId left join ufe u on u.userId = t.userId
  left join ife i on i.gameId = t.gameId),
c as ({" union all ".join(f"select '{c}' as feature, corr({c}, score) as rho from p" for c in CORRELATED)}),
k as (select feature, round(rho, 6) as rho from c where rho is not null and not isnan(rho))
select 'positive' as direction, feature, rho from (select * from k where rho > 0 order by rho desc, feature limit 3)
union all select 'negative', feature, rho from (select * from k where rho < 0 order by rho, feature limit 3)""")
def q_score_correlations(t):
    d = P.dataset(t)
    pairs = S.pair_scores(d.train_pairs, t.fx_userv, t.fx_itemv)
    pairs = pairs.join(d.ufe.select("userId", "total_sessions", "unique_games"), "userId", "left").join(
        d.ife.select("gameId", "popularity_score", "unique_users"), "gameId", "left")
    row = pairs.agg(*[F.corr(F.col(c).cast("double"), F.col("score")).alias(c) for c in CORRELATED])
    rho = row.unpivot([], CORRELATED, "feature", "rho").where(F.col("rho").isNotNull() & ~F.isnan("rho"))
    rho = rounded(rho)
    up = rho.where("rho > 0").orderBy(F.desc("rho"), "feature").limit(3).select(F.lit("positive").alias("direction"), "*")
    return up.unionByName(rho.where("rho < 0").orderBy("rho", "feature").limit(3).select(F.lit("negative").alias("direction"), "*"))


@register("token_labels", "B36 B32", f"""with {SCORE_CTES},
k as (select 'user' as side, token from uvocab union all select 'item', token from ivocab),
l as (select side, token, case {" ".join(f"when starts_with(token, '{p}') then concat('{r}', substr(token, {len(p) + 1}))" for p, r in M.TOKEN_LABEL_PREFIXES)}
    else token end as label from k)
select side, token, case when length(label) > 36 then concat(substr(label, 1, 35), '...') else label end as label from l""")
def q_token_labels(t):
    d = P.dataset(t)
    k = d.user_vocab.select(F.lit("user").alias("side"), "token").unionByName(d.item_vocab.select(F.lit("item").alias("side"), "token"))
    return k.withColumn("label", M.token_label("token"))


def _axis_sql(k: int, cov: str) -> str:
    """First axis of the matrix ``cov`` (one row ``m``): 20 squarings, then the column of the largest diagonal
    entry, with its largest component positive; and what is left of the matrix without it."""
    return f"""sq{k} as (select 0 as step, m from {cov}
  union all select step + 1, [[v / s for v in r] for r in q] from (
    select step, q, list_sum([q[i][i] for i in range(1, len(q) + 1)]) as s from (
      select step, [[list_dot_product(a, b) for b in m] for a in m] as q from sq{k} where step < 20))),
col{k} as (select m[list_position([m[i][i] for i in range(1, len(m) + 1)], list_max([m[i][i] for i in range(1, len(m) + 1)]))] as c
  from sq{k} where step = 20),
ax{k} as materialized (select [x * s for x in c] as v from (select c, sign(c[list_position([abs(x) for x in c], list_max([abs(x) for x in c]))])
  / sqrt(list_dot_product(c, c)) as s from col{k})),
la{k} as materialized (select list_dot_product(v, [list_dot_product(r, v) for r in m]) as l from ax{k}, {cov}),
left{k} as materialized (select [[m[i][j] - l * v[i] * v[j] for j in range(1, len(m) + 1)] for i in range(1, len(m) + 1)] as m from {cov}, ax{k}, la{k})"""


def _pca_sql(rep: str, key: str) -> str:
    return f"""with recursive {EXPLAIN_CTES},
px as (select {key}, unnest(embedding) as v, generate_subscripts(embedding, 1) as i from {rep}),
mu as (select i, avg(v) as m from px group by i),
pz as materialized (select {key}, px.i, v - m as v from px join mu on mu.i = px.i),
cv as materialized (select a.i, b.i as j, sum(a.v * b.v) / ((select count(*) from {rep}) - 1) as c from pz a join pz b on a.{key} = b.{key} group by 1, 2),
c0 as materialized (select list(r order by i) as m from (select i, list(c order by j) as r from cv group by i)),
{_axis_sql(1, 'c0')},
{_axis_sql(2, 'left1')},
pr as (select {key}, list_dot_product(e, a.v) as pc1, list_dot_product(e, b.v) as pc2, len(e) as dims,
    row_number() over (order by list_dot_product(e, a.v), {key}) - 1 as p, count(*) over () as n
  from (select {key}, list(v order by i) as e from pz group by {key}), ax1 a, ax2 b)
select {key}, round(pc1, 6) as pc1, round(pc2, 6) as pc2, round((select l from la1) / (select sum(c) from cv where i = j), 6) as explained_var_1,
  round((select l from la2) / (select sum(c) from cv where i = j), 6) as explained_var_2, cast(dims as integer) as dims,
  (['low', 'mid', 'high'])[case when n <= 1 then 1 else greatest(1, (p * least(n, 3) + n - 2) // (n - 1)) end] as pc1_tertile from pr"""


def _projection(rep, key):
    """2-D PCA of representations: distributed Gramian and mean, the small eigenproblem on the driver (Spark's PCA).
    The largest component of each axis is positive, which makes the axes unique."""
    dims = len(rep.first()["embedding"])
    mean = rep.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    mean_arr = [r["m"] for r in mean.orderBy("i").collect()]  # one value per model dimension
    centred = rep.withColumn("v", array_to_vector(F.zip_with(
        "embedding", F.array(*[F.lit(v) for v in mean_arr]), lambda a, b: a - b)))
    model_ = PCA(k=2, inputCol="v", outputCol="pc").fit(centred)
    var = list(model_.explainedVariance.toArray())
    axes = model_.pc.toArray()
    sign = [1.0 if axes[abs(axes[:, k]).argmax(), k] > 0 else -1.0 for k in (0, 1)]
    out = model_.transform(centred).select(key, vector_to_array("pc").alias("pc"))
    out = out.select(key, (F.col("pc")[0] * sign[0]).alias("pc1"), (F.col("pc")[1] * sign[1]).alias("pc2"),
                     F.lit(var[0]).alias("explained_var_1"), F.lit(var[1]).alias("explained_var_2"),
                     F.lit(dims).alias("dims"))
    return rounded(quantile_bucket(out, key, "pc1", ["low", "mid", "high"], "pc1_tertile"))


@register("pca_projection", "H31 E6", _pca_sql("urep", "userId"))
def q_pca(t):
    """2-D PCA of the user representations, explained variance, tertile label on the first axis."""
    return _projection(fixture_model(t)["u_rep"], "userId")


@register("pca_projection_items", "H31 E6 (items)", _pca_sql("irep", "gameId"))
def q_pca_items(t):
    """The same of the item representations."""
    return _projection(fixture_model(t)["i_rep"], "gameId")


def _eval_variant(t, u_ef, i_ef):
    m = fixture_model(t)
    d = m["d"]
    u_rep = X.representations(u_ef, m["u_fv"], "userId")
    i_rep = X.representations(i_ef, m["i_fv"], "gameId")
    blocks = S.item_blocks(i_rep)
    rows = u_rep.join(_lists(d.test_pairs, "pos"), "userId").join(_lists(d.train_pairs, "seen"), "userId", "left")
    return MT.mean_metrics(MT.per_user_metrics(
        S.positive_ranks(rows, blocks, "userId", "pos", exclude="seen"), K)).first()


def _metrics_by(t, u_rep, i_rep, features):
    """Mean test metrics for each of the features and for none (``''``); vectors end in a component for each feature."""
    d = P.dataset(t)
    rows = u_rep.join(_lists(d.test_pairs, "pos"), "userId").join(_lists(d.train_pairs, "seen"), "userId", "left")
    per = MT.per_user_metrics(S.positive_ranks(rows, S.item_blocks(i_rep), "userId", "pos", exclude="seen", variants=features), K)
    return per.groupBy(F.split("userId", S.SEP)[0].alias("feature")).agg(
        F.avg("precision_at_k").alias("precision_at_k"), F.avg("auc").alias("auc"))


_SEP = "chr(1)"

#: A permuted feature changes a score by (new value - old value) times the product of its vector with the other side.
_PERMUTED = f"""top8 as (select side, feature, contribution from ga order by abs(contribution) desc, side, feature limit {DEFAULT.permutation_top_features}),
""" + ",\n".join(f"""{s}val as (select f.feature, x.{key}, coalesce(e.value, 0.0) as v from top8 f join {idx} x on true
  left join {s}ef e on e.{key} = x.{key} and e.feature = f.feature where f.side = '{side}'),
{s}pos as (select *, row_number() over (partition by feature order by {key}) as pa,
    row_number() over (partition by feature order by md5(concat_ws('/', {key}, feature, '42')), {key}) as pb from {s}val),
{s}perm as materialized (select a.feature, a.{key}, b.v - a.v as dv from {s}pos a join {s}pos b on b.feature = a.feature and b.pb = a.pa),
{s}prod as materialized (select f.feature, r.{other}, list_inner_product(fv.embedding, r.embedding) + fv.bias as d
  from top8 f join {s}fv fv on fv.feature = f.feature join {orep} r on true where f.side = '{side}')"""
    for s, side, key, idx, other, orep in (("u", "user", "userId", "uidx", "gameId", "irep"), ("i", "item", "gameId", "iidx", "userId", "urep"))) + f""",
raw as materialized (select u.userId, i.gameId, list_inner_product(u.embedding, i.embedding) + u.bias + i.bias as s from urep u join irep i on true
  where not exists (select 1 from train_pairs t where t.userId = u.userId and t.gameId = i.gameId)),
vs as (select concat({_SEP}, userId) as userId, gameId, round(s, 6) as score from raw
  union all select concat(p.feature, {_SEP}, r.userId), r.gameId, round(r.s + p.dv * d.d, 6) from raw r
    join uperm p on p.userId = r.userId join uprod d on d.feature = p.feature and d.gameId = r.gameId
  union all select concat(p.feature, {_SEP}, r.userId), r.gameId, round(r.s + p.dv * d.d, 6) from raw r
    join iperm p on p.gameId = r.gameId join iprod d on d.feature = p.feature and d.userId = r.userId),
rv as ({_ranked_sql('vs')}),
pv as (select r.* from rv r join test_pairs p on p.userId = split_part(r.userId, {_SEP}, 2) and p.gameId = r.gameId),
mv as (select split_part(userId, {_SEP}, 1) as feature, avg(precision_at_k) as p, avg(auc) as a from ({_per_user_sql('pv')}) group by 1)"""


@register("permutation_importance", "H27 C16", f"""with {EXPLAIN_CTES}, {GLOBAL_SQL}, {_PERMUTED}
select t.side, t.feature, round(t.contribution, 6) as contribution, round(b.p - v.p, 6) as precision_drop, round(b.a - v.a, 6) as auc_drop
from top8 t join mv v on v.feature = t.feature join mv b on b.feature = ''""")
def q_permutation(t):
    """Shuffle each of the top-8 attributed features over its side's entities and report the precision / AUC drop
    (base - permuted), joined to the attribution table.  All variants are ranked in one evaluation."""
    m = fixture_model(t)
    d = m["d"]
    g = X.global_attribution(attribution(t))
    top = [(r["side"], r["feature"]) for r in X.top_by_abs(g, "contribution", DEFAULT.permutation_top_features, None, ["side", "feature"]).collect()]
    found = {r["feature"]: r for r in _metrics_by(t, *X.permuted_models(
        m["u_rep"], m["i_rep"], m["u_ef"], m["i_ef"], m["u_fv"], m["i_fv"], d.user_index, d.item_index, top, apart=False), [f for _, f in top]).collect()}
    base = found[""]
    rows = [(side, f, base["precision_at_k"] - found[f]["precision_at_k"], base["auc"] - found[f]["auc"]) for side, f in top]
    perm = t.spark.createDataFrame(rows, "side string, feature string, precision_drop double, auc_drop double")
    return rounded(g.join(perm, ["side", "feature"], "inner"))


ABLATION_EPOCHS, ABLATION_K = 8, 10


def ablation_tokens(t):
    """(user table, item table) with one column for each token group of the ablation variants."""
    d = P.dataset(t)
    u = d.user_index.select("userId").join(d.ufe.select("userId", F.col("preferred_device").alias("device"), "avg_engagement_intensity",
                                                        "recency_days", "unique_games", "total_sessions"), "userId", "left")
    u = u.join(t.fx_players.select("userId", F.col("country").cast("string").alias("country")), "userId", "left").join(
        ub(t).select("userId", "preferred_game_type"), "userId", "left")
    u = u.withColumn("recency_bucket", M.right_closed_bucket("recency_days", A.USER_RECENCY_EDGES, A.USER_RECENCY_LABELS)).withColumn(
        "diversity_bucket", M.right_closed_bucket(F.col("unique_games") / F.col("total_sessions"), A.DIVERSITY_EDGES, A.LEVEL_LABELS))
    u = u.join(quantile_bucket(u.select("userId", "avg_engagement_intensity"), "userId", "avg_engagement_intensity", A.QUARTILE_LABELS,
                               "engagement_bucket").select("userId", "engagement_bucket"), "userId", "left")
    i = d.item_index.select("gameId").join(d.ife.select("gameId", F.col("game_type").alias("gameType"), F.col("provider").alias("vendor"),
                                                        "popularity_bucket", "popularity_score"), "gameId", "left")
    games = t.fx_games.select("gameId", "maxBet")
    i = i.join(quantile_bucket(games, "gameId", "maxBet", A.BET_TIER_LABELS, "bet_tier").select("gameId", "bet_tier"), "gameId", "left")
    return u, i.withColumn("top_pop_flags", F.when(F.col("popularity_bucket") == "blockbuster", "top"))


@register("feature_group_ablation", "H29 B33 F5 (rows; WARP trained on all variants' token groups at once)")
def q_group_ablation(t):
    """Variants without one side's token groups, each trained anew; metric deltas
    against the full model and the best / worst variant flags."""
    from stakeflow.operators import warp as W
    d = P.dataset(t)
    u, i = ablation_tokens(t)
    # written: training and the evaluation of every variant read them
    tokens = [cut_lineage(reduce(lambda a, b: a.unionByName(b), [
        table.select(F.lit(v[0]).alias("variant"), key, M.tokens(v[side]).alias("tokens")) for v in X.ABLATION_VARIANTS]))
        for side, key, table in ((1, "userId", u), (2, "gameId", i))]
    # all variants share the tables of a training
    params, _ = W.train_warp(d.train_pairs, *tokens, d.user_index, d.item_index, epochs=ABLATION_EPOCHS, local_epochs=ABLATION_EPOCHS)
    params = cut_lineage(params)
    asked = test_lists(t)

    def measured(name):
        ut, it = (x.where(F.col("variant") == name).drop("variant") for x in tokens)
        ur, ir = W.representations(params.where(F.col("variant") == name), ut, d.user_index, it, d.item_index)
        m = MT.mean_metrics(MT.per_user_metrics(S.positive_ranks(
            ur.join(asked, "userId"), S.item_blocks(ir, bias="bias"), "userId", "pos", exclude="seen", bias="bias"), ABLATION_K)).first()
        return name, m["precision_at_k"], m["auc"]

    found = at_once(t.spark, measured, [name for name, *_ in X.ABLATION_VARIANTS])
    rows = [(*r, r[1] - found[0][1]) for r in found]
    df = t.spark.createDataFrame(rows, "variant string, precision_at_k double, auc double, delta_p double")
    best = df.where("variant != 'full'").agg(F.max_by("variant", F.struct("delta_p", F.col("variant")))).scalar()
    worst = df.where("variant != 'full'").agg(F.min_by("variant", F.struct("delta_p", F.col("variant")))).scalar()
    return rounded(df.withColumn("is_best", F.col("variant") == best).withColumn("is_worst", F.col("variant") == worst))


# ---------------------------------------------------------------------------
# E2 + B24: EDA session view; B33 tokens; C15; H2; G6; I3; A6
# ---------------------------------------------------------------------------


@register("eda_session_view", "E2 B24 E1 (minutes since previous bet, EDA exit type)", f"""with {PLAYS_CTES},
e as (select p.txnId, p.userId, p.timestamp, en.session_duration_sec as dur from plays p
  join enriched en on en.txnId = p.txnId),
g as (select *, lag(timestamp) over (partition by userId order by timestamp, txnId) as prev_ts,
    lead(timestamp) over (partition by userId order by timestamp, txnId) as next_ts from e)
select txnId, userId, round(coalesce((epoch_us(timestamp) - epoch_us(prev_ts)) / 60000000.0, 1e6), 6)
    as minutes_since_prev,
  case when dur is null then 'no_session_data' when dur < 30 then 'quick_exit'
       when coalesce(epoch_us(next_ts) - epoch_us(timestamp) <= 600000000, false) then 'returned_quickly'
       else 'natural_end' end as eda_exit_type
from g""")
def q_eda(t):
    p = P.plays(t).select("txnId", "userId", "timestamp").join(
        P.enriched_bets(t).select("txnId", F.col("session_duration_sec").alias("dur")), "txnId")
    g = previous_event_gap(p, "userId", "timestamp", "txnId", "minutes_since_prev")
    g = next_event_gap(g, "userId", "timestamp", "txnId", "returned", 600)
    return rounded(g.select("txnId", "userId", "minutes_since_prev",
                            M.eda_exit_type("dur", "returned").alias("eda_exit_type")))


@register("selected_user_tokens", "B33 C14 (requested token groups only, NULL values skipped)", f"""with {PLAYS_CTES}, {UB_SQL}
select p.userId, list_filter([case when p.archetype is not null then concat('archetype:', p.archetype) end,
    case when ub.preferred_game_type is not null then concat('preferred_game_type:', ub.preferred_game_type) end],
    lambda x: x is not null) as tokens
from fx_players p left join ub on ub.userId = p.userId""")
def q_sel_tokens(t):
    u = t.fx_players.select("userId", "archetype").join(ub(t).select("userId", "preferred_game_type"), "userId", "left")
    return u.select("userId", M.tokens(["archetype", "preferred_game_type"]).alias("tokens"))


@register("dimension_match_coverage", "C15", f"""with {pipeline_ctes('merged')}
select count(*) as fact_rows, count(g.gameId) as matched_rows, round(count(g.gameId) / count(*), 6) as match_share
from fx_bets b left join fx_games g on g.gameId = b.gameId_raw""")
def q_match(t):
    j = t.fx_bets.join(t.fx_games.select(F.col("gameId"), F.col("gameId").alias("__g")),
                       t.fx_bets["gameId_raw"] == F.col("gameId"), "left")
    return rounded(j.agg(F.count("*").alias("fact_rows"), F.count("__g").alias("matched_rows"),
                         (F.count("__g") / F.count("*")).alias("match_share")))


def random_split(pairs, seed: int = DEFAULT.seed):
    """H2: stable hash split: ``substr(md5(user/item/seed), 1, 4) < '2666'``
    (~15 %) is test, the rest train."""
    key = F.md5(F.concat_ws("/", F.col("userId"), F.col("gameId"), F.lit(str(seed))))
    return pairs.withColumn("split", F.when(F.substring(key, 1, 4) < F.lit("2666"), "test").otherwise("train"))


@register("random_hash_split", "H2", f"""with {SCORE_CTES}
select userId, gameId, case when substr(md5(concat_ws('/', userId, gameId, '{DEFAULT.seed}')), 1, 4) < '2666'
  then 'test' else 'train' end as split from full_pairs""")
def q_random_split(t):
    return random_split(P.dataset(t).full_pairs.select("userId", "gameId"))


_MERGED_COLUMNS = {"userId": "userId", "gameId": "gameId", "timestamp": "timestamp"}


@register("missing_schema_columns", "G6", f"""with {pipeline_ctes('merged')}
{" union all ".join(f"select '{c}' as " + chr(34) + "column" + chr(34) + f", {str(c in _MERGED_COLUMNS).lower()} as present, " + (f"count({c})" if c in _MERGED_COLUMNS else "count(null)") + " as rows_filled from tx" for c in EVENT_COLUMNS)}""")
def q_missing(t):
    """Event-schema columns of the merged bet table: which it has, and how many rows fill them."""
    return schema_coverage(P.merged_bets(t))


def _violations_sql():
    allowed = {"entryPoint": M.VALID_ENTRY_POINTS, "provider": M.VALID_PROVIDERS, "gameType": M.VALID_GAME_TYPES,
               "deviceType": M.VALID_DEVICE_TYPES}
    parts = [f"""select '{c}' as col, {c} as value from events where {c} not in ({", ".join(f"'{v}'" for v in vs)})"""
             for c, vs in allowed.items()]
    return "select 'enum_violation' as section, concat(col, '=', value) as item, 1.0 as value from (" + " union ".join(parts) + ")"


_VIOL_SQL = _violations_sql()


def _kr(c):
    return (f"select 'known_rate' as section, '{c}' as item, round(coalesce(avg(case when lower(trim(coalesce(cast({c} "
            f"as varchar), 'nan'))) in ('unknown', 'nan', 'none', 'null', '') then 0.0 else 1.0 end), 0.0), 6) "
            f"from events")


@register("readiness_report", "I3 G3 G6 D10", f"""with {pipeline_ctes('events')}
{_VIOL_SQL}
union all {' union all '.join(_kr(c) for c in ['deviceType', 'entryPoint', 'provider', 'gameType'])}
union all select 'count', 'events', cast(count(*) as double) from events
union all select 'count', 'users', cast(count(distinct userId) as double) from events
union all select 'count', 'games', cast(count(distinct gameId) as double) from events""")
def q_readiness(t):
    from stakeflow.operators.analytics import known_rate
    e = P.events(t)
    viol = enum_violations(e).select(F.lit("enum_violation").alias("section"),
                                     F.concat("column", F.lit("="), "value").alias("item"), F.lit(1.0).alias("value"))
    miss = [(c,) for c in missing_columns(e, EVENT_COLUMNS)]
    schema = t.spark.createDataFrame(miss, "item string").select(
        F.lit("missing_column").alias("section"), "item", F.lit(1.0).alias("value"))
    rates = e.agg(*[known_rate(c).alias(c) for c in ["deviceType", "entryPoint", "provider", "gameType"]])
    rates = rates.unpivot([], rates.columns, "item", "value").select(F.lit("known_rate").alias("section"), "item",
                                                                     round6(F.col("value")).alias("value"))
    counts = e.agg(F.count("*").cast("double").alias("events")).select(
        "events", *[e.agg(F.count_distinct(c)).scalar().cast("double").alias(n) for c, n in (("userId", "users"), ("gameId", "games"))])
    counts = counts.unpivot([], counts.columns, "item", "value").select(F.lit("count").alias("section"), "item", "value")
    return viol.unionByName(schema).unionByName(rates).unionByName(counts)


@register("input_contract_report", "A6", f"""with {RAW_CTES},
tx as (select * from raw_bets where gameType = 'Live Casino' and status = 'SETTLED' and len(betParts) > 0)
select 'transactions_non_empty' as "check", count(*) > 0 as ok, count(*) as rows from tx
union all select 'games_have_category', true, count(*) from raw_games
union all select 'games_missing_column_detected', false, count(*) from raw_games
union all select 'empty_filter_detected', false, 0
union all select 'missing_session_source_gives_nulls', true, count(*) from raw_bets""")
def q_contracts(t):
    """Contract checks on the derived inputs: empty inputs, required columns,
    and typed NULL enrichment columns when a source is missing."""
    from stakeflow.errors import DataValidationError
    from stakeflow.operators import enrich as E
    from stakeflow.sources import ingest as I
    rows = []

    def check(name, table, fn):
        try:
            fn()
            ok = True
        except DataValidationError:
            ok = False
        rows.append((name, ok, table.count()))

    tx = I.load_transactions(raw_bets(t), check=False)
    filtered = raw_bets(t).where((F.col("gameType") == DEFAULT.game_type_filter) & (F.col("status") == DEFAULT.bet_status_filter)
                                 & (F.size("betParts") > 0))
    check("transactions_non_empty", filtered, lambda: I.require_rows(tx, "bet transactions"))
    check("games_have_category", raw_games(t), lambda: I.require_columns(raw_games(t), ["category"], "game details"))
    check("games_missing_column_detected", raw_games(t), lambda: I.require_columns(
        raw_games(t).drop("category"), ["category"], "game details"))
    none = raw_bets(t).where("false")
    check("empty_filter_detected", none, lambda: I.require_rows(none, "bet transactions"))
    no_sess = E.enrich_sessions(P.merged_bets(t), None)
    n, filled = no_sess.agg(F.count("*"), F.count("session_duration_sec")).first()
    rows.append(("missing_session_source_gives_nulls", filled == 0 and dict(no_sess.dtypes)["session_duration_sec"] == "double", n))
    return t.spark.createDataFrame(rows, "check string, ok boolean, rows long")
