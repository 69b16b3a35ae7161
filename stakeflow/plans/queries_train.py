"""Training queries (iterative: rows-only checks, no oracle SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stakeflow.config import DEFAULT
from stakeflow.operators import dataset as D
from stakeflow.operators import metrics as MT
from stakeflow.operators import scoring as S
from stakeflow.operators import train as TR
from stakeflow.plans import stages as P
from stakeflow.plans.catalog import register, rounded
from stakeflow.session import at_once, cut_lineage

K = DEFAULT.eval_k


def _lists(pairs, name):
    return pairs.groupBy("userId").agg(F.collect_list("gameId").alias(name))


def train_triplets(t):
    d = P.dataset(t)
    # written: every fit reads it several times
    return P._memo(t, "train_triplets", lambda: cut_lineage(D.triplets(d.train_pairs, d.user_index, d.item_index)))


def train_lists(t):
    return P._memo(t, "train_lists", lambda: cut_lineage(_lists(P.dataset(t).train_pairs, "seen")))


def test_lists(t):
    """(userId, pos, seen) of the users with a test pair."""
    return P._memo(t, "test_lists", lambda: cut_lineage(
        _lists(P.dataset(t).test_pairs, "pos").join(train_lists(t), "userId", "left")))


def evaluate(t, users, items):
    """Mean train and test precision@k / AUC / NDCG for given vector tables."""
    lists = train_lists(t).join(test_lists(t).select("userId", "pos"), "userId", "full")
    tr, te = (MT.mean_metrics(MT.per_user_metrics(r, K)) for r in S.split_ranks(users.join(lists, "userId"), S.item_blocks(items), "userId", "seen", "pos"))
    return tr, te


def als_model(t, iters=None):
    key = f"als_{iters}"
    return P._memo(t, key, lambda: TR.fit_als(train_triplets(t), max_iter=iters))


def model_vectors(t, iters=None):
    d = P.dataset(t)
    m = als_model(t, iters)
    return TR.factors(m, d.user_index, "userId", "user"), TR.factors(m, d.item_index, "gameId", "item")


@register("als_training_history", "H10 F6 H22 (rows)")
def q_history(t):
    spark = t.spark
    train_triplets(t), test_lists(t)  # what all share is written before

    def checkpoint(ep):
        tr, te = evaluate(t, *model_vectors(t, ep))
        return ep, tr.first()["precision_at_k"], te.first()["precision_at_k"]

    # the fits do not depend on each other: the many short stages of one leave cores to the others
    rows = at_once(spark, checkpoint, range(5, DEFAULT.n_epochs + 1, 5))
    h = spark.createDataFrame(rows, "epoch int, train_p5 double, test_p5 double")
    # best checkpoint = highest test precision (ties: earliest epoch)
    best = h.agg(F.max_by("epoch", F.struct("test_p5", -F.col("epoch")))).scalar()
    return rounded(h.withColumn("is_best", F.col("epoch") == best))


@register("hybrid_representations", "H8 (rows)")
def q_repr(t):
    d = P.dataset(t)
    u, _ = model_vectors(t)
    toks = TR.token_vectors(u, "userId", d.user_tokens)
    ids = TR.identity_vectors(u, "userId", d.user_tokens, toks)
    rep = TR.representations(d.user_index, "userId", d.user_tokens, toks, ids)
    diff = rep.join(u.select("userId", F.col("embedding").alias("f")), "userId").select(
        "userId", F.aggregate(F.zip_with("embedding", "f", lambda a, b: F.abs(a - b)), F.lit(0.0),
                              lambda acc, x: F.greatest(acc, x)).alias("max_abs_diff"))
    return rounded(diff)


@register("als_recommend_top5", "H7 E10 C12 with the trained model (rows)")
def q_als_top5(t):
    d = P.dataset(t)
    u, i = model_vectors(t)
    rows = u.join(_lists(d.full_pairs, "seen"), "userId", "left")
    return S.top_k(rows, S.item_blocks(i), 5, "userId", exclude="seen")


@register("warp_training_history", "H10 H8 F6 (sharded WARP, rows)")
def q_warp(t):
    """Sharded WARP with iterative parameter mixing; test precision@k every 5
    epochs, best checkpoint flagged."""
    from stakeflow.operators import warp as W
    d = P.dataset(t)

    def evaluate(params):
        u_rep, i_rep = W.representations(params, d.user_tokens, d.user_index, d.item_tokens, d.item_index)
        blocks = S.item_blocks(i_rep, bias="bias")
        rows = u_rep.join(_lists(d.test_pairs, "pos"), "userId").join(_lists(d.train_pairs, "seen"), "userId", "left")
        m = MT.mean_metrics(MT.per_user_metrics(
            S.positive_ranks(rows, blocks, "userId", "pos", exclude="seen", bias="bias"), K)).first()
        return {"test_p5": m["precision_at_k"], "test_auc": m["auc"]}

    _, hist = W.train_warp(d.train_pairs, d.user_tokens, d.item_tokens, d.user_index, d.item_index,
                           epochs=DEFAULT.n_epochs, evaluate=evaluate)
    h = t.spark.createDataFrame([(r["epoch"], r["test_p5"], r["test_auc"]) for r in hist],
                                "epoch int, test_p5 double, test_auc double")
    best = h.agg(F.max_by("epoch", F.struct("test_p5", -F.col("epoch")))).scalar()
    return rounded(h.withColumn("is_best", F.col("epoch") == best))
