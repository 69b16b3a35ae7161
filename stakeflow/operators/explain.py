"""Score explanations and feature diagnostics.

A hybrid model is a table of feature vectors ``(feature, embedding, bias)``
per side plus each entity's active features ``(key, feature, value)`` (its
identity feature ``id:<key>`` and its tokens, each weighing 1/(k+1)).
Everything below is joins and aggregations over those two tables:

* representation (H8) = sum of value * vector per entity: exploded by vector
  component, summed per (entity, component), re-assembled (the array length is
  the model rank, a fixed bound);
* a side token's contribution to a (user, item) score is
  ``value * (bias_f + vector_f . other side's representation)``;
* attribution (H25) and stability (H26) aggregate those contributions over
  all train pairs - no sampling cap; a stability sample is the seven tenths of
  the pairs with the smallest ``md5(pair/sample)``, which every engine
  reproduces.

Spark broadcasts the vocabulary (token vectors) below its own byte threshold;
pairs and entities stay partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeflow.errors import DataValidationError
from stakeflow.functions import mappers as M
from stakeflow.session import cut_lineage

SAMPLE_TENTHS = 7  # fixed value: share of the pairs in a stability sample


def entity_features(index: DataFrame, key: str, token_table: DataFrame) -> DataFrame:
    """(key, feature, value, is_token): identity + tokens, each 1/(k+1)."""
    t = index.select(key).join(token_table, key, "left").select(
        key, F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"))
    w = 1.0 / (F.size("tokens") + 1)
    ident = t.select(key, F.concat(F.lit("id:"), F.col(key)).alias("feature"), w.alias("value"),
                     F.lit(False).alias("is_token"))
    toks = t.select(key, F.explode("tokens").alias("feature"), w.alias("value"), F.lit(True).alias("is_token"))
    return ident.unionByName(toks)


def sum_vectors(rows: DataFrame, key: str, weight: str, vec: str = "embedding", more: Sequence[Column] = ()) -> DataFrame:
    """(key, embedding, *more): sum of weight * vector per key, component-wise, and further aggregates of the same rows.

    A key has a handful of vectors (its features), so they are gathered and added; nothing is exploded into components."""
    x = F.when(F.size(vec) > 0, F.struct(F.col(weight).alias("w"), F.col(vec).alias("v")))
    g = rows.groupBy(key).agg(F.collect_list(x).alias("__l"), *more).where(F.size("__l") > 0)

    def add(total, row):
        # as a sum does: a missing component adds nothing
        return F.zip_with(total, row["v"], lambda a, b: F.when(b.isNull(), a).otherwise(F.coalesce(a, F.lit(0.0)) + row["w"] * b))

    names = [c for c in g.columns if c not in (key, "__l")]
    return g.select(key, F.aggregate("__l", F.array().cast("array<double>"), add).alias(vec), *names)


def representations(ef: DataFrame, fv: DataFrame, key: str) -> DataFrame:
    """H8: (key, embedding, bias) = sum over active features of value * (vector, bias).

    A token is carried by a good part of all entities, so the tokens' vectors are a table of their own, as small as
    the vocabulary: Spark brings it to the entities where it is small, and no task gets all carriers of a token."""
    tokens = ef.where("is_token")
    own = tokens.select("feature").distinct().join(fv, "feature")
    j = ef.where(~F.col("is_token")).join(fv, "feature").unionByName(tokens.join(own, "feature"))
    return sum_vectors(j, key, "value", more=[F.sum(F.col("value") * F.coalesce("bias", F.lit(0.0))).alias("bias")])


def require_known(pairs: DataFrame, u_ef: DataFrame, i_ef: DataFrame) -> DataFrame:
    """The pairs as they are, or an error that names how many have an unknown user or item."""
    u = u_ef.select("userId", F.lit(True).alias("__u")).distinct()
    i = i_ef.select("gameId", F.lit(True).alias("__i")).distinct()
    bad = (pairs.select("userId", "gameId").join(u, "userId", "left").join(i, "gameId", "left")
           .agg(F.count_if(F.col("__u").isNull()), F.count_if(F.col("__i").isNull())).first())
    if any(bad):
        raise DataValidationError(f"cannot explain: {bad[0]} pairs have an unknown user, {bad[1]} an unknown item")
    return pairs


def contributions(pairs: DataFrame, u_ef: DataFrame, i_ef: DataFrame, u_fv: DataFrame, i_fv: DataFrame,
                  u_rep: DataFrame, i_rep: DataFrame, weight: str | None = None) -> DataFrame:
    """H24 core: one row per (userId, gameId, side, feature) side token with
    ``contribution = value * (bias_f + vector_f . other representation)``."""
    p = pairs.select("userId", "gameId", *( [weight] if weight else []))
    ut = u_ef.where("is_token").join(u_fv, "feature").select(
        "userId", "feature", "value", F.col("embedding").alias("__fv"), F.coalesce("bias", F.lit(0.0)).alias("__fb"))
    it = i_ef.where("is_token").join(i_fv, "feature").select(
        "gameId", "feature", "value", F.col("embedding").alias("__fv"), F.coalesce("bias", F.lit(0.0)).alias("__fb"))
    u_side = (p.join(ut, "userId").join(i_rep.select("gameId", F.col("embedding").alias("__other")), "gameId")
              .withColumn("side", F.lit("user")))
    i_side = (p.join(it, "gameId").join(u_rep.select("userId", F.col("embedding").alias("__other")), "userId")
              .withColumn("side", F.lit("item")))
    both = u_side.unionByName(i_side)
    c = F.col("value") * (F.col("__fb") + M.dot("__fv", "__other"))
    return both.select("userId", "gameId", "side", "feature", "value", *([weight] if weight else []),
                       c.alias("contribution"))


def explain_summary(pairs: DataFrame, contribs: DataFrame, u_rep: DataFrame, i_rep: DataFrame) -> DataFrame:
    """H24 totals: score = p.q + b_u + b_i, metadata total, residual."""
    s = (pairs.select("userId", "gameId")
         .join(u_rep.select("userId", F.col("embedding").alias("__p"), F.col("bias").alias("__bu")), "userId")
         .join(i_rep.select("gameId", F.col("embedding").alias("__q"), F.col("bias").alias("__bi")), "gameId")
         .select("userId", "gameId", (M.dot("__p", "__q") + F.col("__bu") + F.col("__bi")).alias("score")))
    tot = contribs.groupBy("userId", "gameId").agg(F.sum("contribution").alias("metadata_contribution_total"))
    return (s.join(tot, ["userId", "gameId"], "left")
            .withColumn("metadata_contribution_total", F.coalesce("metadata_contribution_total", F.lit(0.0)))
            .withColumn("residual", F.col("score") - F.col("metadata_contribution_total")))


def top_by_abs(df: DataFrame, value: str, n: int, partition: list[str] | None = None, tie: list[str] | None = None):
    """The n rows with the largest |value| per partition (or overall).

    Overall, the window ranks only the ``n`` rows of a distributed top-n."""
    order = [F.desc(F.abs(F.col(value))), *(tie or [])]
    rows = df if partition else df.orderBy(*order).limit(n)
    w = Window.partitionBy(*(partition or [])).orderBy(*order)
    return rows.withColumn("abs_rank", F.row_number().over(w)).where(F.col("abs_rank") <= n)


def sample_key(cols: list[str], sample: int) -> Column:
    """The hash that orders rows for a sample."""
    return F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in cols], F.lit(str(sample))))


def sample_cutoffs(rows: DataFrame, cols: list[str], samples: int, tenths: int = SAMPLE_TENTHS) -> list[str | None]:
    """For each sample the ``ceil(tenths / 10 * n)``-th smallest ``sample_key``: the rows up to it are a sample of
    exactly that size (keys of different ``cols`` differ).

    One pass counts the hash prefixes and finds the one that holds the cut, a second ranks the few rows of that
    prefix; one row per sample reaches the driver each time."""
    keyed = rows.select(F.explode(F.array(*[F.struct(F.lit(s).alias("sample"), sample_key(cols, s).alias("h")) for s in range(samples)])).alias("x"))
    keyed = keyed.select("x.sample", "x.h", F.substring("x.h", 1, 4).alias("prefix"))
    counts = keyed.groupBy("sample", "prefix").agg(F.count("*").alias("n"))
    w = Window.partitionBy("sample").orderBy("prefix")  # 65,536 prefixes at most
    whole = Window.partitionBy("sample")
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    size = F.floor((F.sum("n").over(whole) * tenths + 9) / 10)
    cut = counts.withColumn("upto", upto).withColumn("size", size).where("upto >= size and upto - n < size").select(
        "sample", "prefix", (F.col("size") - F.col("upto") + F.col("n")).alias("place")).collect()
    if not cut:
        return [None] * samples
    inside = reduce(lambda x, y: x | y, [(F.col("sample") == r.sample) & (F.col("prefix") == r.prefix) for r in cut])
    place = F.create_map(*[F.lit(v) for r in cut for v in (r.sample, r.place)])[F.col("sample")]
    ranked = keyed.where(inside).withColumn("at", F.row_number().over(Window.partitionBy("sample").orderBy("h")))
    found = {r.sample: r.h for r in ranked.where(F.col("at") == place).collect()}
    return [found.get(s) for s in range(samples)]


def attribution(pairs: DataFrame, u_ef: DataFrame, i_ef: DataFrame, u_fv: DataFrame, i_fv: DataFrame,
                u_rep: DataFrame, i_rep: DataFrame, weight: str, samples: int = 0) -> DataFrame:
    """H25 (and the samples of H26): per (side, feature) the weighted mean contribution ``c`` over all
    pairs, and ``c0 .. c<samples - 1>`` over each sample of seven tenths of the pairs (NULL where it has no such pair).

    Weights are summed by (feature, other side's entity) before any vector is
    attached, so the vectors meet that small table and not pairs x tokens rows."""
    cols = ["userId", "gameId"]
    cutoffs = sample_cutoffs(pairs, cols, samples) if samples else []
    keeps = {f"__k{s}": sample_key(cols, s) <= F.lit(cutoffs[s]) for s in range(samples)}
    p = pairs.select("userId", "gameId", F.col(weight).alias("__w"), *[k.alias(n) for n, k in keeps.items()])
    parts = []
    for side, own, other, ef, fv, rep in (("user", "userId", "gameId", u_ef, u_fv, i_rep), ("item", "gameId", "userId", i_ef, i_fv, u_rep)):
        j = p.join(ef.where("is_token").select(own, "feature", "value"), own)
        x = F.col("__w") * F.col("value")
        sums = j.groupBy("feature", other).agg(
            F.sum(x).alias("a"), F.sum("__w").alias("w"),
            *[f for s in range(samples) for f in (F.sum(F.when(F.col(f"__k{s}"), x)).alias(f"a{s}"),
                                                  F.sum(F.when(F.col(f"__k{s}"), F.col("__w"))).alias(f"w{s}"))])
        t = (sums.join(fv.select("feature", F.col("embedding").alias("__fv"), F.coalesce("bias", F.lit(0.0)).alias("__fb")), "feature")
             .join(rep.select(other, F.col("embedding").alias("__o")), other)
             .withColumn("d", F.col("__fb") + M.dot("__fv", "__o")))

        def mean(n):
            return F.sum(F.col(f"a{n}") * F.col("d")) / F.greatest(F.sum(f"w{n}"), F.lit(1e-9))
        parts.append(t.groupBy("feature").agg(
            mean("").alias("c"), *[F.when(F.count(f"w{s}") > 0, mean(s)).alias(f"c{s}") for s in range(samples)])
            .select(F.lit(side).alias("side"), "*"))
    return parts[0].unionByName(parts[1])


def global_attribution(table: DataFrame) -> DataFrame:
    """(side, feature, contribution) of an ``attribution`` table."""
    return table.select("side", "feature", F.col("c").alias("contribution"))


def stability(table: DataFrame, samples: int = 6) -> DataFrame:
    """H26 from an ``attribution`` table: per (side, feature) mean and
    population std over the samples, stability = |m| / (|m| + s + 1e-9), sign
    consistency (share of non-zero sample values with the mean's sign; 1.0 if
    none or the mean is zero) and the number of samples that saw the feature."""
    cs = F.array_compact(F.array(*[F.col(f"c{s}") for s in range(samples)]))
    g = table.select("side", "feature", cs.alias("__cs")).where(F.size("__cs") > 0)
    n = F.size("__cs")
    total = F.aggregate("__cs", F.lit(0.0), lambda a, x: a + x)
    g = g.withColumn("mean_contribution", total / n)
    m = F.col("mean_contribution")
    g = g.withColumn("std_deviation", F.sqrt(F.aggregate("__cs", F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / n))
    nz = F.filter("__cs", lambda x: F.abs(x) > 1e-9)
    agree = F.size(F.filter(nz, lambda x: F.signum(x) == F.signum(m)))
    cons = F.when((F.size(nz) == 0) | (F.abs(m) <= 1e-9), F.lit(1.0)).otherwise(agree / F.size(nz))
    return g.select("side", "feature", "mean_contribution", "std_deviation",
                    (F.abs(m) / (F.abs(m) + F.col("std_deviation") + 1e-9)).alias("stability_score"),
                    cons.alias("sign_consistency"), n.cast("long").alias("samples_observed"))


def vector_norms(fv: DataFrame, side: str) -> DataFrame:
    """L2 norm of each feature vector."""
    return fv.select(F.lit(side).alias("side"), "feature",
                     F.sqrt(F.aggregate(F.transform("embedding", lambda x: x * x), F.lit(0.0),
                                        lambda a, x: a + x)).alias("l2_norm"))


def eligible_users(pairs: DataFrame, min_interactions: int, n: int, seed: int = 42,
                   count_col: str | None = None) -> DataFrame:
    """Users with at least ``min_interactions`` (sum of ``count_col`` or
    rows), n of them without replacement in md5(id/seed) order (a sampling
    operator: the limit is the feature)."""
    cnt = F.sum(count_col) if count_col else F.count("*")
    u = pairs.groupBy("userId").agg(cnt.alias("interactions")).where(F.col("interactions") >= min_interactions)
    order = F.md5(F.concat_ws("/", F.col("userId"), F.lit(str(seed))))
    return u.withColumn("sample_key", order).orderBy("sample_key", "userId").limit(n)


def ablate(ef: DataFrame, features: list[str]) -> DataFrame:
    """Drop the given features from the entity feature table without
    re-normalising the remaining values."""
    return ef.where(~F.col("feature").isin(*features)) if features else ef


def diverse_pick(candidates: DataFrame, order_users: DataFrame, n_users: int) -> list[dict]:
    """users in order (interaction count desc, id); each takes its best item
    not taken by an earlier user, else its own best.  ``candidates`` holds
    (userId, gameId, score, rank) with at least ``n_users + 1`` items per user;
    only ``n_users * (n_users + 1)`` rows reach the driver (a bounded fold)."""
    users = [r["userId"] for r in order_users.orderBy(F.desc("n"), "userId").limit(n_users).collect()]
    keep = candidates.where(F.col("rank") <= n_users + 1).join(
        order_users.sparkSession.createDataFrame([(u,) for u in users], "userId string"), "userId")
    rows = {}
    for r in keep.collect():
        rows.setdefault(r["userId"], []).append((r["rank"], r["gameId"], r["score"]))
    used, out = set(), []
    for u in users:
        cands = sorted(rows.get(u, []))
        if not cands:
            continue
        pick = next((c for c in cands if c[1] not in used), cands[0])
        used.add(pick[1])
        out.append({"userId": u, "gameId": pick[1], "score": pick[2], "pick_order": len(out) + 1})
    return out


def permuted_changes(ef: DataFrame, index: DataFrame, key: str, features: list[str], seed: int = 42) -> DataFrame:
    """(key, changes): what each entity's value of each feature changes by when the feature's column is
    shuffled over all entities (zeros included).

    The value held by the entity at place i of the md5(id/feature/seed) order moves to the entity at place i of
    the id order, which is its dense ``idx``.  One sort by (feature, hash) places all features at once."""
    from stakeflow.operators.stats import positions
    n = index.count()
    names = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.lit(x).alias("feature")) for i, x in enumerate(features)]))
    col = index.select(key, "idx", names.alias("x")).select(key, "idx", "x.f", "x.feature").join(
        ef.select(key, "feature", "value"), [key, "feature"], "left").fillna(0.0, subset=["value"])
    col = cut_lineage(col)
    by_hash = positions(col.withColumn("__h", F.md5(F.concat_ws("/", F.col(key), F.col("feature"), F.lit(str(seed))))), ["f", "__h", key], "__p")
    moved = by_hash.select("f", (F.col("__p") - F.col("f") * F.lit(n)).alias("idx"), F.col("value").alias("new"))
    change = F.struct("f", (F.col("new") - F.col("value")).alias("by"))
    return col.join(moved, ["f", "idx"]).groupBy(key).agg(F.array_sort(F.collect_list(change)).alias("c")).select(key, F.col("c.by").alias("changes"))


def feature_products(rep: DataFrame, key: str, vectors: DataFrame, features: list[str]) -> DataFrame:
    """(key, products): product of each feature's vector (plus its bias) with each entity's representation."""
    few = vectors.join(F.broadcast(rep.sparkSession.createDataFrame(list(enumerate(features)), "f int, feature string")), "feature")
    few = few.select("f", F.col("embedding").alias("__v"), F.coalesce("bias", F.lit(0.0)).alias("__b"))  # one row per feature
    x = F.struct("f", (M.dot("__v", "embedding") + F.col("__b")).alias("by"))
    return rep.select(key, "embedding").crossJoin(F.broadcast(few)).groupBy(key).agg(
        F.array_sort(F.collect_list(x)).alias("c")).select(key, F.col("c.by").alias("products"))


def permuted_models(u_rep: DataFrame, i_rep: DataFrame, u_ef: DataFrame, i_ef: DataFrame, u_fv: DataFrame, i_fv: DataFrame,
                    users: DataFrame, items: DataFrame, top: list[tuple[str, str]], apart: bool = True) -> tuple[DataFrame, DataFrame]:
    """H27 for all features (side, feature) at once: (feature, userId, embedding) and (gameId, embedding).
    With ``apart=False`` a user has one row, whose vector ends in the components of all features (``variants`` of
    ``scoring.positive_ranks``).

    A shuffled feature adds a product to each score: an entity's change of value times the feature vector's product
    with the other side.  It is one more dimension of both sides: items hold all of them, and a user row per feature
    (``''``: none) holds only its own.  Nothing is derived anew, and one evaluation ranks all variants."""
    width = len(top)
    sides = {}
    for side, own, other, rep, ef, fv, index in (("user", "userId", "gameId", i_rep, u_ef, u_fv, users), ("item", "gameId", "userId", u_rep, i_ef, i_fv, items)):
        at = [k for k, (s, _) in enumerate(top) if s == side]
        names = [top[k][1] for k in at]
        if names:
            sides[side] = at, permuted_changes(ef, index, own, names), feature_products(rep, other, fv, names)

    def extra(rep, key, own, other):
        """Array of ``width`` numbers: changes of the own side's features, products with the other's."""
        out = rep.select(key, "embedding")
        parts = [F.lit(0.0)] * width
        for side, column, name in ((own, 1, "changes"), (other, 2, "products")):
            if side in sides:
                at, table = sides[side][0], sides[side][column]
                out = out.join(table, key, "left")
                for i, k in enumerate(at):
                    parts[k] = F.coalesce(F.col(name)[i], F.lit(0.0))
        return out.select(key, "embedding", F.array(*parts).cast("array<double>").alias("extra"))

    u = extra(u_rep, "userId", "user", "item")
    i = extra(i_rep, "gameId", "item", "user")
    i = i.select("gameId", F.concat("embedding", "extra").alias("embedding"))
    if not apart:
        return u.select("userId", F.concat("embedding", "extra").alias("embedding")), i
    which = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f).alias("feature")) for k, f in enumerate([*(f for _, f in top), ""])]))
    u = u.withColumn("w", which).select("w.feature", "userId", F.concat("embedding", F.transform(
        "extra", lambda x, j: F.when(j == F.col("w.k"), x).otherwise(0.0))).alias("embedding"))
    return u, i


# fixed values: token groups that each variant of the feature-group ablation keeps
USER_GROUPS = ["device", "country", "preferred_game_type", "engagement_bucket", "recency_bucket", "diversity_bucket"]
ITEM_GROUPS = ["gameType", "vendor", "top_pop_flags", "bet_tier", "popularity_bucket"]
ABLATION_VARIANTS = [
    ("full", USER_GROUPS, ITEM_GROUPS),
    ("drop_user_context", ["engagement_bucket", "recency_bucket", "diversity_bucket"], ITEM_GROUPS),
    ("drop_user_behavior", ["device", "country", "preferred_game_type"], ITEM_GROUPS),
    ("drop_item_metadata", USER_GROUPS, ["top_pop_flags", "bet_tier", "popularity_bucket"]),
    ("drop_item_popularity", USER_GROUPS, ["gameType", "vendor"]),
]
