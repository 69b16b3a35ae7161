"""Hard-negative mining over anchor-clustered shared lists (MAXIMUS-style).

Anchors are clustered by angle around centroids fitted on a bounded sample.  For
a cluster with centroid ``c`` and radius ``r`` (largest angle of a member), no
member ``u`` scores more with a row ``x`` than ``|u| * |x| * cos(max(0,
angle(x, c) - r))``.  The rows are sorted by that bound once per cluster, and
every member walks the shared list from its top until the bound certifies that
nothing further down can enter its result; then it leaves.

On Spark the rows are packed, as they are scanned, into blocks of bounded size,
and the blocks are dealt into shares.  Groups of anchors and shares of rows meet
on a grid: one task holds one group and one share, both bounded, sorts the
share's part of the list once per cluster, and returns at most five rows per
anchor and window, which are merged per anchor.  No pair of rows leaves a task
otherwise, no key decides where a row goes, so repeated vectors, a large label
or a large cluster cannot make a task larger than another.

Two passes over the grid: the first finds each anchor's positives, the second
walks the lists for the negatives between 0.8 times and once the score of each
positive.  Exact; the sample only decides how early the walks end.

Defined results: rows with a null id, null label, null vector, or a null or
non-finite component take no part; vectors compare with those of their own
length only; scores have to fit in 64 bits.  Rows repeating an id are separate
rows, of which none is a positive or negative of another; an anchor row that occurs n times
gives its result n times; equal scores go by id; other columns of the input are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stakeflow.llm.tables import materialise, read
from stakeflow.llm.textnum import frugal

POSITIVES = 5
NEGATIVES = 5
#: Anchors on which the centroids are fitted (at most), and centroids per vector length.
SAMPLE = 8192
CENTROIDS = 64
MEMBERS_PER_CENTROID = 16
#: Rows of a packed block, of a share of the list, and of a group of anchors.
BLOCK_ROWS = 512
SHARE_ROWS = 65_536
GROUP_ROWS = 4096
#: Shares into which small tables are dealt as well, so that they fill a few tasks.
SMALL_SHARES, SMALL_SHARE_ROWS = 64, 4096
#: Members of a cluster that walk together, and rows of one step of the walk.
WALKERS = 512
FIRST_STEP, LAST_STEP = 256, 4096
LOWEST = np.iinfo(np.int64).min
HIGHEST = np.iinfo(np.int64).max


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, integer vectors floor(256 x)) for each vector length in the column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(length) - length
    for dim in np.unique(length):
        rows = np.flatnonzero(length == dim)
        yield int(dim), rows, np.floor(256.0 * flat[first[rows][:, None] + np.arange(dim)]).astype(np.int64)


def _units(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, norms); a zero vector stays zero."""
    x = q.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def fit_centroids(unit: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(20240715)
    centres = unit[rng.choice(len(unit), count, replace=False)]
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, own, unit)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        centres = np.where(norm > 0, total / np.where(norm > 0, norm, 1), centres)
    return centres


def _centroids(anchors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Centroids by vector length, from at most ``SAMPLE`` anchors; lengths not met there have none."""
    share = max(1, -(-2 * count // SAMPLE))
    rows = anchors.where(F.pmod("a1", F.lit(share)) == 0).select("embedding").limit(SAMPLE).toArrow().column(0).combine_chunks()
    out = {}
    for dim, _, q in _vectors(rows):
        unit = _units(q)[0]
        if dim:
            out[dim] = fit_centroids(unit, max(1, min(CENTROIDS, len(unit) // MEMBERS_PER_CENTROID)))
    return out


def _assign(centroids: dict[int, np.ndarray]):
    """Batches with ``embedding`` get ``dim, cluster``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cluster = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for dim, rows, q in _vectors(batch.column("embedding")):
                dims[rows] = dim
                if dim in centroids:
                    cluster[rows] = (_units(q)[0] @ centroids[dim].T).argmax(1)
            yield batch.append_column("dim", pa.array(dims)).append_column("cluster", pa.array(cluster))
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows become blocks of at most ``BLOCK_ROWS`` rows of one vector length, as they come."""
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for dim, rows, q in _vectors(batch.column("embedding")):
            for at in range(0, len(rows), BLOCK_ROWS):
                own, block = rows[at:at + BLOCK_ROWS], q[at:at + BLOCK_ROWS]
                most = int(max(block.max(initial=0), -block.min(initial=0)))
                width = 2 if most < 2**15 else 4 if most < 2**31 else 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), pa.array([part], pa.int32()), pa.array([nth], pa.int32()), pa.array([len(own)], pa.int32()),
                     pa.array([width], pa.int32()), pa.array([ids[own].tobytes()]), pa.array([labels[own].tobytes()]),
                     pa.array([block.astype(f"<i{width}").tobytes()])],
                    names=["dim", "part", "nth", "n", "width", "ids", "labels", "q"])
                nth += 1


@dataclass
class Rows:
    """Rows of one share with the same vector length."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    unit: np.ndarray
    norm: np.ndarray

    @staticmethod
    def of(blocks: pa.Table, dim: int) -> Rows:
        cut = [blocks.column(c).to_pylist() for c in ("ids", "labels", "q", "width")]
        q = np.concatenate([np.frombuffer(b, f"<i{w}").reshape(-1, dim) if dim else np.zeros((len(i) // 8, 0)) for i, _, b, w in zip(*cut)]).astype(np.int64)
        return Rows(np.frombuffer(b"".join(cut[0]), np.int64), np.frombuffer(b"".join(cut[1]), np.int64), q, *_units(q))


def shared_list(rows: Rows, centre: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds for a member of norm 1), highest bound first.  The slack covers rounding."""
    angle = np.arccos(np.clip(rows.unit @ centre, -1, 1))
    bound = rows.norm * np.cos(np.minimum(np.maximum(angle - radius - 1e-6, 0), np.pi))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(rows: Rows, order: np.ndarray, bound: np.ndarray, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, low: np.ndarray,
         high: np.ndarray, same: bool, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(member, window, score, row id): for each member and each of its windows ``low <= score <= high`` the
    ``keep`` best rows of another id, of its own label (``same``) or of the others; ties by id."""
    windows = low.shape[1]
    norm = _units(q)[1]
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(rows.q).max(initial=0)) * max(1, q.shape[1]) < 2.0**53
    left, right = (q.astype(np.float64), rows.q.astype(np.float64)) if exact else (q, rows.q)
    need = low.copy()  # what a row has to score to enter a window
    pool_w, pool_s, pool_i = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, step = 0, FIRST_STEP
    while at < len(order):
        reach = norm * bound[at]
        reach = reach + np.abs(reach) * 1e-9 + 1
        walking = np.flatnonzero(((reach[:, None] >= need) & (low <= high)).any(1))
        if not len(walking):  # certified for all members
            break
        here = order[at:at + step]
        score = (left[walking] @ right[here].T).astype(np.int64)
        fits = (labels[walking][:, None] == rows.labels[here]) == same
        fits &= ids[walking][:, None] != rows.ids[here]
        least, most = np.where(low <= high, need, HIGHEST).min(1), np.where(low <= high, high, LOWEST).max(1)
        fits &= (score >= least[walking][:, None]) & (score <= most[walking][:, None])
        m, r = np.nonzero(fits)
        s, i, m = score[m, r], rows.ids[here][r], walking[m]
        new = [(pool_w, pool_s, pool_i)]
        for k in range(windows):
            ok = (s >= need[m, k]) & (s <= high[m, k])
            new.append((m[ok] * windows + k, s[ok], i[ok]))
        pool_w, pool_s, pool_i = (np.concatenate(x) for x in zip(*new))
        best = np.lexsort((pool_i, -pool_s, pool_w))
        pool_w, pool_s, pool_i = pool_w[best], pool_s[best], pool_i[best]
        first = np.append(True, pool_w[1:] != pool_w[:-1]) if len(pool_w) else np.zeros(0, bool)
        place = np.arange(len(pool_w)) - np.maximum.accumulate(np.where(first, np.arange(len(pool_w)), 0))
        held = place < keep
        pool_w, pool_s, pool_i, place = pool_w[held], pool_s[held], pool_i[held], place[held]
        full = place == keep - 1
        need.reshape(-1)[pool_w[full]] = np.maximum(need.reshape(-1)[pool_w[full]], pool_s[full])
        at += step
        step = min(2 * step, LAST_STEP)
    return pool_w // windows, pool_w % windows, pool_s, pool_i


def _mine(centroids: dict[int, np.ndarray], same: bool, keep: int):
    """One group of anchors against one share of the rows: ``a1, a2, ceiling, other_id, score``."""
    def run(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        found = []
        if anchors.num_rows and blocks.num_rows:
            col = {c: anchors.column(c).to_numpy() for c in ("a1", "a2", "vec_id", "label", "cluster")}
            dims = blocks.column("dim").to_numpy()
            for dim, at, q in _vectors(anchors.column("embedding").combine_chunks()):
                if not (dims == dim).any():
                    continue
                rows = Rows.of(blocks.filter(pa.array(dims == dim)), dim)
                if same:
                    high = np.full((len(at), 1), HIGHEST)
                    low = np.full((len(at), 1), LOWEST)
                else:
                    cut = [anchors.column("ceilings")[int(k)].as_py() for k in at]
                    # the place of a missing ceiling is an empty window
                    high = np.array([c + [-1] * (POSITIVES - len(c)) for c in cut], np.int64).reshape(len(at), POSITIVES)
                    low = high - high // 5
                unit = _units(q)[0]
                for c in np.unique(col["cluster"][at]):
                    own = np.flatnonzero(col["cluster"][at] == c)
                    centre = centroids[dim][c] if dim in centroids else np.zeros(dim)
                    radius = float(np.arccos(np.clip(unit[own] @ centre, -1, 1)).max())
                    order, bound = shared_list(rows, centre, radius)
                    for b in range(0, len(own), WALKERS):
                        w = own[b:b + WALKERS]
                        g = at[w]
                        m, k, s, i = walk(rows, order, bound, col["vec_id"][g], col["label"][g], q[w], low[w], high[w], same, keep)
                        found.append((col["a1"][g][m], col["a2"][g][m], high[w][m, k], i, s))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
        return pa.table([pa.array(x) for x in parts], names=["a1", "a2", "ceiling", "other_id", "score"])
    return run


def _on_grid(anchors: DataFrame, blocks: DataFrame, groups: int, shares: int, run) -> DataFrame:
    """``run`` on every (group of anchors, share of blocks)."""
    left = anchors.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    right = blocks.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    tasks = groups * shares
    return (left.repartition(tasks, "grp", "share").groupBy("grp", "share")
            .cogroup(right.repartition(tasks, "grp", "share").groupBy("grp", "share"))
            .applyInArrow(run, "a1 bigint, a2 bigint, ceiling bigint, other_id bigint, score bigint"))


def _first(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` best rows of each key with their place in ``nth``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)


def hard_negatives(vectors: DataFrame, anchor: str = "vec_id % 100 = 0", id_col="vec_id", vector_col="embedding",
                   label_col="label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``anchor`` is a condition
    on ``vec_id`` and ``label``."""
    x = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    broken = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(broken, F.lit(True)))
    blocks = materialise(rows.mapInArrow(frugal(_pack), "dim int, part int, nth int, n int, width int, ids binary, labels binary, q binary"), "vector_blocks")
    anchors = materialise(rows.where(anchor).groupBy("vec_id", "label", "embedding").agg(F.count("*").alias("copies")).withColumns({
        "a1": F.xxhash64("vec_id", "label", "embedding"), "a2": F.xxhash64("embedding", "label", "vec_id", F.lit(1))}), "anchors")
    total, count = blocks.agg(F.sum("n")).first()[0] or 0, anchors.count()
    centroids = _centroids(anchors, count)
    shares = max(1, -(-total // SHARE_ROWS), min(SMALL_SHARES, -(-total // SMALL_SHARE_ROWS)))
    groups = max(1, -(-count // GROUP_ROWS))
    # a cluster stays together up to the size of a group
    dealt = anchors.mapInArrow(frugal(_assign(centroids)), f"{_ddl(anchors)}, dim int, cluster int")
    sizes = dealt.groupBy("dim", "cluster").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("pieces"))
    dealt = materialise(dealt.join(sizes, ["dim", "cluster"]).withColumn("grp", F.pmod(F.xxhash64(
        "dim", "cluster", F.pmod("a2", F.col("pieces"))), F.lit(groups)).cast("int")).drop("pieces"), "anchor_groups")
    blocks = blocks.withColumn("share", F.pmod(F.xxhash64("part", "nth"), F.lit(shares)).cast("int"))
    near = _on_grid(dealt, blocks, groups, shares, _mine(centroids, True, POSITIVES))
    positives = materialise(_first(near, ["a1", "a2"], POSITIVES).select(
        "a1", "a2", F.col("other_id").alias("positive_id"), F.col("score").alias("ceiling")), "positives")
    ceilings = positives.where("ceiling >= 0").groupBy("a1", "a2").agg(F.collect_set("ceiling").alias("ceilings"))
    hard = _on_grid(dealt.join(ceilings, ["a1", "a2"]), blocks, groups, shares, _mine(centroids, False, NEGATIVES))
    negatives = _first(hard, ["a1", "a2", "ceiling"], NEGATIVES)
    out = (positives.join(negatives, ["a1", "a2", "ceiling"])
           .join(anchors.select("a1", "a2", F.col("vec_id").alias("anchor_id"), "copies"), ["a1", "a2"])
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    return out.select("anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                      F.col("ceiling").alias("positive_score"), F.col("score").alias("negative_score"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {k}" for n, k in df.dtypes)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


ORACLE = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same, list_dot_product(a.q, r.q)::bigint as score
  from r a join r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), p as (
  select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), n as (
  select p.anchor_id, p.other_id as positive_id, s.other_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.other_id order by s.score desc, s.other_id) as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""
