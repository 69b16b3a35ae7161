"""Embedding near-dedup by E8 lattice hashing.

Unit vectors are projected at random to 8 dimensions and decoded to the nearest
point of the E8 lattice; ``tables`` projections (orthogonal to each other where
the dimension allows) give as many cells.  A vector stands in its own cell and
probes the ``probes`` neighbouring cells whose points are next nearest.  Two
vectors meet where one's own cell is among the other's; each pair that meets is
verified by cosine in double precision and counted in its first meeting place
only, so link counts need no table of pairs.

Equal vectors are one class with a weight.  A cell with more than ``BLOCK``
vectors is split into a grid of block pairs, each a small matrix product of its
own, so a hot cell spreads over many tasks; a task returns one count and one
local root per vector, never the pairs.  With more vectors per label the key
joins the codes of several lattices (``lattices_for``), so the cells' load
stays alike, and there are more tables (``tables_for``), so the recall does too.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, link with nothing and are their own
component; vectors of different length do not compare; rows repeating a
``vec_id`` are separate vectors of that id; a null ``vec_id`` links with nothing
and has a null component; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.graph import components
from stakeflow.llm.tables import materialise, read

PROBES = 2
#: Edge of a lattice cell against unit vectors.
SCALE = 0.2
#: Share of the vectors of a label in one cell of one lattice at this scale.
CELL_SHARE = 0.001
BLOCK = 1024
ROWS_PER_TASK = 50_000


@functools.cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            out.append(np.array(signs))
    return np.array(out)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with even sum: round, and where the sum is odd move the worst entry."""
    f = np.rint(y)
    e = y - f
    odd = np.flatnonzero(f.sum(1).astype(np.int64) & 1)
    k = np.abs(e[odd]).argmax(1)
    f[odd, k] += np.where(e[odd, k] >= 0, 1.0, -1.0)
    return f


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of the two cosets of D8."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    near = ((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1)
    return np.where(near[:, None], a, b)


@functools.cache
def projections(dim: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` matrices (dim, 8) with orthonormal columns, and shifts."""
    rng = np.random.default_rng([20240611, dim, count])
    columns: list[np.ndarray] = []
    while len(columns) < 8 * count:  # a new basis whenever one is used up
        q = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        columns += list(q.T[:dim - dim % 8] if dim >= 8 else np.resize(q.T, (8, dim)))
    return np.array(columns[:8 * count]).reshape(count, 8, dim).transpose(0, 2, 1), rng.uniform(0, 1, (count, 8))


def lattices_for(n: int) -> int:
    """Lattices per table that keep a cell's expected load under about 2,000 of ``n`` vectors."""
    return max(1, math.ceil(math.log(max(n, 1) / 2048) / -math.log(CELL_SHARE))) if n > 2048 else 1


def tables_for(lattices: int) -> int:
    """Tables with which a pair at cosine 0.98 is lost less than once in 10,000: one table finds about
    0.91, 0.81, 0.70 of them with one, two, three lattices."""
    return 2 + 2 * lattices


def cells(unit: np.ndarray, label: np.ndarray, tables: int, probes: int, lattices: int) -> np.ndarray:
    """Keys (vectors, tables, cells): a vector's own cell first, then those it probes."""
    n, dim = unit.shape
    matrices, shifts = projections(dim, tables * lattices)
    weights = np.random.default_rng(20240612).integers(1, 2**63, (lattices, 8), dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for t in range(tables):
            keys = np.zeros((n, 1), np.uint64)
            for p in range(lattices):
                y = unit @ matrices[t * lattices + p] / SCALE + shifts[t * lattices + p]
                home = nearest_e8(y)
                points = home[:, None]
                if probes:
                    near = np.argsort(-(y - home) @ neighbours().T, axis=1, kind="stable")[:, :probes]
                    points = np.concatenate([points, home[:, None] + neighbours()[near]], 1)
                code = ((2 * points).astype(np.int64).view(np.uint64) * weights[p]).sum(2, dtype=np.uint64)
                code = T.mix(code + np.uint64(t * 64 + p + 1))
                keys = (keys[:, :, None] * np.uint64(0x9E3779B97F4A7C15) + code[:, None, :]).reshape(n, -1)
            out.append(T.mix(keys + T.mix(label.astype(np.int64).view(np.uint64) + np.uint64(dim))[:, None]))
    return np.stack(out, 1).view(np.int64)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for each vector length in the column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    length = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(length) - length
    for dim in np.unique(length):
        rows = np.flatnonzero(length == dim)
        x = flat[first[rows][:, None] + np.arange(dim)]
        x = x / np.abs(x).max(1, keepdims=True)
        yield rows, x / np.sqrt((x * x).sum(1, keepdims=True))


def _cell_rows(tables: int, probes: int, lattices: int, with_vectors: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                label = part.column("label").to_numpy()
                for rows, unit in _by_length(part.column("embedding")):
                    keys = cells(unit, label[rows], tables, probes, lattices)
                    width = keys.shape[1] * keys.shape[2]
                    if not with_vectors:
                        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1))], names=["cell"])
                        continue
                    copies = pa.array(np.repeat(rows, width))
                    home = np.zeros(keys.shape, bool)
                    home[:, :, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.reshape(-1)), pa.array(home.reshape(-1)),
                         *[part.column(c).take(copies) for c in ("node", "weight", "label", "embedding")]],
                        names=["cell", "home", "node", "weight", "label", "embedding"])
    return run


def _local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes by the pairs."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _count_links(tables: int, probes: int, lattices: int, threshold: float):
    """(node, links, root) of the vectors that link in the partition's cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        col = {c: table.column(c).to_numpy() for c in ("cell", "i", "j", "block", "home", "node", "weight", "label")}
        for rows, unit in _by_length(table.column("embedding").combine_chunks()):
            c = {k: v[rows] for k, v in col.items()}
            order = np.lexsort((c["node"], c["j"], c["i"], c["cell"]))
            c = {k: v[order] for k, v in c.items()}
            unit = unit[order]
            new = np.append(True, (c["cell"][1:] != c["cell"][:-1]) | (c["i"][1:] != c["i"][:-1]) | (c["j"][1:] != c["j"][:-1]))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(new)))
            found_a, found_b, total = [], [], 0
            for f, s in zip(first[size > 1], size[size > 1]):
                g = slice(f, f + s)
                if c["i"][f] == c["j"][f]:
                    cos = unit[g] @ unit[g].T
                    a, b = np.nonzero(np.triu(cos >= threshold, 1))
                else:  # one block against another
                    left, right = np.flatnonzero(c["block"][g] == c["i"][f]), np.flatnonzero(c["block"][g] == c["j"][f])
                    a, b = np.nonzero(unit[f + left] @ unit[f + right].T >= threshold)
                    a, b = left[a], right[b]
                if len(a):
                    found_a.append(a + f)
                    found_b.append(b + f)
                    total += len(a)
                if total > 200_000:
                    yield from _emit(c, unit, np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b, total = [], [], 0
            if total:
                yield from _emit(c, unit, np.concatenate(found_a), np.concatenate(found_b))

    def _emit(c, unit, a, b) -> Iterator[pa.RecordBatch]:
        ok = (c["home"][a] | c["home"][b]) & (c["node"][a] != c["node"][b]) & (c["label"][a] == c["label"][b])
        a, b = a[ok], b[ok]
        rows, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
        keys = cells(unit[rows], c["label"][rows], tables, probes, lattices)
        x, y = inverse[:len(a)], inverse[len(a):]
        meets, open_ = np.zeros(len(a), np.int64), np.ones(len(a), bool)
        for t in range(tables):  # the first table in which the two meet, there the smaller cell
            at = np.flatnonzero(open_)
            if not len(at):
                break
            hx, hy = keys[x[at], t, 0], keys[y[at], t, 0]
            in_y = (keys[y[at], t] == hx[:, None]).any(1)
            in_x = (keys[x[at], t] == hy[:, None]).any(1)
            top = np.iinfo(np.int64).max
            meets[at] = np.minimum(np.where(in_y, hx, top), np.where(in_x, hy, top))
            open_[at] = ~(in_y | in_x)
        here = meets == c["cell"][a]
        a, b, x, y = a[here], b[here], x[here], y[here]
        if not len(a):
            return
        links = np.bincount(x, c["weight"][b], len(rows)) + np.bincount(y, c["weight"][a], len(rows))
        node = c["node"][rows]
        # several rows of one vector (its cells) are one node
        uniq, at = np.unique(node, return_inverse=True)
        root = uniq[_local_roots(at[x], at[y], len(uniq))][at]
        out = links > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[out]), pa.array(links[out].astype(np.int64)), pa.array(root[out])],
            names=["node", "links", "root"])

    return run


def near_dedup(vectors: DataFrame, threshold: float = 0.98, id_col="vec_id", vector_col="embedding",
               label_col="label", tables: int | None = None, probes: int = PROBES, lattices: int | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per input row."""
    x = F.col("embedding")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                          F.col(label_col).cast("long").alias("label"))
    valid = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
             & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
             & F.exists(x, lambda v: v != 0))
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    prints = materialise(rows.select(
        "vec_id", "label", "valid", F.when(F.col("valid"), F.xxhash64("label", "embedding")).alias("h1"),
        F.when(F.col("valid"), F.xxhash64("embedding", "label", F.lit(1))).alias("h2")), "vector_prints")
    # one row per distinct vector; its number is fixed once it is written
    classes = materialise(prints.where("valid").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("weight")).withColumn("node", F.monotonically_increasing_id()), "vector_classes")
    if lattices is None:
        lattices = lattices_for(prints.where("valid").groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    tables = tables or tables_for(lattices)
    # one row of each class: its hash pair again, so that a repeated vec_id cannot bring another vector
    heads = materialise(
        rows.where("valid").withColumns({"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64("embedding", "label", F.lit(1))})
        .join(classes, ["h1", "h2"]).where(F.col("vec_id") == F.col("least"))
        .dropDuplicates(["h1", "h2"]).select("node", "weight", "label", "embedding"), "heads")
    count = heads.count()
    only_keys = heads.select("label", "embedding").mapInArrow(T.frugal(_cell_rows(tables, probes, lattices, False)), "cell bigint")
    hot = materialise(only_keys.groupBy("cell").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK)
                      .select("cell", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")), "hot_cells")
    vector_type = dict(heads.dtypes)["embedding"]
    spread = heads.select("node", "weight", "label", "embedding").mapInArrow(
        T.frugal(_cell_rows(tables, probes, lattices, True)),
        f"cell bigint, home boolean, node bigint, weight bigint, label bigint, embedding {vector_type}")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (spread.join(hot, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("block", block)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other"))
    per_vector = tables * (probes + 1) ** lattices
    tasks = max(1, -(-count * per_vector // ROWS_PER_TASK))
    links = materialise(spread.repartition(tasks, "cell", "i", "j").mapInArrow(
        T.frugal(_count_links(tables, probes, lattices, threshold)), "node bigint, links bigint, root bigint"), "links")
    roots = materialise(components(links.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector_components"), "vector_roots")
    names = (roots.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component_id")))
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.join(sums, "node", "left").join(roots.join(names, "root"), "node", "left")
             .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component_id", "least").alias("component_id")))
    out = prints.join(named, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (
  select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n
  from embeddings where label is not null and embedding is not null
), l as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), r as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from r join l on r.b = l.a
), c as (select a as vec_id, min(b) as component_id from r group by a),
n as (select a as vec_id, count(*) as n_links from l group by a)
select c.vec_id, coalesce(n_links, 0) as n_links, component_id, c.vec_id = component_id as kept
from c left join n on c.vec_id = n.vec_id
"""
