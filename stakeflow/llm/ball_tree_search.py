"""Ranked lexical search: exact maximum inner product over sparse ball trees.

A document is a sparse vector over the terms of the queries: its component for a
term is ``(10^9 tf) div (1000 tf + 20 m)``.  A query is the vector of its terms'
weights, and the score is their inner product in integers.

Every task cuts its documents into shards of bounded size and builds a ball tree
over each: a node is split along the line between two far apart documents, and
keeps its centroid, its radius and the terms that occur below it.  No document
of a node scores more than ``q . centroid + |q'| * radius``, where ``q'`` is the
query on the terms of the node; the bound is raised by more than what rounding
can take from it.  A query visits nodes best bound first, scores the documents
of the leaves it reaches in integers, and stops as soon as the best bound left
is below the score of its last place, which it carries from shard to shard.
Each task returns at most ``k`` rows per query; these are merged in two steps.

Queries are handled in groups with a checked number of queries and terms, so
what goes to the tasks is bounded however many queries there are; each group
reads the documents once.

Defined results: a null text has no terms; rows repeating a ``doc_id`` are
separate documents; at equal scores a null ``doc_id`` comes last; rows repeating
an ``item_id`` are one item with the terms of all; items without terms or without
a matching document give no rows; other columns are ignored; empty tables give
no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.llm import textnum as X
from stakeflow.llm.tables import materialise, read

K = 50
#: Most queries of a group, and most (query, term) pairs of a group with several queries.
GROUP_ITEMS, GROUP_PAIRS = 512, 16_384
#: Documents and components of a shard; documents of a leaf; entries of all centroids of a tree.
SHARD_DOCS, SHARD_ENTRIES, LEAF_DOCS, CENTROID_ENTRIES = 8192, 2_000_000, 64, 4_000_000
#: First merge of the tasks' rows: so many parts per query.
MERGE_PARTS = 32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The bytes that part terms: ASCII but digits and letters.
PARTS = np.zeros(256, bool)
PARTS[:128] = True
PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


@dataclass
class Queries:
    """One group: item ids, distinct terms, and (item, term) pairs sorted by item."""

    items: pa.Array
    terms: list[bytes]
    pair_item: np.ndarray
    pair_term: np.ndarray

    @staticmethod
    def of(rows: pa.Table) -> Queries:
        number: dict[bytes, int] = {}
        items, pair_item, pair_term = [], [], []
        for i, terms in enumerate(rows.column("terms").to_pylist()):
            items.append(rows.column("item_id")[i].as_py())
            for t in terms:
                pair_item.append(i)
                pair_term.append(number.setdefault(t.encode(), len(number)))
        kind = rows.schema.field("item_id").type
        return Queries(pa.array(items, kind), list(number), np.array(pair_item, np.int64), np.array(pair_term, np.int64))


class TermFinder:
    """Finds the given terms among the words of a run of texts."""

    def __init__(self, terms: list[bytes]):
        raw = np.frombuffer(b"".join(terms), np.uint8)
        self.size = np.array([len(t) for t in terms], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.raw = raw
        hashes = X.span_hash(raw, self.first, self.first + self.size)
        self.order = np.argsort(hashes, kind="stable")
        self.hash = hashes[self.order]

    def find(self, data: np.ndarray, w: X.Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, term) of every word that is one of the terms; hashes propose, bytes decide."""
        text, term = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = np.searchsorted(self.hash, w.hash)
        live = np.flatnonzero(at < len(self.hash))
        while len(live):  # more than one round only where terms share a hash
            live = live[self.hash[at[live]] == w.hash[live]]
            t = self.order[at[live]]
            fits = np.flatnonzero(self.size[t] == w.end[live] - w.start[live])
            own, t = live[fits], t[fits]
            if len(own):
                n = self.size[t]
                end = np.cumsum(n)
                step = np.arange(end[-1])
                alike = data[step + np.repeat(w.start[own] - (end - n), n)] == self.raw[step + np.repeat(self.first[t] - (end - n), n)]
                same = np.logical_and.reduceat(alike, end - n)
                text.append(w.doc[own[same]])
                term.append(t[same])
            at[live] += 1
            live = live[at[live] < len(self.hash)]
        return np.concatenate(text), np.concatenate(term)


def _hits(queries: Queries):
    """Documents with a term: ``doc_id, n, terms, tfs`` (of the terms of the queries)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, width = TermFinder(queries.terms), len(queries.terms)
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, data, off in X.chunks(batch.column("text")):
                data = X.lowered(data)
                w = X.words(data, off, PARTS)
                n = w.count()
                text, term = finder.find(data, w)
                key, tf = np.unique(text * width + term, return_counts=True)
                has = np.flatnonzero(n > 0)
                per = np.bincount(key // width, minlength=j - i)[has]
                edges = pa.array(np.append(0, np.cumsum(per)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).take(pa.array(has)), pa.array(n[has]),
                     pa.ListArray.from_arrays(edges, pa.array((key % width).astype(np.int32))),
                     pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])
    return run


def _document_counts(width: int):
    """``term, df`` of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=width)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(df[term])], names=["term", "df"])
    return run


@dataclass
class Sparse:
    """Rows of a shard: entries ``first[i]:first[i + 1]`` of row i."""

    first: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry numbers of the rows, where each row begins among them); no row is empty."""
        size = self.first[rows + 1] - self.first[rows]
        end = np.cumsum(size)
        return np.arange(end[-1]) + np.repeat(self.first[rows] - (end - size), size), end - size

    def take(self, rows: np.ndarray) -> Sparse:
        at, begin = self.entries(rows)
        return Sparse(np.append(begin, len(at)), self.term[at], self.value[at])


@dataclass
class BallTree:
    """Nodes: rows ``start:end`` of ``docs``, children (0: none), centroid, radius and terms below."""

    docs: Sparse
    order: np.ndarray
    start: list[int]
    end: list[int]
    child: list[int]
    centroid: np.ndarray
    radius: np.ndarray
    present: np.ndarray

    @staticmethod
    def of(docs: Sparse, width: int, leaf: int) -> BallTree:
        count = len(docs.first) - 1
        value = docs.value.astype(np.float64)
        square = np.add.reduceat(value * value, docs.first[:-1])
        order = np.arange(count)
        start, end, child, centroid, radius, present = [0], [count], [0], [], [], []
        node = 0
        while node < len(start):
            rows = order[start[node]:end[node]]
            at, begin = docs.entries(rows)
            term, x = docs.term[at], value[at]

            def dot(v):
                return np.add.reduceat(x * v[term], begin)

            def dense(row):
                v = np.zeros(width)
                v[docs.term[docs.first[row]:docs.first[row + 1]]] = value[docs.first[row]:docs.first[row + 1]]
                return v

            total = np.bincount(term, x, width)
            mean = total / len(rows)
            size = float(mean @ mean)
            away = square[rows] - 2 * dot(mean) + size
            # the three summands lose less than a part in 10^12 of their sizes
            radius.append(math.sqrt(max(0.0, float(away.max())) + 1e-11 * (float(square[rows].max()) + size)))
            centroid.append(mean)
            present.append(total > 0)
            if len(rows) > leaf:
                a = dense(rows[away.argmax()])
                far = square[rows] - 2 * dot(a)
                line = a - dense(rows[far.argmax()])
                half = len(rows) // 2
                order[start[node]:end[node]] = rows[np.argpartition(dot(line), half)]
                middle = start[node] + half
                child[node] = len(start)
                start += [start[node], middle]
                end += [middle, end[node]]
                child += [0, 0]
            node += 1
        return BallTree(docs.take(order), order, start, end, child, np.array(centroid), np.array(radius), np.array(present))


class Search:
    """The best ``k`` rows of every query so far, and the walks that find them."""

    def __init__(self, queries: Queries, weight: np.ndarray, k: int):
        self.q, self.k = queries, k
        self.count, self.width = len(queries.items), len(queries.terms)
        self.pair_weight = weight[queries.pair_term]
        self.first = np.searchsorted(queries.pair_item, np.arange(self.count + 1))
        self.need = np.zeros(self.count, np.int64)  # the score of the last place, 0 while there is room
        self.pool = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * self.count
        self.scored = 0

    def bounds(self, tree: BallTree) -> np.ndarray:
        """(queries, nodes): no document below the node scores more."""
        w = self.pair_weight.astype(np.float64)
        inner = np.add.reduceat(tree.centroid[:, self.q.pair_term] * w, self.first[:-1], axis=1)
        norm = np.sqrt(np.add.reduceat(tree.present[:, self.q.pair_term] * (w * w), self.first[:-1], axis=1))
        return ((inner + norm * tree.radius[:, None]) * (1 + 1e-9) + 1).T

    def shard(self, ids: np.ndarray, unnamed: np.ndarray, tree: BallTree) -> None:
        """Search one tree; ``ids`` and ``unnamed`` (null ids) belong to its rows as they were given."""
        bounds = self.bounds(tree)
        ids, unnamed = ids[tree.order], unnamed[tree.order]
        weights = np.zeros(self.width, np.int64)
        for item in range(self.count):
            bound = bounds[item]
            if bound[0] < max(self.need[item], 1):
                continue
            pairs = slice(self.first[item], self.first[item + 1])
            weights[self.q.pair_term[pairs]] = self.pair_weight[pairs]
            self._walk(item, bound.tolist(), weights, tree, ids, unnamed)
            weights[self.q.pair_term[pairs]] = 0

    def _walk(self, item: int, bound: list[float], weights: np.ndarray, tree: BallTree, ids, unnamed) -> None:
        heap, wave = [(-bound[0], 0)], 1
        while heap and -heap[0][0] >= max(self.need[item], 1):
            leaves = []
            while heap and len(leaves) < wave and -heap[0][0] >= max(self.need[item], 1):
                node = heapq.heappop(heap)[1]
                child = tree.child[node]
                if child:
                    for c in (child, child + 1):
                        heapq.heappush(heap, (-min(bound[c], bound[node]), c))
                        bound[c] = min(bound[c], bound[node])
                else:
                    leaves.append(node)
            wave = min(2 * wave, 8)
            for node in leaves:
                self._score(item, weights, tree, tree.start[node], tree.end[node], ids, unnamed)

    def _score(self, item: int, weights: np.ndarray, tree: BallTree, start: int, end: int, ids, unnamed) -> None:
        first = tree.docs.first
        a, b = first[start], first[end]
        score = np.add.reduceat(tree.docs.value[a:b] * weights[tree.docs.term[a:b]], first[start:end] - a)
        self.scored += end - start
        at = np.flatnonzero(score >= max(self.need[item], 1))
        if not len(at):
            return
        pool = [np.concatenate(x) for x in zip(self.pool[item], (score[at], unnamed[start + at], ids[start + at]))]
        best = np.lexsort((pool[2], pool[1], -pool[0]))[:self.k]
        self.pool[item] = tuple(x[best] for x in pool)
        if len(best) == self.k:
            self.need[item] = self.pool[item][0][-1]


def _search(queries: Queries, weight: np.ndarray, documents: int, words: int, k: int):
    """The best ``k`` rows of each query among the documents of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(queries, weight, k)
        width = len(queries.terms)
        leaf = max(LEAF_DOCS, 2 * SHARD_DOCS * width // CENTROID_ENTRIES)
        kind, held, docs, entries = None, [], 0, 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            n = table.column("n").to_numpy()
            lengths, inverse = np.unique(n, return_inverse=True)
            # in Python's integers: the product may leave 64 bits
            m = np.array([100 - 50 + 50 * x * documents // words for x in lengths.tolist()], np.int64)[inverse]
            terms = table.column("terms").combine_chunks()
            size = terms.value_lengths().to_numpy()
            tf = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            value = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(m, size))
            rows = Sparse(np.append(0, np.cumsum(size)), terms.flatten().to_numpy().astype(np.int64), value)
            ids = table.column("doc_id").combine_chunks()
            search.shard(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), BallTree.of(rows, width, leaf))

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                part = part.filter(pa.compute.greater(pa.compute.list_value_length(part.column("terms")), 0))
                if part.num_rows:
                    held.append(part)
                    docs += part.num_rows
                    entries += len(part.column("terms").flatten())
                if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
                    flush()
                    held, docs, entries = [], 0, 0
        if docs:
            flush()
        part = TaskContext.get().partitionId()
        for item, (score, unnamed, ids) in enumerate(search.pool):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [queries.items.take(pa.array(np.full(len(score), item))), pa.array(ids, kind, mask=unnamed), pa.array(score),
                     pa.array(np.full(len(score), part % MERGE_PARTS, np.int32))], names=["item_id", "doc_id", "score", "part"])
    return run


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, terms``: the distinct terms of each item, for items with any."""
    lower = F.translate(F.col(text_col), _UPPER, _LOWER)
    return (items.select(F.col(id_col).alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(f"({TERM})"), F.lit(1))).alias("term"))
            .distinct().groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")))


def _groups(terms: DataFrame) -> tuple[DataFrame, int]:
    """The items with ``grp``: as many groups as it takes for each to keep its bounds."""
    sized = terms.select("item_id", F.size("terms").alias("pairs"))
    total = sized.agg(F.count("*"), F.sum("pairs")).first()
    groups = max(1, -(-total[0] // GROUP_ITEMS), -(-(total[1] or 0) // GROUP_PAIRS))
    while True:
        group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
        over = sized.groupBy(group).agg(F.count("*").alias("i"), F.sum("pairs").alias("p")).where(
            (F.col("i") > GROUP_ITEMS) | ((F.col("i") > 1) & (F.col("p") > GROUP_PAIRS)))
        if over.isEmpty():
            return terms.withColumn("grp", group), groups
        groups *= 2


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    terms, groups = _groups(materialise(item_terms(items, item_id, item_text), "item_terms"))
    item_type = dict(terms.dtypes)["item_id"]
    schema = f"item_id {item_type}, doc_id bigint, score bigint, part int"
    out = docs.sparkSession.createDataFrame([], T._parse_datatype_string(schema))
    for g in range(groups):
        queries = Queries.of(terms.where(F.col("grp") == g).select("item_id", "terms").toArrow())
        if not len(queries.items):
            continue
        width = len(queries.terms)
        hits = materialise(rows.where(F.col("text").isNotNull()).mapInArrow(
            X.frugal(_hits(queries)), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"), "term_hits")
        documents, words = hits.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(width, np.int64)
        counts = hits.select("terms").mapInArrow(_document_counts(width), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
        for r in counts.collect():  # at most one row per term of the group
            df[r.term] = r.df
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found = hits.mapInArrow(X.frugal(_search(queries, weight, documents, words or 1, k)), schema)
        out = out.union(materialise(_best(found, ["item_id", "part"], k).select("item_id", "doc_id", "score", "part"), "ranked"))
    return _best(out, ["item_id"], k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = f"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') as t from documents
), g as (select count(*) as docs, sum(len(t)) as words from d where len(t) > 0),
e as (select r, doc_id, len(t) as n, unnest(t) as term from d),
tf as (select r, doc_id, n, term, count(*) as tf from e group by all),
i as (select distinct item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) as term from benchmark),
w as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from tf, g group by term, docs
), s as (
  select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::bigint as score
  from i join tf using (term) join w using (term), g group by item_id, r, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
from s where score > 0
qualify rank <= 50
"""
