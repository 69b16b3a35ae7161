"""Best-fit packing of documents into training sequences, by large-item matching.

Every document is tokenised, closed by an end id, and cut into pieces of the
sequence length only where it is longer.  Which pieces share a sequence depends
on their lengths alone, so the plan is made on the histogram of lengths, which
has at most ``capacity`` rows at any input size:

* Pieces above a third of the capacity go at most two to a sequence.  From the
  largest down, each takes the largest such partner that still fits.
* Smaller pieces, from the largest down, go where the gap is smallest.  Pieces
  of one length and sequences of one gap are handled together, so the plan is a
  short list of runs: ranks ``[a, b)`` of length ``l`` go to sequences from
  ``s``, ``k`` in each, at offset ``o``.

Each piece then finds its run by its rank among the pieces of its length: its
place inside its task, counted while tokenising, plus the pieces of that length
in earlier tasks, a running sum over (length, task).  No sequence, length or
document is ever gathered in one task, and the plan is the same as if one
process had placed the pieces one by one.

Defined results: a null or empty text is one piece with the end id alone; rows
repeating a ``doc_id`` are separate documents, a null ``doc_id`` is kept as it
is; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.llm import bpe
from stakeflow.llm.tables import materialise, read
from stakeflow.llm.textnum import frugal

CAPACITY = 2048
END_ID = 0
#: Runs of the plan that go to the tasks at once (48 bytes each).
PLAN_ROWS = 200_000
#: Ranks of one length stay below this power of two.
RANK_BITS = 48


@dataclass
class Plan:
    """Runs ``(length, first rank, pieces, first sequence, pieces in each sequence, offset)``."""

    capacity: int
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def plan_sequences(histogram: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the pieces of each length go."""
    plan = Plan(capacity)
    left = [0] * (capacity + 1)
    for length, n in histogram.items():
        left[length] = n
    rank = [0] * (capacity + 1)
    groups: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many)
    gaps: list[int] = []

    def give(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in groups:
                bisect.insort(gaps, gap)
            groups.setdefault(gap, []).append((first, n))

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        plan.runs.append((length, rank[length], n * each, first, each, offset))
        rank[length] += n * each
        left[length] -= n * each

    def opened(n: int) -> int:
        plan.sequences += n
        return plan.sequences - n

    third = capacity // 3
    for a in range(capacity, third, -1):
        b = min(a, capacity - a)
        while left[a]:
            while b > third and left[b] < (2 if a == b else 1):
                b -= 1
            if b <= third:
                n = left[a]
                first = opened(n)
                put(a, n, first, 1, 0)
                give(capacity - a, first, n)
            else:
                n = left[a] // 2 if a == b else min(left[a], left[b])
                first = opened(n)
                put(a, n, first, 1, 0)
                put(b, n, first, 1, a)
                give(capacity - a - b, first, n)
    for s in range(third, 0, -1):
        while left[s]:
            at = bisect.bisect_left(gaps, s)
            if at < len(gaps):
                gap = gaps[at]
                first, n = groups[gap].pop()
                if not groups[gap]:
                    del groups[gap], gaps[at]
            else:
                gap = capacity
                n = -(-left[s] // (capacity // s))
                first = opened(n)
            each = gap // s
            full = min(n, left[s] // each)
            if full:
                put(s, full, first, each, capacity - gap)
                give(gap - each * s, first, full)
            if full < n and left[s]:
                rest = left[s]
                put(s, 1, first + full, rest, capacity - gap)
                give(gap - rest * s, first + full, 1)
                full += 1
            give(gap, first + full, n - full)
    return plan


def _cut(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    """Batches of ``doc_id, text`` become pieces; ``nth`` counts the pieces of a length in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = bpe.vocabulary(bpe.local_file(tokenizer))
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for i, j, ids, count in bpe.encoded_runs(vocab, batch.column("text")):
                end = np.cumsum(count)
                ids = np.insert(ids, end, end_id).astype("<u4")
                count = count + 1
                pieces = -(-count // capacity)
                doc = np.repeat(np.arange(j - i), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(count[doc] - start, capacity)
                edges = np.append(0, np.cumsum(length))
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in itertools.pairwise(edges.tolist())]
                order = np.argsort(length, kind="stable")
                size = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(size) - size, size)
                nth += seen[length]
                seen += size
                columns = [batch.column("doc_id").slice(i, j - i).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array(np.array(crc, np.int64)),
                           pa.array(np.full(len(doc), part, np.int32)), pa.array(nth)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=_names(with_ids))
    return run


def _names(with_ids: bool) -> list[str]:
    return ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * with_ids


def _place(runs: np.ndarray):
    """Batches with ``length, rank`` get ``sequence_id, offset``."""
    keys = runs[:, 0] << RANK_BITS | runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            own = runs[np.searchsorted(keys, length << RANK_BITS | rank, "right") - 1]
            i = rank - own[:, 1]
            sequence = own[:, 3] + i // own[:, 4]
            offset = own[:, 5] + i % own[:, 4] * length
            out = batch.drop_columns(["rank"])
            yield out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece (``with_ids``: and its ``ids``)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [rows.schema["doc_id"].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.IntegerType(),
             T.LongType()] + [T.ArrayType(T.IntegerType())] * with_ids
    schema = T.StructType([T.StructField(n, k) for n, k in zip(_names(with_ids), kinds)])
    pieces = materialise(rows.mapInArrow(frugal(_cut(tokenizer, capacity, end_id, with_ids)), schema), "pieces")
    counts = materialise(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(plan_sequences(histogram, capacity).runs), np.int64).reshape(-1, 6)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = (pieces.join(base.hint("shuffle_hash"), ["part", "length"])
              .withColumn("rank", F.col("base") + F.col("nth")).drop("part", "base", "nth"))
    out_schema = T.StructType([*ranked.drop("rank").schema, T.StructField("sequence_id", T.LongType()),
                               T.StructField("offset", T.LongType())])
    # few runs: one pass; else the lengths are placed in bounded shares of the plan
    edges = [0, *(np.searchsorted(runs[:, 0], runs[k, 0]) for k in range(PLAN_ROWS, len(runs), PLAN_ROWS)), len(runs)]
    placed = None
    for a, b in itertools.pairwise(sorted({int(e) for e in edges})):
        share = ranked if b - a == len(runs) else ranked.where(F.col("length").between(int(runs[a, 0]), int(runs[b - 1, 0])))
        part = share.mapInArrow(frugal(_place(runs[a:b])), out_schema)
        placed = part if placed is None else placed.union(part)
    if placed is None:  # no document
        placed = ranked.mapInArrow(_place(runs), out_schema)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(*columns, *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_starts``: the token ids of every sequence and the offsets at which its pieces
    begin, from ``pack(..., with_ids=True)``.  A group is one sequence, so it is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("doc_starts")))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), bpe.PUBLIC)
