"""Substring dedup with suffix automata of reference shards.

A window of ``size`` words is removed where its words also start earlier in the
corpus.  Windows meet through anchors: the least hashed ``size // 2``-gram of a
window depends on its words alone, so equal windows have equal anchors.  A run
of windows with one anchor is a *piece*.

* **Broadcast reference.**  Pieces that a bounded sample of documents shows to
  be very common form the reference whose suffix automaton goes to every task
  (its size is bounded by the sample).  Documents are streamed through it; the
  first place of each reference window is a partial minimum per task, so what
  many documents share never meets in one task.
* **Reference shards.**  All other pieces are dealt by anchor.  The first
  occurrence of each distinct piece is its reference; later equal pieces are
  repeats as a whole.  Where an anchor has several distinct pieces, their words
  are dealt by anchor too, and each shard streams them in corpus order through
  the automaton of the earlier ones: matching statistics of at least ``size``
  words mark the repeated windows.  (A broadcast of all shards to all documents
  would cost the square of the corpus, so the documents' pieces go to the one
  shard that can match them.)
* Documents then meet their repeated spans and drop the covered words.

Texts move compressed, twice.  Pieces compare by 128-bit hashes.

Defined results: a null text has no words; rows repeating a ``doc_id`` with
equal text are one document and each gets the same result, with other texts
they are separate documents in the order of a 64-bit hash of the text (which
also tells them apart; it plays no part where ids are unique); a null ``doc_id``
comes before all others; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.suffix_automaton import SuffixAutomaton
from stakeflow.llm.tables import materialise, read

SAMPLED_DOCS = 16_384
COMMON_IN_SAMPLE = 32
#: Text of the broadcast reference, and anchors known to be common, at most.
REFERENCE_BYTES = 2 << 20
COMMON_ANCHORS = 500_000
#: Piece rows that one task sorts in memory.
ROWS_PER_TASK = 500_000
#: Words of references that one shard's automaton holds at once (single anchors may exceed it).
SHARD_WORDS = 50_000


class Reference:
    """Broadcast part: automaton of the common pieces, their window hashes and the common anchors."""

    def __init__(self, texts: list[bytes], anchors: list[int], size: int):
        self.size = size
        self.automaton = SuffixAutomaton()
        hashes = [np.zeros(0, np.uint64)]
        for text in sorted(set(texts)):
            self.automaton.add(text.split())
            data = np.frombuffer(text, np.uint8)
            hashes.append(T.words(data, np.array([0, len(data)])).grams(size)[1])
        self.hashes = np.unique(np.concatenate(hashes))
        self.anchors = np.sort(np.array(anchors, np.int64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _windows(data: np.ndarray, off: np.ndarray, size: int):
    """Words; start (word index), hash and anchor position and hash of every window."""
    w = T.words(data, off)
    at, hashes = w.grams(size)
    if not len(at):
        return w, at, hashes, at, hashes.view(np.int64)
    k = size // 2
    n = len(w.hash) - k + 1
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams += w.hash[j:j + n] * T._STEP[32 + j]
    grams = T.mix(grams)
    lowest = sliding_window_view(grams, size - k + 1)[at].argmin(1)
    place = at + lowest
    return w, at, hashes, place, grams[place].view(np.int64)


def _pieces(size: int, reference: Reference | None):
    """(key, ph, doc_id, th, start, cnt) of the runs of windows with one anchor, without those of the
    broadcast reference; a window whose anchor is common stands alone under its own hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in T.chunks(batch.column("text")):
                w, at, hashes, place, anchor = _windows(data, off, size)
                single = np.zeros(len(at), bool)
                if reference is not None and len(at):
                    left = ~_among(hashes, reference.hashes)
                    at, hashes, place, anchor = at[left], hashes[left], place[left], anchor[left]
                    single = _among(anchor, reference.anchors)
                if not len(at):
                    continue
                new = np.ones(len(at), bool)
                new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1) | single[1:] | single[:-1]
                first = np.flatnonzero(new)
                cnt = np.diff(np.append(first, len(at)))
                last = hashes[first + cnt - 1]
                with np.errstate(over="ignore"):
                    ph = T.mix(hashes[first] + T.mix(last + cnt.astype(np.uint64))).view(np.int64)
                key = np.where(single[first], hashes[first].view(np.int64), anchor[first])
                ph = np.where(single[first], anchor[first], ph)
                doc = w.doc[at[first]]
                rows = pa.array(i + doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ph), batch.column("doc_id").take(rows), batch.column("th").take(rows),
                     pa.array((at[first] - w.first[doc]).astype(np.int32)), pa.array(cnt.astype(np.int32))],
                    names=["key", "ph", "doc_id", "th", "start", "cnt"])
    return run


_PIECE = "key bigint, ph bigint, doc_id bigint, th bigint, start int, cnt int"


def _reference_windows(reference: Reference):
    """Per text with windows of the broadcast reference: (row, [(start, state)])."""
    def run(column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        size = reference.size
        for i, _, data, off in T.chunks(column):
            w, at, hashes, _, _ = _windows(data, off, size)
            at = at[_among(hashes, reference.hashes)]
            if not len(at):
                continue
            begin = np.append(True, (at[1:] != at[:-1] + 1) | (w.doc[at[1:]] != w.doc[at[:-1]]))
            runs = np.flatnonzero(begin)
            ends = np.append(runs[1:], len(at))
            found: dict[int, list[tuple[int, int]]] = {}
            for a, b in zip(at[runs], at[ends - 1]):
                doc = int(w.doc[a])
                words = [bytes(data[s:e]) for s, e in zip(w.start[a:b + size], w.end[a:b + size])]
                base = int(a - w.first[doc])
                found.setdefault(doc, []).extend(
                    (base + s, state) for s, state in reference.automaton.windows(words, size))
            for doc, hits in found.items():
                yield i + doc, hits
    return run


def _first_places(reference: Reference):
    """(state, doc_id, th, start): the first place of each reference window in the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = _reference_windows(reference)
        for batch in batches:
            ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            first: dict[int, tuple] = {}
            for row, hits in matches(batch.column("text")):
                for start, state in hits:
                    place = (ids[row], ths[row], start)
                    if state not in first or place < first[state]:
                        first[state] = place
            if first:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(first), pa.int32()), *[pa.array([p[c] for p in first.values()], t)
                     for c, t in enumerate((pa.int64(), pa.int64(), pa.int32()))]],
                    names=["state", "doc_id", "th", "start"])
    return run


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    """(start, count) of the runs of consecutive numbers."""
    out: list[list[int]] = []
    for s in sorted(set(starts)):
        if out and s == out[-1][0] + out[-1][1]:
            out[-1][1] += 1
        else:
            out.append([s, 1])
    return [tuple(x) for x in out]


def _reference_spans(reference: Reference, first: dict[int, tuple]):
    """(doc_id, th, start, cnt): windows of the broadcast reference anywhere but at their first place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = _reference_windows(reference)
        for batch in batches:
            ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            rows = []
            for row, hits in matches(batch.column("text")):
                later = [s for s, state in hits if (ids[row], ths[row], s) != first[state]]
                rows += [(ids[row], ths[row], s, n) for s, n in _runs(later)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                    names=["doc_id", "th", "start", "cnt"])
    return run


_SPAN = "doc_id bigint, th bigint, start int, cnt int"


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that occur earlier as they are (``fresh`` false), and first occurrences of pieces whose
    anchor has others (``fresh`` true)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    key, ph, doc, th, start, cnt = (table.column(c).to_numpy() for c in ("key", "ph", "doc_id", "th", "start", "cnt"))
    order = np.lexsort((start, th, doc, ph, key))
    key, ph, doc, th, start, cnt = (x[order] for x in (key, ph, doc, th, start, cnt))
    new_key = np.append(True, key[1:] != key[:-1])
    new_piece = new_key | np.append(True, ph[1:] != ph[:-1])
    head = np.maximum.accumulate(np.where(new_piece, np.arange(len(key)), 0))
    is_first = (doc == doc[head]) & (th == th[head]) & (start == start[head])
    group = np.cumsum(new_key) - 1
    contested = np.bincount(group, new_piece)[group] > 1
    fresh = new_piece & contested
    keep = ~is_first | fresh
    yield pa.RecordBatch.from_arrays(
        [pa.array(x[keep]) for x in (key, doc, th, start, cnt, fresh)],
        names=["key", "doc_id", "th", "start", "cnt", "fresh"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [squeeze.compress((t.as_py() or "").encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(packed, pa.binary())],
                                         names=["doc_id", "th", "packed"])


def _cut_pieces(size: int):
    """(key, doc_id, th, start, words) of the pieces asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "doc_id", "th", "start", "words")}
            for r in range(batch.num_rows):
                words = unpack.decompress(batch.column("packed")[r].as_py()).split()
                for piece in batch.column("asked")[r].as_py():
                    out["key"].append(piece["key"])
                    out["doc_id"].append(batch.column("doc_id")[r].as_py())
                    out["th"].append(batch.column("th")[r].as_py())
                    out["start"].append(piece["start"])
                    out["words"].append(b" ".join(words[piece["start"]:piece["start"] + piece["cnt"] + size - 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["key"], pa.int64()), pa.array(out["doc_id"], pa.int64()), pa.array(out["th"], pa.int64()),
                 pa.array(out["start"], pa.int32()), pa.array(out["words"], pa.binary())], names=list(out))
    return run


def _shard_spans(size: int):
    """Streams the pieces of a shard, in corpus order for each anchor, through the automaton of the
    earlier ones.  Equal rows of a document give each piece again: only the first counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, held, now, last = SuffixAutomaton(), 0, None, None
        for batch in batches:
            rows = []
            for key, doc, th, start, text in zip(*[batch.column(c).to_pylist() for c in
                                                   ("key", "doc_id", "th", "start", "words")]):
                if (key, doc, th, start) == last:
                    continue
                last = key, doc, th, start
                if key != now and held > SHARD_WORDS:
                    automaton, held = SuffixAutomaton(), 0
                now = key
                words = text.split()
                known = [s for s, _ in automaton.windows(words, size)]
                rows += [(doc, th, start + s, n) for s, n in _runs(known)]
                if len(known) < len(words) - size + 1:
                    automaton.add(words)
                    held += len(words)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                    names=["doc_id", "th", "start", "cnt"])
    return run


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, total, removed = [], [], []
            for packed, spans in zip(batch.column("packed"), batch.column("spans")):
                words = unpack.decompress(packed.as_py()).split()
                total.append(len(words))
                if spans.is_valid:
                    gone = np.zeros(len(words) + 1, np.int32)
                    for span in spans.as_py():
                        gone[span["start"]] += 1
                        gone[span["start"] + span["cnt"] + size - 1] -= 1
                    stay = np.cumsum(gone)[:-1] == 0
                    words = [w for w, s in zip(words, stay) if s]
                kept.append(b" ".join(words))
                removed.append(total[-1] - len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def _up_to(rows: DataFrame, measure, weight, limit: int, largest: bool = False) -> DataFrame:
    """The rows of the smallest (``largest``: the largest) measures whose weights add up to ``limit`` at most,
    cut between two powers of two: one row per power reaches the driver."""
    power = F.floor(F.log2(measure)).cast("int")
    held, cut = 0, None
    for r in rows.groupBy(power.alias("p")).agg(F.sum(weight).alias("w")).orderBy(F.desc("p") if largest else "p").collect():
        held += r.w
        if held > limit:
            cut = r.p
            break
    return rows if cut is None else rows.where(power > cut if largest else power < cut)


def broadcast_reference(rows: DataFrame, size: int) -> Reference | None:
    """Reference of the pieces that many sampled documents hold, within its bounds."""
    share = max(1, rows.count() // SAMPLED_DOCS)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(share)) == 0)
    pieces = materialise(sample.mapInArrow(T.frugal(_pieces(size, None)), _PIECE), "sampled_pieces")
    common = (pieces.groupBy("key", "ph").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "start", "cnt")).alias("p"))
              .where(F.col("c") >= COMMON_IN_SAMPLE).select("key", "p.*"))
    asked = common.groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "start", "cnt")).alias("asked"))
    texts = materialise(sample.mapInArrow(T.frugal(_pack), "doc_id bigint, th bigint, packed binary").join(asked, ["doc_id", "th"])
                        .mapInArrow(T.frugal(_cut_pieces(size)), "key bigint, doc_id bigint, th bigint, start int, words binary")
                        .select("words").distinct(), "common_pieces")
    texts = [bytes(r["words"]) for r in _up_to(texts, F.octet_length("words"), F.octet_length("words"), REFERENCE_BYTES).collect()]
    anchors = materialise(pieces.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= COMMON_IN_SAMPLE), "common_anchors")
    anchors = [r["key"] for r in _up_to(anchors, F.col("c"), F.lit(1), COMMON_ANCHORS, largest=True).collect()]
    return Reference(texts, anchors, size) if anchors else None


def repeated_spans(rows: DataFrame, size: int) -> DataFrame:
    """``doc_id, th, start, cnt``: runs of ``cnt`` windows from word ``start`` on that also start earlier."""
    reference = broadcast_reference(rows, size)
    pieces = rows.mapInArrow(T.frugal(_pieces(size, reference)), _PIECE)
    tasks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (24 * ROWS_PER_TASK)))
    repeats = materialise(pieces.repartition(tasks, "key").mapInArrow(
        T.frugal(_repeats), "key bigint, doc_id bigint, th bigint, start int, cnt int, fresh boolean"), "repeats")
    asked = (repeats.where("fresh").groupBy("doc_id", "th")
             .agg(F.collect_list(F.struct("key", "start", "cnt")).alias("asked")))
    shards = (rows.mapInArrow(T.frugal(_pack), "doc_id bigint, th bigint, packed binary").join(asked.hint("shuffle_hash"), ["doc_id", "th"])
              .mapInArrow(T.frugal(_cut_pieces(size)), "key bigint, doc_id bigint, th bigint, start int, words binary")
              .repartition(tasks, "key").sortWithinPartitions("key", "doc_id", "th", "start")
              .mapInArrow(T.frugal(_shard_spans(size)), _SPAN))
    spans = repeats.where(~F.col("fresh")).select("doc_id", "th", "start", "cnt").union(shards)
    if reference is not None and len(reference.hashes):
        places = (rows.mapInArrow(T.frugal(_first_places(reference)), "state int, doc_id bigint, th bigint, start int")
                  .groupBy("state").agg(F.min(F.struct("doc_id", "th", "start")).alias("p"))
                  .select("state", "p.*").collect())  # one row per state of the bounded automaton
        first = {r["state"]: (r["doc_id"], r["th"], r["start"]) for r in places}
        spans = spans.union(rows.mapInArrow(T.frugal(_reference_spans(reference, first)), _SPAN))
    return spans


def substring_dedup(docs: DataFrame, size: int = 20, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` per input row."""
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(-2**63)).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"),
                       F.col(text_col).alias("text"))
    spans = (repeated_spans(rows, size).groupBy("doc_id", "th")
             .agg(F.collect_list(F.struct("start", "cnt")).alias("spans")))
    return (rows.mapInArrow(T.frugal(_pack), "doc_id bigint, th bigint, packed binary")
            .join(spans.hint("shuffle_hash"), ["doc_id", "th"], "left")
            .mapInArrow(T.frugal(_remove(size)), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
            .withColumn("doc_id", F.when(F.col("doc_id") != -2**63, F.col("doc_id"))))


#: Automata of a broadcast reference by its digest, kept for the next task of the worker.
_SHARDS: dict[str, list[SuffixAutomaton]] = {}


def _automata(digest: str, shards: list[list[bytes]]) -> list[SuffixAutomaton]:
    if digest not in _SHARDS:
        _SHARDS.clear()
        built = []
        for texts in shards:
            automaton = SuffixAutomaton()
            for text in texts:
                automaton.add(text.split())
            built.append(automaton)
        _SHARDS[digest] = built
    return _SHARDS[digest]


def remove_reference(docs: DataFrame, reference: DataFrame, size: int = 20, max_bytes: int = 16 << 20,
                     id_col="doc_id", text_col="text", reference_col="text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: documents without the words that a window of ``size``
    words shares with a given reference (benchmark texts, for instance).

    The reference is broadcast in shards, so its distinct texts may have ``max_bytes`` at most (checked
    before they are collected; more is an error).  Every document is streamed through each shard's
    automaton; nothing is shuffled."""
    texts = reference.select(F.col(reference_col).alias("t")).where("t is not null").distinct()
    held = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if held > max_bytes:
        raise ValueError(f"the reference has {held} bytes; up to {max_bytes} can be broadcast")
    shards, words = [[]], 0
    for text in sorted(r["t"].encode() for r in texts.collect()):
        if words > SHARD_WORDS:
            shards, words = [*shards, []], 0
        shards[-1].append(text)
        words += len(text.split())
    digest = hashlib.md5(repr(shards).encode()).hexdigest()
    broadcast = docs.sparkSession.sparkContext.broadcast(shards)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(digest, broadcast.value)
        for batch in batches:
            total, removed, kept = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words), bool)
                for automaton in automata:
                    for start, count in _runs([s for s, _ in automaton.windows(words, size)]):
                        gone[start:start + count + size - 1] = True
                kept.append(b" ".join(w for w, g in zip(words, gone) if not g))
                total.append(len(words))
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(T.frugal(remove), "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), g as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as gram
  from (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as i from w where len(w) >= 20)
), f as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by gram order by doc_id, i) as n from g) where n > 1
), c as (
  select distinct doc_id, i + o as pos from f, unnest(generate_series(0, 19)) t(o)
), p as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from w
), k as (
  select p.doc_id, count(*) filter (where c.pos is not null) as n_removed,
         string_agg(word, ' ' order by p.pos) filter (where c.pos is null) as kept
  from p left join c on p.doc_id = c.doc_id and p.pos = c.pos group by p.doc_id
)
select w.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from w left join k on w.doc_id = k.doc_id
"""
