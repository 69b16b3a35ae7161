"""N-gram Jaccard join by size-aware heavy-light candidate search.

1. Each document becomes its set of word shingles; equal sets are one class.
2. A first round deals a fixed share of each class's shingles by shingle.  A
   shingle of one class alone links nothing, so a class with more such ones
   than a link may leave out is finished; this ends nearly all documents
   without a near copy.  Only the others' texts move on.
3. Their shingles meet by shingle again, now all of them, for their document
   frequency, and those of two or more classes return to their class.
   Shingles that a bounded sample of documents shows to be very common skip
   these rounds (they would all meet in one task) and count as shared and as
   the most frequent ones; any order is right if it is the same for all.
4. Sets are ordered from rare to frequent shingle.  Linked sets share a shingle
   of their prefixes, and two of their longer prefixes.  Sets up to a size
   boundary enumerate the pairs (fixed-size subsets) of the longer prefix;
   sets above it scan the inverted lists of the prefix shingles, in which
   smaller sets within reach stand too.  The boundary is the one of least cost,
   from sums of both costs by size.
5. Two sets are in reach of each other only if their sizes and the shingles
   that each has alone leave room for the similarity; a list keeps only sets
   with another in reach.  Each set is first held against the list's most
   central set of like size, which ties near copies together without all their
   pairs.  Then all pairs of a list in reach that still lie in different
   components are verified.  So no link between components is lost, whatever
   the lists' lengths.
6. Verification counts the common shingles exactly.

Class keys and shingles are hashes of 64 and 48 bits.

Defined results: a null text or one without words has an empty set, links with
nothing and is its own component; so is every row with a null ``doc_id`` (its
component is null); rows that repeat a ``doc_id`` each have the set of their
own text, and a component's id is the smallest ``doc_id`` in it; other columns
of the input are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.graph import components
from stakeflow.llm.tables import materialise, read

#: Rows that one task of the frequency round sorts in memory.
ROWS_PER_TASK = 500_000
#: Documents sampled to find very common shingles, and in how many of them one has to be.
SAMPLED_DOCS = 16_384
COMMON_IN_SAMPLE = 32
COMMON = 1 << 30
#: Pairs of a list that are left for verification, as a share of its length, against one enumerated subset: most are tied
#: by the central sets and never made (measured: 0.00003 to 0.001).
OPEN_SHARE = 0.001


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text (48 bits)."""
    data = T.lowered(data)
    w = T.words(data, off)
    at, grams = w.grams(k)
    grams >>= np.uint64(16)
    first = np.searchsorted(at, w.first)
    counts = w.count()
    for d in range(len(off) - 1):
        if counts[d] >= k:
            yield np.unique(grams[first[d]:first[d + 1]])
        elif counts[d]:
            whole = T.mix(np.array([sum(int(h) * (2 * i + 3) for i, h in enumerate(
                w.hash[w.first[d]:w.first[d + 1]])) + int(counts[d]) & (2**64 - 1)], np.uint64))
            yield whole >> np.uint64(16)
        else:
            yield np.zeros(0, np.uint64)


def class_key(tokens: np.ndarray) -> int:
    """Hash of a set."""
    with np.errstate(over="ignore"):
        mixed = T.mix(tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(tokens)))
        total = np.uint64(mixed.sum(dtype=np.uint64))
        return int(T.mix(np.array([total ^ np.bitwise_xor.reduce(mixed) << np.uint64(1)], np.uint64))
                   .view(np.int64)[0])


def sampling(percent: int) -> int:
    """One in so many shingles takes part in the first round: well over the share that a link may leave out."""
    return max(1, int(100 / (1.6 * (100 - percent)))) if percent < 100 else 16


def _fingerprints(k: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in T.chunks(batch.column("text")):
                sets = list(shingle_sets(data, off, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([int((s % np.uint64(share) == 0).sum()) for s in sets], pa.int64())],
                    names=["doc_id", "n_shingles", "k", "n_sampled"])
    return run


def _classes(batches: Iterator[pa.RecordBatch], k: int, known: int = 100_000) -> Iterator[tuple[int, np.ndarray]]:
    """(key, set) of each class, in general once per task.  Batches hold ``text``, or ``packed`` and
    the key ``k`` that is asked for."""
    seen: set[int] = set()
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        asked = None
        if "packed" in batch.schema.names:
            asked = batch.column("k").to_pylist()
            texts = pa.array([unpack.decompress(x.as_py()) for x in batch.column("packed")], pa.large_binary())
        else:
            texts = batch.column("text")
        for i, _, data, off in T.chunks(texts):
            for d, s in enumerate(shingle_sets(data, off, k)):
                if not len(s):
                    continue
                key = class_key(s)
                if key in seen or asked is not None and asked[i + d] != key:
                    continue
                if len(seen) >= known:
                    seen.clear()
                seen.add(key)
                yield key, s


def _frequency_of(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Frequency rank of the common tokens, 0 for all others."""
    df = np.zeros(len(tokens), np.int32)
    if len(common):
        place = np.minimum(np.searchsorted(common[:, 0], tokens), len(common) - 1)
        hit = common[place, 0] == tokens
        df[hit] = COMMON + common[place[hit], 1]
    return df


def _in_runs(items: Iterator, size: int = 1000) -> Iterator[list]:
    while run := list(itertools.islice(items, size)):
        yield run


def _token_rows(k: int, common: np.ndarray):
    """(token, k, n, df) of each class; ``df`` is set for common tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _in_runs(_classes(batches, k)):
            sizes = [len(s) for _, s in held]
            flat = np.concatenate([s for _, s in held]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(np.array([key for key, _ in held], np.int64), sizes)),
                 pa.array(np.repeat(np.array(sizes, np.int32), sizes)), pa.array(_frequency_of(flat, common))],
                names=["token", "k", "n", "df"])
    return run


def _sampled_rows(k: int, share: int, common: np.ndarray):
    """(token, k, c) of the sampled share of each class; its common tokens are one row with their
    number, under a token below 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _in_runs(_classes(batches, k)):
            some = [s[s % np.uint64(share) == 0].view(np.int64) for _, s in held]
            keys = np.repeat(np.array([key for key, _ in held], np.int64), [len(s) for s in some])
            flat = np.concatenate(some)
            often = _frequency_of(flat, common) > 0
            once, number = np.unique(keys[often], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([flat[~often], -1 - (once >> 16 & (1 << 47) - 1)])),
                 pa.array(np.concatenate([keys[~often], once])),
                 pa.array(np.concatenate([np.ones((~often).sum()), number]).astype(np.int32))], names=["token", "k", "c"])
    return run


_TOKEN_ROW = "token bigint, k bigint, n int, df int"


def _gathered(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray] | None:
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, shared): a row for each token of a class that other classes have too, so that the number of
    rows does not depend on the number of tasks; the sums are partial before they are shuffled."""
    rows = _gathered(batches)
    if rows is None:
        return
    order = np.lexsort((rows["k"], rows["token"]))
    token, k, c = (rows[x][order] for x in ("token", "k", "c"))
    keep = np.append(True, (token[1:] != token[:-1]) | (k[1:] != k[:-1]))  # copies of a class from other tasks
    token, k, c = token[keep], k[keep], c[keep]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    size = np.diff(np.append(first, len(token)))
    shared = (np.repeat(size, size) >= 2) | (token < 0)
    yield pa.RecordBatch.from_arrays([pa.array(k[shared]), pa.array(c[shared].astype(np.int64))], names=["k", "shared"])


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the partition whose token is in two or more classes, with their number."""
    rows = _gathered(batches)
    if rows is None:
        return
    order = np.lexsort((rows["k"], rows["token"]))
    token, k, n = (rows[c][order] for c in ("token", "k", "n"))
    keep = np.ones(len(token), bool)  # copies of a class from other tasks
    keep[1:] = (token[1:] != token[:-1]) | (k[1:] != k[:-1])
    token, k, n = token[keep], k[keep], n[keep]
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    df = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token))))
    many = df >= 2
    yield pa.RecordBatch.from_arrays(
        [pa.array(token[many]), pa.array(k[many]), pa.array(n[many]), pa.array(df[many].astype(np.int32))],
        names=["token", "k", "n", "df"])


def _ordered_sets(percent: int, share: int):
    """``share``: documents for each sampled one, to estimate how long the lists of common tokens are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets that may link: their shared tokens from rare to frequent, and their prefixes."""
        rows = _gathered(batches)
        if rows is None:
            return
        order = np.lexsort((rows["token"], rows["df"], rows["k"]))
        token, k, n, df = (rows[c][order] for c in ("token", "k", "n", "df"))
        keep = np.ones(len(token), bool)
        keep[1:] = (token[1:] != token[:-1]) | (k[1:] != k[:-1])
        token, k, n, df = token[keep], k[keep], n[keep], df[keep]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        size = np.diff(np.append(first, len(k)))
        total = n[first].astype(np.int64)
        least = -(-percent * total // 100)  # tokens in common with any partner
        alone = total - size
        prefix = total - least + 1 - alone
        length = np.where(df < COMMON, df, (df - COMMON).astype(np.int64) * share)
        run_df = np.concatenate([[0], np.cumsum(1 + OPEN_SHARE * length)])
        out = np.flatnonzero(prefix > 0)
        if not len(out):
            return
        p1 = prefix[out]
        p2 = np.minimum(p1 + 1, size[out])
        scan = run_df[first[out] + p1] - run_df[first[out]]
        offsets = np.concatenate([[0], np.cumsum(size[out])]).astype(np.int32)
        pick = np.concatenate([np.arange(f, f + s) for f, s in zip(first[out], size[out])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[first[out]]), pa.array(total[out]), pa.array(alone[out].astype(np.int64)),
             pa.array(p1.astype(np.int32)), pa.array(p2.astype(np.int32)), pa.array(scan),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(token[pick]))],
            names=["k", "n", "alone", "p1", "p2", "scan", "tokens"])
    return run


_SET = "k bigint, n bigint, alone bigint, p1 int, p2 int, scan double, tokens array<bigint>"


def size_boundary(sets: DataFrame) -> int:
    """Largest set size for which enumerating pairs of prefix tokens costs less than scanning lists."""
    bucket = F.ceil(F.log2("n") * 4)
    pairs = F.col("p2").cast("double") * (F.col("p2") - 1) / 2
    rows = sets.groupBy(bucket.alias("b")).agg(F.sum(pairs).alias("light"), F.sum("scan").alias("heavy"))
    rows = sorted(rows.collect())  # at most a few hundred sizes of a logarithmic scale
    best, at = sum(r["heavy"] for r in rows), 0
    cost = best
    for r in rows:
        cost += r["light"] - r["heavy"]
        if cost < best:
            best, at = cost, int(2 ** (r["b"] / 4))
    return at


def postings(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """``key, k, n, room, light``: subset keys of light sets, prefix tokens of heavy ones and of
    the light sets that are large enough to link with a heavy one.

    ``room`` is the most tokens a set can share with another if the key's tokens
    are the first that they have in common."""
    base = sets.select("k", "n", "alone", "p1", F.slice("tokens", 1, F.col("p2")).alias("t"))
    subset = F.flatten(F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.transform(
        F.sequence(i + 1, F.size("t")), lambda j: F.struct(
            F.xxhash64(F.element_at("t", i), F.element_at("t", j)).alias("key"),
            (F.col("n") - F.col("alone") - j + 2).alias("room")))))
    light = base.where((F.col("n") <= boundary) & (F.size("t") > 1)).select(
        "k", "n", F.explode(subset).alias("p"), F.lit(True).alias("light"))
    single = F.transform(F.slice("t", 1, F.col("p1")), lambda t, i: F.struct(
        t.alias("key"), (F.col("n") - F.col("alone") - i).alias("room")))
    heavy = base.where(F.col("n") * 100 > boundary * percent).select(
        "k", "n", F.explode(single).alias("p"), F.lit(False).alias("light"))
    return light.union(heavy).select("p.key", "k", "n", "p.room", "light")


def _in_reach(a: str, b: str, percent: int):
    """Whether sets of these sizes, with this room each, can be similar enough."""
    room = F.least(F.col(f"{a}room"), F.col(f"{b}room"))
    return percent * (F.col(f"{a}n") + F.col(f"{b}n")) <= (100 + percent) * room


def with_partner(lists: DataFrame, percent: int) -> DataFrame:
    """Rows of the lists in which some other set may be in reach.

    Each list is held against its sizes only (with the most room of each)."""
    sizes = (lists.groupBy("key", "light", "n").agg(F.max("room").alias("room"), F.count("*").alias("m"))
             .select("key", "light", F.col("n").alias("b_n"), F.col("room").alias("b_room"), "m"))
    a = lists.withColumnsRenamed({"n": "a_n", "room": "a_room"})
    kept = a.join(sizes, (a["key"] == sizes["key"]) & (a["light"] == sizes["light"]) & _in_reach("a_", "b_", percent)
                  & ((F.col("a_n") != F.col("b_n")) | (F.col("m") > 1)), "left_semi")
    return kept.withColumnsRenamed({"a_n": "n", "a_room": "room"})


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``u, v``) whose Jaccard similarity is at least ``percent`` / 100."""
    side = sets.select("k", "n", "tokens")
    left = side.toDF("u", "nu", "tu")
    right = side.toDF("v", "nv", "tv")
    common = F.size(F.array_intersect("tu", "tv"))
    return (pairs.join(right, "v").join(left, "u")
            .where(100 * common >= percent * (F.col("nu") + F.col("nv") - common)).select("u", "v"))


def star_pairs(lists: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Each set with the most central set of like size in each of its lists: that with the most room."""
    band = F.floor(F.log(F.col("n")) / math.log(100 / percent))
    rows = lists.withColumn("band", band)
    centre = rows.groupBy("key", "light", "band").agg(
        F.min(F.struct((-F.col("room") / F.col("n")).alias("share"), F.col("k"), F.col("n"), F.col("room"))).alias("c"))
    centre = centre.select("key", "light", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
                           F.col("c.k").alias("ck"), F.col("c.n").alias("cn"), F.col("c.room").alias("croom"))
    return (rows.join(centre, ["key", "light", "band"]).where("k <> ck").where(_in_reach("", "c", percent))
            .where(F.col("light") | (F.greatest("n", "cn") > boundary))
            .select(F.least("k", "ck").alias("u"), F.greatest("k", "ck").alias("v")).distinct())


def open_pairs(lists: DataFrame, roots: DataFrame, boundary: int, percent: int) -> DataFrame:
    """All pairs of a list in reach that lie in different components.

    The sets of a list's largest component stand on one side only, so a long
    list of near copies and a few others costs their product, not its square."""
    rows = (lists.join(roots.select(F.col("node").alias("k"), "root"), "k", "left")
            .withColumn("root", F.coalesce("root", "k")))
    parts = rows.groupBy("key", "light", "root").agg(F.count("*").alias("m"))
    most = (parts.groupBy("key", "light").agg(F.count("*").alias("parts"), F.max(F.struct("m", "root")).alias("top"))
            .where("parts > 1").select("key", "light", F.col("top.root").alias("top")))
    rows = materialise(rows.join(most, ["key", "light"]).withColumn("is_top", F.col("root") == F.col("top")).drop("top"),
                       "open_lists")
    cols = ("k", "n", "room", "root")
    a = rows.where(~F.col("is_top")).select("key", "light", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = rows.select("key", "light", "is_top", *[F.col(c).alias(f"b_{c}") for c in cols])
    return (a.join(b, ["key", "light"])
            .where((F.col("a_root") != F.col("b_root")) & _in_reach("a_", "b_", percent)
                   & (F.col("is_top") | (F.col("a_k") < F.col("b_k")))
                   & (F.col("light") | (F.greatest("a_n", "b_n") > boundary)))
            .select(F.least("a_k", "b_k").alias("u"), F.greatest("a_k", "b_k").alias("v")).distinct())


def _common(counts: DataFrame) -> np.ndarray:
    """(token, count) of the tokens in many of the sampled documents, sorted (at most sampled
    tokens / COMMON_IN_SAMPLE)."""
    rows = counts.where(F.col("c") >= COMMON_IN_SAMPLE).collect()
    return np.array(sorted((r["token"], min(r["c"], COMMON - 1)) for r in rows), np.int64).reshape(-1, 2)


def _sample(rows: DataFrame, n_docs: int) -> DataFrame:
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n_docs // SAMPLED_DOCS))) == 0)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [squeeze.compress((t.as_py() or "").encode()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def open_classes(rows: DataFrame, prints: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, k, packed``: text of one document of each class that the first round leaves open."""
    share = sampling(percent)
    n_docs, n_tokens = prints.agg(F.count("*"), F.coalesce(F.sum("n_sampled"), F.lit(0))).first()
    none = np.zeros((0, 2), np.int64)
    token_row = "token bigint, k bigint, c int"
    common = _common(_sample(rows, n_docs).select("text").mapInArrow(T.frugal(_sampled_rows(k, share, none)), token_row)
                     .groupBy("token").agg(F.count("*").alias("c")))
    tasks = max(1, -(-n_tokens // ROWS_PER_TASK))
    shared = (rows.select("text").mapInArrow(T.frugal(_sampled_rows(k, share, common)), token_row)
              .repartition(tasks, "token").mapInArrow(T.frugal(_shared_counts), "k bigint, shared bigint")
              .groupBy("k").agg(F.sum("shared").alias("shared")))
    classes = (prints.where("k is not null and doc_id is not null").groupBy("k")
               .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("n_sampled").alias("n_sampled")))
    least = F.ceil(percent * F.col("n") / 100)
    still = (classes.join(shared, "k", "left")
             .where(F.col("n_sampled") - F.coalesce("shared", F.lit(0)) <= F.col("n") - least).select("doc_id", "k"))
    packed = rows.where("doc_id is not null").mapInArrow(T.frugal(_pack), "doc_id bigint, packed binary")
    return packed.join(still.hint("shuffle_hash"), "doc_id")


def ordered_sets(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Sets that may link with another, as rows of ``_SET``, from ``doc_id, k, packed``."""
    tokens = classes.select("k", "packed")
    n_docs = classes.count()
    common = _common(_sample(classes, n_docs).select("k", "packed").mapInArrow(T.frugal(_token_rows(k, np.zeros((0, 2), np.int64))), _TOKEN_ROW)
                     .groupBy("token").agg(F.count("*").alias("c")))
    tokens = tokens.mapInArrow(T.frugal(_token_rows(k, common)), _TOKEN_ROW)
    # an upper bound of the tokens: two compressed bytes or more for each
    size = classes.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    tasks = max(1, -(-size // (2 * ROWS_PER_TASK)))
    shared = tokens.where("df = 0").repartition(tasks, "token").mapInArrow(T.frugal(_shared_tokens), _TOKEN_ROW)
    frequent = tokens.where("df > 0")
    share = max(1, n_docs // SAMPLED_DOCS)
    return shared.union(frequent).repartition(tasks, "k").mapInArrow(T.frugal(_ordered_sets(percent, share)), _SET)


def ngram_join(docs: DataFrame, k: int = 4, percent: int = 85, id_col="doc_id", text_col="text",
               boundary: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per input row: components of the documents whose sets of
    ``k``-word shingles have Jaccard similarity ``percent`` / 100 or more."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = materialise(rows.mapInArrow(T.frugal(_fingerprints(k, sampling(percent))),
                                         "doc_id bigint, n_shingles bigint, k bigint, n_sampled bigint"), "prints")
    classes = materialise(open_classes(rows, prints, k, percent), "open_classes")
    sets = materialise(ordered_sets(classes, k, percent), "sets")
    if boundary is None:
        boundary = size_boundary(sets)
    lists = materialise(with_partner(materialise(postings(sets, boundary, percent), "postings"), percent), "lists")
    links = materialise(verified(star_pairs(lists, boundary, percent), sets, percent), "star_links")
    roots = components(links, "star_components")
    more = materialise(verified(open_pairs(lists, roots, boundary, percent), sets, percent), "open_links")
    if not more.isEmpty():
        roots = components(links.union(more), "components")
    # from class keys to the smallest doc_id; without a link a class is its own component
    named = prints.where("k is not null and doc_id is not null").groupBy("k").agg(F.min("doc_id").alias("least"))
    named = named.join(roots.select(F.col("node").alias("k"), "root"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    named = materialise(named, "classes")
    heads = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(heads, "root").select("k", "component")
    return (prints.join(found, "k", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), s as (
  select doc_id, array_to_string(w, ' ') as gram from w where len(w) between 1 and 3
  union
  select doc_id, array_to_string(w[i:i + 3], ' ')
  from (select doc_id, w, unnest(generate_series(1, len(w) - 3)) as i from w where len(w) >= 4)
), n as (select doc_id, count(*) as n from s group by doc_id),
l as (
  select a.doc_id as a, b.doc_id as b from s a join s b on a.gram = b.gram and a.doc_id <> b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  where 100 * least(na.n, nb.n) >= 85 * greatest(na.n, nb.n)
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), r as (
  select doc_id as a, doc_id as b from w
  union
  select r.a, l.b from r join l on r.b = l.a
), c as (select a as doc_id, min(b) as component_id from r group by a)
select c.doc_id, coalesce(n.n, 0) as n_shingles, component_id from c left join n on c.doc_id = n.doc_id
"""
