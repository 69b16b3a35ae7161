"""Quality classifier: interpolated modified Kneser-Ney over byte n-grams.

The model is trained on trusted text (labelled good and not toxic; nine tenths
of it by hash, the rest calibrates).  All counts are rows sharded by n-gram:
raw counts for the highest order, continuation counts below, discounts from
the counts of counts, and one join per order for the interpolated probability
of every n-gram that the documents hold.  Two scores of each document are then
held against its language's quantiles of the calibration documents: its mean
bits a byte, and the mean bits a byte of its worst word, which a few insults in
otherwise clean text do not hide from.

Texts move as compressed blocks of about ``BLOCK_BYTES``, dealt by a hash of
``doc_id``: once to meet the labels and give their n-grams, once to meet the
probabilities of just the n-grams that the block holds.  What is gathered
(n-grams by block) grows with the input; no table is collected or broadcast by
hand, and a byte context has at most 256 continuations, so no shard is hot.

Defined results: a null or empty text has no perplexity and is not kept; a
language without calibration documents (null included) takes the limits of all
languages together, one with too few for the quantile (under 1 / (1 - quantile))
its own median plus that quantile of all documents' distances from their
language's median; a text without long words has 0 bits in its worst word; without trusted text every text with bytes is kept; a
``doc_id`` labelled both ways is not trusted; rows repeating a ``doc_id`` are
separate rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.tables import materialise, read

ORDER = 4
BLOCK_BYTES = 16 << 20
#: Blocks over which the rows of one id are dealt.
SALTS = 8
#: Share of the calibration documents of a language that its limit accepts.
QUANTILE = 0.995
#: Shorter words (bytes) are left out of a document's worst word.
WORD_BYTES = 4
#: A text's bits per byte count with so many bytes at its language's median, so
#: that a few words alone do not condemn it.
PRIOR_BYTES = 100
_DOC = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string())])


def _block(doc_id: Column, salt: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, salt), F.lit(n_blocks)).cast("long")


def _salt(doc_id: Column, text: Column) -> Column:
    """Rows of one id are dealt into ``SALTS`` blocks by their text; rows without id, which are never trusted, into all."""
    own = F.xxhash64(text)
    return F.when(doc_id.isNull(), own).otherwise(F.pmod(own, F.lit(SALTS)))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that go to the same block as one compressed blob."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        rows = batch.drop_columns(["block"])
        blocks, blobs = [], []
        for b in np.unique(block):
            part = rows.take(pa.array(np.flatnonzero(block == b)))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _DOC) as out:
                out.write_batch(pa.RecordBatch.from_arrays(part.columns, schema=_DOC))
            blocks.append(int(b))
            blobs.append(squeeze.compress(sink.getvalue()))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(blobs, pa.binary())],
                                         names=["block", "blob"])


def _unpack(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for blob in table.column("blob"):
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob.as_py())) as stream:
            yield from stream


def gram_codes(data: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Code of the n-gram that ends at each byte; before a text stand \\n bytes."""
    codes = data.astype(np.int64)
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    for back in range(1, order):
        earlier = np.full(len(data), 10, np.int64)
        earlier[back:] = data[:-back]
        earlier[place < back] = 10
        codes += earlier << (8 * back)
    return codes


def _block_grams(order: int):
    def count(docs: pa.Table, trusted: pa.Table) -> pa.Table:
        train = np.sort(trusted.column("trusted_id").to_numpy())
        found: dict[int, int] = {}
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in _unpack(docs):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            known = np.isin(ids, train)
            for i, j, data, off in T.chunks(batch.column("text")):
                codes = gram_codes(data, off, order)
                weight = np.repeat(known[i:j], np.diff(off))
                new, inverse = np.unique(codes, return_inverse=True)
                n = np.bincount(inverse, weight, len(new)).astype(np.int64)
                both, at = np.unique(np.concatenate([held, new]), return_inverse=True)
                total = np.zeros(len(both), np.int64)
                total[at[:len(held)]] = counts
                total[at[len(held):]] += n
                held, counts = both, total
        block = docs.column("block")[0].as_py() if docs.num_rows else 0
        T.release_memory()
        return pa.table({"block": np.full(len(held), block, np.int64), "code": held, "n": counts})
    return count


def _block_scores(order: int):
    def score(docs: pa.Table, probs: pa.Table) -> pa.Table:
        code = probs.column("code").to_numpy()
        by = np.argsort(code)
        code, bits = code[by], probs.column("bits").to_numpy()[by]
        out = []
        for batch in _unpack(docs):
            for i, j, data, off in T.chunks(batch.column("text")):
                total = np.zeros(len(data) + 1)
                if len(data):
                    np.cumsum(bits[np.searchsorted(code, gram_codes(data, off, order))], out=total[1:])
                w = T.words(data, off)
                long = w.end - w.start >= WORD_BYTES
                start, end = w.start[long], w.end[long]
                worst = np.zeros(j - i)
                np.maximum.at(worst, w.doc[long], (total[end] - total[start]) / (end - start))
                out.append(pa.table({
                    "doc_id": batch.column("doc_id").slice(i, j - i), "lang": batch.column("lang").slice(i, j - i),
                    "n_bytes": np.diff(off), "bits": total[off[1:]] - total[off[:-1]],
                    "word_bits": worst}))
        schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_bytes", pa.int64()),
                            ("bits", pa.float64()), ("word_bits", pa.float64())])
        T.release_memory()
        return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()
    return score


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of a level from its counts of counts (at least 0.1, so that every context
    leaves some mass to the level below)."""
    n = counts.agg(*[F.sum((F.col("n") == i).cast("long")) for i in (1, 2, 3, 4)]).first()
    n = [x or 0 for x in n]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(i + 1.0, max(0.1, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else (i + 1) / 2
            for i in range(3)]


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, F.lit(d[0])).when(n == 2, F.lit(d[1])).otherwise(F.lit(d[2]))


def probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``code, p`` for every code of ``grams`` (``code, n``: n-grams and their counts in trusted text,
    0 for those that only other documents hold)."""
    counts = {order: grams.where("n > 0")}
    for k in range(order - 1, 0, -1):
        counts[k] = materialise(
            counts[k + 1].groupBy((F.col("code") % F.lit(256 ** k)).alias("code")).agg(F.count("*").alias("n")),
            f"continuations{k}")
    lower = None
    for k in range(1, order + 1):
        d = discounts(counts[k])
        asked = grams.select((F.col("code") % F.lit(256 ** k)).alias("code")).distinct() if k < order \
            else grams.select("code")
        context = counts[k].groupBy(F.shiftright("code", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(_discount(F.col("n"), d)).alias("mass"))
        rows = (asked.withColumn("context", F.shiftright("code", 8))
                .withColumn("rest", F.col("code") % F.lit(256 ** (k - 1)))
                .join(counts[k], "code", "left").join(context, "context", "left"))
        if lower is None:
            rows = rows.withColumn("below", F.lit(1 / 256))
        else:
            rows = rows.join(lower.select(F.col("code").alias("rest"), F.col("p").alias("below")), "rest")
        seen = F.coalesce(F.col("n") - _discount(F.col("n"), d), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            (seen + F.col("mass") * F.col("below")) / F.col("total"))
        lower = materialise(rows.select("code", p.alias("p")), f"probabilities{k}")
    return lower


def score_documents(docs: DataFrame, trusted: DataFrame, order: int = ORDER,
                    id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """``doc_id, lang, n_bytes, bits, word_bits`` per row; ``bits`` is the text's whole code length,
    ``word_bits`` the mean bits a byte of its worst word of ``WORD_BYTES`` or more.

    ``trusted`` has one ``doc_id`` per document to train on."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES) + 1
    blobs = (rows.withColumn("block", _block(F.col("doc_id"), _salt(F.col("doc_id"), F.col("text")), n_blocks))
             .mapInArrow(T.frugal(_pack), "block bigint, blob binary"))
    # an id's trust goes to each block that may hold a row of it
    known = (trusted.select(F.col("doc_id").alias("trusted_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
             .select(_block(F.col("trusted_id"), F.col("salt"), n_blocks).alias("block"), "trusted_id").distinct())
    held = materialise(
        blobs.groupBy("block").cogroup(known.groupBy("block"))
        .applyInArrow(_block_grams(order), "block bigint, code bigint, n bigint"), "block_grams")
    grams = materialise(held.groupBy("code").agg(F.sum("n").alias("n")), "grams")
    bits = probabilities(grams, order).select("code", (-F.log2("p")).alias("bits"))
    slices = held.select("block", "code").join(bits, "code").select("block", "code", "bits")
    return (blobs.groupBy("block").cogroup(slices.groupBy("block"))
            .applyInArrow(_block_scores(order), "doc_id bigint, lang string, n_bytes bigint, bits double, word_bits double"))


def quality(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
            id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """``doc_id, lang, n_bytes, perplexity, adjusted_bits, limit_bits, word_bits, word_limit_bits, kept``
    per row of ``docs``."""
    trusted = (labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
               .where("q = 1 and t = 0 and doc_id is not null")
               .select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(10)) == 0).alias("held")))
    scores = materialise(score_documents(docs, trusted.where(~F.col("held")), order, id_col, text_col, lang_col),
                         "scores").withColumn("rate", F.col("bits") / F.when(F.col("n_bytes") > 0, F.col("n_bytes")))
    calibration = scores.where("n_bytes > 0").join(trusted.where("held").select("doc_id"), "doc_id", "left_semi")
    calibration = materialise(calibration.select("lang", "n_bytes", "bits", "rate", "word_bits"), "calibration")

    def by_lang(df: DataFrame, value: str, **shares: float) -> DataFrame:
        """Quantiles for each language and, in the row ``*all*``, for all together."""
        every = df.select(F.explode(F.array("lang", F.lit("*all*"))).alias("l"), value).where("l is not null")
        return every.groupBy("l").agg(F.count(value).alias("n"),
                                      *[F.percentile_approx(value, q, 10_000).alias(n) for n, q in shares.items()])

    def with_limit(df: DataFrame, limits: DataFrame, name: str) -> DataFrame:
        own = limits.where("l <> '*all*'").select(F.col("l").alias("lang"), F.col(name).alias("own"))
        every = limits.where("l = '*all*'").select(name).scalar()
        return df.join(own, "lang", "left").withColumn(name, F.coalesce(F.col("own"), every)).drop("own")

    def adjust(df: DataFrame) -> DataFrame:
        return df.withColumn("adjusted_bits", (F.col("bits") + PRIOR_BYTES * F.coalesce("median", "rate"))
                             / (F.col("n_bytes") + PRIOR_BYTES))

    medians = materialise(by_lang(calibration, "rate", median=0.5), "medians")
    adjusted = materialise(adjust(with_limit(calibration, medians, "median")).select("lang", "adjusted_bits", "word_bits"),
                           "adjusted")

    def limits(value: str, name: str) -> DataFrame:
        own = materialise(by_lang(adjusted, value, mid=0.5, top=quantile), f"quantiles_{value}")
        distance = with_limit(adjusted, own, "mid").agg(
            F.percentile_approx(F.col(value) - F.col("mid"), quantile, 10_000).alias("d")).scalar()
        enough = (F.col("l") == "*all*") | (F.col("n") * (1 - quantile) >= 1)
        return materialise(own.select("l", F.when(enough, F.col("top")).otherwise(F.col("mid") + distance).alias(name)), name)

    judged = with_limit(adjust(with_limit(scores, medians, "median")), limits("adjusted_bits", "limit_bits"), "limit_bits")
    judged = with_limit(judged, limits("word_bits", "word_limit_bits"), "word_limit_bits")
    return judged.select(
        "doc_id", "lang", "n_bytes", F.pow(F.lit(2.0), "rate").alias("perplexity"), "adjusted_bits", "limit_bits",
        "word_bits", "word_limit_bits",
        ((F.col("n_bytes") > 0) & F.coalesce(F.col("adjusted_bits") <= F.col("limit_bits"), F.lit(True))
         & F.coalesce(F.col("word_bits") <= F.col("word_limit_bits"), F.lit(True))).alias("kept"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
