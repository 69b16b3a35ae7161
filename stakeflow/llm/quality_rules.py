"""Quality rules per host.

Each document gets its base counts; the failures are summed by host (here the
``source``), each host's failure rate is shrunk with a beta prior fitted to the
other hosts, and the host's verdict goes back to its documents.  A host goes
when its shrunk rate lies ``LIMIT_SDS`` standard deviations of that prior above
its mean: the limit follows the hosts, and a bad host does not raise it for
itself.

The counts come from numpy over whole texts; per host only one partial row per
task moves.  The prior is one row of sums over hosts, and the verdicts join
back on the host (the join is Spark's choice by size; a hot host splits on the
documents' side, whose rows hold eight numbers, never the text).

Defined results: a null text has no words and fails; a null host counts as a
host of its own; rows repeating a ``doc_id`` are separate rows; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm import textnum as T
from stakeflow.llm.tables import materialise, read

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Standard deviations of the other hosts' prior above its mean, beyond which a host goes.
LIMIT_SDS = 4.0

_IS_SYMBOL = np.zeros(256, np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(per_byte: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(per_byte) + 1, np.int64)
    np.cumsum(per_byte, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Positions whose (doc, key) occurs at least twice; second array: all but the first of each."""
    order = np.lexsort((key, doc))  # stable: equal pairs stay in text order
    d, k = doc[order], key[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (d[1:] == d[:-1]) & (k[1:] == k[:-1])
    return order[same[:-1] | same[1:]], order[same[:-1]]


def _text_stats(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    n = len(off) - 1
    w = T.words(data, off)
    at, gram = w.grams(3)
    hits, _ = _repeated(w.doc[at], gram)
    covered = np.zeros(len(w.hash) + 3, bool)
    for j in range(3):
        covered[at[hits] + j] = True
    chars = T.char_count(data)
    word_chars = np.bincount(w.doc, chars[w.end] - chars[w.start], n).astype(np.int64)
    repeat = np.bincount(w.doc[covered[:len(w.hash)]], minlength=n)
    # lines: cut at \n and at the text's ends
    cut = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([off[:-1], cut + 1]))
    line_of = np.searchsorted(off, begin, "right") - 1
    line_doc = np.minimum(line_of, n - 1)
    stop = np.append(begin[1:], len(data))
    # a line's key is its raw bytes up to the \n; only lines with a word count
    first_word = np.searchsorted(w.start, begin)
    has_word = (first_word < len(w.start)) & (np.append(w.start, len(data))[first_word] < stop)
    begin, stop, line_doc = begin[has_word], stop[has_word], line_doc[has_word]
    stop = np.where((stop > 0) & (data[np.maximum(stop - 1, 0)] == 10), stop - 1, stop)
    dup = np.zeros(n, np.int64)
    if len(begin):
        _, later = _repeated(line_doc, T.span_hash(data, begin, stop))
        dup = np.bincount(line_doc[later], minlength=n)
    return [w.count(), word_chars, _sums(_IS_SYMBOL[data], off), dup, repeat]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in T.chunks(batch.column("text")):
            cols = [batch.column("doc_id").slice(i, j - i), batch.column("host").slice(i, j - i)]
            cols += [pa.array(np.asarray(x, np.int64)) for x in _text_stats(data, off)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "host", *STATS])


def document_stats(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """``doc_id, host``, the five counts and ``base_failed`` per row."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                      F.col(text_col).alias("text"))
    schema = f"doc_id bigint, host string, {', '.join(s + ' bigint' for s in STATS)}"
    return out.mapInArrow(T.frugal(_stats), schema).withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(stats: DataFrame, limit_sds: float = LIMIT_SDS) -> DataFrame:
    """``host, host_docs, host_failed, host_rate, host_limit, host_ok``.

    The beta prior of a host is fitted by moments of the other hosts' raw rates, each weighted by its documents:
    mean m (not below 1 / (their documents + 2)), variance v (not below m(1-m) over their documents per host,
    what chance alone gives), strength s = m(1-m)/v - 1 (at least 1), alpha = m s, beta = (1-m) s.  A host alone
    stays.
    """
    hosts = stats.groupBy("host").agg(F.count("*").alias("host_docs"),
                                      F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    hosts = materialise(hosts, "hosts").withColumn("raw", F.col("host_failed") / F.col("host_docs"))
    # the sums over all hosts, one row, less the host's own share
    n, docs, failed, squares = hosts.agg(F.count("*"), F.sum("host_docs"), F.sum("host_failed"), F.sum(F.col("host_failed") * F.col("raw"))).first()
    others = F.lit(n - 1)
    rest = F.lit(docs or 0) - F.col("host_docs")
    mean = F.greatest((F.lit(failed or 0) - F.col("host_failed")) / rest, 1 / (rest + 2))
    spread = (F.lit(squares or 0.0) - F.col("host_failed") * F.col("raw")) / rest - mean * mean
    chance = mean * (1 - mean)
    strength = F.greatest(F.lit(1.0), chance / F.greatest(spread, chance * others / rest) - 1)
    rate = (F.col("host_failed") + F.col("m") * F.col("s")) / (F.col("host_docs") + F.col("s"))
    limit = F.col("m") + F.lit(limit_sds) * F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("s") + 1))
    if n < 2:
        return hosts.select("host", "host_docs", "host_failed", F.col("raw").alias("host_rate"), F.lit(1.0).alias("host_limit"),
                            F.lit(True).alias("host_ok"))
    return (hosts.withColumn("m", mean).withColumn("s", F.when(F.col("m") < 1, strength).otherwise(1.0))
            .select("host", "host_docs", "host_failed", rate.alias("host_rate"), limit.alias("host_limit"))
            .withColumn("host_ok", F.col("host_rate") <= F.col("host_limit")))


def quality_rules(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source",
                  limit_sds: float = LIMIT_SDS) -> DataFrame:
    """Counts, ``base_failed``, the host's figures and ``kept`` per input row."""
    stats = materialise(document_stats(docs, id_col, text_col, host_col), "doc_stats")
    hosts = host_verdicts(stats, limit_sds).withColumnRenamed("host", "h")
    return (stats.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_ok")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), g as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select doc_id, w, unnest(generate_series(1, len(w) - 2)) as i from d where len(w) >= 3)
), r as (
  select doc_id, count(distinct i + o.o) as n_repeat_words
  from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from g) x,
       (values (0), (1), (2)) o(o)
  where c >= 2 group by doc_id
), l as (
  select doc_id, sum(c - 1) as n_dup_lines from (
    select doc_id, line, count(*) as c
    from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id, line) group by doc_id
), s as (
  select d.doc_id, d.source, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from d left join r on d.doc_id = r.doc_id left join l on d.doc_id = l.doc_id
), f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s
), h as (
  select source, count(*) as n, count(*) filter (where base_failed) as k from f group by source
), t as (
  select count(*) as hosts, sum(n) as docs, sum(k) as failed, sum(k * (k / n)) as squares from h
), m as (
  select source, n, k, hosts - 1 as others, docs - n as rest, squares,
    greatest((failed - k) / (docs - n), 1 / (docs - n + 2)) as m from h, t
), p as (
  select *, case when m < 1 then greatest(1, m * (1 - m) / greatest((squares - k * (k / n)) / rest - m * m,
    m * (1 - m) * others / rest) - 1) else 1 end as s from m
), v as (
  select source, others = 0 or (k + m * s) / (n + s) <= m + 4 * sqrt(m * (1 - m) / (s + 1)) as ok from p
)
select f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and ok as kept
from f join v on f.source is not distinct from v.source
"""
