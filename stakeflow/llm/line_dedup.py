"""Line dedup (DataFrame functions only).

Lines are exploded, normalised and hashed; each hash gets its number of
distinct documents; the lines of hashes in ``min_docs`` or more documents go
everywhere except in the largest ``doc_id`` that holds them; the others are put
together again by position.

Only (document, position, hash) rows move for the count: the hash rows are
partially aggregated before the shuffle, so a line of a third of all documents
costs one row per task.  The text moves once, to meet its dropped positions.

Defined results: a null or empty text is one empty line; rows repeating a
``doc_id`` count as one document and each row is cleaned by itself; a null
``doc_id`` is counted as one more document, keeps its row and, being the
smallest, its lines go whenever another document holds them; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.tables import materialise, read

#: Space and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` and ``row``, the other columns, per input row."""
    others = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.struct(F.lit(0), *others).alias("row"))
    # a repeated doc_id with another text needs its own positions
    base = base.withColumn("text_id", F.xxhash64("text"))
    lines = (
        base.select("doc_id", "text_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "text_id", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(F.coalesce("doc_id", F.lit(-2**63)).alias("doc_id"), "text_id", "pos",
                F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))
    )
    lines = materialise(lines, "lines")
    common = materialise(
        lines.groupBy("h1", "h2")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        .where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc"),
        "common_lines")
    dropped = (
        lines.join(common, ["h1", "h2"])
        .where(F.col("doc_id") != F.col("last_doc"))
        .groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("dropped"))
        .select(F.col("doc_id").alias("d"), F.col("text_id").alias("t"), "dropped")
    )
    joined = base.join(dropped, (F.coalesce("doc_id", F.lit(-2**63)) == F.col("d"))
                       & (F.col("text_id") == F.col("t")), "left")
    split = F.split("text", "\n", -1)
    # the split is computed once per row: bound by a one-row lambda variable
    kept = F.transform(F.array(split), lambda a: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(a) - 1), F.col("dropped")),
        lambda i: F.get(a, i)), "\n"))[0]
    return joined.select(
        "doc_id", "row",
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept_text``."""
    return _deduplicated(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs).drop("row")


def without_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The rows and columns of ``docs`` with the kept lines as their text."""
    named = {id_col: F.col("doc_id"), text_col: F.col("kept_text")}
    return _deduplicated(docs, id_col, text_col, min_chars, min_docs).select(
        *[named.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from {documents}
), k as (
  select doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
), c as (
  select key, max(doc_id) as last_doc from k where length(key) >= 20
  group by key having count(distinct doc_id) >= 3
), m as (
  select k.doc_id, k.pos, k.line, c.key is not null and k.doc_id <> c.last_doc as dropped
  from k left join c on k.key = c.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from m group by doc_id
"""

ORACLE = SQL.format(documents="documents")
