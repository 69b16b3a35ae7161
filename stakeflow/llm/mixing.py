"""Mixing sources to target weights (DataFrame functions only).

Documents fall into cells of source, language and topic.  Iterative
proportional fitting rakes the cells' token weights to target shares of each of
the three marginals; a cell's factor (fitted weight per token), divided by the
largest factor, is the probability with which its documents are sampled, so
the sample's tokens have the target shares in expectation.  The draw is a hash
of ``doc_id``: the same documents come whenever it is repeated.

Only the cells' token sums are shuffled, one partial row per cell and task; the
fitting works on the table of cells, never on the driver.  A written table of
factors goes back to the documents, so Spark knows its size before it decides
to broadcast it.

The default targets are the marginals' own shares to the power ``temper``,
which takes from the hot values and gives to the rare ones.  The default topic
is the text's form (``topic_of``), as the table of documents has no topic.

Defined results: null sources, languages and topics are the value ``''``; a null
or empty text has no tokens, weighs nothing in the fit and is sampled by its
cell's factor; cells whose values all lack tokens have factor 1 and go to the
largest probability at most; a null ``doc_id`` draws like the empty string;
rows repeating a ``doc_id`` draw alike; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stakeflow.llm.tables import materialise, read

DIMS = ("source", "lang", "topic")
TEMPER = 0.9
ROUNDS = 10
#: Rounds of the fit in one job; then the table of cells is written.
ROUNDS_PER_JOB = 2
BLANKS = r"[\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def topic_of(text: Column, n_tokens: Column) -> Column:
    """Form of a text: ``short``, ``table``, ``sections`` or ``prose``."""
    def count(char: str) -> Column:
        return F.length(text) - F.length(F.translate(text, char, ""))
    return (F.when(text.isNull() | (n_tokens < 100), "short")
            .when(10 * count("|") >= n_tokens, "table")
            .when(count("\n") >= 8, "sections").otherwise("prose"))


def draw(doc_id: Column) -> Column:
    """Uniform number of [0, 1) from the id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def with_cell(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", lang_col="lang",
              topic: Column | None = None) -> DataFrame:
    """``row`` (the document as a struct), ``id``, the three cell values and ``n_tokens``."""
    out = docs.select(F.struct("*").alias("row"))
    text = F.col(f"row.{text_col}")
    out = out.withColumn("n_tokens", token_count(text))
    topic = topic_of(text, F.col("n_tokens")) if topic is None else topic
    return out.select("row", F.col(f"row.{id_col}").alias("id"), "n_tokens",
                      F.coalesce(F.col(f"row.{source_col}"), F.lit("")).alias("source"),
                      F.coalesce(F.col(f"row.{lang_col}"), F.lit("")).alias("lang"),
                      F.coalesce(topic, F.lit("")).alias("topic"))


def tempered(cells: DataFrame, dim: str, temper: float = TEMPER) -> DataFrame:
    """``value, target``: the marginal's shares of tokens to the power ``temper``."""
    return (cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("t")).where("t > 0")
            .select("value", F.pow(F.col("t").cast("double"), F.lit(temper)).alias("target")))


def fit(cells: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER,
        rounds: int = ROUNDS) -> DataFrame:
    """``source, lang, topic, tokens, factor, probability`` of each cell.

    ``targets`` gives a table ``value, target`` for a dimension (any scale); the
    others are tempered.  A value without tokens or target keeps its factor."""
    now = cells.withColumn("factor", F.lit(1.0))
    for dim in DIMS:
        goal = (targets or {}).get(dim)
        goal = tempered(cells, dim, temper) if goal is None else goal
        # shares of the values that have tokens; one row per value moves
        held = cells.where("tokens > 0").select(F.col(dim).alias("value")).distinct()
        goal = goal.join(held, "value").withColumn("target", F.col("target").cast("double"))
        share = F.col("target") / goal.agg(F.sum("target")).scalar()
        now = now.join(goal.select(F.col("value").alias(dim), share.alias(f"t_{dim}")), dim, "left")
    now = materialise(now, "cells")
    for done in range(rounds):
        for dim in DIMS:
            held = F.sum(F.col("tokens") * F.col("factor")).over(W.partitionBy(dim))
            now = now.withColumn("factor", F.when(held > 0, F.col("factor") * F.coalesce(F.col(f"t_{dim}") / held, F.lit(1.0)))
                                 .otherwise(F.col("factor")))
        if (done + 1) % ROUNDS_PER_JOB == 0 or done + 1 == rounds:
            now = materialise(now, "fitted")
    top = now.where("tokens > 0").agg(F.max("factor")).scalar()
    probability = F.least(F.coalesce(F.col("factor") / top, F.lit(1.0)), F.lit(1.0))
    return now.select(*DIMS, "tokens", "factor", probability.alias("probability"))


def cells_of(rows: DataFrame) -> DataFrame:
    """``source, lang, topic, tokens`` from rows of ``with_cell``."""
    return materialise(rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "token_sums")


def sample_to_targets(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: float = TEMPER,
                      **columns) -> DataFrame:
    """The sampled documents, with the columns of ``docs``."""
    rows = with_cell(docs, **columns)
    fitted = materialise(fit(cells_of(rows.drop("row", "id")), targets, temper), "factors")
    kept = rows.join(fitted.select(*DIMS, "probability"), list(DIMS)).where(draw(F.col("id")) < F.col("probability"))
    return kept.select("row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(with_cell(read(spark, sf_dir, "documents")).drop("row"), "doc_cells")
    fitted = materialise(fit(cells_of(rows)), "factors")
    return rows.join(fitted.drop("tokens"), list(DIMS)).select(
        F.col("id").alias("doc_id"), *DIMS, "n_tokens",
        F.expr("round(factor * 1e12) / 1e12").alias("factor"), F.expr("round(probability * 1e9) / 1e9").alias("probability"),
        (draw(F.col("id")) < F.col("probability")).alias("selected"))


def _oracle() -> str:
    ctes = [r"""d as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, text,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n_tokens
  from documents
), r as (
  select doc_id, source, lang, n_tokens,
         case when text is null or n_tokens < 100 then 'short'
              when 10 * (length(text) - length(replace(text, '|', ''))) >= n_tokens then 'table'
              when length(text) - length(replace(text, chr(10), '')) >= 8 then 'sections' else 'prose' end as topic
  from d
), c as (select source, lang, topic, sum(n_tokens)::double as tokens, 1.0::double as factor from r group by all)"""]
    for dim in DIMS:
        ctes.append(f"g_{dim} as (select {dim}, pow(sum(tokens), {TEMPER}) as g from c group by {dim} having sum(tokens) > 0)")
        ctes.append(f"t_{dim} as (select {dim}, g / (select sum(g) from g_{dim}) as t_{dim} from g_{dim})")
    ctes.append("w0 as (select c.*, " + ", ".join(f"t_{d}" for d in DIMS) + " from c "
                + " ".join(f"left join t_{d} using ({d})" for d in DIMS) + ")")
    step = 0
    for _ in range(ROUNDS):
        for dim in DIMS:
            held = f"sum(tokens * factor) over (partition by {dim})"
            ctes.append(f"w{step + 1} as materialized (select * replace (case when {held} > 0 then factor * coalesce(t_{dim} / {held}, 1) "
                        f"else factor end as factor) from w{step})")
            step += 1
    ctes.append(f"p as (select source, lang, topic, factor, least(coalesce(factor / (select max(factor) from w{step} where tokens > 0), 1), 1) "
                f"as probability from w{step})")
    return "with " + ",\n".join(ctes) + """
select doc_id, source, lang, topic, n_tokens, round(factor * 1e12) / 1e12 as factor,
       round(probability * 1e9) / 1e9 as probability,
       cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) / 4294967296.0 < probability as selected
from r join p using (source, lang, topic)
"""


ORACLE = _oracle()
