"""Distributed building blocks: global positions, exact quantiles, ranks, prefix sums.

Values are counted first (``groupBy(value).count()``, partial before the
shuffle), so a value that a third of all rows share is one row from then on.
``positions`` sorts by range partitions into the shared checkpoint folder and
numbers rows with ``offset[partition] + row-in-partition``; the offsets are one
row per partition.  ``cumulative_sums`` adds running sums in the same written
sort.  There is one path for every table size, and no group is gathered in one
task:

* ``quantiles`` - exact linear-interpolation quantiles (pandas / Spark
  ``percentile`` / DuckDB ``quantile_cont`` semantics) without a sort: a
  mergeable sketch brackets each quantile in one pass, a second pass counts the
  values inside the brackets; where these are too many for the driver, sketches
  of the brackets narrow them first.  ``exact=False`` stops at the sketch;
* ``grouped_quantiles`` - the same per group, for any number of groups, from
  running counts over the distinct values;
* ``distinct_in_group`` - exact distinct counts without one copy of every row
  per counted column;
* ``dense_index`` - sorted distinct keys numbered 0..n-1;
* ``average_ranks`` - ranks with ties averaged (Spearman);
* ``prefix_share`` - cumulative share of a value in sort order (Lorenz).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.session import cut_lineage


def positions(df: DataFrame, order: list, pos: str = "__pos") -> DataFrame:
    """``df`` plus ``pos`` = 0-based position in the total order ``order``.

    ``order`` should be a total order (add an id column) when positions are
    attached to rows; for quantiles ties do not matter.
    """
    s = df.sort(*order).withColumn("__pid", F.spark_partition_id()).withColumn(
        "__mid", F.monotonically_increasing_id())
    s = cut_lineage(s)
    counts = s.groupBy("__pid").agg(F.count("*").alias("__c"))
    offsets = counts.withColumn(
        "__off", F.sum("__c").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("__pid", F.coalesce("__off", F.lit(0)).alias("__off"))
    # one row per partition: a proven bound, so the broadcast is safe
    out = s.join(F.broadcast(offsets), "__pid")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return out.withColumn(pos, F.col("__off") + local).drop("__pid", "__mid", "__off")


def value_counts(df: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    """Distinct non-NULL values ``__v`` of ``column`` (per ``keys``) with their number ``__c`` and
    the running count ``cum___c`` in the order of (keys, value)."""
    counts = (df.select(*keys, F.col(column).cast("double").alias("__v")).where(F.col("__v").isNotNull())
              .groupBy(*keys, "__v").agg(F.count("*").alias("__c")))
    return cumulative_sums(counts, [*keys, "__v"], ["__c"])


def distinct_in_group(column: str) -> Column:
    """Exact number of distinct non-NULL values per group, as an aggregate that takes part in any other.

    Several ``count_distinct`` in one aggregate make Spark copy every row once per column; a set per group is
    filled map-side instead.  It holds the distinct values of one group, so it suits columns whose values come
    from a catalog (a user's games, providers), not a game's users."""
    return F.size(F.collect_set(column)).cast("long")


#: Size of the sketches, the ranks (as shares) at which they are read, and how far a bracket reaches to both
#: sides: more than the sketch's error (about 0.4 %).  Counting decides, so a bad sketch costs a pass, no result.
SKETCH_K, SKETCH_STEPS, BRACKET = 1024, 200, 0.01
#: Counted values that may reach the driver.
COLLECTED = 100_000


def _sketched(v: DataFrame, spans: list[tuple[float, float]]) -> list[tuple[int, int, list[float]]]:
    """For each span of values: how many lie below it, how many inside, and the sketch's values at equal steps."""
    steps = F.array(*[F.lit(i / SKETCH_STEPS) for i in range(SKETCH_STEPS + 1)])
    aggs = []
    for i, (lo, hi) in enumerate(spans):
        inside = (F.col("__v") >= lo) & (F.col("__v") <= hi)
        aggs += [F.count_if(F.col("__v") < lo).alias(f"below{i}"), F.count_if(inside).alias(f"n{i}"),
                 F.kll_sketch_agg_double(F.when(inside, F.col("__v")), F.lit(SKETCH_K)).alias(f"s{i}")]
    read = [c for i in range(len(spans)) for c in (
        f"below{i}", f"n{i}", F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", steps)).alias(f"q{i}"))]
    row = v.agg(*aggs).select(*read).first()
    return [(row[f"below{i}"], row[f"n{i}"], row[f"q{i}"]) for i in range(len(spans))]


def _values_at(v: DataFrame, brackets: dict[int, tuple[float, float]], limit: int) -> tuple[dict, dict] | None:
    """(values of the ranks whose brackets hold them, other brackets for the rest); nothing if more than
    ``limit`` distinct values lie inside the brackets."""
    spans: list[list[float]] = []
    for lo, hi in sorted(set(brackets.values())):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    # regions in the order of values: before the first span, inside it, between it and the next, ...
    region, inside = F.lit(2 * len(spans)), F.lit(False)
    for i, (lo, hi) in reversed(list(enumerate(spans))):
        region = F.when(F.col("__v") < lo, 2 * i).when(F.col("__v") <= hi, 2 * i + 1).otherwise(region)
        inside = inside | F.col("__v").between(lo, hi)
    counts = v.groupBy(region.alias("region"), F.when(inside, F.col("__v")).alias("value")).agg(F.count("*").alias("n"))
    rows = counts.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    found, off, seen = {}, {}, 0
    wanted = sorted(brackets)
    for r in sorted(rows, key=lambda r: (r.region, r.value or 0.0)):
        while wanted and wanted[0] < seen + r.n:
            rank = wanted.pop(0)
            if r.region % 2:
                found[rank] = r.value
            else:
                i = r.region // 2
                off[rank] = (spans[i - 1][1] if i else -math.inf, spans[i][0] if i < len(spans) else math.inf)
        seen += r.n
    return found, off


def quantiles(df: DataFrame, column: str, probs, exact: bool = True, limit: int = COLLECTED) -> list:
    """Quantiles of ``column`` (NULLs ignored); ``None`` entries on empty input.

    ``exact=False`` gives the sketch's values (rank error about 0.4 %) from one pass."""
    probs = list(probs)
    v = df.select(F.col(column).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    whole = (-math.inf, math.inf)
    ((_, n, steps),) = _sketched(v, [whole])
    if n == 0:
        return [None] * len(probs)
    if not exact:
        return [steps[round(p * SKETCH_STEPS)] for p in probs]

    def bracket(rank: int, below: int, n: int, steps: list[float]) -> tuple[float, float]:
        at = (rank - below) / n
        return (steps[max(0, math.floor((at - BRACKET) * SKETCH_STEPS))], steps[min(SKETCH_STEPS, math.ceil((at + BRACKET) * SKETCH_STEPS))])

    spots = [(p * (n - 1), math.floor(p * (n - 1)), math.ceil(p * (n - 1))) for p in probs]
    open_ = {r: bracket(r, 0, n, steps) for _, lo, hi in spots for r in (lo, hi)}
    at: dict[int, float] = {}
    while open_:
        result = _values_at(v, open_, max(limit, 16 * len(open_)))
        if result:
            at |= result[0]
            open_ = result[1]  # a bracket that missed its rank goes on with the span that holds it
        else:  # sketch the brackets themselves
            spans = sorted(set(open_.values()))
            held = dict(zip(spans, _sketched(v, spans)))
            open_ = {r: bracket(r, *held[b]) if held[b][0] <= r < held[b][0] + held[b][1] else whole for r, b in open_.items()}
    return [at[lo] + (at[hi] - at[lo]) * (x - lo) for x, lo, hi in spots]


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probs, names=None) -> DataFrame:
    """Exact per-group quantiles: one row per group with one column per prob.

    One global order by (keys, value) over the distinct values; each group's
    start is a ``min`` aggregate, so hot groups spread over range partitions.
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    counts = value_counts(df, value, list(keys))
    begin = F.col("cum___c") - F.col("__c")
    groups = cut_lineage(counts.groupBy(*keys).agg(F.min(begin).alias("__start"), F.sum("__c").alias("__n")))
    j = counts.join(groups, keys).withColumn("__from", begin - F.col("__start")).withColumn(
        "__to", F.col("cum___c") - F.col("__start"))
    aggs, any_cond = [], F.lit(False)
    for p, nm in zip(probs, names):
        at = F.lit(float(p)) * (F.col("__n") - 1)
        for rank, tag in ((F.floor(at), "lo"), (F.ceil(at), "hi")):
            here = (rank >= F.col("__from")) & (rank < F.col("__to"))
            any_cond = any_cond | here
            aggs.append(F.max(F.when(here, F.col("__v"))).alias(f"__{tag}_{nm}"))
        aggs.append(F.first(at).alias(f"__at_{nm}"))
    g = j.where(any_cond).groupBy(*keys).agg(*aggs)
    outs = []
    for nm in names:
        lo_v, hi_v, at = F.col(f"__lo_{nm}"), F.col(f"__hi_{nm}"), F.col(f"__at_{nm}")
        outs.append((lo_v + (hi_v - lo_v) * (at - F.floor(at))).alias(nm))
    return g.select(*keys, *outs)


def dense_index(df: DataFrame, key: str, index_name: str = "idx") -> DataFrame:
    """Distinct ``key`` values sorted ascending, numbered ``0..n-1`` (LongType)."""
    keys = df.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return positions(keys, [key], index_name).select(key, index_name)


def grouped_average_ranks(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """(keys, value, out): 1-based rank within the group of each distinct value, ties averaged.

    A written table of distinct values, so that joining it to rows splits a hot value on the rows' side."""
    counts = value_counts(df, value, list(keys))
    begin = F.col("cum___c") - F.col("__c")
    rank = begin + (F.col("__c") + 1) / 2.0
    if keys:
        start = counts.groupBy(*keys).agg(F.min(begin).alias("__start"))
        counts, rank = counts.join(start, list(keys)), rank - F.col("__start")
    return cut_lineage(counts.select(*keys, F.col("__v").alias(value), rank.alias(out)))


def average_ranks(df: DataFrame, id_col: str, value: str, out: str) -> DataFrame:
    """1-based rank of ``value`` with ties averaged, per ``id_col`` row (NULL values are left out)."""
    base = df.select(id_col, F.col(value).cast("double").alias("__x")).where(F.col("__x").isNotNull())
    return base.join(grouped_average_ranks(base, [], "__x", out), "__x").select(id_col, out)


def prefix_share(df: DataFrame, id_col: str, value: str) -> DataFrame:
    """Rows sorted by (value, id); ``cum_users`` = position / n and
    ``cum_value`` = running sum / total.  Partition sums give the offsets."""
    base = df.select(id_col, F.col(value).cast("double").alias("__v"))
    run = cumulative_sums(base, ["__v", id_col], ["__v"])
    total = base.agg(F.sum("__v")).scalar()
    n = base.agg(F.count("*")).scalar()
    return run.select(id_col, F.col("__v").alias(value), (F.col("__pos") + 1).alias("position"),
                      ((F.col("__pos") + 1) / n).alias("cum_users"), (F.col("cum___v") / total).alias("cum_value"))


def quantile_bucket(df: DataFrame, id_col: str, value: str, labels: list[str], out: str) -> DataFrame:
    """E5 / E6 rule: rank by (value, id), q = min(len(labels), n),
    bucket = max(1, ceil((rank - 1) * q / (n - 1))).  Distributed positions, no
    single-partition window."""
    base = df.where(F.col(value).isNotNull())
    pos = positions(base, [value, id_col], "__pos")
    n = pos.agg(F.count("*")).scalar()  # of the written sort: ``base`` is often the end of a long plan
    q = F.least(n, F.lit(len(labels)))
    b = F.when(q <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor((F.col("__pos") * q + (n - 2)) / (n - 1))))
    arr = F.array(*[F.lit(x) for x in labels])
    return pos.withColumn(out, F.element_at(arr, b.cast("int"))).drop("__pos")


def _running(values: list[str]):
    """Batches of a sorted partition get the running sums of ``values`` inside the partition, and the row's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = {v: 0 for v in values}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for v in values:
                col = batch.column(v)
                part = np.cumsum(np.append(held[v], col.fill_null(0).to_numpy(zero_copy_only=False)))[1:]
                held[v] = part[-1]
                batch = batch.append_column(f"cum_{v}", pa.array(part, col.type))
            yield batch.append_column("__pos", pa.array(np.arange(rows, rows + batch.num_rows)))
            rows += batch.num_rows
    return run


def cumulative_sums(df: DataFrame, order: list, values: list[str], tie: str | None = None) -> DataFrame:
    """Running sums of ``values`` (longs or doubles) in the total order ``order`` (add an id for a total order).

    One written sort: the partitions sum as they are sorted, and one row per partition (broadcast) moves each
    to its place.  Output adds ``cum_<value>`` columns and ``__pos``."""
    kinds = {v: "double" if df.schema[v].dataType.typeName() in ("double", "float", "decimal") else "bigint" for v in values}
    base = df.withColumns({v: F.col(v).cast(k) for v, k in kinds.items()}).sort(*order).withColumn("__pid", F.spark_partition_id())
    schema = T.StructType([*base.schema, *[T.StructField(f"cum_{v}", base.schema[v].dataType) for v in values], T.StructField("__pos", T.LongType())])
    run = cut_lineage(base.mapInArrow(_running(values), schema))
    part = run.groupBy("__pid").agg(F.count("*").alias("__n"), *[F.max_by(f"cum_{v}", "__pos").alias(f"__s_{v}") for v in values])
    w0 = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = part.select("__pid", F.coalesce(F.sum("__n").over(w0), F.lit(0)).alias("__o"),
                      *[F.coalesce(F.sum(f"__s_{v}").over(w0), F.lit(0)).alias(f"__o_{v}") for v in values])
    out = run.join(F.broadcast(off), "__pid").withColumn("__pos", F.col("__pos") + F.col("__o"))
    for v in values:
        out = out.withColumn(f"cum_{v}", F.col(f"cum_{v}") + F.col(f"__o_{v}"))
    return out.drop("__pid", "__o", *[f"__o_{v}" for v in values])
