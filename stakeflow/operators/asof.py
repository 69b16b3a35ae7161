"""Backward as-of join with a tolerance (C2) and the per-user "next event" window.

Design (no pair explosion, no copied rows, hot keys split wherever their rows lie):

* Left and right rows are united; in the order ``(key, time, side, tie)`` the
  match of a left row is the last right row before it, if its key and the
  tolerance agree.
* The rows of each key are counted first (map-side combined).  Keys up to
  ``hot_rows`` rows go through one window per key: one shuffle.
* Hotter keys are range-partitioned by that same order, so even a key whose
  rows all lie inside one tolerance, or at one instant, spreads evenly.  The
  last right row of each partition is carried into the next ones: a prefix scan
  over one row per partition, which is all that reaches the driver.  Each
  partition then scans its rows once in Arrow batches.
* Left rows with a NULL key or time cannot match; they go around both ways and
  are united with the result, so they never meet in one task.
* The matched right row is carried as a struct, so a match whose payload is
  NULL still counts as the match (it is not skipped for an older row).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeflow.functions.mappers import epoch_micros
from stakeflow.session import cut_lineage

#: Rows of a key that one task may sort.
HOT_ROWS = 1_000_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    by: list[tuple[str, str]],
    payload: dict[str, str],
    tolerance_seconds: float,
    right_tie: str | None = None,
    matched_time_as: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For every left row, the latest right row with the same keys and
    ``left_time - tolerance <= right_time <= left_time`` (exact match allowed).

    ``payload`` maps right column -> output column name.  Unmatched left rows get
    NULLs.  Among right rows with equal time the largest ``right_tie`` wins.
    Left rows with a NULL time or key never match; right rows with a NULL time
    or key are ignored.  All left rows and columns are kept.
    """
    tol_us = int(round(tolerance_seconds * 1_000_000))
    left_cols = left.columns
    keys = [f"__k{i}" for i in range(len(by))]
    l = left.select(
        *[F.col(lk).cast("string").alias(k) for (lk, _), k in zip(by, keys)],
        epoch_micros(left_time).alias("__t"), F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in left_cols]).alias("__left"))
    r = right.select(
        *[F.col(rk).cast("string").alias(k) for (_, rk), k in zip(by, keys)],
        epoch_micros(right_time).alias("__t"), F.lit(0).alias("__side"),
        (F.col(right_tie) if right_tie else F.lit(None).cast("string")).alias("__tie"),
        F.struct(epoch_micros(right_time).alias("t"), *[F.col(src).alias(dst) for src, dst in payload.items()]).alias("__m"))
    can_match = F.col("__t").isNotNull()
    for k in keys:
        can_match = can_match & F.col(k).isNotNull()
    r, apart = r.where(can_match), l.where(~can_match)
    none = {c: F.lit(None).cast(t) for c, t in (("__tie", r.schema["__tie"].dataType), ("__m", r.schema["__m"].dataType),
                                                ("__left", l.schema["__left"].dataType))}
    rows = l.where(can_match).withColumns({c: none[c] for c in ("__tie", "__m")}).unionByName(r.withColumn("__left", none["__left"]))

    hot = cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows))
    n_hot = hot.agg(F.sum("__n")).first()[0] or 0
    if n_hot:
        hits = _windowed(rows.join(hot, keys, "left_anti"), keys).unionByName(
            _carried(rows.join(hot.select(*keys), keys, "left_semi"), keys, -(-2 * n_hot // hot_rows)))
    else:
        hits = _windowed(rows, keys)
    hits = hits.unionByName(apart.select("__left", "__t", none["__m"].alias("__hit")))
    ok = F.col("__hit.t") >= F.col("__t") - F.lit(tol_us)
    outs = [F.col(f"__left.{c}").alias(c) for c in left_cols]
    outs += [F.when(ok, F.col(f"__hit.{dst}")).alias(dst) for dst in payload.values()]
    if matched_time_as:
        outs.append(F.when(ok, F.col("__hit.t")).alias(matched_time_as))
    return hits.select(*outs)


def _windowed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``__left, __t, __hit``: the last right row before each left row, one window per key."""
    w = (Window.partitionBy(*keys).orderBy("__t", "__side", "__tie")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (rows.withColumn("__hit", F.last("__m", ignorenulls=True).over(w)).where(F.col("__side") == 1)
            .select("__left", "__t", "__hit"))


def _carried(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """The same by ranges of ``(key, time, side, tie)`` and the last right row of earlier ranges."""
    # left rows of one instant are alike in the order: a random number parts them
    order = [*keys, "__t", "__side", "__tie", "__r"]
    spread = rows.withColumn("__r", F.rand(17)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    spread = cut_lineage(spread.withColumn("__p", F.spark_partition_id()).drop("__r"))
    place = F.struct(*keys, "__t", "__tie")
    last = (spread.where(F.col("__side") == 0).groupBy("__p")
            .agg(F.max_by(F.struct(*keys, "__m"), place).alias("last")).select("__p", "last.*").orderBy("__p").toArrow())
    schema = T.StructType([spread.schema["__left"], spread.schema["__t"], T.StructField("__hit", spread.schema["__m"].dataType)])
    return spread.mapInArrow(_scan(keys, last), schema)


def _scan(keys: list[str], last: pa.Table):
    """Forward fill inside a partition, from the last right row of the partitions before it."""
    before = last.column("__p").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # the last right row so far: keys and __m, one row
        began = False
        for batch in batches:
            if not batch.num_rows:
                continue
            if not began:
                began = True
                at = int(np.searchsorted(before, batch.column("__p")[0].as_py())) - 1
                if at >= 0:
                    state = last.slice(at, 1).select([*keys, "__m"]).combine_chunks().to_batches()[0]
            n = batch.num_rows
            side = batch.column("__side").to_numpy()
            new = np.zeros(n, bool)
            new[0] = True
            for k in keys:
                col = batch.column(k)
                new[1:] |= pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            hit = np.maximum.accumulate(np.where(side == 0, np.arange(n), -1))
            hit = np.where(hit >= group, hit, -1)
            source = batch.column("__m")
            if state is not None and all(state.column(k)[0].as_py() == batch.column(k)[0].as_py() for k in keys):
                # the batch goes on with the key of the row before it
                source = pa.concat_arrays([source, state.column("__m").cast(source.type)])
                hit = np.where((hit < 0) & (group == 0), n, hit)
            own = np.flatnonzero(side == 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__left").take(pa.array(own)), batch.column("__t").take(pa.array(own)),
                 source.take(pa.array(hit[own], mask=hit[own] < 0))], names=["__left", "__t", "__hit"])
            rights = np.flatnonzero(side == 0)
            if len(rights):
                state = batch.slice(int(rights[-1]), 1).select([*keys, "__m"])
    return run


def next_event_gap(
    events: DataFrame,
    user: str,
    ts: str,
    tie: str,
    out: str,
    max_gap_seconds: float,
    bucket_seconds: int = 86400,
) -> DataFrame:
    """``out`` = True when the same user's next event (by ``ts, tie``) is at
    most ``max_gap_seconds`` later; the user's last event gives False.

    The window is partitioned by ``(user, time bucket)`` instead of ``user`` so
    a heavy user is split over many tasks.  Rows in the first ``max_gap`` of a
    bucket are copied (time and tie only) into the previous bucket as
    look-ahead rows; that is all the previous bucket needs.
    """
    gap_us = int(round(max_gap_seconds * 1_000_000))
    width = int(bucket_seconds) * 1_000_000
    if gap_us >= width:
        raise ValueError("bucket_seconds must exceed the gap")
    cols = events.columns
    t = epoch_micros(ts)
    base = events.select(
        F.col(user).alias("__u"), t.alias("__t"), F.col(tie).alias("__tie"),
        F.lit(1).alias("__real"), F.struct(*[F.col(c) for c in cols]).alias("__row"),
    ).withColumn("__b", F.floor(F.col("__t") / F.lit(width)))
    look = base.where(F.col("__t") - F.col("__b") * F.lit(width) <= F.lit(gap_us)).select(
        "__u", "__t", "__tie", F.lit(0).alias("__real"),
        F.lit(None).cast(base.schema["__row"].dataType).alias("__row"),
        (F.col("__b") - 1).alias("__b"),
    )
    w = Window.partitionBy("__u", "__b").orderBy("__t", "__tie")
    u = base.unionByName(look).withColumn("__next", F.lead("__t").over(w)).where(F.col("__real") == 1)
    flag = F.coalesce((F.col("__next") - F.col("__t")) <= F.lit(gap_us), F.lit(False))
    return u.select(*[F.col(f"__row.{c}").alias(c) for c in cols], flag.alias(out))


def previous_event_gap(
    events: DataFrame,
    user: str,
    ts: str,
    tie: str,
    out: str,
    first_value: float = 1e6,
    bucket_seconds: int = 86400,
) -> DataFrame:
    """Minutes since the same user's previous event (by ``ts, tie``); the
    first event gets ``first_value``.

    Rows are windowed per (user, day bucket); a bucket's first row takes its
    previous time from the last time of the user's previous non-empty bucket,
    found by a per-user window over the (user, bucket) summary table, which has
    one row per active bucket rather than per event.  A user with a third of
    all rows is split over its days.
    """
    width = int(bucket_seconds) * 1_000_000
    cols = events.columns
    base = events.withColumn("__t", epoch_micros(ts)).withColumn("__b", F.floor(F.col("__t") / F.lit(width)))
    w1 = Window.partitionBy(user, "__b").orderBy("__t", tie)
    base = base.withColumn("__prev", F.lag("__t").over(w1))
    summ = base.groupBy(user, "__b").agg(F.max("__t").alias("__last"))
    summ = summ.withColumn("__prev_bucket", F.lag("__last").over(Window.partitionBy(user).orderBy("__b")))
    j = base.join(summ.select(user, "__b", "__prev_bucket"), [user, "__b"])
    prev = F.coalesce(F.col("__prev"), F.col("__prev_bucket"))
    gap = F.when(prev.isNull(), F.lit(first_value)).otherwise((F.col("__t") - prev) / F.lit(60_000_000.0))
    return j.select(*cols, gap.alias(out))
