"""Two-dimensional joins: every row of one table next to every row of another, in groups.

The left rows are dealt into ``rows`` groups and the right ones into ``cols``;
a task holds one group of each (fragment and replicate).  A left row moves
``cols`` times and a right row ``rows`` times, however few right rows there are,
so a small catalog still fills as many tasks as there are groups of users.
Spark deals rows to tasks by the hash of their key, which puts several groups into
one task and none into others; the keys of the groups are chosen so that each
has a task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    rows: int
    cols: int


def grid_for(left: int, left_limit: int, right: int, right_limit: int, left_bytes: float, right_bytes: float, tasks: int) -> Grid:
    """The grid that moves the fewest bytes among those whose groups keep their limits (rows of a group)
    and that has ``tasks`` cells, where there are rows for so many."""
    least_rows, least_cols = max(1, -(-left // left_limit)), max(1, -(-right // right_limit))
    best = None
    cols = least_cols
    while True:
        cols = min(cols, max(right, 1))
        rows = max(least_rows, min(-(-tasks // cols), max(left, 1)))
        moved = left * left_bytes * cols + right * right_bytes * rows
        # fewer cells than asked for only where the rows don't suffice
        short = max(0, tasks - rows * cols)
        if best is None or (short, moved) < best[0]:
            best = (short, moved), Grid(rows, cols)
        if cols >= max(right, 1) or cols >= max(tasks, least_cols):
            return best[1]
        cols *= 2


def task_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` integers that ``repartition(n, key)`` deals to ``n`` different tasks."""
    tried = 8 * n
    while True:
        ids = spark.range(tried).select(F.col("id").cast("int").alias("key"))
        found = ids.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("task")).agg(F.min("key").alias("key")).collect()
        if len(found) == n:
            return sorted(r["key"] for r in found)
        tried *= 2


def task_key(cell: Column, keys: list[int]) -> Column:
    """The key of a cell 0..n-1."""
    return F.element_at(F.array(*[F.lit(k) for k in keys]), (cell + 1).cast("int"))


def cogroup_on_grid(left: DataFrame, right: DataFrame, left_deal: Column, right_deal: Column, grid: Grid, run, schema: str) -> DataFrame:
    """``run(left rows, right rows)`` (Arrow tables) on every cell; ``*_deal`` are integers by which rows are dealt."""
    cells = grid.rows * grid.cols
    key = task_key(F.col("__row") * F.lit(grid.cols) + F.col("__col"), task_keys(left.sparkSession, cells))
    one = (left.withColumn("__row", F.pmod(left_deal, F.lit(grid.rows)).cast("int"))
           .withColumn("__col", F.explode(F.sequence(F.lit(0), F.lit(grid.cols - 1)))).withColumn("__cell", key))
    two = (right.withColumn("__col", F.pmod(right_deal, F.lit(grid.cols)).cast("int"))
           .withColumn("__row", F.explode(F.sequence(F.lit(0), F.lit(grid.rows - 1)))).withColumn("__cell", key))
    return (one.drop("__row", "__col").repartition(cells, "__cell").groupBy("__cell")
            .cogroup(two.drop("__row", "__col").repartition(cells, "__cell").groupBy("__cell"))
            .applyInArrow(run, schema))
