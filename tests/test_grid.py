"""Two-dimensional joins: even cells, kept limits, every pair once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from stakeflow.operators import scoring as S
from stakeflow.operators.grid import Grid, cogroup_on_grid, grid_for, task_key, task_keys


@pytest.mark.parametrize("left,right,tasks", [(1, 1, 8), (256_000, 1, 64), (10, 1000, 40), (10**9, 10**5, 1000), (50_000, 33, 8), (0, 0, 8)])
def test_limits_and_cells(left, right, tasks):
    g = grid_for(left, 16_384, right, 16, 100, 10_000, tasks)
    assert left <= g.rows * 16_384 and right <= g.cols * 16
    assert g.rows * g.cols >= min(tasks, max(left, 1) * max(right, 1))
    assert g.rows <= max(left, 1) and g.cols <= max(right, 1)


def test_small_side_is_replicated():
    assert grid_for(1000, 10**6, 64, 64, 500, 10**9, 64) == Grid(1, 64)  # a large catalog moves once
    assert grid_for(10**6, 10**6, 64, 64, 500, 10, 64) == Grid(64, 1)  # a small one goes to all users


def test_every_pair_meets_once(spark):
    left, right = spark.range(97).withColumnRenamed("id", "a"), spark.range(41).withColumnRenamed("id", "b")

    def pairs(x, y):
        a, b = x.column("a").to_numpy(), y.column("b").to_numpy()
        return pa.table({"a": np.repeat(a, len(b)), "b": np.tile(b, len(a))})

    got = cogroup_on_grid(left, right, F.xxhash64("a"), F.col("b"), Grid(5, 3), pairs, "a bigint, b bigint")
    assert got.count() == got.distinct().count() == 97 * 41
    assert cogroup_on_grid(left.limit(0), right, F.xxhash64("a"), F.col("b"), Grid(5, 3), pairs, "a bigint, b bigint").count() == 0


def test_one_block_and_many_users_fill_many_tasks(spark):
    """256,000 users against a catalog of one block: the tasks grow with the users, and none has much more than its share."""
    rng = np.random.default_rng(1)
    items = spark.createDataFrame([(f"i{j}", rng.normal(size=4).tolist()) for j in range(50)], "gameId string, embedding array<double>")
    blocks = S.item_blocks(items)
    assert blocks.n_blocks == 1
    grid = S.score_grid(256_000, blocks, 40)
    assert grid.cols == 1 and grid.rows >= 40
    users = spark.range(256_000).select(F.col("id").cast("string").alias("rid"))
    seen = cogroup_on_grid(users, blocks.table, F.xxhash64("rid"), F.col("block"), grid,
                           lambda u, b: pa.table({"users": [u.num_rows], "blocks": [b.num_rows]}), "users bigint, blocks bigint").collect()
    assert len(seen) == grid.rows and all(r.blocks == 1 for r in seen)
    sizes = [r.users for r in seen]
    assert sum(sizes) == 256_000 and max(sizes) < 1.1 * 256_000 / grid.rows
    assert S.score_grid(2_560_000, blocks, 40).rows > grid.rows


@pytest.mark.parametrize("n", [1, 8, 50])
def test_every_group_has_a_task_of_its_own(spark, n):
    keys = task_keys(spark, n)
    cells = spark.range(n).withColumn("key", task_key(F.col("id"), keys)).repartition(n, "key")
    assert cells.select(F.spark_partition_id()).distinct().count() == n


def test_cells_of_the_grid_fill_all_tasks(spark):
    """Eight cells dealt by the hash of their row and column fill five or six of eight tasks."""
    left, right = spark.range(800).withColumnRenamed("id", "a"), spark.range(8).withColumnRenamed("id", "b")

    def task(x, y):
        return pa.table({"task": [TaskContext.get().partitionId()], "rows": [x.num_rows]})

    for grid in (Grid(8, 1), Grid(1, 8), Grid(4, 2)):
        seen = cogroup_on_grid(left, right, F.col("a"), F.col("b"), grid, task, "task bigint, rows bigint").collect()
        assert len({r.task for r in seen}) == 8 and sum(r.rows for r in seen) == 800 * grid.cols
