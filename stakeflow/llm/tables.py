"""Reading the input tables and cutting lineage by written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stakeflow.session import ensure_checkpoint_dir


#: Bytes of one Arrow batch on its way to Python, where the session does not say: texts are long, and
#: the usual bound of 10,000 rows would be tens of megabytes in every worker.
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = 4 << 20


def _bound_batches(spark: SparkSession) -> None:
    if spark.conf.get(ARROW_BATCH, None) is None:
        spark.conf.set(ARROW_BATCH, str(ARROW_BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    _bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _folder(spark: SparkSession) -> str:
    """This application's folder of written tables in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{spark.sparkContext.applicationId}"


def drop_written(spark: SparkSession) -> None:
    """Delete all tables that this application has written with ``materialise``; results that were not
    written elsewhere cannot be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The files survive the loss of any executor, take a column-compressed form
    (smaller than an RDD checkpoint) and cut the lineage.  ``drop_written`` removes them.
    """
    spark = df.sparkSession
    _bound_batches(spark)
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
