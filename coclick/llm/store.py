"""Tables handed from one job to the next through shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from coclick.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    root = checkpoint_dir(spark)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage with a replica that survives lost executors, and later reads
    of the table prune columns.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows per Arrow batch: texts are long, and a batch is held by the JVM and the Python worker at once.
ROWS_PER_BATCH = 1000


def shipped(spark: SparkSession) -> SparkSession:
    """Executors can import this package from here on; texts go to Python in small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark
