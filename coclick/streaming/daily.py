"""Incremental daily jobs on Structured Streaming.

The reference recomputes a day's counts as a batch job per day and merges
N days later.  Here the daily layer is an ``availableNow`` stream over the
click files: each micro-batch finds the days it touched and recomputes exactly
those days from the full source (a left-semi join on the day partition
column, which Spark prunes dynamically), then dynamically overwrites those
day partitions.  Re-running a batch after a failure rewrites the same
partitions with the same content, so the output is exactly-once; progress
lives in the checkpoint location (a shared folder on a cluster).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def daily_stream(spark: SparkSession, source_path: str, schema: StructType, out_path: str,
                 checkpoint_location: str, build: Callable[[DataFrame], DataFrame],
                 day_col: str = "day", available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Keep ``out_path`` (partitioned by ``day_col``) equal to ``build`` applied
    per day to the Parquet data under ``source_path`` (partitioned by day).

    ``build`` receives the clicks of the touched days (all columns, including
    ``day_col``) and must return rows that carry ``day_col``.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(day_col).distinct()
        full = spark.read.schema(schema).parquet(source_path)
        days = full.join(touched, day_col, "left_semi")
        out = build(days)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(day_col).parquet(out_path)

    stream = spark.readStream.schema(schema).parquet(source_path)
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def daily_cooccurrence_stream(spark: SparkSession, source_path: str, schema: StructType, out_path: str,
                              checkpoint_location: str, **cf_kwargs) -> StreamingQuery:
    """CF1 per day, incrementally (clicks columns: user, item, ts, day)."""
    from coclick.operators.itemcf import daily_cooccurrence

    return daily_stream(spark, source_path, schema, out_path, checkpoint_location,
                        lambda d: daily_cooccurrence(d, day_col="day", **cf_kwargs))


def daily_edges_stream(spark: SparkSession, source_path: str, schema: StructType, out_path: str,
                       checkpoint_location: str, session_cols: list[str], tiebreak: str | None = None
                       ) -> StreamingQuery:
    """GR1 per day, incrementally (clicks columns include the session cols and day)."""
    from coclick.operators.graph import session_edges

    return daily_stream(spark, source_path, schema, out_path, checkpoint_location,
                        lambda d: session_edges(d, session_cols, tiebreak=tiebreak, day_col="day"))
