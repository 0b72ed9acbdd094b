"""Documents in ascending id order, in bounded buckets of consecutive ids."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 4096


def id_bounds(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[int]:
    """Smallest ids of the buckets: present ids that cut the table into about equal runs.

    One pruned scan of ``doc_id`` with a map-side quantile sketch; the driver
    gets one number per bucket.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    rows, least = ids.agg(F.count("doc_id"), F.min("doc_id")).first()
    if not rows:
        return []
    buckets = max(1, math.ceil(rows / rows_per_bucket))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5],
                                       50 * buckets)).first()[0] if buckets > 1 else []
    return sorted({int(least), *map(int, cuts)})


def with_buckets(docs: DataFrame, bounds: list[int], look_ahead: bool = False) -> DataFrame:
    """``docs`` plus ``bucket`` (position of its id range; null ids are in the first) and ``ahead``.

    With ``look_ahead`` every row that opens a bucket also appears, marked
    ``ahead``, at the end of the bucket before (the first one: the last), so each
    row's successor is in its own bucket and no row is sent to another task for it.
    """
    starts = np.array(bounds or [0], dtype=np.int64)
    n = len(starts)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        v = ids.to_numpy()
        at = np.clip(np.searchsorted(starts, v, "right") - 1, 0, n - 1)
        return pd.Series((2 * at + (starts[at] == v)).astype("int32"))

    # null ids share the first bucket and precede its ids
    coded = docs.withColumn("__code", place(F.coalesce(F.col("doc_id"), F.lit(int(starts[0])))))
    at, opens = F.shiftright("__code", 1), F.col("__code").bitwiseAND(1) == 1
    if not look_ahead:
        return coded.withColumns({"bucket": at, "ahead": F.lit(False)}).drop("__code")
    own = F.struct(at.alias("bucket"), F.lit(False).alias("ahead"))
    before = F.struct(F.pmod(at - 1, F.lit(n)).alias("bucket"), F.lit(True).alias("ahead"))
    return coded.withColumn("__place", F.explode(F.when(opens, F.array(own, before)).otherwise(F.array(own)))) \
        .withColumns({"bucket": F.col("__place.bucket"), "ahead": F.col("__place.ahead")}).drop("__code", "__place")


def in_order(bucketed: DataFrame) -> DataFrame:
    """Buckets dealt to tasks; inside a task sorted by bucket, then id (nulls first, ties by text)."""
    return bucketed.repartition("bucket") \
        .sortWithinPartitions("bucket", "ahead", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
