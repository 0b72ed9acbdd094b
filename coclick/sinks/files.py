"""Sinks and dataset housekeeping (SNK1-SNK12, SRC10 helpers).

File-system work (success markers, listing, retention) goes through the
Hadoop FileSystem API from the driver, so it works on HDFS / object stores
and never shells out.  Deletions only ever touch children of the given base.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from coclick.session import shared_folder

SUCCESS = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a success marker (a finished write)."""
    fs, p, jvm = _fs(spark, path)
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(p, SUCCESS)))


def complete_snapshots(spark: SparkSession, base: str) -> list[str]:
    """Child directories of ``base`` with a success marker, newest (by name) first."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = [st.getPath().toString() for st in fs.listStatus(p)
           if st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), SUCCESS))]
    return sorted(out, key=lambda s: s.rstrip("/").rsplit("/", 1)[-1], reverse=True)


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """AG9: attach a row-count metric that is filled by whatever action runs
    next (the write), instead of a separate ``count()`` pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> str:
    """SNK1: overwrite ``path`` with snappy Parquet; ``files`` fixes the file
    count (a repartition, for layout only), otherwise AQE sizes the output."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_clustered(df: DataFrame, keys: list[str], name: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """SNK1 (clustered form): ``df`` as a table bucketed and sorted by ``keys``, read back.

    Joins on exactly these keys take the stored side as it lies, without a shuffle.
    ``buckets`` defaults to the session's shuffle partitions, so the other side is
    dealt alike; the files go to ``path`` or a new folder of the shared one.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys) \
        .option("path", path or shared_folder(spark, name)).saveAsTable(table)
    return spark.table(table)


def write_snapshot(df: DataFrame, base: str, snapshot: str, files: int | None = None) -> str:
    """SNK2: write a versioned snapshot ``base/<snapshot>`` (epoch or day)."""
    return write_parquet(df, f"{base.rstrip('/')}/{snapshot}", files)


def write_partition(df: DataFrame, base: str, partition_col: str) -> str:
    """SNK2 (partition-column form): dynamic overwrite of only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(base)
    return base


def if_missing(spark: SparkSession, path: str, build: Callable[[], DataFrame],
               write: Callable[[DataFrame, str], object] = write_parquet) -> bool:
    """SNK3: build and write only when ``path`` has no success marker.
    Returns True when it wrote."""
    if is_complete(spark, path):
        return False
    write(build(), path)
    return True


def keep_latest(spark: SparkSession, base: str, keep: int) -> list[str]:
    """SNK4: delete all but the newest ``keep`` complete snapshots under
    ``base``; incomplete directories are never listed, so never deleted.
    Returns the removed paths."""
    doomed = complete_snapshots(spark, base)[keep:]
    jvm = spark.sparkContext._jvm
    for d in doomed:
        fs, p, _ = _fs(spark, d)
        fs.delete(jvm.org.apache.hadoop.fs.Path(d), True)
    return doomed


def write_lines(df: DataFrame, path: str, col: str = "line", compression: str | None = "gzip",
                files: int | None = None) -> str:
    """SNK5/SNK6/SNK7/SNK10: one text line per row (gzip by default)."""
    out = df.select(col)
    if files:
        out = out.repartition(files)
    w = out.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def write_tsv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """SNK8/SNK11: header-less tab-separated text."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", "false")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def convert_if_absent(spark: SparkSession, parquet_path: str, tsv_path: str,
                      render: Callable[[DataFrame], DataFrame] | None = None) -> bool:
    """SNK9: re-export Parquet rows as TSV unless the TSV is already complete."""
    def build():
        df = spark.read.parquet(parquet_path)
        return render(df) if render else df
    return if_missing(spark, tsv_path, build, write_tsv)


def save_model(model, path: str) -> str:
    """SNK12: persist a Spark ML model (e.g. Word2Vec) with overwrite."""
    model.write().overwrite().save(path)
    return path
