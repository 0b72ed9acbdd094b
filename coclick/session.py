"""Session construction and lineage checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library wants; a cluster deployment passes its
# own master / memory and keeps these.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "coclick",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder there.  Only when the
    setting is unset (local tests) is ``fallback`` used and written back.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and fallback:
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    spark = df.sparkSession
    if not checkpoint_dir(spark):
        raise ValueError("spark.checkpoint.dir is not set: name a shared folder for reliable checkpoints")
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder.

    A local master without the setting gets a folder of its own; a cluster has
    to name one that all executors share.
    """
    local = spark.sparkContext.master.startswith("local")
    root = checkpoint_dir(spark) or (checkpoint_dir(spark, tempfile.mkdtemp(prefix="coclick-")) if local else None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage is cut, lost executors cost nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_test_session(tmp_root: str, cores: int = 8, partitions: int = 8) -> SparkSession:
    """Session for tests / bench: local master, checkpoint dir under tmp_root."""
    spark = build_session(master=f"local[{cores}]", shuffle_partitions=partitions,
                          extra={"spark.driver.memory": "16g",
                                 "spark.local.dir": os.path.join(tmp_root, "spark-local")})
    checkpoint_dir(spark, os.path.join(tmp_root, "checkpoints"))
    return spark


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``coclick`` importable in the Python workers of this application.

    Operators that run Python inside tasks (Arrow UDFs, cogroups) pickle
    functions of this package by reference; ``addPyFile`` distributes a zip of
    the package to every executor.  Harmless when it is already installed
    there; done once per SparkContext.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if not _ZIP:
        # driver-side staging of the code archive only; Spark copies it to every
        # executor through its file server (no data is kept in this folder)
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="coclick-pyfiles-"), "coclick.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(root):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(d, f)
                        z.write(full, os.path.join("coclick", os.path.relpath(full, root)))
        _ZIP.append(path)
    sc.addPyFile(_ZIP[0])
    _SHIPPED.add(sc.applicationId)
