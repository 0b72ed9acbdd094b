"""Mapping of the generated test tables onto the library's input fixtures.

* ``events``            -> sparse timed clicks: user ``user_id``, item ``$.k`` of
  ``props`` (0 is invalid), ``ts``, tie-break ``event_id``, session (user, day).
* ``lineitem ⋈ orders`` -> dense co-purchase: user ``o_custkey``, item
  ``l_partkey``, time ``o_orderdate``, session ``l_orderkey``.
* ``part``              -> whitelist (``p_size <= 25``), shop (brand number),
  item feature snapshots (``p_retailprice`` based).
* ``embeddings``        -> item vectors; ``documents`` / ``benchmark`` -> words.

Only the columns each fixture needs are selected, so scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coclick.functions.ids import item_id_cast, item_id_strict


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def copurchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, ts, session, line): one row per order line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
        F.col("o_orderdate").alias("ts"), F.col("l_orderkey").alias("session"),
        F.col("l_linenumber").cast("bigint").alias("line"))


def event_clicks(spark: SparkSession, sf_dir: str, event_type: str | None = "click",
                 strict_ids: bool = True) -> DataFrame:
    """(user, item, ts, eid, day): clicks from ``events``; ``day`` is the UTC date."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    if event_type is not None:
        ev = ev.where(F.col("event_type") == event_type)
    item = item_id_strict("props", "$.k") if strict_ids else item_id_cast("props", "$.k")
    out = ev.where(F.col("user_id") > 0).select(
        F.col("user_id").alias("user"), item.alias("item"), F.col("ts"),
        F.col("event_id").alias("eid"), F.to_date("ts").alias("day"))
    return out.where(F.col("item") != 0) if strict_ids else out.where(F.col("item").isNotNull())


def part_whitelist(spark: SparkSession, sf_dir: str, max_size: int = 25) -> DataFrame:
    """Recommendable ids: parts with ``p_size <= max_size`` (one column ``item``)."""
    return table(spark, sf_dir, "part").where(F.col("p_size") <= max_size) \
        .select(F.col("p_partkey").alias("item")).distinct()


def part_shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item -> shop dimension (``item_id``, ``shop_id`` = brand number)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint").alias("shop_id"))


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item feature snapshots (``itemid, ctcvr30, country, dt``), two days.

    The older snapshot holds every part, the newer one the parts whose size is
    not a multiple of 3, so picking the newest snapshot matters.
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    old = p.select(F.col("p_partkey").alias("itemid"), (F.col("p_retailprice") / 4000.0).alias("ctcvr30"),
                   F.lit("ID").alias("country"), F.lit("2024-01-29").alias("dt"))
    new = p.where(F.col("p_size") % 3 != 0).select(
        F.col("p_partkey").alias("itemid"), (F.col("p_retailprice") / 2000.0).alias("ctcvr30"),
        F.lit("ID").alias("country"), F.lit("2024-01-30").alias("dt"))
    return old.unionByName(new)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec array<float>, label)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label")
