"""Positions by sampled splitters and joins that split heavy keys."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from coclick.operators.positions import numbered, running, wrapping_add, wrapping_sub
from coclick.operators.skew import heavy_from_sizes, heavy_keys, split_join
from support import rows


def skewed(spark, n=60_000):
    """A third of the rows on one (null) key and one hour; small keys; a key column of two parts."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise((F.xxhash64("id") % 50).cast("string")).alias("user"),
        (F.col("id") % 2).alias("kind"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("ts"),
        F.xxhash64("id").alias("v"))


def test_running_equals_row_number_and_no_task_holds_the_hot_key(spark):
    df = skewed(spark)
    out = running(df, ["user", "kind"], ["ts", "v"], parts=24)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("user", "kind").orderBy("ts", "v")).cast("bigint"))
    assert out.select(*want.columns).exceptAll(want).isEmpty() and out.count() == 60_000
    tasks = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(tasks) == 24 and max(tasks) <= 2 * np.median(tasks)


def test_running_sums_wrap_and_neighbours_share_keys(spark):
    out = running(skewed(spark, 3000), ["user", "kind"], ["v"], ["v"], parts=7).toPandas() \
        .sort_values(["user", "kind", "v"], na_position="first")
    keys = list(out[["user", "kind"]].astype(object).where(out.notna(), None).itertuples(index=False, name=None))
    shared = [0] + [2 if a == b else int(a[0] == b[0]) for a, b in zip(keys, keys[1:])]
    assert out["shared_prev"].tolist() == shared and out["shared_next"].tolist() == shared[1:] + [0]
    for _, g in out.groupby(["user", "kind"], dropna=False):
        assert (np.cumsum(g["v"].to_numpy().view(np.uint64)).view(np.int64) == g["v_upto"].to_numpy()).all()


def test_running_drops_rows_without_company(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (4, "e"), (4, "e"), (None, "z")], "k long, v string")
    out = running(df, ["k"], ["v"], parts=3, drop_alone=True)
    assert sorted(r["k"] for r in out.collect()) == [2, 2, 4, 4]
    assert running(df.limit(0), ["k"], ["v"], ["k"]).collect() == []
    # one sequence over the whole table
    assert sorted(r["pos"] for r in running(df, [], ["k", "v"], parts=3).collect()) == list(range(1, 8))
    with pytest.raises(ValueError):
        running(df.withColumnRenamed("v", "pos"), ["k"], ["pos"])


@pytest.mark.parametrize("rows_per_task", [None, 500])
def test_numbered_equals_window(spark, rows_per_task):
    df = skewed(spark, 6000)
    key = Window.partitionBy("user")
    want = df.withColumn("pos", F.row_number().over(key.orderBy("ts", "v")).cast("bigint")).withColumn("n", F.count("*").over(key))
    got = numbered(df, ["user"], ["ts", "v"], "pos", "n", rows_per_task=rows_per_task, parts=9)
    assert got.count() == 6000 and got.select(*want.columns).exceptAll(want).isEmpty()


def test_wrapping_arithmetic(spark):
    pairs = [(2 ** 63 - 1, 1), (-2 ** 63, -1), (-1, -1), (5, -7), (2 ** 62, 2 ** 62), (0, -2 ** 63)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", wrapping_add(F.col("a"), F.col("b")).alias("s"),
                                                               wrapping_sub(F.col("a"), F.col("b")).alias("d"))
    wrap = lambda x: (x + 2 ** 63) % 2 ** 64 - 2 ** 63
    assert all(r["s"] == wrap(r["a"] + r["b"]) and r["d"] == wrap(r["a"] - r["b"]) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_join(spark, how):
    left = skewed(spark, 9000).withColumn("user", F.coalesce("user", F.lit("hot")))
    left = left.unionByName(left.limit(5).withColumn("user", F.lit(None).cast("string")))
    right = left.select("user").distinct().where("user <> '7'").withColumn("w", F.length("user")) \
        .unionByName(spark.range(300).select(F.lit("hot").alias("user"), F.col("id").cast("int").alias("w")))
    plain = left.join(right, ["user"], how)
    split = split_join(left, right, ["user"], how, rows_per_piece=100)
    assert "__a" in split._jdf.queryExecution().optimizedPlan().toString()
    assert rows(split.groupBy(*plain.columns).count()) == rows(plain.groupBy(*plain.columns).count()) if how == "left_semi" \
        else split.count() == plain.count() and split.select(*plain.columns).exceptAll(plain).isEmpty()
    # ordinary keys: no salt in the plan
    assert "__a" not in split_join(left, right, ["user"], how, rows_per_piece=10_000)._jdf.queryExecution() \
        .optimizedPlan().toString()


def test_heavy_keys_are_named_with_their_size(spark):
    heavy = heavy_keys(skewed(spark).withColumn("user", F.coalesce("user", F.lit("hot"))), ["user"], 5000)
    h = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert heavy == {h: 4}
    sizes = spark.createDataFrame([(1, 10), (2, 25), (3, 11)], "k long, n long")
    assert sorted(heavy_from_sizes(sizes, ["k"], "n", 10).values()) == [2, 3]
