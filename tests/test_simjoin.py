"""The bounded similarity join against all pairs."""

import pytest
from pyspark.sql import functions as F

from coclick.operators import itemcf, simjoin


def clicks(spark, n=4000):
    """Skewed users and items, repeated clicks, a user with a third of all rows."""
    d = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.floor(F.pow(F.rand(3), 2) * 120) + 1).cast("long").alias("user"),
        F.floor(F.pow(F.rand(5), 2) * 90).cast("long").alias("item"), F.timestamp_seconds("id").alias("ts"))
    return d.unionByName(d.limit(9).withColumn("item", F.lit(None).cast("long"))).cache()


def as_rows(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def all_scores(c, min_weight=3):
    return itemcf.cosine_scores(itemcf.merge_counts(itemcf.daily_cooccurrence(c), min_weight=min_weight))


@pytest.mark.parametrize("min_weight", [0, 3])
def test_pairs_over_every_floor_equal_all_pairs(spark, min_weight):
    c = clicks(spark)
    scores = all_scores(c, min_weight).cache()
    vectors = simjoin.click_vectors(c).cache()
    cols = ["va", "vb", "weight", "weight_a", "weight_b", "score"]
    for floor in (0.0, 0.1, 0.3, 0.6, 0.9):
        want = as_rows(scores.where(F.col("score") > floor), *cols)
        assert as_rows(simjoin.similar_pairs(vectors, floor, min_weight), *cols) == want


def test_pairs_that_cannot_reach_the_floor_are_not_made(spark):
    # groups of users with a taste of their own, and six who click everywhere: those make most pairs
    own = spark.range(9000).select((F.col("id") % 900 + 10).alias("user"),
                                   ((F.col("id") % 60) * 20 + F.pmod(F.xxhash64("id"), F.lit(20))).alias("item"))
    wide = spark.range(2400).select((F.col("id") % 6).alias("user"), F.pmod(F.xxhash64("id"), F.lit(1200)).alias("item"))
    c = own.unionByName(wide).distinct().withColumn("ts", F.timestamp_seconds("item")).cache()
    scores = all_scores(c).cache()
    weighted, _ = simjoin._weighted(simjoin.click_vectors(c), 3)
    everything = itemcf.daily_cooccurrence(c).where("vi <> vj").count()
    made = [simjoin.candidate_pairs(weighted, floor, 3).count() for floor in (0.1, 0.3, 0.5)]
    assert made == sorted(made, reverse=True) and made[0] < 0.3 * everything, (everything, made)
    for floor, n in zip((0.1, 0.3, 0.5), made, strict=True):
        want = scores.where(F.col("score") > floor).count()
        assert 0 < want <= n and simjoin.similar_pairs(simjoin.click_vectors(c), floor).count() == want


@pytest.mark.parametrize("rule", [dict(k2=10, min_keep=5, floor=0.4, clamp_at=0.9), dict(k2=6, min_keep=0, floor=0.5),
                                  dict(k2=8, min_keep=8, floor=0.7), dict(k2=9, min_keep=3, floor=0.9, clamp_at=0.3)])
def test_lists_equal_those_of_all_pairs(spark, rule):
    c = clicks(spark)
    want = itemcf.neighbour_lists(all_scores(c), **rule)
    got = simjoin.bounded_lists(simjoin.click_vectors(c), **rule)
    assert as_rows(got, "item", "rank", "nbr", "score") == as_rows(want, "item", "rank", "nbr", "score")


def test_empty_clicks(spark):
    c = clicks(spark).limit(0)
    assert simjoin.similar_pairs(simjoin.click_vectors(c), 0.1).collect() == []
    assert simjoin.bounded_lists(simjoin.click_vectors(c)).collect() == []
