"""Clustered storage: the stored side of a join is not shuffled."""

import pytest
from pyspark.sql import functions as F

from coclick.operators import graph, itemcf
from coclick.session import stored
from coclick.sinks import write_clustered
from support import rows


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_counts_are_not_shuffled(spark, no_broadcast):
    merged = spark.range(3000).selectExpr("id % 60 AS va", "(id * 7) % 61 AS vb", "id % 5 + 3.0 AS weight") \
        .groupBy("va", "vb").agg(F.max("weight").alias("weight"))
    merged = merged.unionByName(spark.range(60).selectExpr("id AS va", "id AS vb", "9.0D AS weight")).groupBy("va", "vb") \
        .agg(F.max("weight").alias("weight"))
    merged = stored(merged, "merged")
    got = itemcf.cosine_scores(merged, itemcf.clustered_counts(merged))
    # the pairs move to each end's item, the counts never
    assert exchanges(got) == 2 and exchanges(itemcf.cosine_scores(merged)) == 4
    assert rows(got) == rows(itemcf.cosine_scores(merged))


def test_adjacency_is_not_shuffled(spark, no_broadcast):
    edges = spark.range(900).selectExpr("id % 30 AS va", "id % 29 + 100 AS vb", "9.0D AS w").distinct()
    adj = graph.adjacency(edges.unionByName(edges.selectExpr("vb AS va", "va AS vb", "w")))
    ctx = graph.label_contexts(edges.limit(40).withColumn("w", F.lit(3.0)))
    adj, ctx = stored(adj, "adjacency"), stored(ctx, "contexts")
    lying = graph.clustered_adjacency(adj)
    got = graph.hop1_samples(ctx, lying)
    # contexts and degrees meet by the centre, the draws come to the neighbours as these lie
    assert exchanges(got) == 3 and exchanges(graph.hop1_samples(ctx, adj)) == 4
    assert rows(got) == rows(graph.hop1_samples(ctx, adj))
    assert sorted(map(str, graph.hop2_samples(got, lying).collect())) == \
        sorted(map(str, graph.hop2_samples(graph.hop1_samples(ctx, adj), adj).collect()))


def test_round_trip_of_any_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a"), (2, None)], "k long, v string")
    assert sorted(map(str, write_clustered(df, ["k"], "some-rows", 3).collect())) == sorted(map(str, df.collect()))
    assert write_clustered(df.limit(0), ["k", "v"], "no-rows").collect() == []
