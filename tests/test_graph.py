from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import Window

from coclick.functions.hashing import balanced_draws, floyd_sample
from coclick.functions.text import array_text, nested_array_text
from coclick.operators import graph
from coclick.operators.positions import numbered
from support import rows


def test_f4_session_edges(spark):
    df = spark.createDataFrame([("s", 5, 1), ("s", 7, 2), ("s", 7, 3), ("s", 9, 4)], "session string, item bigint, ts bigint") \
        .withColumn("ts", F.timestamp_seconds("ts"))
    e = graph.session_edges(df, ["session"])
    assert rows(e, "va", "vb", "w") == [(5, 7, 1.0), (7, 5, 1.0), (7, 9, 1.0), (9, 7, 1.0)]


def test_positions_of_a_hot_session_match_window(spark):
    # one hot session spread over many hours plus small ones
    data = [("hot", (i * 37) % 1000, i * 600 + (i % 3)) for i in range(500)] + \
           [(f"s{j}", j, j * 10) for j in range(20)]
    df = spark.createDataFrame(data, "session string, item bigint, ts bigint").withColumn("eid", F.col("ts")) \
        .withColumn("ts", F.timestamp_seconds("ts"))
    idx = numbered(df, ["session"], ["ts", "eid"], rows_per_task=50)
    ref = df.withColumn("pos", F.row_number().over(Window.partitionBy("session").orderBy("ts", "eid")))
    assert rows(idx, "session", "eid", "pos") == rows(ref, "session", "eid", "pos")


def draws(spark, n, k, ctx="x"):
    df = spark.createDataFrame([(n,)], "n bigint")
    return df.select(balanced_draws("n", k, "seed", F.lit(ctx)).alias("d")).collect()[0].d


def test_f5_balanced_sample_repeats(spark):
    d = draws(spark, 3, 10)
    c = Counter(d)
    assert len(d) == 10 and sorted(c.values()) == [3, 3, 4] and set(c) == {0, 1, 2}


def test_f6_balanced_sample_distinct(spark):
    for ctx in "abcdef":
        d = draws(spark, 15, 10, ctx)
        assert len(d) == 10 and len(set(d)) == 10 and all(0 <= x < 15 for x in d)


def test_floyd_is_uniform_enough(spark):
    df = spark.range(3000).select(floyd_sample(F.lit(6), F.lit(2), "s", F.col("id")).alias("d"))
    c = Counter(x for r in df.collect() for x in r.d)
    assert set(c) == set(range(6)) and min(c.values()) > 800 and max(c.values()) < 1200


def test_f7_f8_hops(spark):
    # star: centre 1 with neighbours 2 and 3; node 2 only knows 1; symmetric edges
    edges = spark.createDataFrame([(1, 2, 5.0), (2, 1, 5.0), (1, 3, 5.0), (3, 1, 5.0), (3, 4, 5.0), (4, 3, 5.0)],
                                  "va bigint, vb bigint, w double")
    adj = graph.adjacency(edges, edge_thre=3)
    labels = spark.createDataFrame([(1, 2, 3.0)], "va bigint, vb bigint, w double")
    s = graph.two_hop_samples(labels, adj, k1=4, k2=3).collect()
    assert sorted(r.tag for r in s) == [0, 1, 2]                       # F8
    for r in s:
        assert len(r.hop1s) == 4 and Counter(r.hop1s) == Counter({2: 2, 3: 2})
        for h1, h2 in zip(r.hop1s, r.hop2s):
            assert 1 not in h2                                          # centre excluded
            assert h2 == ([] if h1 == 2 else [4, 4, 4])                  # F7


def test_f16_array_text(spark):
    df = spark.createDataFrame([([[1], [2, 3]], [1, 2]), ([[]], [])], "a array<array<bigint>>, b array<bigint>")
    out = df.select(nested_array_text("a").alias("a"), array_text("b").alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [("[[1],[2,3]]", "[1,2]"), ("[[]]", "[]")]


def test_training_rows_join_both_sides(spark):
    edges = spark.createDataFrame([(1, 2, 5.0), (2, 1, 5.0), (2, 3, 5.0), (3, 2, 5.0)], "va bigint, vb bigint, w double")
    adj = graph.adjacency(edges, edge_thre=3)
    labels = spark.createDataFrame([(1, 2, 2.0), (2, 9, 1.0)], "va bigint, vb bigint, w double")
    t = graph.training_rows(labels, adj, k1=2, k2=2).collect()
    # (2, 9): node 9 has no edge over the threshold -> the whole row is dropped
    assert sorted((r.tag, r.va, r.vb) for r in t) == [(0, 1, 2), (1, 1, 2)]
    assert all(r.va_hop1 == "[2,2]" and r.vb_hop1 in ("[1,3]", "[3,1]", "[1,1]", "[3,3]") for r in t)


def test_label_contexts_chunks(spark):
    labels = spark.createDataFrame([(1, 2, 10.7), (3, 4, 0.5), (5, 6, 3.0)], "va bigint, vb bigint, w double")
    got = graph.label_contexts(labels, chunk=4)
    assert rows(got, "va", "vb", "tag") == [(1, 2, t) for t in range(10)] + [(5, 6, t) for t in range(3)]


def test_adjacency_index_with_hub_buckets(spark):
    # node 0 is a hub with 40 neighbours; block 4 numbers them in 11 id ranges
    edges = spark.createDataFrame([(0, j, 5.0) for j in range(1, 41)] + [(j, 0, 5.0) for j in range(1, 41)],
                                  "va bigint, vb bigint, w double")
    adj = graph.adjacency(edges, edge_thre=3, block=4)
    hub = adj.where("va = 0").collect()
    assert sorted((r.idx, r.vb) for r in hub) == [(i, i + 1) for i in range(40)] and {r.deg for r in hub} == {40}
    labels = spark.createDataFrame([(0, 1, 2.0)], "va bigint, vb bigint, w double")
    s = graph.two_hop_samples(labels, adj, k1=10, k2=3).collect()
    for r in s:
        assert len(r.hop1s) == 10 and len(set(r.hop1s)) == 10 and all(1 <= x <= 40 for x in r.hop1s)
        assert all(h2 == [] for h2 in r.hop2s)          # every neighbour only knows the hub


def test_session_edges_with_epoch_timestamps(spark):
    # the raw click log carries event_timestamp as bigint epoch seconds
    df = spark.createDataFrame([("s", 5, 100), ("s", 7, 7300), ("s", 9, 7301), ("t", 1, 5), ("t", 2, 4)],
                               "session string, item bigint, ts bigint")
    e = graph.session_edges(df, ["session"])
    assert rows(e, "va", "vb") == [(1, 2), (2, 1), (5, 7), (7, 5), (7, 9), (9, 7)]
