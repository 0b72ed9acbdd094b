"""A third of all rows on one key: blocked / salted plans must stay exact."""

import duckdb
from pyspark.sql import functions as F

from coclick.operators import graph, itemcf, swing
from coclick.sources import testdata as T
from support import SF_SMALL

HOT = """SELECT CASE WHEN o.o_custkey % 3 = 0 THEN 1 ELSE o.o_custkey END AS u, l.l_partkey AS item,
                o.o_orderdate AS ts
         FROM read_parquet('{sf}/lineitem.parquet') l JOIN read_parquet('{sf}/orders.parquet') o
           ON l.l_orderkey = o.o_orderkey"""


def hot_clicks(spark):
    cp = T.copurchase(spark, SF_SMALL)
    return cp.select(F.when(F.col("user") % 3 == 0, F.lit(1)).otherwise(F.col("user")).cast("bigint").alias("user"),
                     "item", "ts")


def test_itemcf_with_hot_user_matches_sql(spark):
    cap, window = 700, 50
    got = itemcf.daily_cooccurrence(hot_clicks(spark), max_user_items=cap, window_size=window, block=64)
    got = sorted((r.vi, r.vj, round(r.weight, 6)) for r in got.collect())
    sql = f"""WITH c AS ({HOT.format(sf=SF_SMALL)}),
      cap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY item, ts) AS r FROM c) WHERE r <= {cap}),
      sz AS (SELECT *, count(*) OVER (PARTITION BY u) AS n FROM cap),
      rk AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY ts, item) AS pos FROM sz WHERE n >= 2),
      p AS (SELECT least(a.item, b.item) AS vi, greatest(a.item, b.item) AS vj, count(*) * 1.0 AS w
            FROM rk a JOIN rk b ON a.u = b.u AND b.pos > a.pos AND b.pos <= a.pos + {window}
            WHERE a.item <> b.item GROUP BY 1, 2)
      SELECT vi, vj, w FROM p UNION ALL SELECT item, item, count(*) * 1.0 FROM rk GROUP BY item"""
    want = sorted((int(a), int(b), round(float(w), 6)) for a, b, w in duckdb.sql(sql).fetchall())
    assert got == want


def test_swing_pairs_with_hot_user_match_sql(spark):
    ui = swing.user_item(hot_clicks(spark))
    ipu = swing.item_pair_users(ui, block=8)
    paths = swing.item_pair_user_pairs(ipu, block=4)
    u2u = swing.user_pair_counts(ui, block=4)
    got_ipu, got_paths = ipu.count(), paths.count()
    got_u2u = sorted((r.ui, r.uj, r.weight) for r in u2u.collect())
    base = f"WITH ui AS (SELECT DISTINCT u, item FROM ({HOT.format(sf=SF_SMALL)}))"
    n_ipu = duckdb.sql(base + " SELECT count(*) FROM ui a JOIN ui b ON a.u = b.u AND a.item < b.item").fetchall()[0][0]
    n_paths = duckdb.sql(base + """, p AS (SELECT a.item AS i, b.item AS j, a.u FROM ui a JOIN ui b ON a.u = b.u AND a.item < b.item)
        SELECT count(*) FROM p x JOIN p y ON x.i = y.i AND x.j = y.j AND x.u < y.u""").fetchall()[0][0]
    want_u2u = sorted(duckdb.sql(base + """, ok AS (SELECT item FROM ui GROUP BY item HAVING count(*) BETWEEN 2 AND 1000)
        SELECT a.u, b.u, count(*) FROM ui a JOIN ui b ON a.item = b.item AND a.u < b.u
        WHERE a.item IN (SELECT item FROM ok) GROUP BY 1, 2""").fetchall())
    assert (got_ipu, got_paths) == (n_ipu, n_paths)
    assert got_u2u == [tuple(int(x) for x in r) for r in want_u2u]


def test_itemcf_split_users_equal_default(spark):
    a = itemcf.daily_cooccurrence(hot_clicks(spark), max_user_items=300, window_size=20)
    b = itemcf.daily_cooccurrence(hot_clicks(spark), max_user_items=300, window_size=20, rows_per_task=40)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_swing_scores_with_split_user_pairs(spark, monkeypatch):
    want = {(r.itemi, r.itemj): r.swing_score for r in swing.swing_from_clicks(swing.user_item(hot_clicks(spark))).collect()}
    monkeypatch.setattr(swing, "PATHS_PER_PIECE", 5)
    got = {(r.itemi, r.itemj): r.swing_score for r in swing.swing_from_clicks(swing.user_item(hot_clicks(spark))).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_hop_samples_with_split_centres(spark):
    edges = spark.range(400).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 40 END AS va", "id % 37 + 100 AS vb") \
        .distinct().withColumn("w", F.lit(9.0))
    edges = edges.unionByName(edges.selectExpr("vb AS va", "va AS vb", "w"))
    labels = edges.where("va = 1 or va = 5").withColumn("w", F.lit(30.0))
    adj = graph.adjacency(edges)
    ctx = graph.label_contexts(labels)
    plain = graph.hop2_samples(graph.hop1_samples(ctx, adj), adj)
    split = graph.hop2_samples(graph.hop1_samples(ctx, adj, rows_per_piece=20), adj, rows_per_piece=20)
    assert "__a" in split._jdf.queryExecution().optimizedPlan().toString()
    assert "__a" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)
