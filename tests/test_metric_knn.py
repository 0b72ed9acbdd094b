"""Exact search in shells against brute force, and what the bounds skip."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coclick.operators import metric_knn as M
from coclick.operators import vectors


def corpus(spark, n=1500, dim=8, groups=40, spread=0.15):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(groups, dim))
    x = (centres[np.arange(n) % groups] + spread * rng.normal(size=(n, dim))).astype(np.float32)
    x[n // 2:n // 2 + n // 10] = x[0]       # copies: ties by id
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<float>")


def as_rows(df):
    return sorted((r["qid"], r["rank"], r["cid"], round(r["dist"], 6)) for r in df.collect())


@pytest.mark.parametrize("space", M.SPACES)
def test_shells_equal_brute_force_and_skip_most_tiles(spark, space):
    e = corpus(spark).cache()
    outside = e.where("id % 100 = 3").select((F.col("id") + 9000).alias("id"),
                                             F.transform("vec", lambda v: (v * 1.5 + 0.4).cast("float")).alias("vec"))
    q = e.where("id % 10 = 0").unionByName(outside)
    shells = M.build_shells(e, space, pivots=40, block=64)
    assert shells.shells.agg(F.sum("size")).first()[0] == 1500 and shells.shells.agg(F.max("size")).first()[0] <= 64
    found, sent = M.search_shells(shells, q)
    assert as_rows(found) == as_rows(vectors.knn_exact(q, e, 10, space))
    assert M.skipped_share(shells, q, sent) > 0.6


def test_nothing_to_skip_is_still_exact(spark):
    rng = np.random.default_rng(1)
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 48)).astype(np.float32))],
                              "id long, vec array<float>")
    assert as_rows(M.knn_pruned(e, e, 5, "l2", pivots=9, block=17)) == as_rows(vectors.knn_exact(e, e, 5, "l2"))


def test_few_vectors_nulls_and_empty_tables(spark):
    e = corpus(spark, 6, groups=2)
    odd = e.unionByName(spark.createDataFrame([(None, [1.0] * 8), (99, None)], e.schema))
    assert as_rows(M.knn_pruned(odd, odd, 10, "l2")) == as_rows(vectors.knn_exact(e, e, 10, "l2"))
    assert M.knn_pruned(e, e.limit(0)).collect() == [] and M.knn_pruned(e.limit(0), e).collect() == []
    with pytest.raises(ValueError):
        M.build_shells(e, "ip")


@pytest.mark.parametrize("ring", [1, 50, 16_384])
def test_rings_of_shells_are_exact_and_take_a_query_once(spark, monkeypatch, ring):
    monkeypatch.setattr(M, "RING", ring)
    e = corpus(spark, 400, groups=6, spread=0.8).cache()
    shells = M.build_shells(e, "l2", pivots=3, block=8)
    rings = {r.ring: r.n for r in shells.shells.groupBy("ring").agg(F.count("*").alias("n")).collect()}
    assert max(rings.values()) == {1: 1, 50: 6}.get(ring, max(rings.values())) and (ring < 16_384 or len(rings) == 3)
    found, _ = M.search_shells(shells, e)
    assert as_rows(found) == as_rows(vectors.knn_exact(e, e, 10, "l2"))


@pytest.mark.parametrize("space", M.SPACES)
def test_shares_of_queries_far_from_zero_are_exact(spark, monkeypatch, space):
    monkeypatch.setattr(M, "SHARE", 60)
    monkeypatch.setattr(M, "RING", 100)
    e = corpus(spark, 350, groups=9, spread=0.4).withColumn("vec", F.transform("vec", lambda v: (v * 4 + 900).cast("float"))).cache()
    q = e.where("id % 2 = 0").unionByName(corpus(spark, 30).selectExpr("id + 5000 AS id", "vec"))
    found = M.knn_pruned(q, e, 7, space, pivots=4, block=16).collect()
    want = vectors.knn_exact(q, e, 7, space).collect()
    assert len(found) == len(want) == 7 * q.count()
    by = lambda rows: {(r["qid"], r["rank"]): r["dist"] for r in rows}
    got = by(found)
    assert all(abs(got[k] - d) <= 1e-6 * max(1.0, abs(d)) for k, d in by(want).items())


def test_a_query_is_not_joined_to_all_shells_of_its_pivot(spark, monkeypatch):
    stored, homes = M.stored, []
    monkeypatch.setattr(M, "stored", lambda df, name: (homes.append(df) if name == "shell-homes" else None, stored(df, name))[1])
    e = corpus(spark, 500)
    found, _ = M.search_shells(M.build_shells(e, "l2", pivots=3, block=4), e)
    plan = homes[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and found.count() == 5000


def test_home_is_the_shell_around_or_closest():
    rng = np.random.default_rng(2)
    ends = np.sort(rng.random(20)).reshape(10, 2)
    d = np.concatenate([rng.random(50) * 1.4 - 0.2, ends.ravel()])
    rows = [("1/0", 0, None, f"s{i}", lo, hi) for i, (lo, hi) in enumerate(ends)] + [("1/0", 1, i, None, x, 0.0) for i, x in enumerate(d)]
    rows += [("2/0", 1, 9, None, 0.5, 0.0), ("3/0", 0, None, "t", 0.1, 0.2), ("3/0", 1, 77, None, 9.0, 0.0)]
    types = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.float64())
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                     names=["tile", "kind", "qid", "shell", "lo", "hi"])
    got = {q: (shell, off) for b in M._homes(iter(table.to_batches(max_chunksize=7))) for q, shell, off in
           zip(b["qid"].to_pylist(), b["shell"].to_pylist(), b["off"].to_pylist(), strict=True)}
    off = np.maximum(np.maximum(ends[:, 0] - d[:, None], d[:, None] - ends[:, 1]), 0.0)
    assert got.pop(77) == ("t", 8.8) and set(got) == set(range(len(d)))
    assert all(abs(got[i][1] - off[i].min()) < 1e-12 and off[i, int(got[i][0][1:])] == got[i][1] for i in got)
