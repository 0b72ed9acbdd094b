import numpy as np

from coclick.operators import vectors


def random_vectors(spark, n, d, seed):
    rng = np.random.RandomState(seed)
    v = rng.normal(size=(n, d)).astype(np.float32)
    return spark.createDataFrame([(i, v[i].tolist()) for i in range(n)], "id bigint, vec array<float>"), v


def brute(q, c, k, space):
    q = q.astype(np.float64)
    c = c.astype(np.float64)
    if space == "cosine":
        d = 1 - (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
    elif space == "ip":
        d = 1 - q @ c.T
    else:
        d = ((q[:, None, :] - c[None, :, :]) ** 2).sum(-1)
    return {i: list(np.lexsort((np.arange(len(c)), np.round(d[i], 9)))[:k]) for i in range(len(q))}


def test_knn_exact_matches_brute_force(spark):
    df, v = random_vectors(spark, 120, 8, 1)
    for space in ("cosine", "l2", "ip"):
        # small blocks force several tiles per side
        got = vectors.knn_exact(df, df, 5, space, block=16).collect()
        res = {}
        for r in got:
            res.setdefault(r.qid, []).append((r.rank, r.cid))
        want = brute(v, v, 5, space)
        assert {q: [c for _, c in sorted(x)] for q, x in res.items()} == want


def test_knn_approx_full_probe_is_exact_and_recall(spark):
    df, v = random_vectors(spark, 200, 8, 2)
    exact = vectors.knn_exact(df, df, 5, "cosine")
    full = vectors.knn_approx(df, df, 5, "cosine", n_lists=4, n_probe=4)
    assert vectors.recall_at_k(full, exact).collect()[0].recall == 1.0
    part = vectors.knn_approx(df, df, 5, "cosine", n_lists=8, n_probe=3)
    assert vectors.recall_at_k(part, exact).collect()[0].recall >= 0.6


def test_sentences_and_word2vec(spark):
    import pyspark.sql.functions as F
    data = [(u, (u + i) % 7 + 1, i) for u in range(30) for i in range(12)]
    clicks = spark.createDataFrame(data, "user bigint, item bigint, ts bigint").withColumn("ts", F.timestamp_seconds("ts"))
    s = vectors.session_sentences(clicks, ["user"], max_len=5)
    assert s.where("user = 0").count() == 3           # 12 tokens in chunks of 5
    m = vectors.item2vec_fit(s, dim=8, iters=2, partitions=1, min_count=1)
    vecs = vectors.model_vectors(m).collect()
    assert len(vecs) == 7 and all(len(r.vec) == 8 and np.isfinite(r.vec).all() for r in vecs)
    sim = vectors.similar_items(m, k=3)
    assert sim.where("qid = cid").count() == 0 and sim.count() == 21


def test_chunks_that_overlap_by_the_window_lose_no_pair(spark):
    from coclick.operators.vectors import session_sentences
    n, window, max_len = 103, 4, 10
    df = spark.createDataFrame([("s", i, i) for i in range(n)] + [("t", i, i) for i in range(10)] + [("u", 1, 1)],
                               "session string, item long, ts long")
    want = {(i, j) for i in range(n) for j in range(i + 1, min(i + window + 1, n))}
    for overlap, lost in ((window, False), (0, True)):
        out = session_sentences(df, ["session"], max_len=max_len, overlap=overlap).where("session = 's'").collect()
        got = {(int(t[a]), int(t[b])) for r in out for t in [r.tokens] for a in range(len(t))
               for b in range(a + 1, min(a + window + 1, len(t)))}
        assert all(len(r.tokens) <= max_len for r in out) and got <= want and (got != want) == lost
    short = session_sentences(df, ["session"], max_len=max_len, overlap=window).where("session <> 's'").collect()
    assert sorted((r.session, r.chunk, len(r.tokens)) for r in short) == [("t", 0, 10), ("u", 0, 1)]


def test_tiles_are_streams_with_wide_query_blocks(spark):
    df, v = random_vectors(spark, 700, 8, 4)
    copies = df.unionByName(df.selectExpr("id + 1000 AS id", "vec"))       # every distance twice: lower id first
    whole = np.concatenate([v, v])
    ids = np.concatenate([np.arange(700), np.arange(700) + 1000])
    for space in vectors.SPACES:
        found = vectors.knn_exact(df, copies, 5, space, block=8)
        assert "FlatMapCoGroups" not in found._jdf.queryExecution().toString()
        res = {}
        for r in found.collect():
            res.setdefault(r.qid, []).append((r.rank, r.cid))
        want = {i: [int(ids[c]) for c in x] for i, x in brute(v, whole, 5, space).items()}
        assert {q: [c for _, c in sorted(x)] for q, x in res.items()} == want
    # 600,000 vectors: a corpus vector is copied 37 times (147 in square tiles), a query 10 times
    assert vectors._blocks(600_000, 4096, vectors.QUERY_BLOCKS, 8) == 37
    assert vectors._blocks(600_000, 4096, vectors.CORPUS_BLOCKS, 4) == 10
    assert [vectors._blocks(n, 4096, 4, 8) for n in (0, 1, 4097, 100_000)] == [1, 1, 2, 8]


def test_tiles_compare_in_single_precision_and_rank_in_double(spark):
    # neighbours that single precision cannot tell apart, copies, and sizes that it cannot hold
    rng = np.random.RandomState(7)
    v = np.concatenate([1.0 + rng.normal(size=(300, 6)) * 1e-7, rng.normal(size=(1500, 6))])
    v = np.concatenate([v, v[:200]])
    for space, big in (("l2", 1.0), ("cosine", 1.0), ("ip", 1.0), ("cosine", 1e25)):
        near = vectors._Nearest(np.arange(300), v[:300] * big, 7, space)
        assert near.short.dtype == np.float32
        by = rng.permutation(len(v))
        for at in range(0, len(v), 900):
            near.meet(by[at:at + 900], v[by[at:at + 900]] * big)
        got = {}
        for batch in near.found():
            for q, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got.setdefault(q, []).append(c)
        c = v * big if space != "cosine" else v / np.linalg.norm(v, axis=1, keepdims=True)
        q = c[:300]
        d = np.maximum((q * q).sum(1)[:, None] + (c * c).sum(1) - 2 * q @ c.T, 0) if space == "l2" else 1 - q @ c.T
        assert got == {i: np.lexsort((np.arange(len(v)), np.round(d[i], 9)))[:7].tolist() for i in range(300)}


def test_recall_reads_each_side_once(spark):
    exact = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (3, 5), (None, 4), (4, None)], "qid long, cid long")
    approx = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (9, 9), (None, 4), (4, None)], "qid long, cid long")
    seen = spark.sparkContext.accumulator(0)

    def counted(it):
        for batch in it:
            seen.add(batch.num_rows)
            yield batch
    out = vectors.recall_at_k(approx, exact.repartition(1).mapInArrow(counted, exact.schema)).collect()[0]
    assert seen.value == 7                          # 14 when the exact search was run for both sides of a join
    assert out.queries == 5 and np.isclose(out.recall, (2 / 3 + 1) / 5)


def test_ivf_ships_vectors_as_they_are_once_per_query(spark):
    df, v = random_vectors(spark, 300, 8, 5)
    odd = df.unionByName(spark.createDataFrame([(900, None), (901, [0.0] * 8)], df.schema))
    found = vectors.knn_approx(odd, odd, 5, "cosine", n_lists=4, n_probe=4, centres=v[:4].astype(np.float64))
    res = {}
    for r in found.where("qid < 300 and cid < 300").collect():
        res.setdefault(r.qid, []).append((r.rank, r.cid))
    want = brute(v, v, 5, "cosine")
    assert {q: [c for _, c in sorted(x)] for q, x in res.items()} == want
    assert found.where("qid = 900 or cid = 900").count() == 0 and found.where("qid = 901").count() == 5
    files = found.inputFiles()
    stored = {f.rsplit("/", 2)[1].rsplit("-", 1)[0]: spark.read.parquet(f) for f in files}
    assert all(d.schema["vec"].dataType.elementType.typeName() == "float" for d in stored.values())
    assert "lists" in next(d for n, d in stored.items() if "queries" in n).columns
