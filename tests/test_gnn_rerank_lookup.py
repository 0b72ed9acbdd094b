import math

import numpy as np

from coclick.operators import gnn, lookup, rerank
from support import rows


def test_f15_inbatch_metrics(spark):
    # scores [[.9,.1],[.8,.2]] from 2-d vectors: a_i . b_j
    pairs = spark.createDataFrame([(0, 0, [0.9, 0.1], [1.0, 0.0]), (0, 1, [0.8, 0.2], [0.0, 1.0])],
                                  "batch bigint, pos bigint, a array<double>, b array<double>")
    m = gnn.inbatch_metrics(pairs).collect()[0]
    assert m.n == 2 and math.isclose(m.p_at_1, 0.5) and math.isclose(m.mrr, 0.75)
    assert math.isclose(m.pos_cos, 0.55) and math.isclose(m.neg_cos, 0.45)
    loss = {r.pos: r.loss for r in gnn.inbatch_softmax_loss(pairs).collect()}
    p0 = math.exp(0.9) / (math.exp(0.9) + math.exp(0.1))
    assert math.isclose(loss[0], -math.log(p0 + 1e-8), rel_tol=1e-9)


def batches(spark, text_pos=False):
    """Three batches with repeated places, missing vectors, numbers, places and batches, and vectors of two lengths."""
    rng = np.random.default_rng(8)
    data = [(b, p, rng.normal(size=3).tolist(), rng.normal(size=3).tolist(), float(p % 3)) for b, n in ((0, 23), (1, 1), (7, 5)) for p in range(n)]
    data += [(0, 4, [0.5, 0.1, 0.2], [1.0, 0.0, 0.3], 2.0), (0, 30, None, [1.0, 2.0, 3.0], 1.0), (0, 31, [1.0, 2.0, 3.0], None, 1.0),
             (0, 32, [1.0, None, 3.0], [1.0, 2.0, 1.0], 1.0), (0, None, [1.0, 2.0, 3.0], [0.1, 0.2, 0.3], 1.0), (7, 9, [1.0, 1.0], [2.0, 0.5], None),
             (None, 1, [1.0, 2.0, 3.0], [0.1, 0.2, 0.3], 1.0), (8, 0, None, None, 1.0), (0, 4, [0.5, 0.1, 0.2], [1.0, 0.0, 0.3], 2.0)]
    df = spark.createDataFrame(data, "batch bigint, pos bigint, a array<double>, b array<double>, l double")
    return df.withColumn("pos", df.pos.cast("string")) if text_pos else df


def test_softmax_tiles_equal_the_join(spark, monkeypatch):
    def loss(pairs, **how):
        rows = gnn.inbatch_softmax_loss(pairs, label="l", shift=0.2, scale=1.7, **how).collect()
        return sorted((r.batch, int(r.pos), *(None if x is None else round(x, 9) for x in (r.loss, r.p_pos))) for r in rows)
    order = lambda rows: sorted(map(str, rows))
    want = order(loss(batches(spark, text_pos=True)))
    for tile in ((8192, 65_536), (4, 6)):
        monkeypatch.setattr(gnn, "TILE_ROWS", tile[0])
        monkeypatch.setattr(gnn, "TILE_COLUMNS", tile[1])
        assert order(loss(batches(spark))) == want


def test_softmax_runs_over_slices(monkeypatch):
    monkeypatch.setattr(gnn, "ROWS_AT_ONCE", 3)
    monkeypatch.setattr(gnn, "COLUMNS_AT_ONCE", 4)
    rng = np.random.default_rng(1)
    a, b, pos = rng.normal(size=(11, 5)) * 9, rng.normal(size=(17, 5)) * 9, np.arange(17)
    rows = gnn._Softmax(pos[:11], list(a), 0.1, 2.0)
    for part in (slice(0, 6), slice(6, 7), slice(7, 17)):
        rows.meet(pos[part], pos[part] != 3, list(b[part]))
    z = 2.0 * (a @ b.T)
    z[np.arange(11), np.arange(11)] -= 0.2 * (np.arange(11) != 3)
    want = np.exp(z - z.max(1, keepdims=True)).sum(1)
    assert np.allclose(rows.top, z.max(1)) and np.allclose(rows.sum, want)
    assert np.allclose(rows.own[rows.met], np.diag(z)[rows.met]) and rows.met.tolist() == [i != 3 for i in range(11)]


def test_no_row_per_pair_of_a_batch(spark):
    df = spark.createDataFrame([(0, p, [1.0, p / 300], [p / 300, 1.0]) for p in range(300)], "batch long, pos long, a array<double>, b array<double>")
    loss = gnn.inbatch_softmax_loss(df)
    assert loss.count() == 300
    plan = loss._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan


def test_max_pool_sends_a_vector_once_per_block(spark, monkeypatch):
    rng = np.random.default_rng(6)
    W = {k: v * 50 for k, v in gnn.init_weights(4, hidden=5, out_dim=3, seed=1).items()}
    vec = {i: rng.normal(size=4) for i in range(1, 12)}
    data = [(t, int(rng.integers(1, 14)), t, rng.integers(1, 14, rng.integers(0, 4)).tolist()) for t in range(60)]
    data = [(t, va, vb, h, [rng.integers(1, 14, rng.integers(0, 3)).tolist() for _ in h]) for t, va, vb, h in data] + [
        (70, None, 1, [1], [[2]]), (71, 1, 1, [None, 2], [[None, 3], []]), (72, 1, 1, None, [[1]]), (73, 1, 1, [1], None), (74, 1, 1, [1], [None])]
    data += [data[3]]                                                                       # a repeated sample is one
    samples = spark.createDataFrame(data, "tag bigint, va bigint, vb bigint, hop1s array<bigint>, hop2s array<array<bigint>>")
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in vec.items()] + [(2, vec[2].tolist()), (12, None), (None, vec[1].tolist())],
                                "id bigint, vec array<double>")
    want = {}
    for t, va, vb, h1, h2 in data:
        if va not in vec or h1 is None or h2 is None or None in h2:
            continue
        hop1, m1, hop2, m2 = np.zeros((1, 3, 4)), np.zeros((1, 3), bool), np.zeros((1, 3, 2, 4)), np.zeros((1, 3, 2), bool)
        for p, x in enumerate(h1):
            if x in vec:
                hop1[0, p], m1[0, p] = vec[x], True
            for q, y in enumerate(h2[p]):
                if y in vec:
                    hop2[0, p, q], m2[0, p, q] = vec[y], True
        want[t] = gnn.forward(vec[va][None], hop1, m1, hop2, m2, W)[0]
    for size in (2048, 7):
        monkeypatch.setattr(gnn, "BLOCK_SAMPLES", size)
        got = gnn.neighbour_max_pool(samples, vdf, W, 3, 2, out_type="double")
        rows_of = got.collect()
        assert len(rows_of) == len(want) and all(np.allclose(r.emb, want[r.tag], atol=1e-9) for r in rows_of)
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()


def test_nn1_matches_numpy(spark):
    rng = np.random.RandomState(3)
    vec = {i: rng.normal(size=4) for i in range(1, 8)}
    W = gnn.init_weights(4, hidden=5, out_dim=3, seed=1)
    W = {k: v * 100 for k, v in W.items()}  # make the MLP matter
    samples = spark.createDataFrame([(0, 1, 2, [2, 3], [[4, 5], [6]])],
                                    "tag bigint, va bigint, vb bigint, hop1s array<bigint>, hop2s array<array<bigint>>")
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in vec.items()], "id bigint, vec array<double>")
    got = np.array(gnn.neighbour_max_pool(samples, vdf, W, 2, 2).collect()[0].emb)
    centre = vec[1][None]
    hop1 = np.stack([vec[2], vec[3]])[None]
    m1 = np.ones((1, 2), bool)
    hop2 = np.zeros((1, 2, 2, 4))
    hop2[0, 0, 0], hop2[0, 0, 1], hop2[0, 1, 0] = vec[4], vec[5], vec[6]
    m2 = np.array([[[True, True], [True, False]]])
    want = gnn.forward(centre, hop1, m1, hop2, m2, W)[0]
    assert np.allclose(got, want, atol=1e-6) and math.isclose(np.linalg.norm(got), 1.0, rel_tol=1e-5)


def test_f13_mmr(spark):
    cand = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.1)], "query bigint, item bigint, score double")
    sims = spark.createDataFrame([(1, 2, 0.95), (2, 1, 0.95)], "item_a bigint, item_b bigint, sim double")
    out = rerank.mmr_rerank_pairs(cand, sims, lam=0.5, top_n=None)
    assert [r.item for r in out.orderBy("rank").collect()] == [1, 3, 2]
    out2 = rerank.mmr_rerank_pairs(cand, sims, lam=0.5, top_n=2)
    assert [r.item for r in out2.orderBy("rank").collect()] == [1, 3]


def test_mmr_lambda_one_is_score_order(spark):
    cand = spark.createDataFrame([(1, i, s) for i, s in enumerate([0.3, 0.9, 0.5, 0.7])], "query bigint, item bigint, score double")
    vec = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "id bigint, vec array<double>")
    out = rerank.mmr_rerank(cand, vec, lam=1.0, top_n=None)
    assert [r.item for r in out.orderBy("rank").collect()] == [1, 3, 2, 0]


def test_f18_dictionary(spark):
    words = spark.createDataFrame([("ab",), ("a",), ("abc",)], "word string")
    d = spark.createDataFrame([("ab",), ("abc",), ("ab",)], "word string")
    assert rows(lookup.dictionary_match(words, d)) == [("ab",), ("abc",)]


def test_mmr_iterative_equals_grouped(spark):
    rng = np.random.RandomState(5)
    cand = [(q, i, float(rng.uniform())) for q in range(3) for i in range(q * 100, q * 100 + 25)]
    vec = [(i, rng.normal(size=6).tolist()) for q in range(3) for i in range(q * 100, q * 100 + 25)]
    c = spark.createDataFrame(cand, "query bigint, item bigint, score double")
    v = spark.createDataFrame(vec, "id bigint, vec array<double>")
    a = rows(rerank.mmr_rerank(c, v, lam=0.6, top_n=6), "query", "rank", "item")
    b = rows(rerank.mmr_rerank_iterative(c, v, lam=0.6, top_n=6), "query", "rank", "item")
    assert a == b and len(a) == 18


def test_match_counts_either_way(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, "d d"), (4, None)], "doc_id long, text string")
    words = spark.createDataFrame([("a d",), ("d z",), (None,)], "text string")
    for limit in (lookup.BROADCAST_BYTES, 0):
        assert rows(lookup.match_counts(docs, words, broadcast_bytes=limit)) == [(1, 4, 2), (3, 2, 2)]


def test_mmr_pairs_equals_one_list_at_a_time(spark, monkeypatch):
    import numpy as np
    rng = np.random.RandomState(5)
    cand, sims = [], []
    for q in range(40):
        for i in rng.permutation(30)[:rng.randint(1, 20)]:
            cand.append((q, int(i), float(rng.randint(0, 6) / 5)))      # many equal scores
    for a in range(30):
        for b in rng.permutation(30)[:12]:
            sims.append((a, int(b), float(rng.randint(0, 5) / 4)))
    table = {(a, b): s for a, b, s in sims}
    cd, sd = spark.createDataFrame(cand, "query long, item long, score double"), spark.createDataFrame(sims, "item_a long, item_b long, sim double")
    for cells in (rerank.SLICE_CELLS, 500):
        monkeypatch.setattr(rerank, "SLICE_CELLS", cells)
        for top_n in (None, 4):
            out = rerank.mmr_rerank_pairs(cd, sd, lam=0.6, top_n=top_n)
            assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()
            got = sorted((r.query, r["rank"], r.item, r.score, round(r.mmr, 9)) for r in out.collect())
            want = []
            for q in range(40):
                mine = sorted(((i, s) for x, i, s in cand if x == q), key=lambda t: (-round(t[1], 9), t[0]))
                ids, sc = np.array([i for i, _ in mine]), np.array([s for _, s in mine])
                picked = rerank.mmr_select(ids, sc, lambda j: np.array([table.get((i, ids[j]), 0.0) for i in ids]), 0.6, top_n)
                want += [(q, r, int(ids[i]), float(sc[i]), round(o, 9)) for r, (i, o) in enumerate(picked, 1)]
            assert got == sorted(want)
