"""MMR diversity re-ranking (RR1).

Greedy maximal marginal relevance per query:
    pick argmax_i  lambda * score_i - (1 - lambda) * max(0, max_{j in S} sim(i, j))
The selection is sequential inside a query.  ``mmr_rerank`` makes each
query's (bounded, top-k retrieved) candidate list one row and runs the greedy
steps vectorised over all queries of an Arrow batch; similarities come from
candidate vectors (top_n x n dot products), so no candidate-pair table is
materialised.  ``mmr_rerank_iterative`` handles lists of any length with one
distributed aggregation per step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.session import ship_package
from coclick.operators.topk import RANK_DIGITS

SLICE_CELLS = 8_000_000   # numbers in the padded candidate tensor of one slice
LAMBDA = 0.5
TOP_N = 20

_OUT = T.StructType([T.StructField("query", T.LongType()), T.StructField("rank", T.LongType()),
                     T.StructField("item", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("mmr", T.DoubleType())])


def mmr_select(items: np.ndarray, scores: np.ndarray, sim, lam: float, top_n: int | None):
    """Greedy MMR on one candidate list (already in input order: score desc, id).

    ``sim(i, selected_idx)`` returns the similarity vector of candidate i to the
    selected ones.  Ties on the (rounded) objective go to the earlier candidate.
    Returns a list of (index, objective).
    """
    n = len(items)
    limit = n if top_n is None else min(top_n, n)
    chosen: list[tuple[int, float]] = []
    max_sim = np.zeros(n)
    remaining = np.ones(n, dtype=bool)
    for _ in range(limit):
        obj = lam * scores - (1.0 - lam) * max_sim
        obj_r = np.where(remaining, np.round(obj, RANK_DIGITS), -np.inf)
        best = int(np.argmax(obj_r))          # first index among ties
        chosen.append((best, float(obj[best])))
        remaining[best] = False
        s = sim(best)
        max_sim = np.maximum(max_sim, s)
    return chosen


def mmr_batch(items: list, scores: list, vecs: list, lam: float, top_n: int | None):
    """Greedy MMR for many queries at once (one numpy step per pick for the batch).

    ``items``/``scores``/``vecs`` hold one candidate list per query.  Lists are
    ordered by (rounded score desc, id), padded, and every step takes the
    argmax of the rounded objective (first index among ties), exactly like
    :func:`mmr_select`.  Returns per query (picked items, scores, objectives).
    """
    B = len(items)
    n_max = max((len(x) for x in items), default=0)
    dim = next((len(v) for vs in vecs for v in vs if v is not None), 1)
    S = np.zeros((B, n_max))
    ids = np.zeros((B, n_max), dtype=np.int64)
    U = np.zeros((B, n_max, dim))
    valid = np.zeros((B, n_max), dtype=bool)
    for b in range(B):
        it = np.asarray(items[b], dtype=np.int64)
        sc = np.asarray(scores[b], dtype=np.float64)
        order = np.lexsort((it, -np.round(sc, RANK_DIGITS)))
        n = len(it)
        S[b, :n], ids[b, :n], valid[b, :n] = sc[order], it[order], True
        known = np.array([vecs[b][o] is not None for o in order], dtype=bool)
        if known.any():
            v = np.array([vecs[b][o] for o in order[known]], dtype=np.float64)
            norm = np.linalg.norm(v, axis=1, keepdims=True)
            U[b, np.flatnonzero(known)] = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
    steps = n_max if top_n is None else min(top_n, n_max)
    max_sim = np.zeros((B, n_max))
    remaining = valid.copy()
    rows = np.arange(B)
    picks, objs = [], []
    for _ in range(steps):
        obj = lam * S - (1.0 - lam) * max_sim
        best = np.argmax(np.where(remaining, np.round(obj, RANK_DIGITS), -np.inf), axis=1)
        active = remaining[rows, best]
        picks.append(np.where(active, best, -1))
        objs.append(obj[rows, best])
        remaining[rows[active], best[active]] = False
        max_sim = np.maximum(max_sim, np.einsum("bnd,bd->bn", U, U[rows, best]))
    out = []
    for b in range(B):
        sel = [(int(p[b]), float(o[b])) for p, o in zip(picks, objs) if p[b] >= 0]
        out.append(([int(ids[b, i]) for i, _ in sel], [float(S[b, i]) for i, _ in sel], [o for _, o in sel]))
    return out


def mmr_rerank(candidates: DataFrame, vectors: DataFrame, lam: float = LAMBDA, top_n: int | None = TOP_N,
               query_col: str = "query", item_col: str = "item", score_col: str = "score") -> DataFrame:
    """RR1: re-rank each query's candidates; similarity = cosine of item vectors.

    ``candidates``: (query, item, score) from a bounded top-k retrieval;
    ``vectors``: (id, vec).  Each query's list becomes one row and the greedy
    steps run vectorised over all queries of an Arrow batch.  Candidates
    without a vector have similarity 0 to everything.  For lists of unbounded
    length use :func:`mmr_rerank_iterative`.  Returns (query, rank, item, score, mmr).
    """
    v = vectors.select(F.col("id").alias("item"), F.col("vec").cast("array<double>").alias("vec"))
    c = candidates.select(F.col(query_col).cast("bigint").alias("query"), F.col(item_col).cast("bigint").alias("item"),
                          F.col(score_col).cast("double").alias("score"))
    lists = c.join(v, "item", "left").groupBy("query").agg(
        F.collect_list(F.struct("item", "score", "vec")).alias("l"))
    lists = lists.select("query", F.transform("l", lambda x: x["item"]).alias("items"),
                         F.transform("l", lambda x: x["score"]).alias("scores"),
                         F.transform("l", lambda x: x["vec"]).alias("vecs"))
    out_t = T.StructType([T.StructField("items", T.ArrayType(T.LongType())),
                          T.StructField("scores", T.ArrayType(T.DoubleType())),
                          T.StructField("mmrs", T.ArrayType(T.DoubleType()))])

    @F.pandas_udf(out_t)
    def rerank_lists(items: pd.Series, scores: pd.Series, vecs: pd.Series) -> pd.DataFrame:
        # bounded slices: the padded tensor of a slice takes about SLICE_CELLS numbers (or one list)
        longest = max((len(x) for x in items), default=0)
        dim = next((len(v) for x in vecs for v in x if v is not None), 1)
        step = max(1, SLICE_CELLS // max(1, longest * dim))
        res = [r for at in range(0, len(items), step)
               for r in mmr_batch(items[at:at + step].tolist(), scores[at:at + step].tolist(),
                                  vecs[at:at + step].tolist(), lam, top_n)]
        return pd.DataFrame({"items": [r[0] for r in res], "scores": [r[1] for r in res], "mmrs": [r[2] for r in res]})

    ship_package(lists.sparkSession)
    r = lists.select("query", rerank_lists("items", "scores", "vecs").alias("r"))
    z = r.select("query", F.posexplode(F.arrays_zip("r.items", "r.scores", "r.mmrs")).alias("pos", "z"))
    return z.select("query", (F.col("pos") + 1).cast("bigint").alias("rank"), F.col("z.items").alias("item"),
                    F.col("z.scores").alias("score"), F.col("z.mmrs").alias("mmr"))


def mmr_rerank_pairs(candidates: DataFrame, sims: DataFrame, lam: float = LAMBDA, top_n: int | None = TOP_N,
                     query_col: str = "query", item_col: str = "item", score_col: str = "score") -> DataFrame:
    """RR1 with an explicit similarity table (item_a, item_b, sim), the
    reference's ``similarityMatrix``; missing pairs count as 0.

    Only pairs inside a query's candidate list are joined in.
    """
    c = candidates.select(F.col(query_col).cast("bigint").alias("query"), F.col(item_col).cast("bigint").alias("item"),
                          F.col(score_col).cast("double").alias("score"))
    a = c.select("query", F.col("item").alias("item_a"))
    b = c.select("query", F.col("item").alias("item_b"))
    s = sims.select(F.col("item_a").cast("bigint"), F.col("item_b").cast("bigint"), F.col("sim").cast("double"))
    pair_sims = a.join(s, "item_a").join(b, ["query", "item_b"])
    rows = c.select("query", "item", "score", F.lit(None).cast("bigint").alias("item_b"),
                    F.lit(None).cast("double").alias("sim")) \
        .unionByName(pair_sims.select("query", F.col("item_a").alias("item"), F.lit(None).cast("double").alias("score"),
                                      "item_b", "sim"))

    # a query's list and the pairs inside it, one row per query
    mine = F.when(F.col("item_b").isNull(), F.struct("item", "score"))
    near = F.when(F.col("item_b").isNotNull(), F.struct("item", "item_b", "sim"))
    lists = rows.groupBy("query").agg(F.collect_list(mine).alias("l"), F.collect_list(near).alias("p")) \
        .select("query", F.col("l.item").alias("items"), F.col("l.score").alias("scores"),
                F.col("p.item").alias("a"), F.col("p.item_b").alias("b"), F.col("p.sim").alias("sims"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pc.list_value_length(batch.column("items"))
            # bounded slices: the similarities of a slice take about SLICE_CELLS numbers (or one list)
            step = max(1, SLICE_CELLS // max(1, pc.max(n).as_py() or 0) ** 2)
            for at in range(0, batch.num_rows, step):
                yield _picked(batch.slice(at, step), lam, top_n)

    ship_package(rows.sparkSession)
    return lists.mapInArrow(run, _OUT)


def _picked(lists: pa.RecordBatch, lam: float, top_n: int | None) -> pa.RecordBatch:
    """:func:`mmr_select` on all lists of a batch at once, with the similarities of the pairs named there."""
    size = {c: pc.list_value_length(lists.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("items", "a")}
    of, pair_of = (np.repeat(np.arange(lists.num_rows), n) for n in size.values())
    flat = {c: lists.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("items", "scores", "a", "b", "sims")}
    items, scores = flat["items"].astype(np.int64), flat["scores"].astype(np.float64)
    order = np.lexsort((items, -np.round(scores, RANK_DIGITS), of))
    items, scores = items[order], scores[order]
    place = np.arange(len(of)) - np.repeat(np.cumsum(size["items"]) - size["items"], size["items"])
    shape = (lists.num_rows, int(size["items"].max(initial=0)))
    ids, S, remaining = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape, bool)
    ids[of, place], S[of, place], remaining[of, place] = items, scores, True
    # both sides are candidates of the query: their places in id order, last of equal ids
    names = np.unique(items)
    code = lambda q, x: q * len(names) + np.searchsorted(names, x)
    known = code(of, items)
    by_id = np.argsort(known, kind="stable")
    at = [place[by_id[np.searchsorted(known[by_id], code(pair_of, flat[c].astype(np.int64)), "right") - 1]] for c in ("a", "b")]
    near = np.zeros((*shape, shape[1]))
    near[pair_of, at[1], at[0]] = flat["sims"].astype(np.float64)
    rows, max_sim, picks = np.arange(shape[0]), np.zeros(shape), []
    for _ in range(shape[1] if top_n is None else min(top_n, shape[1])):
        obj = lam * S - (1.0 - lam) * max_sim
        best = np.argmax(np.where(remaining, np.round(obj, RANK_DIGITS), -np.inf), axis=1)   # first index among ties
        picks.append((remaining[rows, best], ids[rows, best], S[rows, best], obj[rows, best]))
        remaining[rows, best] = False
        max_sim = np.maximum(max_sim, near[rows, best])
    # (step, query) -> rows of a query together
    done, *out = (np.stack(c, axis=1) if picks else np.zeros((shape[0], 0)) for c in (zip(*picks) if picks else [()] * 4))
    q, rank = np.nonzero(done)
    cols = [lists.column("query").take(pa.array(q)), pa.array(rank + 1), *(pa.array(c[q, rank]) for c in out)]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)],
                                      names=_OUT.fieldNames())


def mmr_rerank_iterative(candidates: DataFrame, vectors: DataFrame, lam: float = LAMBDA, top_n: int = TOP_N,
                         query_col: str = "query", item_col: str = "item", score_col: str = "score") -> DataFrame:
    """RR1 for candidate lists of any length: the same greedy selection as
    :func:`mmr_rerank`, with no query's list held by one task.

    Each of the ``top_n`` steps is a distributed argmax per query (``max_by``
    with the same tie order: rounded objective, rounded score, lower id) and a
    join that folds the new pick's cosine into every candidate's running max
    similarity.  Both results are written as reliable checkpoints in
    ``spark.checkpoint.dir`` (required), so lineage stays one step deep.
    Returns (query, rank, item, score, mmr).
    """
    from coclick.functions.vectors import dot, l2_normalize
    from coclick.session import cut_lineage

    v = vectors.select(F.col("id").alias("item"), l2_normalize(F.col("vec")).alias("vec"))
    c = candidates.select(F.col(query_col).cast("bigint").alias("query"), F.col(item_col).cast("bigint").alias("item"),
                          F.col(score_col).cast("double").alias("score"))
    cand = cut_lineage(c.join(v, "item", "left").select(
        "query", "item", "score", "vec", F.lit(0.0).alias("max_sim"), F.lit(False).alias("done")))
    picks = []
    for step in range(1, top_n + 1):
        obj = F.lit(lam) * F.col("score") - F.lit(1.0 - lam) * F.col("max_sim")
        order = F.struct(F.round(obj, RANK_DIGITS), F.round(F.col("score"), RANK_DIGITS), -F.col("item"))
        best = cut_lineage(cand.where(~F.col("done")).groupBy("query").agg(
            F.max_by(F.struct("item", "vec", "score", obj.alias("mmr")), order).alias("b")).select(
            "query", F.lit(step).cast("bigint").alias("rank"), F.col("b.item").alias("item"),
            F.col("b.score").alias("score"), F.col("b.mmr").alias("mmr"), F.col("b.vec").alias("svec")))
        picks.append(best.drop("svec"))
        if step == top_n:
            break
        sel = best.select("query", F.col("item").alias("__sel"), "svec")
        sim = F.when(F.col("vec").isNotNull() & F.col("svec").isNotNull(), dot("vec", "svec")).otherwise(F.lit(0.0))
        cand = cut_lineage(cand.join(sel, "query", "left").select(
            "query", "item", "score", "vec",
            F.when(F.col("__sel").isNotNull(), F.greatest("max_sim", sim)).otherwise(F.col("max_sim")).alias("max_sim"),
            (F.col("done") | (F.col("item") == F.col("__sel"))).alias("done")))
    out = picks[0]
    for p in picks[1:]:
        out = out.unionByName(p)
    return out
