"""Item vectors: session sentences, Word2Vec, exact and approximate kNN
(VEC1, VEC1b, VEC2, VEC3, VEC4).

Exact kNN is a tiled join: queries and corpus are cut into hash blocks of some
times ``block`` rows; each (query block, corpus block) tile holds its queries,
reads its corpus vectors as a stream of Arrow batches, multiplies with numpy and
keeps a running top-k per query; a ``row_number() <= k`` over the tile results
(WindowGroupLimit) gives the global top-k.  Memory per task is bounded by the
block size, not the data.

Approximate kNN replaces the reference's single-machine HNSW index with an
IVF index that Spark can build and query in parallel: hashed corpus vectors (or
given centroids) cut the corpus into lists, each query probes its ``n_probe``
nearest lists, and candidates are re-ranked exactly with the same tiled kernel per
list.  :mod:`coclick.operators.neighbour_graph` searches without lists.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.functions.vectors import l2_normalize
from coclick.operators.positions import numbered
from coclick.session import ship_package, stored
from coclick.operators.topk import RANK_DIGITS, top_k_by_key

SPACES = ("cosine", "l2", "ip")
# Fixed values of the reference's vector jobs.
W2V_DIM = 32
W2V_WINDOW = 10
W2V_ITER = 15
W2V_PARTITIONS = 15
MAX_SENTENCE = 1000   # tokens per sentence chunk
MAX_LISTS_BYTES = 64 << 20   # largest IVF centroid table that travels with the tasks
# a tile of a large search: QUERY_BLOCKS blocks of queries, CORPUS_BLOCKS blocks of the corpus; so many of each at a time
QUERY_BLOCKS, CORPUS_BLOCKS, QUERY_SIDE, CORPUS_SIDE = 4, 16, 256, 1024
NO_VECTOR = np.iinfo(np.int64).max   # id of a place that a bound takes
LARGEST_SINGLE = 1e30   # products up to here are compared in single precision

_PAIR_SCHEMA = T.StructType([T.StructField("qid", T.LongType()), T.StructField("cid", T.LongType()),
                             T.StructField("dist", T.DoubleType())])


def _stack(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in col])


def _rows(vec: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), -1)
    if not pc.all(pc.equal(pc.list_value_length(vec), x.shape[1])).as_py():
        raise ValueError("vectors must have the same length")
    return x


def _single(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return x.astype(np.float32)


class _Nearest:
    """The k nearest so far of a block of queries, among corpus vectors that come in any order.

    Products of the vectors in single precision are compared with each query's bar, less the
    most that their rounding can take away; only those that pass become distances, from the
    vectors as they are.  What passed waits until a side of queries has some for each, and
    then lowers their bars.  For ``l2`` a corpus vector's half square rides along as one more
    dimension, so the product is (|q|^2 - distance) / 2.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, space: str):
        self.ids, self.k, self.space = ids, k, space
        self.scale = 2.0 if space == "l2" else 1.0
        self.base = (x * x).sum(1) if space == "l2" else np.ones(len(ids))
        self.x = np.hstack([x, np.ones((len(x), 1))]) if space == "l2" else self._unit(x, space)
        self.size = np.sqrt((self.x * self.x).sum(1))
        self.short, self.near = _single(self.x), np.empty((QUERY_SIDE, CORPUS_SIDE), np.float32)
        self.dist = np.full((len(ids), k), np.inf)
        self.cid = np.full((len(ids), k), -1, np.int64)
        self.waiting: dict[int, list[tuple[np.ndarray, ...]]] = {}

    @staticmethod
    def _unit(x: np.ndarray, space: str) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if space == "cosine" else x

    @classmethod
    def corpus(cls, x: np.ndarray, space: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corpus vectors as the products take them, in double and single precision, and their sizes."""
        c = np.hstack([x, -0.5 * (x * x).sum(1)[:, None]]) if space == "l2" else cls._unit(x, space)
        return c, _single(c), np.sqrt((c * c).sum(1))

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        c, short, size = self.corpus(x, self.space)
        for b in range(0, len(ids), CORPUS_SIDE):
            part = slice(b, b + CORPUS_SIDE)
            for a in range(0, len(self.ids), QUERY_SIDE):
                self._meet(a, ids[part], c[part], short[part], size[part].max())

    def reach(self, ids: np.ndarray, corpus: tuple[np.ndarray, np.ndarray, np.ndarray], first: np.ndarray, last: np.ndarray) -> None:
        """Each side of queries meets the corpus vectors from the lowest ``first`` to the highest ``last`` of its queries."""
        c, short, size = corpus
        for a in range(0, len(self.ids), QUERY_SIDE):
            end = int(last[a:a + QUERY_SIDE].max())
            for b in range(int(first[a:a + QUERY_SIDE].min()), end, CORPUS_SIDE):
                part = slice(b, min(b + CORPUS_SIDE, end))
                self._meet(a, ids[part], c[part], short[part], size[part].max())

    def within(self, worst: np.ndarray) -> None:
        """Only distances up to ``worst`` are wanted: the places of a list are taken until nearer vectors come."""
        some = np.isfinite(worst)
        self.dist[some], self.cid[some] = worst[some, None], NO_VECTOR

    def _meet(self, a: int, ids: np.ndarray, c: np.ndarray, short: np.ndarray, largest: float) -> None:
        of = slice(a, a + QUERY_SIDE)
        base, bar, bound = self.base[of], self.dist[of, -1], self.size[of] * largest
        # a product is off by at most half a unit per operation, of the sizes' product; large ones are not cut short
        single = bound.max() < LARGEST_SINGLE
        left, right, near = (self.short[of], short, self.near[:, :len(ids)]) if single else (self.x[of], c, None)
        near = np.matmul(left, right.T, out=None if near is None else near[:len(left)])
        off = (c.shape[1] + 8) * np.finfo(near.dtype).eps * bound + 10.0 ** -RANK_DIGITS
        # nothing past the k-th distance, of those seen or of these, can count; rounding may move it by a last place
        if len(ids) > self.k and np.isinf(bar).any():
            bar = np.minimum(bar, base - self.scale * (np.partition(near, -self.k, axis=1)[:, -self.k] - off))
        least = (base - bar) / self.scale - off - 10.0 ** -RANK_DIGITS
        least = np.nextafter(np.where(np.isnan(least), -np.inf, least).astype(near.dtype), near.dtype.type(-np.inf))
        rows = np.flatnonzero(~(near.max(axis=1) < least))   # later on few queries find anything
        if not len(rows):
            return
        row, col = np.divmod(np.flatnonzero(~(near[rows] < least[rows, None])), len(ids))
        row = rows[row]
        dist = base[row] - self.scale * np.einsum("ij,ij->i", self.x[of][row], c[col])
        if self.space == "l2":
            dist = np.maximum(dist, 0.0)
        # the bars themselves, with equal distances to 9 places by id; NaN counts as the farthest
        by, cid = np.round(dist, RANK_DIGITS), ids[col]
        held, last = np.round(self.dist[of, -1], RANK_DIGITS)[row], self.cid[of, -1][row]
        keep = (by < held) | ((by == held) & (cid < last)) | np.isposinf(held) | (np.isnan(held) & (~np.isnan(by) | (cid < last)))
        if keep.any():
            waits = self.waiting.setdefault(a, [])
            waits.append((row[keep], cid[keep], dist[keep]))
            if np.isinf(self.dist[of, -1]).any() or sum(len(r) for r, _, _ in waits) > self.k * QUERY_SIDE:
                self._settle(a)

    def _settle(self, a: int) -> None:
        of = slice(a, a + QUERY_SIDE)
        held, cids = self.dist[of], self.cid[of]
        row, cid, dist = (np.concatenate(x) for x in zip(*self.waiting.pop(a), strict=True))
        touched = np.unique(row)
        row = np.concatenate([np.repeat(touched, self.k), row])
        cid = np.concatenate([cids[touched].ravel(), cid])
        dist = np.concatenate([held[touched].ravel(), dist])
        # equal distances to 9 places: lower id first; places without a vector last
        by = np.lexsort((cid, np.round(dist, RANK_DIGITS), np.isposinf(dist), row))
        row, cid, dist = row[by], cid[by], dist[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        held[row[keep], place[keep]] = dist[keep]
        cids[row[keep], place[keep]] = cid[keep]

    def found(self) -> Iterator[pa.RecordBatch]:
        for a in list(self.waiting):
            self._settle(a)
        for a in range(0, len(self.ids), 1 + 100_000 // self.k):
            part = slice(a, a + 1 + 100_000 // self.k)
            row, col = np.nonzero(~np.isposinf(self.dist[part]) & (self.cid[part] != NO_VECTOR))
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[part][row]), pa.array(self.cid[part][row, col]),
                                              pa.array(self.dist[part][row, col])], names=["qid", "cid", "dist"])


def _tiles(n_keys: int, k: int, space: str):
    """Rows sorted by (tile, kind): a tile's queries (0) are held, its corpus vectors (1) pass by, to each query's k nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, near = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in range(n_keys + 1)])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key, kind = tuple(marks[:n_keys, a].tolist()), marks[n_keys, a]
                if key != tile:
                    if near is not None:
                        yield from near.found()
                    tile, held, near = key, [], None
                ids, x = batch.column(n_keys + 1).slice(a, b - a).to_numpy(), _rows(batch.column(n_keys + 2).slice(a, b - a))
                if kind == 0:
                    held.append((ids, x))
                    continue
                if near is None:
                    if not held:
                        continue
                    near = _Nearest(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]), k, space)
                    held = []
                near.meet(ids, x)
        if near is not None:
            yield from near.found()
    return run


def _blocks(n: int, block: int, wide: int, least: int) -> int:
    """Blocks of a side of ``n`` rows: ``wide`` times ``block`` rows each, ``block`` rows as long as there are few."""
    return max(-(-n // (wide * block)), min(-(-n // block), least), 1)


def _tiled_topk(queries: DataFrame, corpus: DataFrame, k: int, space: str, block: int,
                group_cols: list[str] | None = None) -> DataFrame:
    """Top-k candidates per (group,) query from tiles; (qid, cid, dist), not yet globally cut.

    A tile holds one block of queries and reads its share of the corpus as a stream,
    so its memory is that of the queries and their k best.  Query blocks are wide:
    a corpus vector is copied once per query block, a query once per share of the corpus.
    """
    g = group_cols or []
    q = queries.select(*g, F.col("id").cast("bigint").alias("id"), F.col("vec"))
    c = corpus.select(*g, F.col("id").cast("bigint").alias("id"), F.col("vec"))
    # sizes of the sides, or of their groups (one row per group: the lists of a bounded index)
    sizes = [{r[g[0]] if g else None: r["count"] for r in side.groupBy(*g).count().collect()} for side in (q, c)]
    both = sorted(x for x in set(sizes[0]) & set(sizes[1]) if x is not None or not g)
    # the groups are tiles already: many of them need no more for the sake of parallel work
    least = [max(1, -(-n // max(1, len(both)))) for n in (8, 4)]
    blocks = {x: (_blocks(sizes[0][x], block, QUERY_BLOCKS, least[0]), _blocks(sizes[1][x], block, CORPUS_BLOCKS, least[1])) for x in both}
    if not both or not (g or (sizes[0][None] and sizes[1][None])):
        return q.select(F.col("id").alias("qid"), F.col("id").alias("cid"), F.lit(0.0).alias("dist")).limit(0)

    def count(side: int):
        if not g:
            return F.lit(blocks[None][side]).cast("bigint")
        return F.create_map(*[F.lit(x).cast("bigint") for x in itertools.chain.from_iterable(
            (x, blocks[x][side]) for x in both)])[F.col(g[0])]

    def sent(df: DataFrame, kind: int) -> DataFrame:
        own, other = (("qb", "cb"), ("cb", "qb"))[kind]
        d = df.withColumns({"__own": count(kind), "__other": count(1 - kind)}).where("__own is not null")
        d = d.where("vec is not null").withColumns({own: F.pmod(F.xxhash64("id"), F.col("__own")),
                           other: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__other") - 1))})
        return d.select(*keys, F.lit(kind).cast("bigint").alias("kind"), "id", "vec")

    ship_package(q.sparkSession)
    keys = [*g, "qb", "cb"]
    # tiles are few and heavy: not merged by the bytes they read
    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent(q, 0).unionByName(sent(c, 1)).repartition(parts, *keys).sortWithinPartitions(*keys, "kind") \
        .mapInArrow(_tiles(len(keys), k, space), _PAIR_SCHEMA)


def knn_exact(queries: DataFrame, corpus: DataFrame, k: int = 10, space: str = "cosine",
              block: int = 4096) -> DataFrame:
    """VEC2: the k nearest corpus vectors of every query vector.

    Distances as the reference's index space: cosine = 1 - cos, l2 = squared
    euclidean, ip = 1 - dot.  Ties: rounded distance, then id.
    Inputs (id, vec); returns (qid, rank, cid, dist).
    """
    if space not in SPACES:
        raise ValueError(f"space must be one of {SPACES}")
    cand = _tiled_topk(queries, corpus, k, space, block)
    return top_k_by_key(cand, ["qid"], [F.round("dist", RANK_DIGITS), "cid"], k).select("qid", "rank", "cid", "dist")


def ivf_search(queries: DataFrame, corpus: DataFrame, centres: np.ndarray, k: int = 10, space: str = "cosine",
               n_probe: int = 8, block: int = 4096) -> DataFrame:
    """VEC3 search given IVF centroids (``n_lists x dim``, a small model).

    Every corpus vector joins the list of its nearest centroid, every query
    probes its ``n_probe`` nearest lists (squared L2; ties to the lower list
    id, on distances rounded to 9 places), and candidates are ranked exactly
    per list with the tiled kernel.  With cosine, vectors are L2-normalised
    first.  Returns (qid, rank, cid, dist).
    """
    corpus, queries = (d.select("id", "vec").where("vec is not null") for d in (corpus, queries))
    if space == "cosine":
        # as in l2_normalize: a vector with a missing number has no direction
        corpus, queries = (d.withColumn("vec", F.when(F.exists("vec", F.isnull), F.transform("vec", lambda x: F.lit(0).cast(
            d.schema["vec"].dataType.elementType))).otherwise(F.col("vec"))) for d in (corpus, queries))
    centres = np.asarray(centres, dtype=np.float64)
    if centres.nbytes > MAX_LISTS_BYTES:
        raise ValueError(f"{centres.nbytes} bytes of centroids; at most {MAX_LISTS_BYTES} are sent to the tasks")

    def nearest(probe: int):
        @F.pandas_udf(T.ArrayType(T.LongType()))
        def lists(v: pd.Series) -> pd.Series:
            x = _stack(v)
            if len(x) == 0:
                return pd.Series([], dtype=object)
            if space == "cosine":
                norm = np.sqrt((x * x).sum(1, keepdims=True))
                x = np.divide(x, norm, out=np.zeros_like(x), where=norm != 0)
            d = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
            idx = np.argsort(np.round(d, RANK_DIGITS), axis=1, kind="stable")[:, :probe]
            return pd.Series([row.astype(np.int64).tolist() for row in idx])
        return lists

    ship_package(queries.sparkSession)
    probe = int(min(n_probe, len(centres)))
    # written: the lists are assigned once for the group sizes and the search; the vectors travel as they
    # are (the tiles normalise them), a query's once for all its lists
    cx = stored(corpus.select("id", "vec", nearest(1)(F.col("vec").cast("array<double>"))[0].alias("list")),
                "ivf-corpus")
    qx = stored(queries.select("id", "vec", nearest(probe)(F.col("vec").cast("array<double>")).alias("lists")),
                "ivf-queries").select("id", "vec", F.explode("lists").alias("list"))
    cand = _tiled_topk(qx, cx, k, space, block, group_cols=["list"])
    return top_k_by_key(cand, ["qid"], [F.round("dist", RANK_DIGITS), "cid"], k).select("qid", "rank", "cid", "dist")


def kmeans_centres(corpus: DataFrame, n_lists: int = 16, space: str = "cosine", seed: int = 7,
                   max_iter: int = 10) -> np.ndarray:
    """IVF training with Spark ML KMeans; returns the ``n_lists x dim`` centroids."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if space == "cosine":
        corpus = corpus.select("id", l2_normalize("vec").alias("vec"))
    cv = corpus.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    model = KMeans(k=n_lists, seed=seed, maxIter=max_iter, featuresCol="features").fit(cv)
    return np.stack([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])


def seed_centres(corpus: DataFrame, n_lists: int = 16, space: str = "cosine", seed: str = "coclick") -> np.ndarray:
    """IVF centroids by sampling: the ``n_lists`` corpus vectors with the
    smallest MD5 of (seed, id) -- random-init k-means seeds without the
    iterations, reproducible by any engine.  Reads n_lists rows only."""
    from coclick.functions.hashing import uniform_hash

    c = corpus.select("id", l2_normalize("vec").alias("vec")) if space == "cosine" else corpus
    picked = c.orderBy(uniform_hash(F.lit(seed), F.col("id")), "id").limit(n_lists).collect()
    return np.stack([np.asarray(r.vec, dtype=np.float64) for r in picked])


def knn_approx(queries: DataFrame, corpus: DataFrame, k: int = 10, space: str = "cosine", *, n_lists: int,
               n_probe: int, seed: str = "coclick", block: int = 4096, centres: np.ndarray | None = None) -> DataFrame:
    """VEC3: approximate kNN with an IVF index.

    Centroids are ``n_lists`` hashed corpus vectors (:func:`seed_centres`)
    unless given (e.g. :func:`kmeans_centres`).  Each query probes its
    ``n_probe`` nearest lists; candidates in those lists are ranked exactly.
    ``n_probe = n_lists`` gives the exact answer.  Returns (qid, rank, cid, dist).
    """
    if centres is None:
        centres = seed_centres(corpus, n_lists, space, seed)
    return ivf_search(queries, corpus, centres, k, space, n_probe, block)


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Mean over queries of |approx top-k ∩ exact top-k| / |exact top-k|."""
    # one pass over either side; a row without an id equals no other
    both = exact.select("qid", "cid", F.lit(1).alias("e"), F.lit(0).alias("a")) \
        .unionByName(approx.select("qid", "cid", F.lit(0).alias("e"), F.lit(1).alias("a")))
    met = both.groupBy("qid", "cid").agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    hit = F.when(F.col("qid").isNotNull() & F.col("cid").isNotNull(), F.col("e") * F.col("a")).otherwise(F.lit(0))
    per = met.groupBy("qid").agg(F.sum(hit).alias("h"), F.sum("e").alias("n")).where("n > 0")
    return per.select((F.col("h") / F.col("n")).alias("r")).agg(F.avg("r").alias("recall"), F.count(F.lit(1)).alias("queries"))


def session_sentences(clicks: DataFrame, session_cols: list[str], item_col: str = "item", ts_col: str = "ts",
                      tiebreak: str | None = None, max_len: int = MAX_SENTENCE, overlap: int = 0) -> DataFrame:
    """VEC1b: each session's items in time order as space-separated sentences.

    Long sessions are cut into chunks of ``max_len`` tokens (Word2Vec does the
    same), so no task holds an unbounded list.  Each chunk repeats the last
    ``overlap`` tokens of the one before: with the model's window no pair of
    neighbours is lost at a cut.  Returns session cols, chunk, sentence, tokens.
    """
    if not 0 <= overlap < max_len:
        raise ValueError("0 <= overlap < max_len is needed")
    # total order up to identical rows, so a retried task numbers ties the same way
    order = [ts_col] + ([tiebreak] if tiebreak else []) + [item_col]
    d = clicks.select(*session_cols, *dict.fromkeys([item_col, *order])).na.drop(subset=[*session_cols, item_col, ts_col])
    step = max_len - overlap
    if overlap:
        idx = numbered(d, session_cols, list(dict.fromkeys(order)), "pos", "__n")
        first = F.greatest(F.ceil((F.col("pos") - max_len) / step), F.lit(0)).cast("bigint")
        idx = idx.withColumn("chunk", F.explode(F.sequence(first, F.floor((F.col("pos") - 1) / step).cast("bigint")))) \
            .where((F.col("chunk") == 0) | (F.col("chunk") * step + overlap < F.col("__n")))
    else:
        idx = numbered(d, session_cols, list(dict.fromkeys(order))) \
            .withColumn("chunk", F.floor((F.col("pos") - 1) / step).cast("bigint"))
    g = idx.groupBy(*session_cols, "chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.col(item_col).cast("string").alias("tok")))).alias("__l"))
    toks = F.transform("__l", lambda x: x["tok"])
    return g.select(*session_cols, "chunk", F.array_join(toks, " ").alias("sentence"), toks.alias("tokens"))


def item2vec_fit(sentences: DataFrame, dim: int = W2V_DIM, window: int = W2V_WINDOW, iters: int = W2V_ITER,
                 partitions: int = W2V_PARTITIONS, min_count: int = 5, seed: int = 42, tokens_col: str = "tokens"):
    """VEC1: skip-gram Word2Vec (Spark ML) over token arrays; returns the fitted model."""
    from pyspark.ml.feature import Word2Vec

    w2v = Word2Vec(vectorSize=dim, windowSize=window, maxIter=iters, numPartitions=partitions,
                   minCount=min_count, seed=seed, inputCol=tokens_col, outputCol="__w2v",
                   maxSentenceLength=MAX_SENTENCE)
    return w2v.fit(sentences.select(tokens_col))


def model_vectors(model) -> DataFrame:
    """(id bigint, vec array<float>) from a Word2Vec model (words are item ids)."""
    from pyspark.ml.functions import vector_to_array

    v = model.getVectors()
    return v.select(F.col("word").try_cast("bigint").alias("id"),
                    vector_to_array("vector", "float32").alias("vec")).where(F.col("id").isNotNull())


def similar_items(model, k: int = 5, space: str = "cosine") -> DataFrame:
    """VEC4: the k most similar other items of every vocabulary item."""
    vecs = model_vectors(model)
    nn = knn_exact(vecs, vecs, k + 1, space)
    nn = nn.where(F.col("qid") != F.col("cid"))
    return top_k_by_key(nn.drop("rank"), ["qid"], [F.round("dist", RANK_DIGITS), "cid"], k)
