"""GraphSAGE max-pool inference and in-batch softmax loss / metrics (NN1-NN3).

NN1 runs a 2-layer max-pool aggregator with supplied weights over the
two-hop samples: samples are dealt to blocks, a node's vector is sent once to
every block that names it, and the forward pass runs vectorised in numpy over
a block's samples as they pass by.

NN2 scores every pair inside a batch in tiles of any batch's size: a tile holds
a block of rows with their running maximum and sum of exponentials and reads its
share of the columns as a stream (numpy), so no pair becomes a row.  NN3 scores
them with a self-join on the batch id (batches are bounded by construction).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coclick.functions.vectors import dot
from coclick.operators.skew import split_join
from coclick.operators.stripes import integral
from coclick.operators.topk import RANK_DIGITS
from coclick.session import ship_package, stored

LEAKY_ALPHA = 0.02   # leaky-relu slope of the aggregator
LOG_EPS = 1e-8       # loss = -ln(p + eps)


# Numbers in the padded neighbourhood tensor of one slice.
SLICE_CELLS = 8_000_000
# Samples of a block, on average; smaller blocks as long as there are few for the tasks.
BLOCK_SAMPLES, LEAST_SAMPLES = 2048, 256
# Rows and columns of a batch's tile, on average; so many of each at a time.
TILE_ROWS, TILE_COLUMNS, ROWS_AT_ONCE, COLUMNS_AT_ONCE = 8192, 65_536, 512, 1024


def init_weights(in_dim: int, hidden: int = 32, out_dim: int = 16, seed: int = 0) -> dict[str, np.ndarray]:
    """Deterministic weights in the reference's initialisation scheme:
    truncated-normal(0.001) MLP kernels and biases, Glorot-uniform projections."""
    rng = np.random.RandomState(seed)

    def tn(*shape):
        return np.clip(rng.normal(0.0, 0.001, size=shape), -0.002, 0.002)

    def glorot(a, b):
        r = np.sqrt(6.0 / (a + b))
        return rng.uniform(-r, r, size=(a, b))

    return {
        "mlp2_w": tn(in_dim, hidden), "mlp2_b": tn(hidden), "self2_w": glorot(in_dim, out_dim),
        "neigh2_w": glorot(hidden, out_dim),
        "mlp1_w": tn(out_dim, hidden), "mlp1_b": tn(hidden), "self1_w": glorot(in_dim, out_dim),
        "neigh1_w": glorot(hidden, out_dim),
    }


def _leaky(x: np.ndarray, alpha: float = LEAKY_ALPHA) -> np.ndarray:
    return np.where(x >= 0, x, alpha * x)


def _pool(neigh: np.ndarray, mask: np.ndarray, w: np.ndarray, b: np.ndarray, mask_padding: bool) -> np.ndarray:
    """max over the neighbour axis of leaky(neigh @ w + b); neigh [..., n, d], mask [..., n]."""
    h = _leaky(neigh @ w + b)
    if mask_padding:
        h = np.where(mask[..., None], h, -np.inf)
        m = h.max(axis=-2)
        return np.where(np.isfinite(m), m, 0.0)
    return h.max(axis=-2)


def forward(centre: np.ndarray, hop1: np.ndarray, m1: np.ndarray, hop2: np.ndarray, m2: np.ndarray,
            W: dict, mask_padding: bool = True) -> np.ndarray:
    """Batch forward pass.  centre [B, d]; hop1 [B, k1, d], m1 [B, k1];
    hop2 [B, k1, k2, d], m2 [B, k1, k2].  Returns L2-normalised [B, out]."""
    # hop-2 layer on every hop-1 node (leaky activation)
    pooled2 = _pool(hop2, m2, W["mlp2_w"], W["mlp2_b"], mask_padding)          # [B, k1, hidden]
    out2 = _leaky(hop1 @ W["self2_w"] + pooled2 @ W["neigh2_w"])               # [B, k1, out]
    # hop-1 layer on the centre (no activation)
    pooled1 = _pool(out2, m1, W["mlp1_w"], W["mlp1_b"], mask_padding)          # [B, hidden]
    out = centre @ W["self1_w"] + pooled1 @ W["neigh1_w"]                      # [B, out]
    n = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(n, 1e-12)


def neighbour_max_pool(samples: DataFrame, vectors: DataFrame, W: dict, k1: int, k2: int,
                       norm_mean: np.ndarray | None = None, norm_std: np.ndarray | None = None,
                       mask_padding: bool = True, key_cols: tuple[str, ...] = ("tag", "va", "vb"),
                       out_type: str = "float") -> DataFrame:
    """NN1: embeddings of the sample centres.

    ``samples``: key cols, ``hop1s array<bigint>``, ``hop2s array<array<bigint>>``
    (GR5 output, centre = ``va``); ``vectors``: (id, vec).  Inputs are
    normalised with the supplied constants first (the reference's
    Normalization layers).  Samples whose centre has no vector are dropped;
    missing neighbour vectors count as padding.  Returns key cols + ``emb``
    (``array<float>``, or ``array<double>`` with ``out_type="double"``).
    """
    keys = list(key_cols)
    in_dim = W["self1_w"].shape[0]
    mean = np.zeros(in_dim) if norm_mean is None else np.asarray(norm_mean, dtype=np.float64)
    std = np.ones(in_dim) if norm_std is None else np.asarray(norm_std, dtype=np.float64)
    weights = {k: np.asarray(a, dtype=np.float64) for k, a in W.items()}
    key_types = dict(samples.dtypes)
    out_schema = ", ".join(f"{k} {key_types[k]}" for k in keys) + f", emb array<{out_type}>"
    np_type = np.float32 if out_type == "float" else np.float64
    spark = samples.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    whole = F.col("hop1s").isNotNull() & F.col("hop2s").isNotNull() & ~F.exists("hop2s", F.isnull)
    s = stored(samples.where(whole).select(*keys, F.col("va").cast("bigint").alias("__centre"),
                                           F.col("hop1s").cast("array<bigint>").alias("hop1s"),
                                           F.col("hop2s").cast("array<array<bigint>>").alias("hop2s")).dropDuplicates(keys), "gnn-samples")
    n = s.count()
    blocks = max(-(-n // BLOCK_SAMPLES), min(parts, -(-n // LEAST_SAMPLES)), 1)
    s = s.withColumn("__block", F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int"))
    # a vector once for every block that names its node
    named = F.array_distinct(F.concat(F.array("__centre"), "hop1s", F.flatten("hop2s")))
    v = vectors.select(F.col("id").cast("bigint").alias("__node"), F.col("vec").cast("array<double>").alias("__vec")).where("__vec is not null")
    v = s.select("__block", F.explode(named).alias("__node")).distinct().join(v, "__node")
    own = ["__centre", "hop1s", "hop2s", *keys]
    held = v.select("__block", F.lit(0).alias("__kind"), "__node", "__vec", *[F.lit(None).cast(s.schema[c].dataType).alias(c) for c in own])
    passing = s.select("__block", F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__node"),
                       F.lit(None).cast("array<double>").alias("__vec"), *own)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known, nodes, x = None, [], np.zeros(0, np.int64), np.zeros((0, in_dim))
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in (0, 1)])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if marks[0, a] != block:
                    block, known, nodes, x = marks[0, a], [], np.zeros(0, np.int64), np.zeros((0, in_dim))
                if marks[1, a] == 0:
                    known.append((part.column(2).to_numpy(), part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b - a, in_dim)))
                    continue
                if known:
                    node, vec = (np.concatenate(c) for c in zip(*known, strict=True))
                    last = np.flatnonzero(np.append(node[1:] != node[:-1], True))
                    nodes, x, known = node[last], (vec[last] - mean) / std, []
                # bounded slices: a slice's padded neighbourhood takes at most about SLICE_CELLS numbers
                step = max(1, SLICE_CELLS // (k1 * (k2 + 1) * in_dim))
                for at in range(0, b - a, step):
                    yield from embedded(part.slice(at, step), nodes, x)

    def embedded(rb: pa.RecordBatch, nodes: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        B = rb.num_rows

        def vectors_of(node: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            missing = node.is_null().to_numpy(zero_copy_only=False)
            node = pc.fill_null(node, 0).to_numpy()
            at = np.minimum(np.searchsorted(nodes, node), max(len(nodes) - 1, 0))
            return at, ~missing & (nodes[at] == node) if len(nodes) else np.zeros(len(node), bool)

        def places(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            return np.repeat(np.arange(len(lens)), lens), np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)

        centre, hop1, m1 = np.zeros((B, in_dim)), np.zeros((B, k1, in_dim)), np.zeros((B, k1), dtype=bool)
        hop2, m2 = np.zeros((B, k1, k2, in_dim)), np.zeros((B, k1, k2), dtype=bool)
        at, has_centre = vectors_of(rb.column(4))
        centre[has_centre] = x[at[has_centre]]
        row1, p1 = places(rb.column(5))
        at1, has1 = vectors_of(rb.column(5).flatten())
        row2, p2 = places(rb.column(6))
        inner = rb.column(6).flatten()
        of, q = places(inner)
        at2, has2 = vectors_of(inner.flatten())
        row2, p2, of1, q = row2[of[has2]], p2[of[has2]], p1[has1], q[has2]
        most = max(int(of1.max(initial=-1)), int(p2.max(initial=-1))), int(q.max(initial=-1))
        if most[0] >= k1 or most[1] >= k2:
            raise ValueError(f"sample positions up to {most}; k1 = {k1} and k2 = {k2} leave them out")
        hop1[row1[has1], of1], m1[row1[has1], of1] = x[at1[has1]], True
        hop2[row2, p2, q], m2[row2, p2, q] = x[at2[has2]], True
        out = forward(centre, hop1, m1, hop2, m2, weights, mask_padding).astype(np_type)
        keep = np.nonzero(has_centre)[0]
        emb = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * out.shape[1]),
                                       pa.array(out[keep].ravel()))
        cols = [rb.column(7 + i).take(pa.array(keep)) for i in range(len(keys))] + [emb]
        yield pa.RecordBatch.from_arrays(cols, names=[*keys, "emb"])

    return held.unionByName(passing).repartition(parts, "__block").sortWithinPartitions("__block", "__kind", "__node", "__vec") \
        .mapInArrow(embed, out_schema)


def _batch_scores(pairs: DataFrame, batch: str, pos: str, a_vec: str, b_vec: str) -> DataFrame:
    a = pairs.select(F.col(batch).alias("batch"), F.col(pos).alias("i"), F.col(a_vec).alias("__a"))
    b = pairs.select(F.col(batch).alias("batch"), F.col(pos).alias("j"), F.col(b_vec).alias("__b"))
    return a.join(b, "batch").select("batch", "i", "j", dot("__a", "__b").alias("s"))


class _Softmax:
    """Running maximum and sum of exponentials of a tile's rows, and their own columns' largest score."""

    def __init__(self, pos: np.ndarray, vec: list[np.ndarray | None], shift: float, scale: float):
        self.pos, self.shift, self.scale = pos, shift, scale
        self.top, self.sum, self.own = (np.full(len(pos), np.nan) for _ in range(3))
        self.seen, self.met = np.zeros(len(pos), bool), np.zeros(len(pos), bool)
        self.sides = _by_length(vec)

    def meet(self, pos: np.ndarray, placed: np.ndarray, vec: list[np.ndarray | None]) -> None:
        """Columns; one that is not placed counts in the sums and is no row's own."""
        for size, (at, b) in _by_length(vec).items():
            rows, a = self.sides.get(size, (np.zeros(0, np.int64), None))
            for i in range(0, len(rows), ROWS_AT_ONCE):
                for j in range(0, len(at), COLUMNS_AT_ONCE):
                    part = at[j:j + COLUMNS_AT_ONCE]
                    self._meet(rows[i:i + ROWS_AT_ONCE], a[i:i + ROWS_AT_ONCE], pos[part], placed[part], b[j:j + COLUMNS_AT_ONCE])

    def _meet(self, of: np.ndarray, a: np.ndarray, pos: np.ndarray, placed: np.ndarray, b: np.ndarray) -> None:
        z = self.scale * (a @ b.T)
        by = np.flatnonzero(placed)
        by = by[np.argsort(pos[by], kind="stable")]
        first, last = (np.searchsorted(pos[by], self.pos[of], side) for side in ("left", "right"))
        count = last - first
        row = np.repeat(np.arange(len(of)), count)
        if len(row):
            col = by[np.arange(len(row)) + np.repeat(first - np.cumsum(count) + count, count)]
            z[row, col] = self.scale * (np.einsum("ij,ij->i", a[row], b[col]) - self.shift)
            some = np.flatnonzero(count)
            own = np.maximum.reduceat(z[row, col], np.cumsum(count)[some] - count[some])
            some = of[some]
            self.own[some] = np.where(self.met[some], np.maximum(self.own[some], own), own)
            self.met[some] = True
        top = z.max(axis=1)
        new = np.where(self.seen[of], np.maximum(self.top[of], top), top)
        before = np.where(self.seen[of], self.sum[of] * np.exp(self.top[of] - new), 0.0)
        self.sum[of] = before + np.exp(z - new[:, None]).sum(axis=1)
        self.top[of], self.seen[of] = new, True


def _by_length(vec: list[np.ndarray | None]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors without a missing number by their length: (places, matrix)."""
    sizes = np.array([-1 if v is None else len(v) for v in vec])
    out = {}
    for size in np.unique(sizes[sizes >= 0]).tolist():
        at = np.flatnonzero(sizes == size)
        out[size] = at, np.stack([vec[i] for i in at])
    return out


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    lens = pc.list_value_length(column).fill_null(-1).to_numpy()
    flat = column.flatten()
    missing, x = flat.is_null().to_numpy(zero_copy_only=False), flat.to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lens, 0))
    gaps = np.concatenate([[0], np.cumsum(missing)])
    return [x[e - n:e] if n >= 0 and gaps[e] == gaps[e - n] else None for n, e in zip(lens.tolist(), ends.tolist(), strict=True)]


def _softmax_tiles(shift: float, scale: float):
    """Rows sorted by (batch, ib, jb, kind): a tile's rows (0), then its columns (1), to the rows' maximum, sum and own score."""
    def found(tile: tuple, rows: _Softmax, label: list) -> Iterator[pa.RecordBatch]:
        n = len(rows.pos)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, tile[0])), pa.array(rows.pos), pa.array(np.full(n, tile[2] == 0)), pa.array(label, pa.float64()),
             *(pa.array(x, mask=~ok) for x, ok in ((rows.top, rows.seen), (rows.sum, rows.seen), (rows.own, rows.met)))],
            names=["batch", "pos", "first", "label", "top", "sum", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, rows, label = None, [], None, []

        def closed():
            pos = np.concatenate([h[0] for h in held])
            return _Softmax(pos, [v for h in held for v in h[1]], shift, scale), [x for h in held for x in h[2]]

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in range(4)])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            vec = _vectors(batch.column(5))
            pos, placed = batch.column(4).fill_null(0).to_numpy(), batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if tuple(marks[:3, a].tolist()) != tile:
                    if held or rows is not None:
                        rows, label = (rows, label) if rows is not None else closed()
                        yield from found(tile, rows, label)
                    tile, held, rows, label = tuple(marks[:3, a].tolist()), [], None, []
                if marks[3, a] == 0:
                    held.append((pos[a:b], vec[a:b], batch.column(6).slice(a, b - a).to_pylist()))
                    continue
                if rows is None:
                    if not held:
                        continue
                    (rows, label), held = closed(), []
                with np.errstate(invalid="ignore", over="ignore"):
                    rows.meet(pos[a:b], placed[a:b], vec[a:b])
        if held or rows is not None:
            rows, label = (rows, label) if rows is not None else closed()
            yield from found(tile, rows, label)
    return run


def _joined_softmax_loss(pairs: DataFrame, batch: str, pos: str, a_vec: str, b_vec: str, label: str | None,
                         shift: float, scale: float) -> DataFrame:
    s = _batch_scores(pairs, batch, pos, a_vec, b_vec)
    z = F.lit(scale) * (F.col("s") - F.when(F.col("i") == F.col("j"), F.lit(shift)).otherwise(F.lit(0.0)))
    w = Window.partitionBy("batch", "i")
    s = s.withColumn("z", z).withColumn("__m", F.max("z").over(w))
    agg = s.groupBy("batch", "i").agg(
        F.sum(F.exp(F.col("z") - F.col("__m"))).alias("__den"),
        F.max(F.when(F.col("i") == F.col("j"), F.exp(F.col("z") - F.col("__m")))).alias("__num"))
    out = agg.withColumn("p_pos", F.col("__num") / F.col("__den"))
    lab = pairs.select(F.col(batch).alias("batch"), F.col(pos).alias("i"),
                       (F.col(label).cast("double") if label else F.lit(1.0)).alias("__lab"))
    return out.join(lab, ["batch", "i"]).select(
        "batch", F.col("i").alias("pos"), (-F.log(F.col("p_pos") + F.lit(LOG_EPS)) * F.col("__lab")).alias("loss"),
        "p_pos")


def inbatch_softmax_loss(pairs: DataFrame, batch: str = "batch", pos: str = "pos", a_vec: str = "a",
                         b_vec: str = "b", label: str | None = None, shift: float = 0.0,
                         scale: float = 1.0) -> DataFrame:
    """NN2: row i of a batch scores a_i against every b_j of the batch;
    the positive logit is lowered by ``shift``; loss_i = -ln(softmax_ii + 1e-8) * label_i.

    A missing vector, or one with a missing number, has no score.  Where batch and pos are no whole
    numbers, pairs are joined and not met in tiles.  Returns (batch, pos, loss, p_pos).
    """
    if not integral(pairs, batch, pos):
        return _joined_softmax_loss(pairs, batch, pos, a_vec, b_vec, label, shift, scale)
    spark = pairs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    types = {c: pairs.schema[c].dataType for c in (batch, pos)}
    p = stored(pairs.where(F.col(batch).isNotNull()).select(
        F.col(batch).cast("bigint").alias("batch"), F.col(pos).cast("bigint").alias("pos"), F.col(a_vec).cast("array<double>").alias("a"),
        F.col(b_vec).cast("array<double>").alias("b"), (F.col(label).cast("double") if label else F.lit(1.0)).alias("label")), "inbatch-pairs")
    sizes = p.groupBy("batch").agg(F.count("*").alias("n")).select(
        "batch", F.ceil(F.col("n") / TILE_ROWS).cast("bigint").alias("__i"), F.ceil(F.col("n") / TILE_COLUMNS).cast("bigint").alias("__j"))
    p = split_join(p, sizes, ["batch"], split_right=False)
    dealt = lambda n: F.pmod(F.xxhash64("pos", "a", "b"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rows = p.where("pos is not null").select("batch", dealt("__i").alias("ib"), every("__j").alias("jb"), F.lit(0).cast("bigint").alias("kind"),
                                             "pos", F.col("a").alias("vec"), "label")
    columns = p.select("batch", every("__i").alias("ib"), dealt("__j").alias("jb"), F.lit(1).cast("bigint").alias("kind"),
                       "pos", F.col("b").alias("vec"), F.lit(None).cast("double").alias("label"))
    tiles = rows.unionByName(columns).repartition(parts, "batch", "ib", "jb").sortWithinPartitions("batch", "ib", "jb", "kind") \
        .mapInArrow(_softmax_tiles(shift, scale), "batch long, pos long, first boolean, label double, top double, sum double, own double")
    # a row's shares, and the rows of a repeated place, come together
    whole = tiles.groupBy("batch", "pos").agg(
        F.max("top").alias("top"), F.collect_list(F.when(F.col("top").isNotNull(), F.struct("top", "sum"))).alias("shares"),
        F.max("own").alias("own"), F.collect_list(F.when(F.col("first"), F.struct("label"))).alias("labels"))
    total = F.aggregate("shares", F.lit(0.0), lambda acc, x: acc + x["sum"] * F.exp(x["top"] - F.col("top")))
    out = whole.select("batch", "pos", (F.exp(F.col("own") - F.col("top")) / total).alias("p_pos"), F.explode("labels").alias("l"))
    return out.select(F.col("batch").cast(types[batch]).alias("batch"), F.col("pos").cast(types[pos]).alias("pos"),
                      (-F.log(F.col("p_pos") + F.lit(LOG_EPS)) * F.col("l.label")).alias("loss"), "p_pos")


def inbatch_metrics(pairs: DataFrame, batch: str = "batch", pos: str = "pos", a_vec: str = "a",
                    b_vec: str = "b") -> DataFrame:
    """NN3: per batch pos_cos (mean diagonal), neg_cos (mean off-diagonal),
    P@1 and MRR of the diagonal in its row (rank ties broken by column index).

    Returns (batch, n, pos_cos, neg_cos, p_at_1, mrr).
    """
    s = _batch_scores(pairs, batch, pos, a_vec, b_vec).withColumn("__r", F.round("s", RANK_DIGITS))
    w = Window.partitionBy("batch", "i")
    s = s.withColumn("__d", F.max(F.when(F.col("i") == F.col("j"), F.col("__r"))).over(w))
    per_row = s.groupBy("batch", "i").agg(
        F.max(F.when(F.col("i") == F.col("j"), F.col("s"))).alias("diag"),
        F.sum(F.when(F.col("i") != F.col("j"), F.col("s"))).alias("off_sum"),
        F.sum(F.when(F.col("i") != F.col("j"), 1).otherwise(0)).alias("off_n"),
        (F.lit(1) + F.sum(F.when((F.col("__r") > F.col("__d")) |
                                 ((F.col("__r") == F.col("__d")) & (F.col("j") < F.col("i"))), 1).otherwise(0)))
        .alias("rank"))
    return per_row.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("diag").alias("pos_cos"),
        F.try_divide(F.sum("off_sum"), F.sum("off_n")).alias("neg_cos"),   # null for a one-row batch
        F.avg(F.when(F.col("rank") == 1, 1.0).otherwise(0.0)).alias("p_at_1"),
        F.avg(F.lit(1.0) / F.col("rank")).alias("mrr"))
