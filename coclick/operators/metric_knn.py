"""Exact nearest neighbours with metric pruning (VEC2).

Vectors are grouped by their nearest pivot (a hashed sample of bounded size) and
cut, in the order of their distance to it, into blocks: a block is a shell around
its pivot.  The corpus is placed once; only queries travel.  A query first meets the
shell that it would itself lie in, which gives an upper bound on its k-th distance.
By the triangle inequality no vector of a shell [lo, hi] around pivot p can be closer
than ``max(d(q, p) - hi, lo - d(q, p))``, so a query is sent only to the shells
where that is within its bound.  Consecutive shells of a pivot make a ring: a query travels once to
a ring that its bound reaches, with its distance to the pivot, however many shells it meets
there.  A ring's task holds its vectors in the order of their distance to the pivot and reads a share
of the queries in that order too, so a few hundred of them meet one stretch of the ring at once: products
in single precision say which pairs are compared in double (the tiles of exact search).

Squared euclidean distance and cosine distance (euclidean on unit vectors); rows are
those of :func:`coclick.operators.vectors.knn_exact`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.functions.hashing import uniform_hash
from coclick.operators.neighbour_graph import _distance, _matrix, _packed, _pivot_arrays, _unit
from coclick.operators.positions import numbered
from coclick.operators.topk import RANK_DIGITS, top_k_by_key
from coclick.operators.vectors import _Nearest
from coclick.session import ship_package, stored

PIVOTS = 256
BLOCK = 2048
#: Queries that a task compares at a time.
QUERIES_AT_ONCE = 1024
#: Vectors of a ring, at most (one shell at least), and queries of a share, on average; smaller shares as long as there are few.
RING, SHARE, LEAST_SHARE, SHARES = 65_536, 65_536, 8192, 4
#: Bounds give way by this much, for the rounding of distances.
SLACK = 1e-6
SPACES = ("cosine", "l2")


@dataclass
class Shells:
    """``vectors(shell, id, vec, ring, d)`` and ``shells(pivot, shell, ring, lo, hi, size)`` of a corpus."""

    vectors: DataFrame
    shells: DataFrame
    pivots: DataFrame
    space: str


def _to_pivots(pivots: np.ndarray, ids: np.ndarray, space: str, every: bool):
    """(id, vec) to its nearest pivot, or with ``every`` to all of them: (id, vec, pivot, d, nearest)."""
    pivots = _unit(pivots, space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                n = part.num_rows
                x = _unit(_matrix(part.column(1), n), space)
                d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * (x @ pivots.T), 0.0))
                best = np.argmin(d, axis=1)
                if every:
                    rows, of = np.repeat(np.arange(n), len(ids)), np.tile(np.arange(len(ids)), n)
                    vec = pa.nulls(len(rows), pa.binary())
                else:
                    rows, of, vec = np.arange(n), best, part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), vec, pa.array(ids[of]), pa.array(d[rows, of]),
                     pa.array(best[rows] == of)], names=["id", "vec", "pivot", "d", "nearest"])
    return run


_PLACED = "id long, vec binary, pivot long, d double, nearest boolean"


def _vectors(df: DataFrame, name: str) -> DataFrame:
    return stored(df.where("id is not null and vec is not null").select(F.col("id").cast("long").alias("id"),
                                                                         _packed().alias("vec")), name)


def build_shells(corpus: DataFrame, space: str = "cosine", pivots: int = PIVOTS, block: int = BLOCK,
                 seed: str = "coclick") -> Shells:
    """The corpus (id, vec) in shells of at most ``block`` vectors."""
    if space not in SPACES:
        raise ValueError(f"space must be one of {SPACES}")
    ship_package(corpus.sparkSession)
    packed = _vectors(corpus, "shell-vectors")
    chosen = stored(packed.select(F.col("id").alias("node"), "vec").orderBy(uniform_hash(F.lit(seed), F.col("node")), "node")
                    .limit(pivots), "shell-pivots")
    if chosen.isEmpty():
        empty = packed.select(F.lit("").alias("shell"), "id", "vec", F.lit("").alias("ring"), F.lit(0.0).alias("d")).limit(0)
        return Shells(empty, empty.selectExpr("id AS pivot", "shell", "ring", "0D AS lo", "0D AS hi", "0L AS size"), chosen, space)
    placed = stored(packed.mapInArrow(_to_pivots(*_pivot_arrays(chosen), space, False), _PLACED), "shell-placed")
    # a pivot with very many vectors is numbered by many tasks
    ranked = numbered(placed.drop("nearest"), ["pivot"], ["d", "id", "vec"])
    shell = F.concat_ws("-", "pivot", F.floor((F.col("pos") - 1) / block).cast("long"))
    ring = F.concat_ws("-", "pivot", F.floor((F.col("pos") - 1) / (max(1, RING // block) * block)).cast("long"))
    ranked = stored(ranked.select("pivot", shell.alias("shell"), ring.alias("ring"), "id", "vec", "d"), "shells")
    shells = stored(ranked.groupBy("pivot", "shell", "ring").agg(F.min("d").alias("lo"), F.max("d").alias("hi"),
                                                         F.count("*").alias("size")), "shell-bounds")
    return Shells(ranked.select("shell", "id", "vec", "ring", "d"), shells, chosen, space)


def _compared(space: str, k: int):
    """Rows sorted by (shell, kind): a shell's vectors (0), then its queries (1), to each query's k nearest there."""
    def near(shell: list[pa.RecordBatch], ids: np.ndarray, x: np.ndarray, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a in range(0, queries.num_rows, QUERIES_AT_ONCE):
            part = queries.slice(a, QUERIES_AT_ONCE)
            q = _unit(_matrix(part.column("vec"), part.num_rows), space)
            d = _distance(q, x, space)
            kk = min(k, len(ids))
            rounded = np.round(d, RANK_DIGITS)
            if kk < len(ids):
                cut = np.partition(rounded, kk - 1, axis=1)[:, kk - 1]
                row, col = np.nonzero(rounded <= cut[:, None])
            else:
                row, col = np.divmod(np.arange(d.size), len(ids))
            by = np.lexsort((ids[col], rounded[row, col], row))
            row, col = row[by], col[by]
            first = np.searchsorted(row, row)
            keep = np.arange(len(row)) - first < kk
            row, col = row[keep], col[keep]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), pa.array(ids[col]), pa.array(d[row, col])],
                                             names=["qid", "cid", "dist"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shell, held, ids, x = None, [], None, None
        for batch in batches:
            names, kinds = batch.column("shell"), batch.column("kind").to_numpy()
            name = names.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((name[1:] != name[:-1]) | (np.diff(kinds) != 0)) + 1).tolist(), len(name)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if name[a] != shell:
                    shell, held, x = name[a], [], None
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if x is None:
                    if not held:
                        continue
                    rows = pa.Table.from_batches(held).combine_chunks()
                    ids = rows.column("id").to_numpy()
                    x = _unit(_matrix(rows.column("vec").chunk(0), len(ids)), space)
                yield from near(held, ids, x, part)
    return run


def _in_shells(shells: Shells, sent: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qid, cid, dist): the k nearest of every query in every shell that it is sent to; ``sent(qid, shell)``."""
    asked = sent.join(queries.select(F.col("id").alias("qid"), "vec"), "qid") \
        .select("shell", F.lit(1).alias("kind"), F.col("qid").alias("id"), "vec")
    met = shells.vectors.join(sent.select("shell").distinct(), "shell", "left_semi").select("shell", F.lit(0).alias("kind"), "id", "vec")
    return met.unionByName(asked).repartition("shell").sortWithinPartitions("shell", "kind", "id") \
        .mapInArrow(_compared(shells.space, k), "qid long, cid long, dist double")


def _held(batches: Iterator[pa.RecordBatch], close, meet) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tile, kind): ``close`` what a tile holds (0), then ``meet`` it with the rows that pass by (1)."""
    tile, held, closed = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        name, kinds = batch.column("tile").to_numpy(zero_copy_only=False), batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero((name[1:] != name[:-1]) | (np.diff(kinds) != 0)) + 1).tolist(), len(name)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if name[a] != tile:
                tile, held, closed = name[a], [], None
            part = batch.slice(a, b - a)
            if kinds[a] == 0:
                held.append(part)
                continue
            if closed is None:
                if not held:
                    continue
                closed, held = close(pa.Table.from_batches(held).combine_chunks()), []
            yield from meet(closed, part)


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pivot's shells, sorted by their bounds, and its queries by distance, to the shell that each lies in or next to."""
    def close(rows: pa.Table) -> tuple:
        return rows.column("lo").to_numpy(), rows.column("hi").to_numpy(), rows.column("shell").combine_chunks()

    def meet(shells: tuple, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lo, hi, names = shells
        d = queries.column("lo").to_numpy()
        below = np.clip(np.searchsorted(lo, d, "right") - 1, 0, len(lo) - 1)
        above = np.minimum(below + 1, len(lo) - 1)
        at = np.where(lo[above] - d < d - hi[below], above, below)
        off = np.maximum(np.maximum(lo[at] - d, d - hi[at]), 0.0)
        yield pa.RecordBatch.from_arrays([queries.column("qid"), names.take(pa.array(at)), pa.array(off)], names=["qid", "shell", "off"])

    yield from _held(batches, close, meet)


def _compared_rings(space: str, k: int):
    """A ring's vectors, sorted by distance to the pivot, and queries in that order, to each query's k nearest within its bound.

    A query's home shell, which it has met, is left out of what is found.
    """
    def close(rows: pa.Table) -> tuple:
        x = _matrix(rows.column("vec").chunk(0), rows.num_rows)
        far = float((x * x).sum(1).max()) if space == "l2" else 1.0
        # vectors go by their place in the order of ids: copies of one may lie in two shells
        ids = rows.column("id").to_numpy()
        by = np.argsort(ids, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        names, shell = np.unique(rows.column("shell").to_numpy().astype(str), return_inverse=True)
        return place, ids[by], names, shell[by], rows.column("d").to_numpy(), _Nearest.corpus(x, space), far

    def meet(ring: tuple, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        place, ids, names, shell, d, corpus, far = ring
        for a in range(0, queries.num_rows, QUERIES_AT_ONCE):
            part = queries.slice(a, QUERIES_AT_ONCE)
            q = _matrix(part.column("vec"), part.num_rows)
            at, bound, worst = (part.column(c).to_numpy() for c in ("d", "bound", "worst"))
            home = part.column("shell").to_numpy(zero_copy_only=False).astype(str)
            code = np.minimum(np.searchsorted(names, home), len(names) - 1)
            code = np.where(names[code] == home, code, -1)
            near = _Nearest(np.arange(len(q)), q, k, space)
            # the bound's own vectors stay within it, however their distance is rounded
            size = (q * q).sum(1) + far if space == "l2" else np.full(len(q), 2.0)
            near.within(worst + 2.0 * 10.0 ** -RANK_DIGITS + 64.0 * np.finfo(float).eps * size)
            near.reach(place, corpus, np.searchsorted(d, at - bound, "left"), np.searchsorted(d, at + bound, "right"))
            for found in near.found():
                row, of, dist = (c.to_numpy() for c in found.columns)
                other = shell[of] != code[row]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row[other])), pa.array(ids[of[other]]), pa.array(dist[other])],
                                                 names=["qid", "cid", "dist"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _held(batches, close, meet)
    return run


def _in_rings(shells: Shells, ranges: DataFrame, home: DataFrame, queries: DataFrame, k: int, shares: int) -> DataFrame:
    """(qid, cid, dist): the k nearest of every query in the rings in reach; ``ranges(qid, pivot, d, bound, worst)``."""
    rings = shells.shells.groupBy("pivot", "ring").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    tile = lambda share: F.concat_ws("/", "ring", share)
    asked = ranges.join(rings, "pivot").where((F.col("d") - F.col("bound") <= F.col("hi")) & (F.col("lo") <= F.col("d") + F.col("bound"))) \
        .join(home, "qid").join(queries.select(F.col("id").alias("qid"), "vec"), "qid") \
        .select(tile(F.pmod(F.xxhash64("qid"), F.lit(shares))).alias("tile"), F.lit(1).alias("kind"), F.col("qid").alias("id"), "shell", "vec",
                "d", "bound", "worst")
    held = shells.vectors.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))) \
        .select(tile("__share").alias("tile"), F.lit(0).alias("kind"), "id", "shell", "vec", "d", F.lit(0.0).alias("bound"), F.lit(0.0).alias("worst"))
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.unionByName(asked).repartition(parts, "tile").sortWithinPartitions("tile", "kind", "d", "id") \
        .mapInArrow(_compared_rings(shells.space, k), "qid long, cid long, dist double")


def search_shells(shells: Shells, queries: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """((qid, rank, cid, dist) of the k nearest, (qid, shell) of all shells that the queries' bounds reach)."""
    spark = queries.sparkSession
    ship_package(spark)
    asked = _vectors(queries, "shell-queries").distinct()
    if shells.pivots.isEmpty():
        return (spark.createDataFrame([], "qid long, rank long, cid long, dist double"),
                spark.createDataFrame([], "qid long, shell string"))
    far = stored(asked.mapInArrow(_to_pivots(*_pivot_arrays(shells.pivots), shells.space, True), _PLACED)
                 .select(F.col("id").alias("qid"), "pivot", "d", "nearest"), "shell-distances")
    n = asked.count()
    shares = max(-(-n // SHARE), min(SHARES, -(-n // LEAST_SHARE)), 1)
    # the shell around the nearest pivot that the query would lie in, or the one closest to that
    tile = lambda share: F.concat_ws("/", "pivot", share)
    own = far.where("nearest").select(tile(F.pmod(F.xxhash64("qid"), F.lit(shares))).alias("tile"), F.lit(1).alias("kind"), "qid",
                                      F.lit(None).cast("string").alias("shell"), F.col("d").alias("lo"), F.lit(0.0).alias("hi"))
    bounds = shells.shells.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))) \
        .select(tile("__share").alias("tile"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("qid"), "shell", "lo", "hi")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    home = bounds.unionByName(own).repartition(parts, "tile").sortWithinPartitions("tile", "kind", "lo", "hi", "shell") \
        .mapInArrow(_homes, "qid long, shell string, off double")
    home = stored(top_k_by_key(home, ["qid"], ["off", "shell"], 1).select("qid", "shell"), "shell-homes")
    first = stored(_in_shells(shells, home, asked, k), "shell-first")
    reach = first.groupBy("qid").agg(F.max("dist").alias("worst"), F.count("*").alias("have"))
    # both distances are squares of the metric, up to a factor of two
    worst = F.sqrt(F.greatest(F.col("worst"), F.lit(0.0)) * (2.0 if shells.space == "cosine" else 1.0))
    bound = F.when(F.col("have") >= k, worst * (1 + SLACK) + SLACK).otherwise(F.lit(float("inf")))
    most = F.when(F.col("have") >= k, F.col("worst")).otherwise(F.lit(float("inf")))
    ranges = far.join(reach.select("qid", bound.alias("bound"), most.alias("worst")), "qid")
    # the shells that are met; not made for the search itself
    sent = ranges.join(shells.shells, "pivot") \
        .where((F.col("d") - F.col("bound") <= F.col("hi")) & (F.col("lo") <= F.col("d") + F.col("bound"))) \
        .select("qid", "shell").join(home, ["qid", "shell"], "left_anti")
    found = first.unionByName(_in_rings(shells, ranges, home, asked, k, shares))
    ranked = top_k_by_key(found, ["qid"], [F.round("dist", RANK_DIGITS), "cid"], k).select("qid", "rank", "cid", "dist")
    return ranked, home.unionByName(sent)


def knn_pruned(queries: DataFrame, corpus: DataFrame, k: int = 10, space: str = "cosine", pivots: int = PIVOTS,
               block: int = BLOCK, seed: str = "coclick") -> DataFrame:
    """VEC2: (qid, rank, cid, dist), exact."""
    return search_shells(build_shells(corpus, space, pivots, block, seed), queries, k)[0]


def skipped_share(shells: Shells, queries: DataFrame, sent: DataFrame) -> float:
    """Share of all (query, shell) pairs that were not compared."""
    every = queries.where("id is not null and vec is not null").select("id").distinct().count() * shells.shells.count()
    return 1.0 - sent.count() / every if every else 0.0
