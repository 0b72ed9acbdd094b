"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

Sets: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, distinct ``shingle``-word
shingles (64-bit hashes); a text with fewer words is one shingle; a text without
words has an empty set and is linked with nothing.  Documents are linked when
``100 * intersection >= percent * union`` on the full sets.

Circulant MinHash: one permutation sigma scatters shingles over 32-bit
positions, a second permutation pi, circularly shifted by k, gives signature
coordinate k = min over the set of pi(sigma(x) + k mod 2**32).  Both are
bijections of 32-bit integers; nothing else is drawn.

Plan: equal sets collapse to one representative (smallest doc_id); every band
of every representative is a row; buckets with one member go.  Round 1 compares
each bucket's most central member with all others (linear in the bucket) and
confirms on full sets.  Round 2 compares, in blocks of bounded size, the members
that are still outside their bucket's largest component with the whole bucket:
signatures first, then the full sets of the nodes that have candidates, sent to
the block once each.  So no link of any candidate pair is lost, and no step
makes a row per pair of a group.
With 32 bands of 4 a pair at 0.8 shares a bucket with probability 1 - 5e-8.

Defined cases: null text = empty; rows repeating a doc_id stay separate rows,
each with its own text's component; a row with a null doc_id gets the
component of the documents with its set, else null, and links nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm import words as W
from coclick.llm.components import min_labels
from coclick.llm.store import materialise, shipped

SHINGLE = 4
PERCENT = 80
BANDS = 32
ROWS = 4
#: A pair at the threshold has an estimate below this with probability under 1e-5 (4.2 standard deviations).
LEAST_ESTIMATE = 0.65
BLOCK = 256
NODE_SEED, CHECK_SEED = 0x1234567, 0x89ABCDE
#: Up to so many ids (8 MB) are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _sigma(x: np.ndarray) -> np.ndarray:
    """First permutation: 64-bit shingle hash to a 32-bit position."""
    return (W.mix(x ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def _pi(x: np.ndarray) -> np.ndarray:
    """Second permutation of the 32-bit positions (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant_signatures(shingles: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """(documents, size) uint32 signatures; ``first`` are the n + 1 bounds of non-empty documents."""
    place = _sigma(shingles)
    out = np.empty((len(first) - 1, size), dtype=np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_pi(place + np.uint32(k)), first[:-1])
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, n + 1 bounds) of the documents of one slice."""
    spans = W.word_spans(data, offsets)
    word = W.span_hash(W.lowered(data), spans.start, spans.end)
    windows = W.window_hash(word, shingle)
    sets, bounds = [], [0]
    for lo, hi in zip(spans.first[:-1], spans.first[1:], strict=True):
        if hi - lo >= shingle:
            s = np.sort(windows[lo:hi - shingle + 1])
            keep = np.empty(len(s), dtype=bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            s = s[keep]
        elif hi > lo:
            s = W.window_hash(word[lo:hi], hi - lo)
        else:
            s = word[:0]
        sets.append(s)
        bounds.append(bounds[-1] + len(s))
    return (np.concatenate(sets) if sets else word[:0]), np.array(bounds)


_SKETCH = "doc_id long, n_shingles long, node long, check long, sketch binary"


def _identity(sets: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Order-free 64-bit hash of each set."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(sets + np.uint64(seed)), dtype=np.uint64)])
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def _sketches(shingle: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat(batch.column(1))
            n, a, b, sketch = [], [], [], []
            for lo, hi in W.slices(offsets):
                base = offsets[lo]
                sets, first = shingle_sets(data[base:offsets[hi]], offsets[lo:hi + 1] - base, shingle)
                count = np.diff(first)
                full = np.flatnonzero(count)
                n.append(count)
                a.append(_identity(sets, first, NODE_SEED))
                b.append(_identity(sets, first, CHECK_SEED))
                rows: list[bytes | None] = [None] * (hi - lo)
                if len(full):
                    signature = circulant_signatures(sets, np.append(first[full], first[-1]), size)
                    folded = (signature & np.uint32(0xFFFF)).astype(">u2")
                    for i, row in zip(full, folded, strict=True):
                        rows[i] = row.tobytes()
                sketch += rows
            if n:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(np.concatenate(n), pa.int64()),
                     pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64()),
                     pa.array(sketch, pa.binary())],
                    names=["doc_id", "n_shingles", "node", "check", "sketch"])
    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat(batch.column(0))
            for lo, hi in W.slices(offsets):
                base = offsets[lo]
                sets, first = shingle_sets(data[base:offsets[hi]], offsets[lo:hi + 1] - base, shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_identity(sets, first, NODE_SEED)),
                     pa.array([sets[s:e].tobytes() for s, e in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                    names=["node", "members"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_x"), batch.column("set_y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                inter = int((both[1:] == both[:-1]).sum())
                linked.append(100 * inter >= percent * (len(x) + len(y) - inter))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def _close(least: float):
    """Keeps pairs whose signatures agree in at least ``least`` of their coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                        for c in ("sketch_x", "sketch_y"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))
    return run


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each run of equal ``by``; rows come sorted by it."""
    rest: dict[str, np.ndarray] = {}
    for batch in batches:
        new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        rest = {c: np.concatenate([rest[c], new[c]]) for c in new} if rest else new
        cuts = np.flatnonzero(np.diff(rest[by])) + 1
        for lo, hi in zip([0, *cuts[:-1]], cuts, strict=False):
            yield {c: v[lo:hi] for c, v in rest.items()}
        if len(cuts):
            rest = {c: v[cuts[-1]:] for c, v in rest.items()}
    if rest and len(rest[by]):
        yield rest


def _across(least: float, rows: int):
    """Candidates between one block of stragglers (side 0) and one block of their bucket (side 1).

    A candidate pair joins two components, has close signatures, and is taken in
    the first band only in which these agree.  Out come, for every block, a row
    per straggler with the list of its candidates, and a row per node involved
    (with no list): never a row per pair.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "block"):
            side = group["side"]
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(one) or not len(two):
                continue
            band = int(group["band"][0])
            sketch = np.frombuffer(b"".join(group["sketch"].tolist()), np.uint16).reshape(len(side), -1)
            node, label, straggler, right = group["node"][two], group["label"][two], group["straggler"][two], sketch[two]
            names: list[int] = []
            lists: list[list[int] | None] = []
            involved: set[int] = set()
            for i in one:
                # two stragglers meet from the side of the smaller node
                may = np.flatnonzero((label != group["label"][i]) & (~straggler | (node > group["node"][i])))
                same = right[may] == sketch[i]
                ok = same.mean(axis=1) >= least
                if band:
                    ok &= ~same[:, :band * rows].reshape(len(may), band, rows).all(axis=2).any(axis=1)
                if ok.any():
                    names.append(int(group["node"][i]))
                    lists.append(node[may[ok]].tolist())
                    involved.update(lists[-1], names[-1:])
            names += sorted(involved)
            lists += [None] * len(involved)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), group["block"][0])), pa.array(names, pa.int64()),
                     pa.array(lists, pa.list_(pa.int64()))], names=["block", "node", "near"])
    return run


def _confirm_blocks(percent: int):
    """Links among the candidates of each block, on the full sets that were sent to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "block"):
            sets = {int(n): np.frombuffer(m, np.uint64)
                    for n, m in zip(group["node"], group["members"], strict=True) if m is not None}
            a, b = [], []
            for u, near in zip(group["node"].tolist(), group["near"], strict=True):
                if near is None or u not in sets:
                    continue
                own = sets[u]
                near = [v for v in near.tolist() if v in sets]
                size = np.array([len(sets[v]) for v in near])
                every = np.concatenate([sets[v] for v in near])
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                inter = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(size) - size)
                for v in np.flatnonzero(100 * inter >= percent * (len(own) + size - inter)):
                    a.append(min(u, near[v]))
                    b.append(max(u, near[v]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _picked(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts that stand for ``nodes``."""
    ids = materialise(nodes.join(classes.select("node", "rep"), "node").select(F.col("rep").alias("doc_id")).distinct(),
                      "near-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi").select("text")


def _full_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(node, members): the whole shingle sets of ``nodes``."""
    return materialise(_picked(docs, classes, nodes).mapInArrow(_sets(shingle), "node long, members binary"),
                       "near-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose full shingle sets are similar enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _full_sets(ends, docs, classes, shingle)
    return pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("set_x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("members").alias("set_y")), "b") \
        .select("a", "b", "set_x", "set_y").mapInArrow(_confirm(percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS, least: float = LEAST_ESTIMATE, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs``; see the module's notes."""
    shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = materialise(docs.mapInArrow(_sketches(shingle, bands * rows), _SKETCH), "near-sketches")
    classes = materialise(
        sketched.where("n_shingles > 0 and doc_id is not null").groupBy("node", "check")
        .agg(F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch")), "near-classes")
    sketch = classes.select("node", "sketch")
    # buckets with company
    bands_of = F.expr(f"transform(sequence(0, {bands - 1}), i -> substring(sketch, i * {2 * rows} + 1, {2 * rows}))")
    keyed = classes.select("node", F.posexplode(bands_of).alias("band", "bucket"))
    sizes = keyed.groupBy("band", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    member = materialise(keyed.join(sizes, ["band", "bucket"]), "near-members")
    # round 1: the most central member of each bucket against the others
    central = member.groupBy("node").agg(F.sum(F.col("size") - 1).alias("central"))
    pivots = member.join(central, "node").groupBy("band", "bucket") \
        .agg(F.max(F.struct("central", "node")).alias("top")).select("band", "bucket", F.col("top.node").alias("pivot"))
    star = member.join(pivots, ["band", "bucket"]).where("node <> pivot") \
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    close = materialise(
        star.join(sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_x")), "a")
        .join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_y")), "b")
        .select("a", "b", "sketch_x", "sketch_y").mapInArrow(_close(least), "a long, b long"), "near-close")
    links = materialise(_confirmed(close, docs, classes, shingle, percent), "near-links")
    # round 2: members that their bucket's largest component has not taken in, against the bucket
    labelled = member.where("size > 2").join(min_labels(links), "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    largest = labelled.groupBy("band", "bucket", "label").agg(F.count("*").alias("part")) \
        .groupBy("band", "bucket").agg(F.count("*").alias("parts"), F.max(F.struct("part", "label")).alias("top")) \
        .where("parts > 1").select("band", "bucket", "top")
    spread = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left_over = materialise(
        labelled.join(largest, ["band", "bucket"]).join(sketch, "node")
        .withColumn("straggler", F.col("label") != F.col("top.label"))
        .withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("few", F.ceil((F.col("size") - F.col("top.part")) / block).cast("int"))
        .select("band", "bucket", "node", "label", "sketch", "straggler", "blocks", "few"), "near-left-over")
    columns = ["band", "bucket", "node", "label", "sketch", "straggler"]
    sides = left_over.where("straggler").select(
        *columns, F.lit(0).alias("side"), spread(F.col("few")).alias("x"), every(F.col("blocks")).alias("y")) \
        .unionByName(left_over.select(
            *columns, F.lit(1).alias("side"), every(F.col("few")).alias("x"), spread(F.col("blocks")).alias("y")))
    sides = sides.withColumn("block", F.xxhash64("band", "bucket", "x", "y"))
    across = materialise(
        sides.repartition("block").sortWithinPartitions("block")
        .select("block", "band", "side", "node", "label", "straggler", "sketch")
        .mapInArrow(_across(least, rows), "block long, node long, near array<long>"), "near-across")
    involved = across.where("near is null").select("block", "node")
    sets = _full_sets(involved.select("node").distinct(), docs, classes, shingle)
    sent = involved.join(sets, "node").select("block", "node", F.lit(None).cast("array<long>").alias("near"), "members") \
        .unionByName(across.where("near is not null").withColumn("members", F.lit(None).cast("binary")))
    more = materialise(sent.repartition("block").sortWithinPartitions("block")
                       .mapInArrow(_confirm_blocks(percent), "a long, b long"), "near-links")
    labels = min_labels(links.unionByName(more))
    # every document gets the smallest id of its class's component
    labelled = materialise(classes.join(labels, "node", "left")
                           .select("node", "check", "rep", F.coalesce("label", "node").alias("label")), "near-labels")
    smallest = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = labelled.join(smallest, "label").select("node", "check", "component_id")
    return sketched.select("doc_id", "n_shingles", "node", "check").join(of_class, ["node", "check"], "left") \
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id"))
                .otherwise(F.col("doc_id")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
