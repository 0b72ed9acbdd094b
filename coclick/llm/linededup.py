"""Incremental, reversible line dedup: sharded cuckoo filters over exact reference counts.

The index is a list of parts, one per insertion, and a part is three tables in
shared storage:

* ``holders``  (k1, k2, doc_id): which documents hold which line key (128-bit hash);
* ``counts``   (shard, k1, k2, n_docs, last_doc): exact reference count of each
  key in the part and the largest document id holding it;
* ``filters``  (shard, slots): one cuckoo filter per shard over the keys with a
  count above zero; a part has as many shards as its keys need.

An insertion writes a part of its own and touches no other.  When counts are
asked for, the keys of a part are held against the filters of the other parts:
a key that none of them knows is settled by its own part's count, and only the
others (and the filters' few false positives) go through the join of the exact
tables.  A deletion lowers the counts of the parts that hold the document; keys
that reach zero leave counts and filter, so deleting what was inserted gives the
index back.  Keys of any frequency are one row per part after aggregation, and
a hot line's holders meet its count in as many pieces as its count asks for.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lowered; keys
shorter than ``least_chars`` code points are not indexed.

Defined cases: null or empty text = one empty line; rows repeating an id are one
document for counting, each row keeps or loses lines by that id; rows with a null
id count as no document and keep all lines; a second insertion of a document
changes nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm.store import materialise, shipped
from coclick.llm.words import mix
from coclick.operators.skew import heavy_from_sizes, split_join

LEAST_CHARS = 40
LEAST_DOCS = 5
KEYS_PER_SHARD = 125_000
#: Insertions that :func:`dedup_lines` makes.
INSERTIONS = 2
#: Parts beyond which an insertion merges them into one.
MOST_PARTS = 8
#: Holders of one line that meet its count in one task.
HOLDERS_PER_PIECE = 50_000
_STRIP = " \t\n\x0b\x0c\r"

_COUNTS = "shard int, k1 long, k2 long, n_docs long, last_doc long, slots binary"


def line_key(line: str, least_chars: int = LEAST_CHARS) -> bytes | None:
    """128-bit key of a line, None for short ones."""
    line = line.strip(_STRIP)
    if len(line) < least_chars:
        return None
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


class CuckooFilter:
    """16-bit fingerprints, 4 slots a bucket; never a false negative for what is in it."""

    SLOTS, KICKS, LOAD = 4, 500, 0.85

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets
        self.slots = np.zeros((buckets, self.SLOTS), np.uint16) if slots is None else slots

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        return cls(1 << max(1, math.ceil(math.log2(max(1, n) / cls.SLOTS / cls.LOAD))))

    @classmethod
    def loads(cls, raw: bytes) -> CuckooFilter:
        slots = np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy()
        return cls(len(slots), slots)

    def dumps(self) -> bytes:
        return self.slots.tobytes()

    def _other(self, bucket, mark):
        return bucket ^ (mix(np.asarray(mark, np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(keys.astype(np.uint64) + np.uint64(0xA0761D6478BD642F))
        mark = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (h & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, one, self._other(one, mark)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(keys)
        return (self.slots[one] == mark[:, None]).any(axis=1) | (self.slots[two] == mark[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Adds the keys; False if the filter is too full (then it must be rebuilt larger)."""
        mark, one, two = self._places(keys)
        left = np.arange(len(keys))
        for bucket in (one, two):
            for slot in range(self.SLOTS):
                free = left[self.slots[bucket[left], slot] == 0]
                _, pick = np.unique(bucket[free], return_index=True)
                put = free[pick]
                self.slots[bucket[put], slot] = mark[put]
                left = np.setdiff1d(left, put, assume_unique=True)
        random = np.random.Generator(np.random.PCG64(len(keys)))
        for i in left.tolist():
            m, b = int(mark[i]), int(two[i])
            for _ in range(self.KICKS):
                free = np.flatnonzero(self.slots[b] == 0)
                if len(free):
                    self.slots[b, free[0]] = m
                    break
                s = int(random.integers(self.SLOTS))
                m, self.slots[b, s] = int(self.slots[b, s]), m
                b = int(self._other(np.array([b]), np.array([m]))[0])
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Removes keys that are in the filter."""
        mark, one, two = self._places(keys)
        for m, *both in zip(mark.tolist(), one.tolist(), two.tolist(), strict=True):
            for b in both:
                at = np.flatnonzero(self.slots[b] == m)
                if len(at):
                    self.slots[b, at[0]] = 0
                    break


@dataclass
class LinePart:
    """Tables of one insertion; ``shards`` stays as it was at creation."""

    holders: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


@dataclass
class LineIndex:
    parts: list[LinePart]

    @property
    def holders(self) -> DataFrame:
        return reduce(DataFrame.unionByName, (p.holders for p in self.parts))

    @property
    def counts(self) -> DataFrame:
        """(k1, k2, n_docs, last_doc): exact counts over all parts."""
        if len(self.parts) == 1:
            return self.parts[0].counts.drop("shard")
        alone, shared = [], []
        for i, part in enumerate(self.parts):
            rows = part.counts.select("k1", "k2", "n_docs", "last_doc").withColumn("maybe", F.lit(False))
            for other in self.parts[:i] + self.parts[i + 1:]:
                rows = _probed(rows, other)
            rows = materialise(rows, "line-probed")
            alone.append(rows.where(~F.col("maybe")).drop("maybe"))
            shared.append(rows.where("maybe").drop("maybe"))
        met = reduce(DataFrame.unionByName, shared).groupBy("k1", "k2").agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        return reduce(DataFrame.unionByName, [*alone, met])


def _probe(key, filters: pa.Table, keys: pa.Table) -> pa.Table:
    """Keys of one shard, marked if the shard's filter may know them."""
    maybe = keys.column("maybe").to_numpy().copy()
    raw = filters.column("slots").to_pylist()
    if raw and len(maybe):
        maybe |= CuckooFilter.loads(raw[0]).contains(keys.column("k1").to_numpy())
    return keys.select(["k1", "k2", "n_docs", "last_doc"]).append_column("maybe", pa.array(maybe, pa.bool_()))


def _probed(rows: DataFrame, part: LinePart) -> DataFrame:
    keyed = rows.withColumn("shard", F.pmod("k2", F.lit(part.shards)).cast("int"))
    return part.filters.groupBy("shard").cogroup(keyed.groupBy("shard")) \
        .applyInArrow(_probe, "k1 long, k2 long, n_docs long, last_doc long, maybe boolean")


def _holders(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {line_key(line, least_chars) for line in (text or "").split("\n")} - {None}
                keys.extend(own)
                names.extend([name] * len(own))
            k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1])),
                 pa.array(names, pa.int64())], names=["k1", "k2", "doc_id"])
    return run


def line_holders(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(k1, k2, doc_id): the distinct line keys of each document."""
    shipped(docs.sparkSession)
    return docs.where("doc_id is not null") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_holders(least_chars), "k1 long, k2 long, doc_id long")


def _merge(key, state: pa.Table, change: pa.Table) -> pa.Table:
    """One shard: counts and filter after adding ``change`` (signed counts, one row per key)."""
    shard = int(key[0].as_py())
    raw = [x for x in state.column("slots").to_pylist() if x is not None]
    old = state.filter(pc.is_valid(state.column("k1")))
    cols = ["k1", "k2", "n_docs", "last_doc"]
    k1, k2, n, last = (old.column(c).to_numpy().copy() for c in cols)
    d1, d2, dn, dlast = (change.column(c).to_numpy() for c in cols)
    known = CuckooFilter.loads(raw[0]) if raw else CuckooFilter.for_keys(len(d1))
    maybe = known.contains(d1) if raw else np.zeros(len(d1), bool)
    # exact look-up of the keys that the filter knows
    at = np.full(len(d1), -1, dtype=np.int64)
    if maybe.any():
        place = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(k1, k2, strict=True))}
        at[maybe] = [place.get((int(a), int(b)), -1) for a, b in zip(d1[maybe], d2[maybe], strict=True)]
    hit = at >= 0
    n[at[hit]] += dn[hit]
    last[at[hit]] = np.where(dn[hit] > 0, np.maximum(last[at[hit]], dlast[hit]), dlast[hit])
    new = ~hit & (dn > 0)
    gone = n <= 0
    if gone.any():
        known.delete(k1[gone])
    k1, k2, n, last = (np.concatenate([x[~gone], y[new]]) for x, y in ((k1, d1), (k2, d2), (n, dn), (last, dlast)))
    if not known.insert(d1[new]):
        size = 2 * len(k1)
        while not (known := CuckooFilter.for_keys(size)).insert(k1):
            size *= 2
    rows = len(k1)
    return pa.table({"shard": pa.array(np.full(rows + 1, shard, np.int32)),
                     **{c: pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(1, pa.int64())])
                        for c, x in zip(cols, (k1, k2, n, last), strict=True)},
                     "slots": pa.concat_arrays([pa.nulls(rows, pa.binary()), pa.array([known.dumps()], pa.binary())])})


def _applied(part: LinePart | None, change: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """Counts and filters of a part (``None``: a new one) after a change."""
    change = change.withColumn("shard", F.pmod("k2", F.lit(shards)).cast("int"))
    if part is None:
        state = change.sparkSession.createDataFrame([], _COUNTS)
    else:
        state = part.counts.withColumn("slots", F.lit(None).cast("binary")).unionByName(
            part.filters, allowMissingColumns=True)
    merged = materialise(state.select("shard", "k1", "k2", "n_docs", "last_doc", "slots").groupBy("shard")
                         .cogroup(change.groupBy("shard")).applyInArrow(_merge, _COUNTS), "line-index")
    return merged.where("k1 is not null").drop("slots"), merged.where("k1 is null").select("shard", "slots")


def _part(holders: DataFrame, keys_per_shard: int) -> LinePart:
    holders = materialise(holders, "line-holders")
    change = materialise(holders.groupBy("k1", "k2").agg(
        F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")), "line-change")
    shards = max(1, math.ceil(change.count() / keys_per_shard))
    return LinePart(holders, *_applied(None, change, shards), shards)


def insert(index: LineIndex | None, docs: DataFrame, least_chars: int = LEAST_CHARS,
           keys_per_shard: int = KEYS_PER_SHARD, new_ids: bool = False) -> LineIndex:
    """The index with the lines of ``docs`` added (``None``: a new index).

    With ``new_ids`` no document of ``docs`` is in the index already; otherwise what it holds is looked up.
    """
    holders = line_holders(docs, least_chars)
    if index is None:
        return LineIndex([_part(holders, keys_per_shard)])
    if not new_ids:
        holders = holders.join(index.holders, ["k1", "k2", "doc_id"], "left_anti")
    if len(index.parts) >= MOST_PARTS:
        index = LineIndex([_part(index.holders, keys_per_shard)])
    return LineIndex([*index.parts, _part(holders, keys_per_shard)])


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents of ``doc_ids(doc_id)``."""
    shipped(doc_ids.sparkSession)
    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return LineIndex([_without(part, ids) for part in index.parts])


def _without(part: LinePart, ids: DataFrame) -> LinePart:
    gone = part.holders.join(ids, "doc_id", "left_semi").distinct()
    stay = materialise(part.holders.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id"), "line-holders")
    lost = materialise(gone.groupBy("k1", "k2").agg((-F.count("*")).alias("n_docs")), "line-change")
    # the largest holder of a touched key, from the exact table
    last = stay.join(lost.select("k1", "k2"), ["k1", "k2"], "left_semi") \
        .groupBy("k1", "k2").agg(F.max("doc_id").alias("last_doc"))
    change = lost.join(last, ["k1", "k2"], "left").select("k1", "k2", "n_docs", F.coalesce("last_doc", F.lit(0).cast("long"))
                                                          .alias("last_doc"))
    return LinePart(stay, *_applied(part, change, part.shards), part.shards)


def losing(index: LineIndex, least_docs: int = LEAST_DOCS, holders_per_piece: int = HOLDERS_PER_PIECE) -> DataFrame:
    """(doc_id, keys): for each document the keys whose lines it loses (16-byte strings)."""
    repeated = materialise(index.counts.where(F.col("n_docs") >= least_docs), "line-repeated")
    held = split_join(index.holders, repeated.select("k1", "k2", "last_doc"), ["k1", "k2"], split_right=False,
                      heavy_left=heavy_from_sizes(repeated, ["k1", "k2"], "n_docs", holders_per_piece))
    return held.where("doc_id <> last_doc") \
        .groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))


def _strip_lines(least_chars: int, extra: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("__keys"))
            text = batch.column(batch.schema.get_field_index("text"))
            kept, total, dropped = [], [], []
            for t, own in zip(text.to_pylist(), keys.to_pylist(), strict=True):
                lines = (t or "").split("\n")
                if own:
                    lose = {np.array([k["k1"], k["k2"]], "<i8").tobytes() for k in own}
                    stay = [x for x in lines if line_key(x, least_chars) not in lose]
                    kept.append("\n".join(stay))
                else:
                    stay = lines
                    kept.append(t)
                total.append(len(lines))
                dropped.append(len(lines) - len(stay))
            arrays = {c: batch.column(i) for i, c in enumerate(batch.schema.names) if c not in ("text", "__keys")}
            arrays |= {"text": pa.array(kept, pa.string())}
            if extra:
                arrays |= {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))
    return run


def drop_lines(docs: DataFrame, index: LineIndex, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS,
               counted: bool = True) -> DataFrame:
    """``docs`` without the lines that it loses by the index; with ``n_lines`` and ``n_dropped`` if ``counted``."""
    shipped(docs.sparkSession)
    if counted:
        docs = docs.drop("n_lines", "n_dropped")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    lose = losing(index, least_docs).select(F.col("doc_id").alias("__doc"), F.col("keys").alias("__keys"))
    joined = docs.join(lose, F.col("doc_id").cast("long") == F.col("__doc"), "left").drop("__doc")
    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = type(docs.schema)([*fields, docs.schema["text"]])
    if counted:
        schema = schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(_strip_lines(least_chars, counted), schema) \
        .select(*docs.columns, *(["n_lines", "n_dropped"] if counted else []))


def dedup_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS,
                counted: bool = True, insertions: int = INSERTIONS) -> DataFrame:
    """Indexes ``docs`` in several insertions and drops repeated lines everywhere but in the largest id that holds them."""
    index = None
    for i in range(insertions):
        share = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(insertions)) == i)
        index = insert(index, share, least_chars, new_ids=True)
    return drop_lines(docs, index, least_docs, least_chars, counted)
