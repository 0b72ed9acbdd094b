"""Packing token spans into windows: best-fit decreasing over a segment tree.

Documents are tokenized once and cut: full windows first, then the rest, so
every piece fits a window.  Pieces (numbers only, no ids) are dealt by hash into
groups of bounded size; in a group, pieces go longest first into the open
window with the tightest sufficient room, found in a segment tree indexed by
remaining capacity.  Each group wastes at most the room of its last windows;
global sequence ids are the group's base (a prefix sum over groups) plus the
local number.

Defined cases: null or empty text = the end id alone; repeated rows are packed
each; null doc_id rows are packed like others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.llm.store import materialise, shipped
from coclick.llm.tokens import END_ID, encoder, tokenizer_path

WINDOW = 2048
PIECES_PER_GROUP = 20_000
CHARS_AT_ONCE = 2_000_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class CapacityTree:
    """Number of open windows per remaining capacity; finds the least capacity that suffices."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, window: int, capacity: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, capacity) of the tightest open window with room for ``need``; it is taken out."""
        i = need + self.size
        if not self.count[i]:
            # up to the first ancestor whose right sibling holds a window, then down its leftmost path
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        self._add(capacity, -1)
        return self.open[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) for each length (1 to ``window``); gapless from 0."""
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, windows = CapacityTree(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found = (windows, window)
            windows += 1
        w, capacity = found
        number[i], offset[i] = w, window - capacity
        if capacity > need:
            tree.put(w, capacity - need)
    return number, offset


def _cut(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            i = 0
            while i < len(names):
                j, size = i, 0
                while j < len(names) and size < CHARS_AT_ONCE:
                    size += len(texts[j] or "")
                    j += 1
                out: list[tuple] = []
                for name, raw in zip(names[i:j], encode.encode(texts[i:j]), strict=True):
                    raw += end
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        part = raw[4 * start:4 * (start + window)]
                        out.append((name, start, len(part) // 4, zlib.crc32(part), n))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                i = j
    return run


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids in pieces of at most ``window``."""
    shipped(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_cut(tokenizer or tokenizer_path(), window, end_id), _PIECES)


def pack(cut: DataFrame, window: int = WINDOW, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """``cut`` plus (sequence_id, offset); ``length`` is 1 to ``window``."""
    shipped(cut.sparkSession)
    cut = materialise(cut, "pieces")
    groups = max(1, math.ceil(cut.count() / per_group))
    schema = T.StructType([*cut.schema.fields, T.StructField("group", T.IntegerType()),
                           T.StructField("number", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        # an order of its own, so that a retried task numbers alike
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True],
                                kind="stable")
        number, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        return rows.assign(number=number, offset=offset)

    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int"))
    packed = materialise(dealt.groupBy("group").applyInPandas(fill, schema), "packed")
    # one row per group: the running total is a small window
    sizes = packed.groupBy("group").agg((F.max("number") + 1).alias("windows"))
    before = F.sum("windows").over(Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("group", F.coalesce(before, F.lit(0)).cast("long").alias("base"))
    return packed.join(F.broadcast(bases), "group") \
        .select(*cut.columns, (F.col("base") + F.col("number")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID,
                   per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece."""
    return pack(pieces(docs, window, tokenizer, end_id), window, per_group)
