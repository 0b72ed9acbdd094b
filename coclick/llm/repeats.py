"""Repeated byte windows by a depth-limited radix sort of all suffixes.

Every byte position opens a suffix; only its first ``LENGTH`` bytes (a window)
order it.  Most-significant-digit passes sort the windows of all documents;
windows alone in their group leave after each pass, and a group of equal windows
is a repeat.  Documents never run into each other.

* **Digit 1** of a window is its minimizer: the smallest hash of the ``GRAM``-byte
  strings inside (leftmost of equals), which equal windows share.  Windows that
  follow each other mostly share the place of their minimizer, so such a run
  travels as one row: ``core`` is the minimizer, which every window of the run
  holds, ``whole`` the bytes that the run covers.  After the sort, neighbours with
  equal ``whole`` settle the run (all its windows are repeated), runs that share
  ``core`` with no neighbour are alone, the others go on.
* **Digit 2** cuts those runs at ``STEP`` places counted from the minimizer, again
  with a ``core`` (the bytes that all windows of a cut hold) and a ``whole``.
* **Digit 3** is the window itself.

A pass is one range-partitioned sort (:func:`coclick.operators.positions.running`)
and a look at the neighbours, so a passage in a third of all documents is spread
over tasks like any other; no group is collected.  Texts are shuffled twice:
documents with undecided runs to cut these out, and all to meet their spans.

Defined cases: null text = empty; rows repeating a doc_id are documents of their
own (rows with equal id and text repeat each other); null ids are documents; texts
shorter than a window lose nothing; an empty table gives an empty result; texts of
any length are read in pieces; columns named like the added ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.llm import words as W
from coclick.llm.store import materialise, shipped
from coclick.operators.positions import running

LENGTH = 200
GRAM = 48
STEP = 16
#: Window starts of one text that are worked on at a time (positions are kept in 24 bits).
PIECE = 1 << 20
#: Up to so many documents' ids (24 MB) are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
ADDED = ("kept", "n_bytes", "n_removed", "n_spans")

_RUN = "core long, whole long, id long, row int, lo int, span short, left short"
_SLICE = "id long, row int, lo int, span short, left short, bytes binary"
_CUT = "core long, whole long, id long, row int, lo int, cut short, start int, till int"
_WINDOW = "core long, whole long, id long, row int, start int"


class _Hashes:
    """Hashes of byte spans of one array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(W._BYTE[data] * W._power(W._BASE, n), out=self.total[1:])
        self.back = W._power(W._INVERSE, n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.back[start]

    def __call__(self, start: np.ndarray, end: np.ndarray, *marks: np.ndarray) -> np.ndarray:
        """64-bit hash of each span and of small numbers that go with it."""
        code = end - start
        for m in marks:
            code = code * 65536 + m
        return W.mix(self.raw(start, end) ^ W.mix(code.astype(np.uint64))).view(np.int64)


def _window_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows with one minimizer: document, lo (first window), span, left (minimizer - lo), core, whole."""
    n = len(data)
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    hashes = _Hashes(data)
    own = W.mix((hashes.total[gram:] - hashes.total[:-gram]) * hashes.back[:n - gram + 1])
    # hash and place in one number: the least is the leftmost of the smallest hashes
    least = (own & ~np.uint64(0xFFFFFF)) | np.arange(len(own), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:size - width], least[width - size:])
    start = np.arange(len(least))
    valid = offsets[doc_of[:len(least)] + 1] - start >= length
    start, place = start[valid], (least[valid] & np.uint64(0xFFFFFF)).astype(np.int64)
    doc = doc_of[start]
    if not len(start):
        return {}
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    lo, hi, place = start[first], start[last], place[first]
    return {"doc": doc[first], "lo": lo, "span": hi - lo, "left": place - lo, "core": own[place].view(np.int64),
            "whole": hashes(lo, hi + length, hi - lo, place - lo)}


def _runs_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    """Runs of the documents of an Arrow batch, ``doc`` their places in it, ``lo`` counted from the text's start."""
    for a, b in W.slices(offsets):
        size = int(offsets[b] - offsets[a])
        if b > a + 1:
            base = offsets[a]
            found = _window_runs(data[base:offsets[b]], offsets[a:b + 1] - base, length, gram) if size >= length else {}
            if found:
                found["lo"] -= (offsets[a:b] - base)[found["doc"]]
                found["doc"] += a
                yield found
            continue
        for base in range(0, size - length + 1, PIECE):
            end = min(base + PIECE + length - 1, size)
            found = _window_runs(data[offsets[a] + base:offsets[a] + end], np.array([0, end - base]), length, gram)
            found["lo"] += base
            found["doc"] += a
            yield found


def _first_digit(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            for f in _runs_of(*W.flat_bytes(batch.column(2)), length, gram):
                doc = pa.array(f["doc"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f["core"]), pa.array(f["whole"]), ids.take(doc), rows.take(doc),
                     pa.array(f["lo"].astype(np.int32)), pa.array(f["span"].astype(np.int16)),
                     pa.array(f["left"].astype(np.int16))], names=["core", "whole", "id", "row", "lo", "span", "left"])
    return run


def _slices(length: int):
    """Documents with their undecided runs to one row per run with the bytes it covers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                data = text.as_buffer()
                raw = memoryview(data) if data is not None else b""
                runs = batch.column("runs")[i].values.flatten()
                lo, span = runs[0].to_numpy(), runs[1].to_numpy()
                n = len(lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("id")[i].as_py()] * n, pa.int64()),
                     pa.array([batch.column("row")[i].as_py()] * n, pa.int32()), *runs,
                     pa.array([bytes(raw[a:a + s + length]) for a, s in zip(lo.tolist(), span.tolist(), strict=True)],
                              pa.binary())], names=["id", "row", "lo", "span", "left", "bytes"])
    return run


def _cuts(span: np.ndarray, left: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """(run, cut, most, least): the distances of window starts before the minimizer, cut at multiples of ``step``."""
    first, last = (left - span) // step, left // step
    count = last - first + 1
    of = np.repeat(np.arange(len(span)), count)
    cut = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return of, cut, np.minimum(cut * step + step - 1, left[of]), np.maximum(cut * step, (left - span)[of])


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]


def _second_digit(length: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat_bytes(batch.column("bytes"))
            lo, span, left = _columns(batch, "lo", "span", "left")
            of, cut, most, least = _cuts(span, left, step)
            hashes, place = _Hashes(data), offsets[:-1][of] + left[of]
            core = hashes(place - cut * step, place - cut * step - (step - 1) + length)
            whole = hashes(place - most, place - least + length, most - cut * step, cut)
            begin = lo[of] + left[of] - most
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(core), pa.array(whole), batch.column("id").take(take), batch.column("row").take(take),
                 batch.column("lo").take(take), pa.array(cut.astype(np.int16)), pa.array(begin.astype(np.int32)),
                 pa.array((begin + most - least + length).astype(np.int32))],
                names=["core", "whole", "id", "row", "lo", "cut", "start", "till"])
    return run


def _third_digit(length: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat_bytes(batch.column("bytes"))
            lo, span, left, cut = _columns(batch, "lo", "span", "left", "cut")
            most, least = np.minimum(cut * step + step - 1, left), np.maximum(cut * step, left - span)
            count = most - least + 1
            of = np.repeat(np.arange(len(lo)), count)
            back = least[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            hashes, place = _Hashes(data), (offsets[:-1] + left)[of]
            edge = place - cut[of] * step
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes(edge, edge - (step - 1) + length)), pa.array(hashes(place - back, place - back + length, back)),
                 batch.column("id").take(take), batch.column("row").take(take),
                 pa.array((lo + left)[of].astype(np.int32) - back.astype(np.int32))],
                names=["core", "whole", "id", "row", "start"])
    return run


_SETTLED = "shared_prev = 2 or shared_next = 2"
#: Runs that go on: alone in their ``whole``, or the one of several classes under a ``core`` that others may meet.
_OPEN = "shared_prev = 1 or shared_next = 1"


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP) -> DataFrame:
    """(id, row, start, till): byte spans of ``docs(id, row, text)`` that are covered by repeated windows.

    Spans of one document may overlap and touch; every byte of every repeated window is in one.
    """
    if not step <= gram <= length:
        raise ValueError("step <= gram <= length is needed")
    first = running(docs.mapInArrow(_first_digit(length, gram), _RUN), ["core", "whole"],
                    ["id", "row", "lo", "span", "left"], drop_alone=True)
    undecided = first.where(_OPEN).groupBy("id", "row").agg(F.collect_list(F.struct("lo", "span", "left")).alias("runs"))
    undecided = materialise(undecided, "repeat-runs")
    if undecided.count() <= BROADCAST_IDS:
        picked = docs.join(F.broadcast(undecided.select("id", "row")), ["id", "row"], "left_semi")
    else:
        picked = docs
    slices = materialise(picked.join(undecided, ["id", "row"]).mapInArrow(_slices(length), _SLICE), "repeat-slices")
    second = running(slices.mapInArrow(_second_digit(length, step), _CUT), ["core", "whole"],
                     ["id", "row", "lo", "cut", "start", "till"], drop_alone=True)
    left_over = slices.join(second.where(_OPEN).select("id", "row", "lo", "cut"), ["id", "row", "lo"])
    third = running(left_over.mapInArrow(_third_digit(length, step), _WINDOW), ["core", "whole"],
                    ["id", "row", "start"], drop_alone=True)
    return first.where(_SETTLED).select("id", "row", F.col("lo").alias("start"),
                                        (F.col("lo") + F.col("span") + length).alias("till")) \
        .unionByName(second.where(_SETTLED).select("id", "row", "start", "till")) \
        .unionByName(third.where(_SETTLED).select("id", "row", "start", (F.col("start") + length).alias("till")))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by the spans."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    opens = np.ones(len(start), bool)
    opens[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(opens)
    return start[first], end[np.append(first[1:], len(start)) - 1]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = {c: i for i, c in enumerate(batch.schema.names)}
        kept, size, removed, count = [], [], [], []
        for text, spans in zip(batch.column(at["__text"]), batch.column(at["__spans"]), strict=True):
            data = text.as_buffer()
            raw = data.to_pybytes() if data is not None else b""
            size.append(len(raw))
            if spans.is_valid:
                start, end = merged(*(x.to_numpy().astype(np.int64) for x in spans.values.flatten()))
                edges = [0, *np.column_stack([start, end]).ravel().tolist(), len(raw)]
                kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
                count.append(len(start))
            else:
                kept.append(raw)
                count.append(0)
            removed.append(size[-1] - len(kept[-1]))
        own = {c: batch.column(i) for c, i in at.items() if c not in ("__text", "__spans")}
        own |= {"kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(size, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(count, pa.int64())}
        yield pa.RecordBatch.from_arrays(list(own.values()), names=list(own))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP) -> DataFrame:
    """``docs`` without its text, with ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    shipped(docs.sparkSession)
    docs = docs.drop(*ADDED)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
                              "__row": F.hash(F.col("doc_id").isNull(), text), "__text": text.cast("binary")}).drop("text")
    spans = repeated_spans(keyed.select(F.col("__id").alias("id"), F.col("__row").alias("row"),
                                        F.col("__text").alias("text")), length, gram, step)
    grouped = spans.groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")) \
        .agg(F.collect_list(F.struct("start", "till")).alias("__spans"))
    joined = keyed.join(grouped, ["__id", "__row"], "left").drop("__id", "__row")
    own = [c for c in docs.columns if c != "text"]
    schema = T.StructType([docs.schema[c] for c in own]).add("kept", "binary")
    for c in ADDED[1:]:
        schema = schema.add(c, "long")
    return joined.select(*own, "__text", "__spans").mapInArrow(_remove, schema)


#: DuckDB SQL of the digest of ``remove_repeats(documents)``: every window by its bytes.
SQL = f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS hex FROM documents),
chunks AS (
    SELECT r, base, substr(hex, 2 * base + 1, {2 * (500 + LENGTH - 1)}) AS part
    FROM (SELECT r, hex, unnest(range(0, len(hex) // 2, 500)) AS base FROM texts)),
windows AS (
    SELECT r, base + s AS s, md5(substr(part, 2 * s + 1, {2 * LENGTH})) AS code
    FROM (SELECT r, base, part, unnest(range(0, greatest(0, len(part) // 2 - {LENGTH - 1}))) AS s FROM chunks)),
repeated AS (
    SELECT r, s FROM windows WHERE code IN (SELECT code FROM windows GROUP BY code HAVING count(*) > 1)),
opened AS (
    SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + {LENGTH} THEN 0 ELSE 1 END AS opens
    FROM repeated),
numbered AS (
    SELECT r, s, sum(opens) OVER (PARTITION BY r ORDER BY s) AS no FROM opened),
spans AS (
    SELECT r, no, min(s) AS a, max(s) + {LENGTH} AS b FROM numbered GROUP BY r, no),
before AS (
    SELECT *, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS prior FROM spans),
cut AS (
    SELECT p.r, count(*) AS n_spans, sum(p.b - p.a) AS n_removed,
        string_agg(substr(t.hex, 2 * p.prior + 1, 2 * (p.a - p.prior)), '' ORDER BY p.a)
            || substr(any_value(t.hex), 2 * max(p.b) + 1) AS kept
    FROM before p JOIN texts t ON p.r = t.r GROUP BY p.r)
SELECT t.doc_id, CAST(len(t.hex) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(c.kept, t.hex))) AS kept_sha256
FROM texts t LEFT JOIN cut c ON t.r = c.r
"""
