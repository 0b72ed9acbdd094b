"""Document fingerprints: order MinHash, sensitive to edit distance.

A text's elements are its k-mers of code points, numbered by occurrence (the
second "abc" differs from the first).  For each of ``size`` orders of the
elements the ``keep`` smallest are selected, put back into text order, and their
k-mers hashed as a tuple: one coordinate.  Two texts agree in a coordinate if
the selected elements are the same and stand in the same order, so shared
content in another order does not count as equal (unlike plain MinHash).

Every element takes part in every order: an order ranks by a byte of its own
first, then by a hash of its own.  A text with at least ``keep`` elements whose
byte is under some number has its smallest among them, so only those are ranked
further: the others are larger by the order itself.  An edit that leaves the
front of a text alone leaves its elements and their bytes alone, so
:func:`edit_signatures` looks for early elements only in what is new.

Defined cases: null = empty; an empty text has the fingerprint of all zeros; a
text shorter than k is one k-mer; equal texts have equal fingerprints and
likeness 1; rows repeating an id are ordered by text; null ids come first; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm import order
from coclick.llm.store import shipped
from coclick.llm.words import _power, mix

KMER = 12
KEEP = 2
SIZE = 64
SLICE_CHARS = 1 << 16
CHARS_AT_ONCE = 4 << 20

_BASE = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bits of a rank that hold the element's position within a slice.
_PLACE_BITS = 26
#: Elements that are ranked further, of a text, on average.
EXPECTED = 16
_ORDERS = np.random.Generator(np.random.PCG64(64)).integers(1, 1 << 63, (2, 4096), dtype=np.uint64) | np.uint64(1)


def _kmers(points: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-mer in text order, n + 1 bounds); a shorter non-empty text is one k-mer."""
    n = len(points)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=total[1:])
    length = np.diff(offsets)
    count = np.where(length >= k, length - k + 1, (length > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(first[-1]) + np.repeat(offsets[:-1] - first[:-1], count)
    end = np.minimum(start + k, np.repeat(offsets[1:], count))
    h = (total[end] - total[start]) * _power(_INVERSE, n + 1)[start]
    return mix(h + (end - start).astype(np.uint64)), first


def _occurrences(kmer: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many equal k-mers stand before each in its document."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    by = np.lexsort((kmer, doc))
    k, d = kmer[by], doc[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    at = np.arange(len(by))
    out = np.empty(len(by), dtype=np.uint64)
    out[by] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return out


def _low(places: int) -> np.uint64:
    """Mask of the bits that hold a place among so many."""
    return np.uint64((1 << max(_PLACE_BITS, places.bit_length())) - 1)


def _repeats(kmer: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As :func:`_occurrences`; only k-mers that may stand twice in their document are compared in full."""
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    low = _low(len(kmer))
    key = ((kmer + mix(np.arange(len(first) - 1, dtype=np.uint64))[doc]) & ~low) | np.arange(len(kmer), dtype=np.uint64)
    key.sort()
    same = (key[1:] ^ key[:-1]) <= low
    many = np.zeros(len(key), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    at = np.sort(key[many] & low).astype(np.int64)
    out = np.zeros(len(kmer), dtype=np.uint64)
    out[at] = _occurrences(kmer[at], np.searchsorted(at, first))
    return out


def _elements(points: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k-mers, elements, n + 1 bounds) of the documents of a slice."""
    kmer, first = _kmers(points, offsets, k)
    return kmer, mix(kmer + mix(_repeats(kmer, first) + np.uint64(1))), first


def _leads(element: np.ndarray, d: int) -> np.ndarray:
    """One byte of each element for each of the orders d to d + 7 (d divisible by 8)."""
    return mix(element ^ _ORDERS[1, d])


def _lead_bytes(element: np.ndarray, d: int) -> np.ndarray:
    """(8, elements): the bytes for the orders d to d + 7."""
    return _leads(element, d).astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T.copy()


def _select(kmer: np.ndarray, element: np.ndarray, first: np.ndarray, at: np.ndarray, lead: np.ndarray, d: int,
            keep: int) -> np.ndarray:
    """Coordinate d of every document (with one element at least) from its early elements ``at``."""
    count = np.diff(first)
    bounds = np.searchsorted(at, first)
    few = np.flatnonzero(np.diff(bounds) < np.minimum(keep, count))
    if len(few):
        # these are ranked whole
        every = np.concatenate([np.arange(first[x], first[x + 1]) for x in few])
        byte = (_leads(element[every], d - d % 8) >> np.uint64(8 * (d % 8))).astype(np.uint8)
        at, where = np.unique(np.concatenate([at, every]), return_index=True)
        lead = np.concatenate([lead, byte])[where]
        bounds = np.searchsorted(at, first)
    low = _low(len(at))
    rank = (element[at] ^ _ORDERS[0, d]) * _ORDERS[1, d]
    rank ^= rank >> np.uint64(32)
    rank *= _ORDERS[0, d]
    rank >>= np.uint64(8)
    rank |= lead.astype(np.uint64) << np.uint64(56)
    rank &= ~low
    rank |= np.arange(len(at), dtype=np.uint64)
    chosen = np.empty((keep, len(count)), dtype=np.int64)
    for i in range(keep):
        chosen[i] = (np.minimum.reduceat(rank, bounds[:-1]) & low).astype(np.int64)
        # documents with fewer elements repeat their last
        if i:
            chosen[i] = np.where(count > i, chosen[i], chosen[i - 1])
        rank[chosen[i]] |= ~low
    chosen.sort(axis=0)
    h = np.full(len(count), keep, dtype=np.uint64)
    for i in range(keep):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + kmer[at[chosen[i]]])
    return (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _slices(sizes: list[int]) -> Iterator[tuple[list[int], int]]:
    """Non-empty texts by length, at most SLICE_CHARS code points at a time (one text at least).

    With each slice goes the byte under which its shortest text has ``EXPECTED`` elements or so: 256 for short texts.
    """
    by = sorted((i for i, n in enumerate(sizes) if n), key=sizes.__getitem__)
    i = 0
    while i < len(by):
        j, chars = i, 0
        while j < len(by) and (j == i or chars + sizes[by[j]] <= SLICE_CHARS):
            chars += sizes[by[j]]
            j += 1
        yield by[i:j], min(256, -(-EXPECTED * 256 // sizes[by[i]]))
        i = j


def signatures(texts: list[str], k: int = KMER, keep: int = KEEP, size: int = SIZE) -> np.ndarray:
    """(texts, size) uint32 coordinates; zeros for empty texts."""
    out = np.zeros((len(texts), size), dtype=np.uint32)
    for own, early in _slices([len(t) for t in texts]):
        kmer, element, first = _elements(*_points([texts[x] for x in own]), k)
        for d in range(size):
            if d % 8 == 0:
                lead = _lead_bytes(element, d)
            at = np.flatnonzero(lead[d % 8] < early)
            out[own, d] = _select(kmer, element, first, at, lead[d % 8][at], d, keep)
    return out


def edit_signatures(texts: list[str], changed: list[str], kept: list[int], k: int = KMER, keep: int = KEEP,
                    size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of ``texts`` and of ``changed``, whose first ``kept`` code points are those of the text.

    A changed text is empty only if its text is.
    """
    out = np.zeros((2, len(texts), size), dtype=np.uint32)
    for own, early in _slices([min(len(a), len(b)) for a, b in zip(texts, changed, strict=True)]):
        kmer, element, first = _elements(*_points([texts[x] for x in own]), k)
        kmer_2, element_2, first_2 = _elements(*_points([changed[x] for x in own]), k)
        # k-mers that lie in the kept front, and where they went
        same = np.array([max(0, kept[x] - k + 1) for x in own])
        stays = np.arange(len(kmer)) - np.repeat(first[:-1], np.diff(first)) < np.repeat(same, np.diff(first))
        to = np.arange(len(kmer)) + np.repeat(first_2[:-1] - first[:-1], np.diff(first))
        fresh = np.flatnonzero(np.arange(len(kmer_2)) - np.repeat(first_2[:-1], np.diff(first_2))
                               >= np.repeat(same, np.diff(first_2)))
        element_fresh = element_2[fresh]
        for d in range(size):
            if d % 8 == 0:
                lead, lead_fresh = _lead_bytes(element, d), _lead_bytes(element_fresh, d)
            at = np.flatnonzero(lead[d % 8] < early)
            byte = lead[d % 8][at]
            out[0, own, d] = _select(kmer, element, first, at, byte, d, keep)
            front, new = stays[at], np.flatnonzero(lead_fresh[d % 8] < early)
            at_2 = np.concatenate([to[at[front]], fresh[new]])
            by = np.argsort(at_2, kind="stable")
            byte = np.concatenate([byte[front], lead_fresh[d % 8][new]])[by]
            out[1, own, d] = _select(kmer_2, element_2, first_2, at_2[by], byte, d, keep)
    return out[0], out[1]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates, row by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as many code points from the start of ``following`` (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rows(k: int, keep: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose successor is in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            ahead, name = (batch.column(i).to_pylist() for i in (1, 2))
            text = [t or "" for t in batch.column(3).to_pylist()]
            lo = 0
            while lo < len(text):
                hi, chars = lo, 0
                while hi < len(text) and chars < CHARS_AT_ONCE:
                    chars += len(text[hi])
                    hi += 1
                rows = ([held] if held else []) + list(zip(ahead[lo:hi], name[lo:hi], text[lo:hi], strict=True))
                held = rows[-1]
                if len(rows) > 1:
                    yield _out(rows, k, keep, size)
                lo = hi
    return run


def _out(rows: list[tuple], k: int, keep: int, size: int) -> pa.RecordBatch:
    """One row for each but the last of ``rows(ahead, doc_id, text)`` that does not just look ahead."""
    texts = [r[2] for r in rows]
    changed = [edited(x, y) for x, y in zip(texts[:-1], texts[1:], strict=True)] + texts[-1:]
    own, other = edit_signatures(texts, changed, [*(len(t) - len(t) // 2 for t in texts[:-1]), len(texts[-1])], k, keep, size)
    here = [i for i, r in enumerate(rows[:-1]) if not r[0]]
    following = own[[i + 1 for i in here]]
    own, other = own[here], other[here]
    as_hex = lambda s: [r.tobytes().hex() for r in s.astype(">u4")]
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[i][1] for i in here], pa.int64()), pa.array([len(texts[i]) for i in here], pa.int64()),
         pa.array([hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest() for i in here], pa.string()),
         pa.array(as_hex(own), pa.string()), pa.array(as_hex(other), pa.string()),
         pa.array(likeness(own, other)), pa.array(likeness(own, following))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edit_probe(docs: DataFrame, k: int = KMER, keep: int = KEEP, size: int = SIZE,
               rows_per_bucket: int = order.ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document's text, with their likeness."""
    shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = order.id_bounds(docs, rows_per_bucket)
    return order.in_order(order.with_buckets(docs, bounds, look_ahead=True)) \
        .select("bucket", "ahead", "doc_id", "text") \
        .mapInArrow(_rows(k, keep, size), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, k: int = KMER, keep: int = KEEP, size: int = SIZE) -> DataFrame:
    """(doc_id, fingerprint): hexadecimal coordinates of each row's text."""
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sign = signatures([t or "" for t in batch.column(1).to_pylist()], k, keep, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes().hex() for r in sign.astype(">u4")], pa.string())],
                names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fingerprint string")
