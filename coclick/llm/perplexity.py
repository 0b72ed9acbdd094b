"""Quality rules: base counts, then perplexity bands per language.

The language model is modified Kneser-Ney over 4-grams of characters, counted by
Spark over every text: as many 4-grams as the corpus has.  It is one for all
languages, as three characters tell the language and texts hold passages in others
than their tag (models per language rejected 35 of 3,302 good labelled texts at
sf0.1, one model 8); the bands are per language.  White space and digits are one
character each, characters beyond the basic plane share 6400 codes, and a run of one
punctuation mark is one event.  A 4-gram counts
once per document, less the document itself: its count is the number of *other*
documents that hold it, so no text is made likely by its own junk, and one that
stands in a single document is scored through the lower orders.

Probabilities and back-off weights are computed by joins and aggregates over the
distinct 4-grams and stored in the shared folder as sorted hash arrays, cut by
ranges of the hash into files of bounded size; tasks map the files into memory
and look up a slice's distinct 4-grams.  Nothing passes through the driver but
the list of files.  ``log_perplexity`` is the mean over a document's characters,
drawn towards its language's median as if ``PRIOR_CHARS`` more characters had that
value (short texts are noisy).

Bands judge the mean itself.  Centre and spread of a language come from the
shortest interval that holds half of its values, which junk under half of the
rows does not move, on whichever side it lies.  A document of n characters is rejected
beyond LOWER or UPPER spreads from the centre, widened by
``sqrt(1 + PRIOR_CHARS / n)``: the noise of a short text.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null text = empty: no words,
base_failed, perplexity null; a null language is a language; repeated rows are
rows; rows without any text give bands of no width; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm import words as W
from coclick.llm.store import materialise, shared_folder, shipped
from coclick.llm.tokenfile import _get, _put, _store

ORDER = 4
BITS = 16
LOWER, UPPER = 4.0, 2.5
LEAST_SPREAD = 0.02
PRIOR_CHARS = 300
LEAST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: Log probability of a character that no other text has.
UNKNOWN = -math.log(1 << BITS)
#: Entries of a model file (12 bytes each), and files that a worker keeps open.
ENTRIES_PER_FILE, OPEN_FILES = 8_000_000, 8
BROADCAST_LANGUAGES = 10_000
_GRID = [i / 100 for i in range(101)]
#: From the width of the inner half of normal values to the distance from their median to a 10th percentile.
HALF_TO_TENTH = 0.95

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_BASE = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, " \
    "n_repeat_words long, n_events long, surprise double"


#: Marks of which a run is one event.
_MARK = np.zeros(1 << BITS, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,"]] = True


def events(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the texts (codes of 16 bits) with each run of one mark cut to one, and the texts' bounds."""
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = begun[offsets]
    c = np.where(points < 1 << BITS, points, 0xE000 + points % 6400).astype(np.uint16)
    c[c <= 32] = 32
    c[(c >= 48) & (c < 58)] = 48
    again = np.zeros(len(c), dtype=bool)
    again[1:] = (c[1:] == c[:-1]) & _MARK[c[1:]]
    again[bounds[:-1][bounds[:-1] < len(c)]] = False
    return c[~again], np.concatenate([[0], np.cumsum(~again)])[bounds]


def distinct_grams(chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, 4-gram, times): the distinct 4-grams of each text; before a text stand zeros."""
    docs, n = len(bounds) - 1, len(chars)
    present = np.zeros(1 << BITS, dtype=bool)
    present[chars] = True
    alphabet = np.concatenate([[0], np.flatnonzero(present)]).astype(np.uint64)
    width = max(1, (len(alphabet) - 1).bit_length())
    if (docs - 1).bit_length() + ORDER * width > 64:
        # too many texts for one key: the halves
        half = docs // 2
        parts = [distinct_grams(chars[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]) for a, b in ((0, half), (half, docs))]
        doc, gram, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        doc[len(parts[0][0]):] += half
        return doc, gram, times
    place = (np.cumsum(present) * present).astype(np.uint64)[chars]
    key = place.copy()
    into = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, ORDER):
        before = np.zeros(n, dtype=np.uint64)
        before[back:] = place[:max(0, n - back)]
        before[into < back] = 0
        key |= before << np.uint64(width * back)
    if docs > 1:
        key |= np.repeat(np.arange(docs, dtype=np.uint64), np.diff(bounds)) << np.uint64(ORDER * width)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else np.zeros(0, np.int64)
    times = np.diff(np.append(first, n))
    key = key[first]
    gram = np.zeros(len(key), dtype=np.uint64)
    for back in range(ORDER):
        gram |= alphabet[(key >> np.uint64(width * back)) & np.uint64((1 << width) - 1)] << np.uint64(BITS * back)
    doc = (key >> np.uint64(ORDER * width)).astype(np.int64) if docs > 1 else np.zeros(len(key), np.int64)
    return doc, gram, times


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return gram, np.bincount(at, np.concatenate([n for _, n in parts]), len(gram)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per 4-gram of one task, merged as they come and passed on when they are many."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for batch in batches:
        data, offsets = W.flat(batch.column(0))
        for lo, hi in W.slices(offsets):
            base = offsets[lo]
            _, gram, _ = distinct_grams(*events(data[base:offsets[hi]], offsets[lo:hi + 1] - base))
            parts.append(np.unique(gram, return_counts=True))
            held += len(parts[-1][0])
        if held > 8_000_000:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > 4_000_000:
                yield _gram_rows(*parts[0])
                parts, held = [], 0
    if parts:
        yield _gram_rows(*_merged(parts))


def _gram_rows(gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n): in how many documents each 4-gram stands, over all texts."""
    shipped(docs.sparkSession)
    return docs.select(F.col("text").cast("string").alias("text")) \
        .mapInArrow(_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def kneser_ney(counted: DataFrame) -> DataFrame:
    """(k, gram, value): log probabilities of k-grams (k = 1 to 4) and, as k + 8, log back-off weights of their contexts.

    ``counted(gram, n)``; a 4-gram counts in ``n - 1`` other documents, a
    lower order in as many contexts as it follows.
    """
    table = materialise(counted.where("n > 1").select(F.col("gram").alias("g"), (F.col("n") - 1).alias("c")), "grams-4")
    tables = {ORDER: table}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = materialise(tables[k + 1].groupBy(F.col("g").bitwiseAND((1 << BITS * k) - 1).alias("g"))
                                .agg(F.count("*").alias("c")), f"grams-{k}")
    out, lower = None, None
    for k in range(1, ORDER + 1):
        seen = [F.sum((F.col("c") == i).cast("double")).alias(f"s{i}") for i in (1, 2, 3, 4)]
        y = F.when((F.col("s1") > 0) & (F.col("s2") > 0), F.col("s1") / (F.col("s1") + 2 * F.col("s2"))).otherwise(F.lit(0.5))
        cut = [F.when(F.col(f"s{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"s{i + 1}") / F.col(f"s{i}"), F.lit(0.05)),
                                                  F.lit(i - 0.05))).otherwise(F.lit(0.5)).alias(f"d{i}") for i in (1, 2, 3)]
        cuts = tables[k].agg(*seen).select(*cut)
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = tables[k].join(F.broadcast(cuts)).select("g", F.shiftrightunsigned("g", BITS).alias("x"),
                                                              F.col("c").cast("double").alias("c"), d.alias("d"))
        heads = rows.groupBy("x").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("left"))
        joined = rows.join(heads, "x")
        if lower is None:
            p = (F.col("c") - F.col("d")) / F.col("total") + F.col("left") / (1 << BITS)
        else:
            joined = joined.withColumn("lg", F.col("g").bitwiseAND((1 << BITS * (k - 1)) - 1)).join(lower, "lg")
            p = (F.col("c") - F.col("d")) / F.col("total") + F.col("left") * F.col("lp")
        scored = materialise(joined.select("g", p.alias("p")), f"chances-{k}")
        lower = scored.select(F.col("g").alias("lg"), F.col("p").alias("lp"))
        part = scored.select(F.lit(k).alias("k"), F.col("g").alias("gram"), F.ln("p").alias("value")) \
            .unionByName(heads.select(F.lit(k + 8).alias("k"), F.col("x").alias("gram"), F.ln("left").alias("value")))
        out = part if out is None else out.unionByName(part)
    return out


def _keys(gram: np.ndarray, k: int) -> np.ndarray:
    return W.mix(gram + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Model rows to (key, value); keys are shifted to sort as signed numbers."""
    for batch in batches:
        k, gram = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        key = np.zeros(len(k), np.uint64)
        for order in np.unique(k):
            key[k == order] = _keys(gram[k == order], int(order))
        yield pa.RecordBatch.from_arrays([pa.array((key ^ np.uint64(1 << 63)).view(np.int64)), batch.column(2)],
                                         names=["key", "value"])


def _written(folder: str):
    """Sorted (key, value) of a task to one pair of files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        key = (rows.column("key").to_numpy().view(np.uint64) ^ np.uint64(1 << 63))
        system, base = _store(folder)
        system.create_dir(base)
        stem = f"{folder}/{uuid.uuid4().hex}"
        _put(f"{stem}.keys", np.ascontiguousarray(key.astype("<u8")))
        _put(f"{stem}.values", np.ascontiguousarray(rows.column("value").to_numpy().astype("<f4")))
        yield pa.RecordBatch.from_arrays([rows.column("key").slice(0, 1).combine_chunks(), pa.array([stem])], names=["key", "stem"])
    return run


def write_model(model: DataFrame) -> list[tuple[int, str]]:
    """The model as sorted hash arrays in the shared folder: (first key, stem) of each file, in order."""
    folder = shared_folder(model.sparkSession, "perplexity-model")
    keyed = materialise(model.mapInArrow(_keyed, "key long, value double"), "model-keys")
    files = max(1, math.ceil(keyed.count() / ENTRIES_PER_FILE))
    manifest = materialise(keyed.repartitionByRange(files, "key").sortWithinPartitions("key")
                           .mapInArrow(_written(folder), "key long, stem string"), "model-files")
    return sorted((r["key"] + (1 << 63), r["stem"]) for r in manifest.collect())


@lru_cache(maxsize=OPEN_FILES)
def _opened(stem: str) -> tuple[np.ndarray, np.ndarray]:
    return _get(f"{stem}.keys", "<u8"), _get(f"{stem}.values", "<f4")


def _looked_up(files: list[tuple[int, str]], key: np.ndarray) -> np.ndarray:
    """Values of the keys, NaN for those the model has not."""
    out = np.full(len(key), np.nan, np.float32)
    of = np.searchsorted(np.array([f for f, _ in files], np.uint64), key, "right") - 1
    for i in np.unique(of[of >= 0]):
        here = np.flatnonzero(of == i) if len(files) > 1 else slice(None)
        known, value = _opened(files[i][1])
        at = np.minimum(np.searchsorted(known, key[here]), len(known) - 1)
        out[here] = np.where(known[at] == key[here], value[at], np.float32(np.nan))
    return out


def log_chances(files: list[tuple[int, str]], gram: np.ndarray) -> np.ndarray:
    """Natural log probability of the last character of each 4-gram after the others."""
    out = np.zeros(len(gram))
    todo = np.arange(len(gram))
    for k in range(ORDER, 0, -1):
        value = _looked_up(files, _keys(gram, k))
        known = ~np.isnan(value)
        out[todo[known]] += value[known]
        gram, todo = gram[~known], todo[~known]
        if not len(todo):
            return out
        # back off: a context that was never seen leaves all to the lower order
        out[todo] += np.nan_to_num(_looked_up(files, _keys(gram >> np.uint64(BITS), k + 8)), nan=0.0)
        gram = gram & np.uint64((1 << BITS * (k - 1)) - 1)
    out[todo] += UNKNOWN
    return out


def _per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's range."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base columns of one slice of documents."""
    spans, n_docs = W.word_spans(data, offsets), len(offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(spans.first))
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out = {"n_words": np.diff(spans.first),
           "word_chars": _per_doc(lead[spans.end] - lead[spans.start], spans.first),
           "n_symbols": _per_doc(_SYMBOL[data], offsets)}
    # lines with a word, equal to an earlier one of the text
    lines = W.line_spans(data, offsets)
    begun = np.zeros(len(data) + 1, dtype=np.int64)
    begun[spans.start + 1] = 1
    begun = np.cumsum(begun)
    worded = begun[lines.end] > begun[lines.start]
    line_doc = np.repeat(np.arange(n_docs), np.diff(lines.first))[worded]
    key = W.mix(W.span_hash(data, lines.start[worded], lines.end[worded]) + W.mix(line_doc.astype(np.uint64)))
    by = np.argsort(key, kind="stable")
    again = np.zeros(len(by), dtype=bool)
    again[1:] = key[by][1:] == key[by][:-1]
    out["n_dup_lines"] = np.bincount(line_doc[by][again], minlength=n_docs)
    # words inside a window that stands twice or more in the text
    word = W.span_hash(data, spans.start, spans.end)
    window = W.window_hash(word, REPEAT_WINDOW)
    at = np.flatnonzero(doc[REPEAT_WINDOW - 1:] == doc[:len(window)]) if len(window) else np.zeros(0, np.int64)
    key = W.mix(window[at] + W.mix(doc[at].astype(np.uint64)))
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = np.zeros(len(by), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(cover, at[by[twice]], 1)
    np.add.at(cover, at[by[twice]] + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = _per_doc((np.cumsum(cover[:-1]) > 0).astype(np.int64), spans.first)
    return out


def _scores(files: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat(batch.column(2))
            for lo, hi in W.slices(offsets):
                base = offsets[lo]
                own, cut = data[base:offsets[hi]], offsets[lo:hi + 1] - base
                counts = base_counts(own, cut)
                chars, bounds = events(own, cut)
                doc, gram, times = distinct_grams(chars, bounds)
                lost = -np.bincount(doc, times * log_chances(files, gram), hi - lo)
                counts |= {"n_events": np.diff(bounds), "surprise": lost}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     *(pa.array(np.asarray(v, np.float64 if k == "surprise" else np.int64))
                       for k, v in counts.items())],
                    names=["doc_id", "lang", *counts])
    return run


def _half(q: str):
    """Ends of the shortest run of quantiles that holds half of a language: junk under a half does not move it."""
    n = len(_GRID) // 2
    runs = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: F.struct(
        (F.get(q, i + n) - F.get(q, i)).alias("width"), F.get(q, i).alias("a"), F.get(q, i + n).alias("b")))
    return F.array_min(runs)


def quality_rules(docs: DataFrame, lower: float = LOWER, upper: float = UPPER,
                  prior_chars: int = PRIOR_CHARS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity)."""
    shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    files = write_model(kneser_ney(materialise(count_grams(docs), "gram-counts")))
    scored = materialise(docs.mapInArrow(_scores(files), _BASE), "perplexity")
    mean = F.when(F.col("n_events") > 0, F.col("surprise") / F.col("n_events"))
    middle = scored.groupBy("lang").agg(F.percentile_approx(mean, 0.5, 10_000).alias("median"),
                                        F.percentile_approx(mean, _GRID, 10_000).alias("q")) \
        .select(F.col("lang").alias("__lang"), "median", ((_half("q")["a"] + _half("q")["b"]) / 2).alias("centre"))
    drawn = (F.col("surprise") + F.col("median") * prior_chars) / (F.col("n_events") + prior_chars)
    # a short text's mean is noisy: its band is wider, so its distance counts for less
    apart = (mean - F.col("centre")) * F.sqrt(F.col("n_events") / (F.col("n_events") + prior_chars))
    languages = middle.count()
    sided = lambda t: F.broadcast(t) if languages <= BROADCAST_LANGUAGES else t
    same = lambda t: F.col("lang").eqNullSafe(F.col("__lang"))
    valued = scored.join(sided(middle), same(middle)).drop("__lang") \
        .withColumns({"log_perplexity": F.when(F.col("n_events") > 0, drawn), "apart": apart})
    bands = valued.groupBy("lang").agg(F.percentile_approx("apart", _GRID, 10_000).alias("q")) \
        .select(F.col("lang").alias("__lang"), ((_half("q")["a"] + _half("q")["b"]) / 2).alias("zero"),
                F.greatest((_half("q")["b"] - _half("q")["a"]) * HALF_TO_TENTH, F.lit(LEAST_SPREAD)).alias("spread"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    inside = F.col("apart").between(F.col("zero") - lower * F.col("spread"), F.col("zero") + upper * F.col("spread"))
    return valued.join(sided(bands), same(bands)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(False))).alias("kept"), "log_perplexity")
