"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 = low quality, 1 = good quality but toxic, 2 = good quality (from
``labels``).  One weight vector over hashed text features is shared by all
grades; ordered thresholds cut its value into grades:
P(grade <= k) = sigmoid(threshold_k - w . x).  The expected grade ranks
documents, the tail probability P(grade >= 1) selects them.

Features: hashed byte trigrams and hashed word shapes (letter case, symbols,
digits, length, equality with the word before), each block as square roots of
relative frequencies.  The model is fitted on at most ``SAMPLE_PER_GRADE``
labelled documents per grade (lowest hashes of the id), weighted back to the
grades' real frequencies, in one task; every document is scored.

Defined cases: null text = empty; labels repeated for an id count once (largest
values); without labelled documents of two grades nothing can be learned: scores
are null and every document is kept; repeated rows are rows; an empty table gives
an empty result; other columns pass through ``select_documents`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.llm import words as W
from coclick.llm.store import materialise, shipped

SAMPLE_PER_GRADE = 2_000
GRAMS, SHAPES = 2048, 256
FEATURES = GRAMS + SHAPES
LEAST_TAIL = 0.5
ADDED = ("expected_grade", "tail", "kept")
STEPS, RATE, RIDGE = 300, 0.5, 1e-4

_SHAPE = np.zeros(256, dtype=np.uint64)     # one bit a kind of byte
_SHAPE[65:91] = 1
_SHAPE[97:123] = 2
_SHAPE[48:58] = 4
_SHAPE[128:] = 2
for _c in "!?":
    _SHAPE[ord(_c)] = 8
for _c in "#*$%&|<>@{}[]=+~^\\/_":
    _SHAPE[ord(_c)] = 16


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, FEATURES) float32 of one slice."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), dtype=np.float32)
    b = data.astype(np.uint32)
    if len(b) > 2:
        gram = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) \
            >> np.uint32(32 - 11)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        own = doc[:-2] == doc[2:]
        out[:, :GRAMS] = np.bincount((doc[:-2] * GRAMS + gram)[own], minlength=n * GRAMS).reshape(n, GRAMS)
    spans = W.word_spans(data, offsets)
    if len(spans.start):
        doc = np.repeat(np.arange(n), np.diff(spans.first))
        kinds = np.bitwise_or.reduceat(_SHAPE[data], spans.start)
        upper = np.concatenate([[0], np.cumsum(_SHAPE[data] == 1)])
        uppers = np.minimum(upper[spans.end] - upper[spans.start], 3)
        length = np.minimum(np.log2(spans.end - spans.start + 1).astype(np.int64), 7)
        word = W.span_hash(W.lowered(data), spans.start, spans.end)
        again = np.zeros(len(word), dtype=np.uint64)
        again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
        shape = kinds | (uppers.astype(np.uint64) << np.uint64(5)) | (again << np.uint64(8))
        for code in (shape, shape << np.uint64(4) | length.astype(np.uint64) | np.uint64(1 << 40)):
            at = (W.mix(code) >> np.uint64(56)).astype(np.int64)
            out[:, GRAMS:] += np.bincount(doc * SHAPES + at, minlength=n * SHAPES).reshape(n, SHAPES)
    for block in (slice(0, GRAMS), slice(GRAMS, FEATURES)):
        part = out[:, block]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1)
        np.sqrt(part, out=part)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by weighted maximum likelihood (Adam, full batch)."""
    w = np.zeros(x.shape[1])
    # thresholds as a first one and logarithms of gaps
    t = np.concatenate([[-1.0], np.zeros(grades - 2)])
    m, v = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        cut = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
        z = (x @ w.astype(x.dtype)).astype(np.float64)
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        up, down = _sigmoid(edge[grade + 1] - z), _sigmoid(edge[grade] - z)
        p = np.maximum(up - down, 1e-12)
        du, dd = up * (1 - up) * np.isfinite(edge[grade + 1]), down * (1 - down) * np.isfinite(edge[grade])
        by_z = weight * (du - dd) / p                   # derivative of the loss by z
        by_cut = np.array([(weight * (-du / p * (grade == k) + dd / p * (grade == k + 1))).sum()
                           for k in range(grades - 1)])
        tail = np.cumsum(by_cut[::-1])[::-1]
        g = np.concatenate([by_z.astype(x.dtype) @ x + RIDGE * w, [tail[0]], tail[1:] * np.exp(t[1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, t = w - move[:len(w)], t - move[len(w):]
    return w, t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 low quality, 1 good but toxic, 2 good."""
    return labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")) \
        .select("doc_id", F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2).alias("grade"))


def _fit_task(frequency: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for batch in batches:
            data, offsets = W.flat(batch.column(1))
            for lo, hi in W.slices(offsets):
                base = offsets[lo]
                x.append(features(data[base:offsets[hi]], offsets[lo:hi + 1] - base))
            y.append(batch.column(0).to_numpy())
        if x:
            matrix, grade = np.concatenate(x), np.concatenate(y)
            present, at, size = np.unique(grade, return_inverse=True, return_counts=True)
            if len(present) > 1:
                share = np.array([frequency[int(g)] for g in present]) / size
                w, cut = fit(matrix, at, share[at], len(present))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.tolist()]), pa.array([cut.tolist()]), pa.array([present.astype(np.int64).tolist()])],
                    names=["weights", "thresholds", "grades"])
    return run


def train(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE_PER_GRADE) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(weights, thresholds, grades) from a bounded sample of labelled documents; None if there is nothing to learn."""
    shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    graded = materialise(grades_of(labels), "grades")
    frequency = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    picks = [graded.where(F.col("grade") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_grade)
             for g in sorted(frequency)]
    if not picks:
        return None
    picked = picks[0]
    for p in picks[1:]:
        picked = picked.unionByName(p)
    # bounded: per_grade ids a grade, one row an id
    sample = materialise(docs.join(F.broadcast(materialise(picked, "sample-ids")), "doc_id")
                         .groupBy("doc_id", "grade").agg(F.min("text").alias("text")), "sample")
    # in id order: the same model whatever order the rows came in
    model = sample.coalesce(1).sortWithinPartitions("doc_id").select("grade", "text").mapInArrow(
        _fit_task(frequency), "weights array<double>, thresholds array<double>, grades array<long>").collect()
    if not model:
        return None
    return np.array(model[0]["weights"]), np.array(model[0]["thresholds"]), np.array(model[0]["grades"])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray] | None,
          least_tail: float = LEAST_TAIL, added: tuple[str, str, str] = ADDED) -> DataFrame:
    """``docs`` plus expected_grade, tail (P(grade above the lowest)) and kept (replaced if there)."""
    spark = shipped(docs.sparkSession)
    docs = docs.drop(*added)
    if model is None:
        return docs.withColumns(dict(zip(added, (F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(True)),
                                         strict=True)))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, cut, grades = shared.value
        for batch in batches:
            data, offsets = W.flat(batch.column(batch.schema.get_field_index("text")))
            above = np.zeros((batch.num_rows, len(cut)))
            for lo, hi in W.slices(offsets):
                base = offsets[lo]
                z = features(data[base:offsets[hi]], offsets[lo:hi + 1] - base) @ w.astype(np.float32)
                above[lo:hi] = _sigmoid(z[:, None] - cut)
            expected = grades[0] + above @ np.diff(grades)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(expected), pa.array(above[:, 0]), pa.array(above[:, 0] >= least_tail)],
                names=[*batch.schema.names, *added])

    kinds = (T.DoubleType(), T.DoubleType(), T.BooleanType())
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)]))


def rate_documents(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE_PER_GRADE) -> DataFrame:
    """(doc_id, expected_grade, tail, kept) for every row."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(text, train(text, labels, per_grade)).select("doc_id", "expected_grade", "tail", "kept")


def select_documents(docs: DataFrame, labels: DataFrame, per_grade: int = SAMPLE_PER_GRADE) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns unchanged."""
    plain = docs.withColumn("text", F.col("text").cast("string"))
    return score(plain, train(plain, labels, per_grade), added=("__expected", "__tail", "__kept")) \
        .where("__kept").select(*docs.columns)
