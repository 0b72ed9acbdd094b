"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, with A-Z lowered, as 64-bit hashes.  One pass over the texts keeps, per
document, its length and the query terms it holds with their counts; statistics
(documents, lengths, document frequencies) are sums over that table.  A document
is in one shard; a shard sorts its postings by term and impact, and for each item
reads the lists of its terms from the top, in blocks:

* ``lower`` of a document is the sum of its impacts read so far;
* ``upper`` adds, for each list it has not been met in, the impact at which that
  list stands, unless the list already stands below the least impact that the
  document could have there (one occurrence in a text of its length);
* reading ends when no unseen document can reach the k-th best lower bound, every
  document that can has ``lower = upper``, and so membership, ties and scores are final.

The k best so far go along from shard to shard of a task, and tasks hand k rows per
item to a last ranking, so what is shuffled does not grow with the texts' size.
Items go through in blocks of at most ``TERMS_PER_BLOCK`` terms (one item at
least), the only thing that travels to all tasks.

The score of a document for an item is the sum over the item's distinct terms of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``m = 10 + (90 * n * N) div L`` and
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``.

Defined cases: null text = no term; rows repeating a doc_id are documents of their
own; a null doc_id ranks after all ids of equal score; every row of the items is an
item (null or empty text: no result); documents without a term count for
nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coclick.llm import words as W
from coclick.llm.store import materialise, shipped

K = 10
TERMS_PER_BLOCK = 200_000
#: Postings that a shard sorts at a time.
SHARD_POSTINGS = 1_000_000
FIRST_READ = 32
#: Stands for a null doc_id, after every id.
_NO_ID = (1 << 63) - 1

_POSTINGS = "doc_id long, no_id boolean, n long, terms array<int>, counts array<int>"


def _term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spans = W.term_spans(data, offsets)
    return W.span_hash(W.lowered(data), spans.start, spans.end), spans.first


def item_terms(texts: list[str | None]) -> list[np.ndarray]:
    """Distinct term hashes of each query text."""
    data, offsets = W.flat(pa.array(texts, pa.string()))
    hashes, first = _term_hashes(data, offsets)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def _index(vocabulary: np.ndarray):
    """Documents to their length and their terms of the (sorted) vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat(batch.column(1))
            for a, b in W.slices(offsets):
                base = offsets[a]
                hashes, first = _term_hashes(data[base:offsets[b]], offsets[a:b + 1] - base)
                n = np.diff(first)
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = np.flatnonzero(vocabulary[at] == hashes)
                doc = np.repeat(np.arange(b - a), n)[known]
                pair, count = np.unique(doc * len(vocabulary) + at[known], return_counts=True)
                bounds = np.searchsorted(pair, np.arange(b - a + 1) * len(vocabulary)).astype(np.int32)
                ids = batch.column(0).slice(a, b - a)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32)))
                         for x in (pair % len(vocabulary), count)]
                yield pa.RecordBatch.from_arrays([ids, ids.is_null(), pa.array(n.astype(np.int64)), *lists],
                                                 names=["doc_id", "no_id", "n", "terms", "counts"]) \
                    .filter(pa.array(n > 0))
    return run


def _frequencies(size: int):
    """(term, df) sums of a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        have = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(df[have])], names=["term", "df"])
    return run


@dataclass
class Shard:
    """Impact-sorted lists: those of term t are ``doc[first[t]:first[t + 1]]`` with ``impact``, best first."""

    ids: np.ndarray
    base: np.ndarray      # least impact of one occurrence, without the term's weight
    first: np.ndarray
    doc: np.ndarray
    impact: np.ndarray


def build_shard(ids: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray,
                weight: np.ndarray, documents: int, length: int) -> Shard:
    m = 10 + (90 * n * documents) // length
    impact = weight[term] * ((10 ** 9 * tf) // (1000 * tf + 8 * m[doc]))
    by = np.lexsort((doc, -impact, term))
    return Shard(ids, 10 ** 9 // (1000 + 8 * m), np.searchsorted(term[by], np.arange(len(weight) + 1)), doc[by], impact[by])


def nra(shard: Shard, terms: np.ndarray, weight: np.ndarray, best: list[tuple[int, int]], k: int) -> tuple[list, int]:
    """The k best (-score, id) of ``best`` and the shard's documents; and how many postings were read."""
    terms = terms[(shard.first[terms + 1] > shard.first[terms]) & (weight[terms] > 0)]
    if not len(terms):
        return best, 0
    at, end = shard.first[terms].copy(), shard.first[terms + 1]
    lower = np.zeros(len(shard.ids), np.int64)
    met_doc: list[np.ndarray] = []
    met_list: list[np.ndarray] = []
    step = FIRST_READ
    while True:
        for i, (a, e) in enumerate(zip(at.tolist(), end.tolist(), strict=True)):
            b = min(a + step, e)
            if b > a:
                # a document is in a list once
                lower[shard.doc[a:b]] += shard.impact[a:b]
                met_doc.append(shard.doc[a:b])
                met_list.append(np.full(b - a, i))
                at[i] = b
        step *= 2
        front = np.where(at < end, shard.impact[np.minimum(at, len(shard.impact) - 1)], 0)
        seen = np.flatnonzero(lower)
        top = lower[seen] if len(seen) <= k else -np.partition(-lower[seen], k - 1)[:k]
        kth = sorted([-int(x) for x in top] + [s for s, _ in best])[:k]
        least = -kth[k - 1] if len(kth) == k else 0
        # what a document may still get: the fronts not below its least impact, but those of lists it was met in
        reach = front // weight[terms]
        by = np.argsort(-reach, kind="stable")
        upto = np.concatenate([[0], np.cumsum(front[by])])
        open_ = upto[np.searchsorted(-reach[by], -shard.base, "right")]
        doc, of = np.concatenate(met_doc), np.concatenate(met_list)
        counts = reach[of] >= shard.base[doc]
        open_ = open_ - np.bincount(doc[counts], weights=front[of[counts]], minlength=len(lower)).astype(np.int64)
        may = seen[lower[seen] + open_[seen] >= least]
        if (front.sum() < max(least, 1)) and not open_[may].any():
            break
    found = [(-s, i) for s, i in zip(lower[may].tolist(), shard.ids[may].tolist(), strict=True)]
    return sorted(best + found)[:k], len(doc)


def _ranked(items: list[np.ndarray], weight: np.ndarray, documents: int, length: int, k: int, shard_postings: int):
    """Postings to the task's k best documents of each item: (item, doc_id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[pa.RecordBatch] = []

        def search():
            rows = pa.Table.from_batches(held).combine_chunks()
            lists = rows.column("terms").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            ids = np.where(rows.column("no_id").to_numpy(), _NO_ID, rows.column("doc_id").fill_null(0).to_numpy())
            shard = build_shard(ids, rows.column("n").to_numpy(), np.repeat(np.arange(len(ids)), size),
                                lists.flatten().to_numpy(), rows.column("counts").combine_chunks().flatten().to_numpy()
                                .astype(np.int64), weight, documents, length)
            for i, terms in enumerate(items):
                best[i], _ = nra(shard, terms, weight, best[i], k)

        postings = 0
        for batch in batches:
            # a long batch is several shards, a short one part of a shard
            ends = np.cumsum(batch.column("terms").value_lengths().to_numpy())
            a = 0
            while a < batch.num_rows:
                before = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, before + shard_postings - postings, "right")))
                held.append(batch.slice(a, b - a))
                postings += int(ends[b - 1]) - before
                a = b
                if postings >= shard_postings or a < batch.num_rows:
                    search()
                    held, postings = [], 0
        if held:
            search()
        out = [(i, None if d == _NO_ID else d, -s) for i, found in enumerate(best) for s, d in found]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)],
                names=["item", "doc_id", "score"])
    return run


def _blocks(terms: list[np.ndarray], limit: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(terms):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(terms):
        yield start, len(terms)


def _search_block(docs: DataFrame, terms: list[np.ndarray], k: int, shard_postings: int) -> DataFrame | None:
    vocabulary = np.unique(np.concatenate(terms))
    if not len(vocabulary):
        return None
    postings = materialise(docs.mapInArrow(_index(vocabulary), _POSTINGS), "search-postings")
    documents, length = postings.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    counted = postings.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, df long") \
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in counted:
        weight[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
    items = [np.searchsorted(vocabulary, t) for t in terms]
    return postings.mapInArrow(_ranked(items, weight, documents, length, k, shard_postings),
                               "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, terms_per_block: int = TERMS_PER_BLOCK,
           shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of every row of ``items(item_id, text)``."""
    spark = shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = items.select("item_id", F.col("text").cast("string").alias("text")).collect()
    terms = item_terms([q["text"] for q in queries])
    names = spark.createDataFrame([(i, q["item_id"]) for i, q in enumerate(queries)],
                                  f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    found = None
    for a, b in _blocks(terms, terms_per_block):
        part = _search_block(docs, terms[a:b], k, shard_postings)
        if part is not None:
            part = part.withColumn("item", F.col("item") + a)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


#: DuckDB SQL of ``search(documents, benchmark)``: every document scored.
SQL = rf"""
WITH held AS (
    SELECT r, doc_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents)),
asked AS (
    SELECT DISTINCT q, item_id, term FROM (
        SELECT q, item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS q, item_id, text FROM benchmark))),
lengths AS (
    SELECT r, count(*) AS n FROM held GROUP BY r),
totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths),
counts AS (
    SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM held
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM totals) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts GROUP BY term),
scores AS (
    SELECT a.q, a.item_id, c.r, c.doc_id, CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf
        + 8 * (100 - 90 + (90 * l.n * (SELECT docs FROM totals)) // (SELECT len FROM totals))))) AS BIGINT) AS score
    FROM asked a JOIN counts c ON a.term = c.term JOIN weights w ON a.term = w.term JOIN lengths l ON c.r = l.r
    GROUP BY a.q, a.item_id, c.r, c.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0) WHERE rank <= {K}
"""
