"""Ranked lexical search against scoring every document."""
import math
import re
from collections import Counter

import numpy as np

from coclick.llm import search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked_by_hand(docs, items, k=10):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        scores.sort(key=lambda x: x[:3])
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def ranked(docs, items, **kw):
    return sorted((tuple(r) for r in S.search(docs, items, **kw).collect()), key=str)


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_search_equals_scoring_all(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = ranked_by_hand(pairs(documents, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert len(want) > 100
    assert ranked(documents, items) == want
    # many small shards, several blocks of items, several tasks
    assert ranked(documents.repartition(3), items, shard_postings=500, terms_per_block=300) == want


def test_messy_documents_and_items(spark, messy):
    items = spark.createDataFrame([(1, "ééa the on"), (1, "one"), (None, "A b C"), (3, None), (4, ""), (5, "?! ."),
                                   (6, "below ZERO below"), (7, "x" * 5000), (8, " ".join(t[0] for t in "abcdefgh"))],
                                  "item_id int, text string")
    texts = [r["text"] for r in messy.select("text").collect() if r["text"]]
    items = items.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts[:12])], items.schema))
    want = ranked_by_hand(pairs(messy, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert ranked(messy, items) == want == ranked(messy, items, shard_postings=40)


def test_empty_tables(spark, nothing, documents):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked(nothing, items) == [] and ranked(documents, items.limit(0)) == []
    assert ranked(documents, spark.createDataFrame([(1, None)], items.schema)) == []


def test_nra_stops_early_and_keeps_ties():
    rng = np.random.Generator(np.random.PCG64(3))
    docs, terms = 20_000, 6
    doc, term = np.divmod(np.flatnonzero(rng.random(docs * terms) < 0.4), terms)
    tf = rng.geometric(0.6, len(doc))
    n = rng.integers(20, 400, docs)
    weight = np.array([6000, 5000, 40, 30, 20, 10])
    ids = rng.permutation(docs)
    shard = S.build_shard(ids, n, doc, term, tf, weight, docs, int(n.sum()))
    whole = np.zeros(docs, np.int64)
    np.add.at(whole, shard.doc, shard.impact)
    want = sorted(zip((-whole).tolist(), ids.tolist(), strict=True))[:10]
    got, reads = S.nra(shard, np.arange(terms), weight, [], 10)
    assert got == want and reads < 0.9 * len(doc)
    # equal documents: the smallest ids win
    same = S.build_shard(np.arange(50)[::-1], np.full(50, 7), np.repeat(np.arange(50), 2), np.tile([0, 1], 50),
                         np.ones(100, np.int64), np.array([9, 8]), 50, 350)
    got, _ = S.nra(same, np.arange(2), np.array([9, 8]), [], 10)
    assert [i for _, i in got] == list(range(10)) and len({s for s, _ in got}) == 1
