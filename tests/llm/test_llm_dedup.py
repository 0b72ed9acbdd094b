"""Line dedup and near-duplicates against brute force."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from coclick.llm import linededup as L
from coclick.llm import neardup as N
from coclick.llm.components import min_labels

STRIP = " \t\n\x0b\x0c\r"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def lines_by_hand(rows, least_docs=5):
    holders = defaultdict(set)
    key = lambda x: lower(x.strip(STRIP))
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(holders[key(x)]) < least_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def lines_by_spark(docs):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"],
                    hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in L.dedup_lines(docs).collect()), key=str)


def test_line_dedup_equals_brute_force(documents, messy, nothing):
    for docs in (documents, messy):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert lines_by_spark(docs) == lines_by_hand(rows)
    assert L.dedup_lines(nothing).collect() == []
    assert L.dedup_lines(messy, counted=False).columns == messy.columns


def index_rows(index):
    return (sorted(map(tuple, index.counts.select("k1", "k2", "n_docs", "last_doc").collect())),
            sorted(map(tuple, index.holders.collect())))


def test_index_is_incremental_and_reversible(documents):
    docs = documents.select("doc_id", "text")
    half, rest = docs.where("doc_id < 120"), docs.where("doc_id >= 120")
    first = L.insert(None, half, keys_per_shard=100)
    both = L.insert(first, rest)
    whole = L.insert(None, docs)
    assert index_rows(both) == index_rows(whole)
    assert index_rows(L.insert(both, half)) == index_rows(both)
    assert index_rows(L.delete(both, rest.select("doc_id"))) == index_rows(first)
    empty = L.delete(first, half.select("doc_id"))
    assert index_rows(empty) == ([], [])
    assert all(not np.frombuffer(r["slots"], np.uint16).any() for p in empty.parts for r in p.filters.collect())
    # what the filters know is what the counts hold
    for part in both.parts:
        assert part.shards == max(1, -(-part.counts.count() // (100 if part is both.parts[0] else L.KEYS_PER_SHARD)))
        for r in part.filters.collect():
            f = L.CuckooFilter.loads(r["slots"])
            keys = [x["k1"] for x in part.counts.where(f"shard = {r['shard']}").collect()]
            assert f.contains(np.array(keys, np.int64)).all() and (f.slots > 0).sum() == len(keys)


def test_filters_choose_the_keys_that_are_joined(documents, monkeypatch):
    docs = documents.select("doc_id", "text")
    index = L.insert(L.insert(None, docs.where("doc_id % 2 = 0")), docs.where("doc_id % 2 = 1"), new_ids=True)
    want = index_rows(L.insert(None, docs))
    assert index_rows(index) == want
    # filters that know nothing: keys of both parts are counted twice over, apart
    empty = [L.LinePart(p.holders, p.counts, p.filters.selectExpr("shard", "CAST(repeat('\\0', 64) AS BINARY) AS slots"), p.shards)
             for p in index.parts]
    blind = L.LineIndex(empty)
    assert blind.counts.count() > len(want[0]) and index_rows(blind) != want
    # insertions beyond the limit merge the parts, with as many shards as the keys need
    monkeypatch.setattr(L, "MOST_PARTS", 2)
    more = L.insert(index, docs.where("doc_id < 30"), keys_per_shard=100)
    assert len(more.parts) == 2 and more.parts[0].shards > 5 and index_rows(more) == want


def test_a_hot_line_is_met_in_pieces(documents):
    docs = documents.select("doc_id", "text")
    index = L.insert(None, docs)
    rows = lambda d: sorted((r["doc_id"], sorted(map(tuple, r["keys"]))) for r in d.collect())
    split = L.losing(index, holders_per_piece=7)
    assert "__a" in split._jdf.queryExecution().optimizedPlan().toString()
    assert rows(split) == rows(L.losing(index))


def test_cuckoo_filter():
    rng = np.random.Generator(np.random.PCG64(1))
    keys = rng.integers(-2 ** 62, 2 ** 62, 20_000)
    f = L.CuckooFilter.for_keys(len(keys))
    assert f.insert(keys) and f.contains(keys).all()
    assert f.contains(rng.integers(-2 ** 62, 2 ** 62, 50_000)).mean() < 0.001
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all() and f.contains(keys[:10_000]).mean() < 0.01
    assert not L.CuckooFilter(2).insert(keys[:100])


def near_by_hand(rows, shingle=4, percent=80):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets.append(frozenset(tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)) if len(w) >= shingle
                    else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i), d) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def near_by_spark(docs, **kw):
    return sorted(map(tuple, N.near_duplicates(docs, **kw).collect()), key=str)


def test_near_duplicates_equal_brute_force(documents, messy, nothing):
    for docs in (documents, messy):
        assert near_by_spark(docs) == near_by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert near_by_spark(nothing) == []


def test_chains_and_crowds_keep_every_link(spark, generator):
    rng, prose = random.Random(5), generator[1]
    rows, base = [], prose(rng, 120).split()
    for i in range(60):             # copies of one text, edited more and more: a chain
        base[rng.randrange(120)] = f"w{i}"
        rows.append((i, " ".join(base)))
    common = prose(rng, 60)
    for i in range(60, 140):        # many texts share half of their words
        rows.append((i, common + " " + " ".join(f"u{i}x{k}" for k in range(rng.randint(5, 60)))))
    rng.shuffle(rows)
    want = near_by_hand(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_by_spark(docs) == want
    assert near_by_spark(docs, block=3) == want


def test_signature_estimates_likeness():
    rng = np.random.Generator(np.random.PCG64(2))
    x = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    for share in (0.5, 0.8):
        n = int(3000 * share)
        a, b = x, np.concatenate([x[:n], rng.integers(0, 2 ** 63, 3000 - n, dtype=np.uint64)])
        s = N.circulant_signatures(np.concatenate([a, b]), np.array([0, 3000, 6000]), 512)
        assert abs((s[0] == s[1]).mean() - n / (6000 - n)) < 0.08


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["label"] for r in min_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert min_labels(spark.createDataFrame([], "a long, b long")).collect() == []
