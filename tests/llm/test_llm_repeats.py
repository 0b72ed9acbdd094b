"""Removal of repeated byte windows against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from coclick.llm import repeats as R


def removed_by_hand(texts, length):
    """(n_bytes, n_removed, n_spans, kept digest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def both(docs, length, **kw):
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], *w) for r, w in zip(rows, removed_by_hand([r["text"] for r in rows], length), strict=True)),
                  key=str)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
                  for r in R.remove_repeats(docs, length, **kw).collect()), key=str)
    return got, want


def test_repeats_equal_brute_force(documents, messy):
    for docs in (documents, messy):
        got, want = both(docs, 200)
        assert got == want and any(w[2] for w in want) and not all(w[2] for w in want)


@pytest.mark.parametrize("length,gram,step", [(20, 6, 4), (9, 9, 3), (30, 3, 2), (16, 8, 8)])
def test_windows_of_any_size_in_dense_repeats(spark, length, gram, step):
    rng = random.Random(length)
    # few letters, copies with edits, periodic runs: minimizers tie and runs are clipped everywhere
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    for _ in range(60):
        t = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            if t:
                t[rng.randrange(len(t))] = rng.choice("abc")
        texts.append("".join(t)[rng.randint(0, 10):])
    texts += ["a" * 90, "ab" * 45, "é" * 50, "x" * length, "y" * (length + 1), None, ""]
    docs = spark.createDataFrame([(i % 100, t, "clash", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, kept string, start long").repartition(4)
    got, want = both(docs, length, gram=gram, step=step)
    assert got == want


def test_long_texts_are_read_in_pieces(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(R.PIECE + 5000))
    copy = long[R.PIECE - 3000:R.PIECE + 1000]
    docs = spark.createDataFrame([(1, long), (2, "other " + copy), (3, copy[100:700] + "z")], "doc_id long, text string")
    out = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept"]) for r in R.remove_repeats(docs).collect()}
    assert out[1] == (4000, 1, (long[:R.PIECE - 3000] + long[R.PIECE + 1000:]).encode())
    assert out[2] == (4000, 1, b"other ") and out[3] == (600, 1, b"z")


def test_many_picked_documents_are_joined_by_a_shuffle(documents, monkeypatch):
    want = sorted(tuple(r) for r in R.remove_repeats(documents).select("doc_id", "n_removed", "n_spans").collect())
    monkeypatch.setattr(R, "BROADCAST_IDS", 0)
    assert sorted(tuple(r) for r in R.remove_repeats(documents).select("doc_id", "n_removed", "n_spans").collect()) == want


def test_empty_table(nothing):
    out = R.remove_repeats(nothing)
    assert out.collect() == [] and set(out.columns) >= {"doc_id", "kept", "n_bytes", "n_removed", "n_spans", "lang"}
