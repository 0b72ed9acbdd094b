"""Token files and packing against the tokenizer itself."""
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coclick.llm import packing, tokenfile
from coclick.llm.tokens import END_ID, WordEncoder, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [END_ID]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = ["don't stop 12 3a", "x<|endoftext|>y <|startoftext|>", "a\x1cb\x85c\xa0d e", "Σας ΟΔΟΣ İx é 日本語",
       "́ x", "", "  ", "\n\n", "it's'll 've", "ab​cd ퟿", "ſ ﬁ Ǆ ẞ", "🙂🙂 a🙂"]


def test_encoder_equals_tokenizer(plain, texts):
    e = WordEncoder(tokenizer_path(), memo_words=500)
    assert e.by_word
    for t in [*ODD, *list(texts.values())[:60]]:
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == plain(t)[:-1], t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_on_any_text(batch):
    e = test_encoder_on_any_text.__dict__.setdefault("e", WordEncoder(tokenizer_path(), memo_words=50))
    got = [np.frombuffer(x, "<u4").tolist() for x in e.encode(batch)]
    assert got == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in batch]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    e = WordEncoder(tokenizer_path(name))
    t = "two  words\nand a line"
    assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_token_files_round_trip(documents, texts, plain):
    got = tokenfile.read_token_files(tokenfile.write_token_files(documents, rows_per_bucket=37)).collect()
    want, start = [], 0
    for i in sorted(texts):
        ids = plain(texts[i])
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got)) == want


def test_token_files_of_messy_rows(messy, nothing, plain):
    rows = sorted(((r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for i, t in rows:
        ids = plain(t)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    for per in (4, 1000):
        got = tokenfile.read_token_files(tokenfile.write_token_files(messy, rows_per_bucket=per)).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert tokenfile.read_token_files(tokenfile.write_token_files(nothing)).collect() == []


def check_packing(rows, ids_of, window):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= window
    for i, own in by_doc.items():
        if i not in ids_of:
            continue
        ids, at = ids_of[i], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == crc(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    return sum(r["length"] for r in rows) / (len(by_seq) * window)


def test_packing_covers_every_id_once(documents, texts, plain):
    rows = packing.pack_documents(documents).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert check_packing(rows, {i: plain(t) for i, t in texts.items()}, packing.WINDOW) > 0.9
    small = packing.pack_documents(documents, window=100, per_group=50).collect()
    check_packing(small, {i: plain(t) for i, t in texts.items()}, 100)


def test_packing_of_messy_rows(messy, nothing, plain):
    rows = packing.pack_documents(messy).collect()
    once = messy.groupBy("doc_id").count().where("count = 1 and doc_id is not null").join(messy, "doc_id").collect()
    check_packing(rows, {r["doc_id"]: plain(r["text"]) for r in once}, packing.WINDOW)
    assert sum(r["length"] for r in rows) == sum(len(plain(r["text"])) for r in messy.collect())
    assert packing.pack_documents(nothing).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_segment_tree_finds_the_tightest_window(lengths):
    number, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    room, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - lengths[i])
        else:
            room.append(64 - lengths[i])
        want[i] = 64 - (min(fits) if fits else 64)
    assert offset.tolist() == [want[i] for i in range(len(lengths))]
    assert len(set(number.tolist())) == len(room)
