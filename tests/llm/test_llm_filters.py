"""Fingerprints, quality rules, extraction, classifiers and mixing against brute force or held-out truth."""
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from coclick.llm import catalog, extract, fingerprint, mixing, order, ordinal, perplexity, toxicity

SF = "/root/testdata/sf0.001"


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


@pytest.mark.parametrize("per", [5, 64, 10_000])
def test_edit_probe_takes_the_next_document(messy, documents, nothing, per):
    for docs in (messy, documents):
        rows = in_order([tuple(r) for r in docs.select("doc_id", "text").collect()])
        want = []
        for k, (i, t) in enumerate(rows):
            t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
            cut = len(t) // 2
            e = t[:len(t) - cut] + following[:cut]
            s = fingerprint.signatures([t, e, following])
            want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), s[0].astype(">u4").tobytes().hex(),
                         s[1].astype(">u4").tobytes().hex(), float((s[0] == s[1]).mean()), float((s[0] == s[2]).mean())))
        got = [tuple(r) for r in fingerprint.edit_probe(docs, rows_per_bucket=per).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert fingerprint.edit_probe(nothing).collect() == []


def whole_by_hand(text, k, keep, size):
    """Order MinHash over every occurrence-numbered k-mer, from the definition of each order."""
    if not text:
        return [0] * size
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kmer, _ = fingerprint._kmers(points, np.array([0, len(points)]), k)
    seen, occ = Counter(), []
    for h in kmer.tolist():
        occ.append(seen[h])
        seen[h] += 1
    element = fingerprint.mix(kmer + fingerprint.mix(np.array(occ, np.uint64) + np.uint64(1)))
    out = []
    for d in range(size):
        lead = fingerprint.mix(element ^ fingerprint._ORDERS[1, d - d % 8]) >> np.uint64(8 * (d % 8)) & np.uint64(255)
        rank = (element ^ fingerprint._ORDERS[0, d]) * fingerprint._ORDERS[1, d]
        rank = ((rank ^ rank >> np.uint64(32)) * fingerprint._ORDERS[0, d]) >> np.uint64(34)
        chosen = sorted(sorted(range(len(kmer)), key=lambda i: (int(lead[i]), int(rank[i]), i))[:keep])
        chosen += [chosen[-1]] * (keep - len(chosen))
        h = np.full(1, keep, np.uint64)
        for i in chosen:
            h = fingerprint.mix(h * np.uint64(0x9E3779B97F4A7C15) + kmer[i:i + 1])
        out.append(int(h[0] >> np.uint64(32)) | 1)
    return out


def test_registered_fingerprints_rank_every_kmer(spark, texts):
    some = ["", "a", "ab" * 40, "abcdefghijkl", "abcdefghijklm", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "né" * 9, "",
            *[t[:n] for t, n in zip(list(texts.values())[:20], [30, 100, 1000, 13] * 5, strict=True)]]
    got = fingerprint.signatures(some, size=19)
    assert [r.tolist() for r in got] == [whole_by_hand(t, fingerprint.KMER, fingerprint.KEEP, 19) for t in some]
    rows = catalog.op1_order_minhash(spark, SF).limit(200).collect()
    want = fingerprint.signatures([texts[r["doc_id"]] for r in rows])
    assert [r["fingerprint"] for r in rows] == [w.astype(">u4").tobytes().hex() for w in want]


def test_one_changed_character_shows():
    rng = random.Random(8)
    a = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(1500)) for _ in range(150)]
    at = [rng.randrange(1500) for _ in a]
    b = [t[:i] + "#" + t[i + 1:] for t, i in zip(a, at, strict=True)]
    same = (fingerprint.signatures(a) == fingerprint.signatures(b)).all(axis=1).mean()
    assert same < 0.15, same


def test_signatures_of_edited_texts_need_no_second_look(texts):
    some = ["", "a", "ab", "", "abcdefghijklm", "a" * 30, *list(texts.values())[:40], "x" * 70_000, "né" * 9, "z"]
    changed = [fingerprint.edited(x, y) for x, y in zip(some, some[1:] + some[:1], strict=True)]
    own, other = fingerprint.edit_signatures(some, changed, [len(t) - len(t) // 2 for t in some], size=24)
    assert (own == fingerprint.signatures(some, size=24)).all()
    assert (other == fingerprint.signatures(changed, size=24)).all()


def test_order_matters(generator):
    rng, prose = random.Random(1), generator[1]
    text = prose(rng, 600)
    words = text.split()
    swapped = " ".join(words[300:] + words[:300])
    touched = " ".join(words[:590] + ["new"] * 10)
    s = fingerprint.signatures([text, swapped, touched, prose(random.Random(2), 600)], size=512)
    like = [float((s[0] == x).mean()) for x in s]
    assert like[0] == 1 and like[2] > 0.8 and 0.3 < like[1] < 0.75 and like[3] < 0.05


def rules_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many, cover, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if many[g] > 1:
            cover.update(range(i, i + 8))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover),
            len(words) < 20 or 100 * len(cover) > 30 * len(words))


def characters_by_hand(text):
    text = re.sub(r"([!-/:-@\[-`{-~])\1+", lambda m: m[0] if m[1] in ".," else m[1],
                  re.sub(r"[0-9]", "0", re.sub(r"[\x00-\x20]", " ", text)))
    return [ord(x) if ord(x) < 65536 else 0xE000 + ord(x) % 6400 for x in text]


def kn_by_hand(texts):
    """Modified Kneser-Ney over character 4-grams, counted in the other texts, straight from the definition."""
    holders, per = Counter(), []
    for t in texts:
        c = [0, 0, 0, *characters_by_hand(t)]
        own = [tuple(c[i:i + 4]) for i in range(len(c) - 3)]
        holders.update(set(own))
        per.append(own)
    tables = {4: {g: n - 1 for g, n in holders.items() if n > 1}}
    for k in (3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts, heads = {}, {}
    for k, table in tables.items():
        n = [sum(c == i for c in table.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        cuts[k] = [0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) if n[i - 1] else 0.5
                         for i in (1, 2, 3)]
        heads[k] = defaultdict(list)
        for g, c in table.items():
            heads[k][g[:-1]].append(c)

    def p(g):
        if not g:
            return 1 / 65536
        k = len(g)
        own = heads[k].get(g[:-1])
        if not own:
            return p(g[1:])
        c = tables[k].get(g, 0)
        lost = sum(cuts[k][min(x, 3)] for x in own)
        return (c - cuts[k][min(c, 3)] + lost * p(g[1:])) / sum(own)

    return [-sum(math.log(p(g)) for g in own) for own in per]


def test_model_in_many_files(spark, documents, monkeypatch):
    model = perplexity.kneser_ney(perplexity.count_grams(documents)).cache()
    monkeypatch.setattr(perplexity, "ENTRIES_PER_FILE", 3000)
    files = perplexity.write_model(model)
    assert len(files) > 5
    grams = np.array([r["gram"] for r in model.where("k = 4").limit(4000).collect()] + list(range(50)), np.int64).view(np.uint64)
    monkeypatch.setattr(perplexity, "ENTRIES_PER_FILE", 10 ** 9)
    one = perplexity.write_model(model)
    assert len(one) == 1
    assert (perplexity.log_chances(files, grams) == perplexity.log_chances(one, grams)).all()
    by = {r["gram"]: r["value"] for r in model.where("k = 4").collect()}
    got = perplexity.log_chances(one, grams)
    assert all(abs(v - by[g]) < 1e-5 for g, v in zip(grams.view(np.int64).tolist(), got.tolist(), strict=True) if g in by)


def test_the_model_grows_with_the_corpus(spark, documents):
    some = perplexity.count_grams(documents.limit(60)).count()
    assert some < 0.8 * perplexity.count_grams(documents).count()


def verdicts_by_hand(rows, surprise, size):
    """Whether each row is in its language's band; (id, text, lang) rows that pass the base rules or not."""
    quantile = lambda v: [v[max(math.ceil(q * len(v)) - 1, 0)] for q in np.arange(101) / 100]

    def half(v):
        q = quantile(sorted(v))
        return min((q[i + 50] - q[i], q[i], q[i + 50]) for i in range(51))

    out = {}
    for la in {r[2] for r in rows}:
        here = [i for i, r in enumerate(rows) if r[2] == la and size[i]]
        if not here:
            continue
        mean = {i: surprise[i] / size[i] for i in here}
        _, a, b = half(mean.values())
        apart = {i: (mean[i] - (a + b) / 2) * math.sqrt(size[i] / (size[i] + perplexity.PRIOR_CHARS)) for i in here}
        _, a, b = half(apart.values())
        spread = max((b - a) * perplexity.HALF_TO_TENTH, perplexity.LEAST_SPREAD)
        for i in here:
            out[i] = (a + b) / 2 - perplexity.LOWER * spread - apart[i], apart[i] - (a + b) / 2 - perplexity.UPPER * spread
    return out


def test_quality_rules(documents, messy, nothing):
    for docs in (messy, documents):
        rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
        got = perplexity.quality_rules(docs).collect()
        assert sorted((tuple(r)[:7] for r in got), key=str) == \
            sorted(((i, *rules_by_hand(t)) for i, t, _ in rows), key=str)
        assert not any(r["kept"] and r["base_failed"] for r in got)
    assert perplexity.quality_rules(nothing).collect() == []
    # the pooled perplexity of each text, and the verdict of its language's band
    rows = [(i, t or "", la) for i, t, la in rows]
    lost = kn_by_hand([t for _, t, _ in rows])
    size = [len(characters_by_hand(t)) for _, t, _ in rows]
    value, median = {}, {}
    for la in {r[2] for r in rows}:
        own = sorted(s / n for s, n, r in zip(lost, size, rows, strict=True) if r[2] == la and n)
        median[la] = own[math.ceil(len(own) / 2) - 1]
    for s, n, (i, _, la) in zip(lost, size, rows, strict=True):
        value[i] = (s + median[la] * perplexity.PRIOR_CHARS) / (n + perplexity.PRIOR_CHARS) if n else None
    for r in got:
        assert (r["log_perplexity"] is None) == (value[r["doc_id"]] is None)
        assert r["log_perplexity"] is None or abs(r["log_perplexity"] - value[r["doc_id"]]) < 1e-4
    # the verdict, but for rows within rounding of a bound
    outside = verdicts_by_hand(rows, lost, size)
    failed = {r["doc_id"]: r["base_failed"] for r in got}
    kept = {r["doc_id"]: r["kept"] for r in got}
    sure = 0
    for i, (name, _, _) in enumerate(rows):
        if i in outside and max(outside[i]) > -1e-4 and max(outside[i]) < 1e-4:
            continue
        sure += 1
        assert kept[name] == (not failed[name] and i in outside and max(outside[i]) < 0), name
    assert sure > 0.95 * len(rows) and 0 < sum(kept.values()) < sum(not f for f in failed.values())


def test_quality_rules_keep_good_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = perplexity.quality_rules(docs).join(labels, "doc_id").collect()
    good = [x["kept"] for x in r if x["quality"] and x["n_words"] >= 20 and not x["base_failed"]]
    assert np.mean(good) > 0.99
    assert np.mean([x["kept"] for x in r if not x["quality"]]) < 0.1


@pytest.mark.parametrize("low", [False, True])
def test_quality_bands_hold_with_a_third_of_junk(spark, low):
    """35 % junk on one side of one language, texts of 25 to 200 words; the other languages as they are."""
    rng = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [tuple(r) for r in docs if labels.get(r["doc_id"], 1)]
    words = [w for _, t, la in rows if la == "en" for w in t.split()]
    few = ["the", "that", "then", "they", "there", "these", "than"]
    n = round(sum(la == "en" for _, _, la in rows) * 35 / 65)
    junk = [" ".join(rng.choice(few) if low else rng.choice(words).upper() + rng.choice(["$#", "#%", "&*", "%$"])
                     for _ in range(rng.randint(25, 200))) for _ in range(n)]
    rows += [(10 ** 9 + i, t, "en") for i, t in enumerate(junk)]
    got = perplexity.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    bad = [r["kept"] for r in got if r["doc_id"] >= 10 ** 9 and not r["base_failed"]]
    good = [r["kept"] for r in got if labels.get(r["doc_id"]) and not r["base_failed"]]
    assert len(bad) > 0.3 * n and np.mean(bad) < 0.1 and np.mean(good) > 0.98


PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<header><a href="/">Home</a></header><nav><ul><li><a href=a>Menu one</a><li><a href=b>Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies to improve this site for you.</div>
%s
<div id="comments"><p>First reader comment, with many words that could look like an article.</p></div>
<aside><p>Read also these other articles about the same subject.</p></aside>
<form><label>Mail</label><input name=x><button>Send</button></form>
<footer>&copy; 2020 somebody</footer><script>var a = "<p>no</p>";</script></body></html>"""
BODY = ["A heading", "First paragraph with a <b>bold</b> word, an <a href=x>entity &lt;tag&gt;</a> and\n  some more text.",
        "Second one, a little shorter.", "Third: caf&eacute; &#8212; d&#x27;accord, and then it goes on for some words."]
WANT = "A heading\nFirst paragraph with a bold word, an entity <tag> and some more text.\n" \
    "Second one, a little shorter.\nThird: café — d'accord, and then it goes on for some words."


@pytest.mark.parametrize("frame", [
    "<article><h1>{}</h1><p>{}</p><div class=ad>Buy now!</div><p>{}</p><p>{}</p></article>",
    "<main><article><h1>{}</h1><p>{}<p>{}<p>{}</article></main>",
    "<div class='post-content'><h1>{}</h1><p>{}</p><p>{}</p><p>{}</p></div>"])
def test_main_text_of_a_page(frame):
    assert extract.main_text(PAGE % frame.format(*BODY)) == WANT


@pytest.mark.parametrize("before, inside", [
    ("<head><title>x</title><meta charset=utf-8>", ""), ("<head><title>x</title></head>", ""), ("<head>\n", ""),
    ("<svg viewBox='0 0 1 1'/>", ""), ("<svg><path d='M0'>", ""), ("<object data=x>", ""), ("<noscript>", ""),
    ("<template>", ""), ("<select><option>one<option>two", ""), ("<select-box>", ""), ("<svg-icon name=x>", ""),
    ("<title-bar></title-bar>", ""), ("<script>var a = '<p>'</script x>", ""),
    ("", "<svg><title>t</title><text>no</text></svg>"), ("", "<select><option>no<option>not this</select>"),
    ("", "<noscript><div>no</div><p>script</noscript>"), ("", "<template><p>no</p></template>"),
    ("", "<svg><foreignObject><div>no</div></foreignObject></svg>"), ("", "<style>p::after { content: '<b>' }</style>")])
def test_hidden_elements_end_where_browsers_end_them(before, inside):
    first, *rest = BODY[1:]
    page = f"<html>{before}<body>{before}<article><h1>{BODY[0]}</h1><p>{first}</p>" \
        f"<p>{rest[0].replace(', ', ', ' + inside, 1)}</p><p>{rest[1]}</p></article></body></html>"
    assert extract.main_text(page) == WANT


def test_text_of_an_object_is_not_content():
    frame = "<article><h1>{}</h1><p>{}</p><object data=x><p>No reader for this kind of file.</p></object><p>{}</p><p>{}</p></article>"
    assert extract.main_text(PAGE % frame.format(*BODY)) == WANT


def test_minimum_cut_equals_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 7)
        odds = [rng.uniform(-2, 2) for _ in range(n)]
        ties = {(i, j): rng.uniform(0, 1.5) for i in range(n) for j in range(i) if rng.random() < 0.6}
        net = extract.FlowNetwork(n + 2)
        for i, o in enumerate(odds):
            net.edge(n, i, max(0, o))
            net.edge(i, n + 1, max(0, -o))
        for (i, j), w in ties.items():
            net.edge(i, j, w, w)
        cost = lambda x: sum(max(0, o) if not y else max(0, -o) for o, y in zip(odds, x, strict=True)) + \
            sum(w for (i, j), w in ties.items() if x[i] != x[j])
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert abs(cost(net.source_side(n, n + 1)[:n]) - best) < 1e-9


@pytest.mark.parametrize("page,chars", [
    ("<div>" * 100_000 + "t", None), ("<div>t " * 100_000, None), ("<b>x " * 100_000, None), ("<b>" * 100_000 + "<p>y" * 100_000, None),
    ("<li>x" * 100_000, None), ("<div>" * 100_000 + "</b>" * 100_000, 0), ("<svg>" * 100_000, 0), ("<!--" * 250_000, 0),
    ("<a " * 340_000, None), ("<a '" * 250_001 + '">', None), ("<a<a" * 250_000, None), ("<script>" + "</script " * 110_000, 0),
    ("<select>" * 60_000 + "</select>", 0), ("&" * 1_000_000, None)])
def test_broken_pages_take_linear_time(page, chars):
    start = time.process_time()
    text = extract.main_text(page)
    assert time.process_time() - start < 15 and (chars is None or len(text) == chars)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in extract.extract_pages(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer|\Z)", r["html"], re.S)[1]
        body = re.sub(r"</?(h1|p)>", "\x00", body)
        want = [" ".join(extract.entities.unescape(re.sub(r"<[^>]*>", " " if "br" in x else "", x)).split())
                for x in body.split("\x00")]
        assert got[r["page_id"]]["text"] == "\n".join(x for x in want if x), r["page_id"]
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
    odd = [(1, None, None), (2, "u", ""), (3, "u", "<"), (4, "u", "<p>" + "a word " * 90_000), (5, "u", "<div" * 99),
           (6, "u", "no tags at all, but a sentence that is long enough to be read as text by any reader."),
           (None, "u", "<article><p>x &am"), (7, "u", "</p></p><article><h1>Hi</h1><p>there &amp")]
    rows = extract.extract_pages(spark.createDataFrame(odd, "page_id long, url string, html string")).collect()
    assert len(rows) == len(odd) and all(r["text"] is not None for r in rows)
    assert [r["text"] for r in rows][:3] == ["", "", ""] and rows[7]["text"] == "Hi\nthere &"
    assert extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    entries = sorted({(word(rng.randint(3, 11)), rng.random() < 0.3) for _ in range(25)})
    automaton = toxicity.LexiconAutomaton(entries)
    for _ in range(3000):
        w = word(rng.randint(1, 13)) if rng.random() < 0.5 else "".join(
            c for c in rng.choice(entries)[0] + word(rng.randint(0, 3)) if rng.random() > 0.1)
        near = []
        for i, (text, stem) in enumerate(entries):
            d = min(edits(text, w[:k]) for k in range(len(w) + 1)) if stem else edits(text, w)
            if d <= toxicity.allowed_edits(text, stem):
                near.append((d, i))
        want = min(near, default=None)
        got = automaton.match(w)
        assert (got and (got[1], got[0])) == want, w


def test_quoted_matches():
    quoted = lambda s: toxicity._is_quoted(s.lower().split(), s.split().index("X"))
    assert quoted('they shouted "you X there" at') and quoted("he said X to me") and quoted("« un X » de plus")
    assert not quoted("you X there") and not quoted('"a" you X there') and not quoted('this X is "marked" here')


def test_toxicity_on_held_out_rows(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    out = [r for r in rows if r["held_out"]]
    hit = [r["predicted"] for r in out if r["toxic"]]
    assert np.mean(hit) > 0.75 and np.mean([r["predicted"] for r in out if not r["toxic"]]) < 0.03
    few = messy.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic")
    assert toxicity.toxicity_scores(messy, few).count() == messy.count()
    none = toxicity.toxicity_scores(messy, few.where("false")).collect()
    assert len(none) == messy.count() and {r["score"] for r in none} == {0.0}
    assert toxicity.toxicity_scores(nothing, few).collect() == []


def test_ordinal_quality_on_held_out_rows(spark, messy, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = ordinal.train(docs, labels.where("doc_id % 3 <> 0"))
    assert (np.diff(model[1]) > 0).all()
    rows = ordinal.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"]]
    assert np.mean(good) > 0.97 and np.mean([r["kept"] for r in rows if not r["quality"]]) < 0.2
    assert all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in rows)
    few = messy.selectExpr("doc_id", "cast(doc_id % 2 as int) quality", "cast(null as int) toxic")
    assert ordinal.rate_documents(messy, few).count() == messy.count()
    assert ordinal.select_documents(messy, few).columns == messy.columns
    assert ordinal.select_documents(messy, few.where("false")).count() == messy.count()
    assert ordinal.rate_documents(nothing, few).collect() == []


def test_ordinal_gradient_recovers_grades():
    rng = np.random.Generator(np.random.PCG64(3))
    x = rng.normal(size=(3000, 4))
    w, cut = np.array([1.5, -1.0, 0.0, 0.5]), np.array([-0.5, 1.0])
    z = x @ w + rng.logistic(size=3000)
    got_w, got_cut = ordinal.fit(x, (z[:, None] > cut).sum(axis=1), np.ones(3000), 3)
    assert np.abs(got_w - w).max() < 0.2 and np.abs(got_cut - cut).max() < 0.2


def test_mixing_counts_and_shares(spark, messy, nothing, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = mixing.mix_sources(documents).select("doc_id", "copy", "n_copies", "rate", "shuffle_key")
    want = con.execute(f"SELECT doc_id, copy, n_copies, rate, shuffle_key FROM ({catalog.ORACLE['op8_poisson_mixing']})")
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    big = spark.range(40_000).selectExpr("id doc_id", "'abcd' text", "if(id % 4 = 0, 'x', 'y') source")
    weights = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("z", 9.0)], "source string, weight double")
    counts = {r["source"]: r["count"] for r in mixing.mix_sources(big, weights).groupBy("source").count().collect()}
    assert abs(counts["x"] - 30_000) < 700 and abs(counts["y"] - 10_000) < 400
    mixed = mixing.mix_sources(messy, spark.createDataFrame([("a", 1.0)], weights.schema))
    assert {r["source"] for r in mixed.collect()} == {"a"} and mixed.columns[:4] == ["doc_id", "text", "lang", "source"]
    assert mixing.mix_sources(messy, counted=False).columns == messy.columns
    assert mixing.mix_sources(nothing).collect() == []


def test_mixing_joins_many_sources_salted(documents, monkeypatch):
    want = sorted(map(tuple, mixing.mix_sources(documents).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ENTRIES", 0)
    assert sorted(map(tuple, mixing.mix_sources(documents).collect())) == want


def test_poisson_inverse(spark):
    big = spark.range(60_000).selectExpr("id doc_id", "'abcd' text", "'s' source").unionByName(
        spark.createDataFrame([(-1, "x" * 2_399_999, "t")], "doc_id long, text string, source string"))
    weights = spark.createDataFrame([("s", 3.0), ("t", 1.0)], "source string, weight double")
    rate = mixing.source_rates(big, weights).where("source = 's'").first()["rate"]
    counts = Counter(r["n_copies"] for r in mixing.mix_sources(big, weights).where("source = 's' and copy = 1").collect())
    counts[0] = 60_000 - sum(counts.values())
    for k in range(9):
        p = math.exp(-rate) * rate ** k / math.factorial(k)
        assert abs(counts[k] / 60_000 - p) < 5 * math.sqrt(p / 60_000) + 1e-4


def test_buckets_cover_ids_in_order(documents):
    bounds = order.id_bounds(documents, 16)
    placed = order.with_buckets(documents, bounds, look_ahead=True).select("bucket", "ahead", "doc_id").collect()
    own = sorted((r["bucket"], r["doc_id"]) for r in placed if not r["ahead"])
    assert [d for _, d in own] == sorted(d for _, d in own) and len(own) == documents.count()
    assert max(Counter(b for b, _ in own).values()) <= 40
    assert sorted(r["doc_id"] for r in placed if r["ahead"]) == bounds
