"""Toxicity: Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon (whole terms, and stems that many terms begin with) is learned from
labelled documents: terms and stems that stand in toxic ones far more often.
The trie of the lexicon and the Levenshtein automata of its entries are run as
one deterministic automaton that is built as words demand it: a state is a set
of (trie node, edits used); entries of 5 to 8 characters allow one edit, longer
ones two, shorter ones none.  Words that die in the automaton, which most do
after a few characters, cost no comparison with any entry.

Each entry has a weight (log-odds) for exact and one for misspelled matches,
learned from the same sample.  A match inside quotation marks, or with a word
of attribution within ``CONTEXT`` words, is quoted rather than said and counts
``QUOTED`` of its weight.  A document's features are the strongest match, the
densest window of ``WINDOW`` words and the whole sum; a logistic model of them
gives the score.

Learning uses at most ``SAMPLE`` toxic and twice as many other documents (lowest
hashes of the id) of the rows that are not held out; scoring covers all rows.
Neither labels nor lang, source or doc_id enter a score.

Defined cases: null text = empty, scored like a text without matches; labels
repeated for an id count as toxic if any is; a null id is not held out; without
toxic training rows the lexicon is empty and every score is 0; repeated rows are
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm.store import materialise, shipped

SAMPLE = 4_000
#: Least evidence (log-likelihood ratio of an entry's documents against chance) and least log-odds.
TERM_EVIDENCE, STEM_EVIDENCE = 9.0, 18.0
LEAST_ODDS = 3.0
CONTEXT, WINDOW = 6, 50
QUOTED = 0.3
PREDICT = 0.7
MEMO_WORDS, MEMO_STATES = 500_000, 200_000

#: Verbs of attribution.
ATTRIBUTION = frozenset("said says called calls wrote writes quoted quote quotes reported reportedly alleged claimed "
                        "dit disait appelle sagte schrieb nannte dijo llamó escribió".split())
_EDGE = "\"'“”„‚‘’«»‹›()[]{}<>.,;:!?…-–—*_~`#$%&|+=/\\^@"
_OPEN, _CLOSE = "“„«‹", "”»›"


def allowed_edits(entry: str, stem: bool) -> int:
    """Edits that an entry of this length allows."""
    n = len(entry) - (1 if stem else 0)
    return 0 if n < 5 else 1 if n < 9 else 2


class LexiconAutomaton:
    """Deterministic automaton of trie x Levenshtein, built lazily; see the module's notes."""

    def __init__(self, entries: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.terminal: list[list[tuple[int, bool, int]]] = [[]]  # (entry, stem, edits)
        self.most: list[int] = [0]
        for i, (text, stem) in enumerate(entries):
            edits, node = allowed_edits(text, stem), 0
            self.most[0] = max(self.most[0], edits)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.terminal.append([])
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits)
            self.terminal[node].append((i, stem, edits))
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0}, {})

    def _state(self, active: dict[int, int], stems: dict[int, int]) -> int:
        """Number of the state; -1 if nothing can be reached from it."""
        # deletions: trie characters skipped
        queue = list(active.items())
        while queue:
            node, e = queue.pop()
            if active.get(node, 99) < e:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and e + 1 < active.get(child, 99):
                    active[child] = e + 1
                    queue.append((child, e + 1))
        stems = dict(stems)
        for node, e in active.items():
            for entry, stem, edits in self.terminal[node]:
                if stem and e <= edits and e < stems.get(entry, 99):
                    stems[entry] = e
        if not active and not stems:
            return -1
        key = (tuple(sorted(active.items())), tuple(sorted(stems.items())))
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            best = min(((e, entry) for entry, e in stems.items()), default=None)
            for node, e in active.items():
                for entry, _, edits in self.terminal[node]:
                    if e <= edits and (best is None or (e, entry) < best):
                        best = (e, entry)
            self.found.append(best and (best[1], best[0]))
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        active, stems = self.sets[state]
        after: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.most[node] and e < after.get(node, 99):
                after[node] = e

        for node, e in active:
            put(node, e + 1)                                    # an extra character
            for d, child in self.children[node].items():
                put(child, e if d == c else e + 1)              # the right or a wrong one
        return self._state(after, dict(stems))

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, edits) of the closest entry that the word spells or misspells."""
        if len(self.sets) > MEMO_STATES:
            self._reset()
        state = self.start
        for c in word:
            after = self.steps[state].get(c)
            if after is None:
                after = self.steps[state][c] = self._step(state, c)
            if after < 0:
                return None
            state = after
        return self.found[state]


class _Memo(dict):
    """word -> (entry, edits) or None, bounded."""

    def __init__(self, automaton: LexiconAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str):
        if len(self) > MEMO_WORDS:
            self.clear()
        bare = word.strip(_EDGE)
        out = self[word] = self.automaton.match(bare) if len(bare) > 2 else None
        return out


def _is_quoted(words: list[str], i: int) -> bool:
    """Whether word i stands between quotation marks or near a word of attribution."""
    around = words[max(0, i - CONTEXT):i + CONTEXT + 1]
    if any(w.strip(_EDGE) in ATTRIBUTION for w in around):
        return True
    before, after = words[max(0, i - 4 * CONTEXT):i], words[i + 1:i + 1 + 4 * CONTEXT]
    own = words[i]
    opened = sum(w.count('"') for w in before) % 2 == 1 or own.startswith('"')
    if opened and (own.rstrip(".,;:!?").endswith('"') or any('"' in w for w in after)):
        return True
    left = " ".join(before) + own[:1]
    right = own[-1:] + " ".join(after)
    return max(map(left.rfind, _OPEN)) > max(map(left.rfind, _CLOSE)) and any(c in right for c in _CLOSE)


def matches(text: str | None, memo: _Memo) -> list[tuple[int, int, int, bool]]:
    """(word position, entry, edits, quoted) of every match in a text."""
    words = (text or "").lower().split()
    return [(i, *memo[w], _is_quoted(words, i)) for i, w in enumerate(words) if memo[w]]


def text_features(found: list[tuple[int, int, int, bool]], exact: np.ndarray, near: np.ndarray) -> list[float]:
    """Strongest match, densest window, log of the whole sum (weights discounted when quoted)."""
    worth = [(i, float((near if e else exact)[entry]) * (QUOTED if quoted else 1.0)) for i, entry, e, quoted in found]
    worth = [(i, v) for i, v in worth if v > 0]
    if not worth:
        return [0.0, 0.0, 0.0]
    densest, total, lo = 0.0, 0.0, 0
    for i, v in worth:
        total += v
        while worth[lo][0] <= i - WINDOW:
            total -= worth[lo][1]
            lo += 1
        densest = max(densest, total)
    return [max(v for _, v in worth), math.log1p(densest), math.log1p(sum(v for _, v in worth))]


def _is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text): bounded sample of labelled rows that are not held out."""
    marked = labels.where("doc_id is not null and toxic is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")) \
        .where(~_is_held_out("doc_id"))
    first = lambda toxic, n: marked.where((F.col("toxic") > 0) == F.lit(toxic)) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    picked = materialise(first(True, sample).unionByName(first(False, 2 * sample))
                         .select("doc_id", (F.col("toxic") > 0).alias("toxic")), "toxic-ids")
    # bounded: 3 * sample ids, one row an id
    return materialise(docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic")
                       .agg(F.min("text").alias("text")).select("toxic", "text"), "toxic-sample")


def learn_lexicon(sample: DataFrame) -> list[tuple[str, bool]]:
    """(entry, is a stem): all terms and stems typical of the toxic texts of a bounded sample."""
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not totals.get(True) or not totals.get(False):
        return []
    bare = F.lower(F.col("text"))
    words = sample.select("toxic", F.explode(F.array_distinct(F.transform(
        F.split(bare, r"[ \t-\r]+"), lambda w: F.btrim(w, F.lit(_EDGE))))).alias("word")) \
        .where(F.length("word").between(3, 40))
    odds = F.log((F.col("toxic_docs") + 0.5) / totals[True]) - F.log((F.col("other_docs") + 0.5) / totals[False])
    rate = totals[True] / (totals[True] + totals[False])
    both = F.col("toxic_docs") + F.col("other_docs")
    evidence = F.col("toxic_docs") * F.log(F.col("toxic_docs") / both / rate) + F.when(
        F.col("other_docs") > 0, F.col("other_docs") * F.log(F.col("other_docs") / both / (1 - rate))).otherwise(0.0)
    count = lambda flag: F.sum(F.col("n") * (F.col("toxic") == F.lit(flag)).cast("long"))
    counts = materialise(words.groupBy("word", "toxic").agg(F.count("*").alias("n")), "toxic-words")
    terms = counts.groupBy("word").agg(count(True).alias("toxic_docs"), count(False).alias("other_docs")) \
        .where((F.col("toxic_docs") > 0) & (evidence >= TERM_EVIDENCE)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS) \
        .collect()
    # stems: beginnings that several words share
    begun = counts.select("toxic", "n", "word", F.explode(F.expr(
        "transform(sequence(4, greatest(4, least(6, length(word) - 1))), k -> substring(word, 1, k))")).alias("stem")) \
        .where(F.length("word") > F.length("stem"))
    stems = begun.groupBy("stem").agg(
        count(True).alias("toxic_docs"), count(False).alias("other_docs"),
        F.countDistinct(F.when(F.col("toxic"), F.col("word"))).alias("words"),
        F.max(F.when(F.col("toxic"), F.col("n"))).alias("most")) \
        .where((F.col("toxic_docs") > 0) & (evidence >= STEM_EVIDENCE) & (F.col("words") >= 4)
               & (F.col("most") < 0.7 * F.col("toxic_docs"))) \
        .withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS) \
        .collect()
    short: list[str] = []
    for s in sorted({r["stem"] for r in stems}, key=lambda s: (len(s), s)):
        if not any(s.startswith(x) for x in short):
            short.append(s)
    whole = sorted(r["word"] for r in terms if not any(r["word"].startswith(s) for s in short))
    return [(s, True) for s in short] + [(w, False) for w in whole]


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and intercept by ridge-penalised Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 0.01 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(entries, exact weights, near weights, coefficients) or None when there is nothing to learn."""
    shipped(docs.sparkSession)
    rows = training_sample(docs, labels, sample)
    entries = learn_lexicon(rows)
    if not entries:
        return None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo(LexiconAutomaton(entries))
        for batch in batches:
            found = [matches(t, memo) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[list(map(int, m)) for m in f] for f in found],
                                           pa.list_(pa.list_(pa.int64())))], names=["toxic", "found"])

    # bounded by the sample: a row per sampled document with its few matches
    seen = rows.mapInArrow(find, "toxic boolean, found array<array<long>>").collect()
    toxic = np.array([r["toxic"] for r in seen])
    found = [[(m[0], m[1], m[2], bool(m[3])) for m in r["found"]] for r in seen]
    docs_with = np.zeros((2, 2, len(entries)))  # exact or near, other or toxic
    for t, f in zip(toxic, found, strict=True):
        for near, entry in {(int(e > 0), entry) for _, entry, e, _ in f}:
            docs_with[near, int(t), entry] += 1
    share = docs_with + 0.5
    prior = math.log((~toxic).sum() / max(1, toxic.sum()))
    exact = np.log(share[0, 1] / share[0, 0]) + prior
    # a misspelling starts from half the entry's weight
    p = 1 / (1 + np.exp(-exact / 2))
    near = np.log((docs_with[1, 1] + p) / (docs_with[1, 0] + 1 - p)) + prior * (docs_with[1].sum(axis=0) > 0)
    exact, near = np.maximum(exact, 0), np.maximum(near, 0)
    x = np.array([text_features(f, exact, near) for f in found])
    order = np.lexsort((*x.T, toxic))
    return entries, exact, near, _fit_logistic(x[order], toxic[order].astype(float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_matches) for every row."""
    spark = shipped(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(train(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        memo = _Memo(LexiconAutomaton(model[0])) if model else None
        for batch in batches:
            found = [matches(t, memo) if model else [] for t in batch.column(1).to_pylist()]
            score = np.zeros(len(found))
            if model:
                _, exact, near, w = model
                x = np.array([text_features(f, exact, near) for f in found]).reshape(-1, 3)
                score = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array([len(f) for f in found], pa.int64())],
                names=["doc_id", "score", "n_matches"])

    return docs.mapInArrow(run, "doc_id long, score double, n_matches long").select(
        "doc_id", _is_held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"), "n_matches")
