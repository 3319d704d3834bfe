"""Toxicity: a learned lexicon met through a Levenshtein automaton, weighed by context.

* Lexicon: on a bounded sample of labelled rows (``SAMPLE`` rows of smallest id hash, near copies
  counted once) words and word beginnings are counted per class. Terms are those whose toxic
  count cannot be chance (``EVIDENCE``); a beginning stays a term only as far as no longer
  one has nearly its count, so a word is learned as a word and a stem as a stem. Words of
  sufficient evidence stay beside the stem they begin with, for the edits that they allow.
* Misspellings: the terms form a trie; its Levenshtein automaton (pairs of trie node and edits) is
  made deterministic while words run through it, so most words end after a few characters. A word
  with digits or signs inside (``id1ot``, ``st*pid``) runs through it whole, unless a part of it is a
  hit by itself: each such character is one edit.
* Context: a hit inside quotation marks, or near a reporting word, counts as quoted, any other
  as abuse. A logistic model over exact, misspelled and quoted hits, fitted on the same sample
  around prior weights, turns them into a score; with nothing to learn from, the priors hold.

Only the text is an input of the score. Every row is scored by itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import checkpointed, fresh, with_python_columns

SAMPLE = 20_000             # labelled rows that the model is fitted on
EVIDENCE = 14.0             # log odds that a term's counts are not chance
STEM = range(4, 13)         # lengths of word beginnings
CLOSED = 0.8                # a longer term with this share of the count stands for the shorter
LONG_TEXT = 1 << 20         # characters; longer texts are scanned without a list of words
REACH = 80                  # characters of context on each side
QUOTES = "\"“”„«»‘’"
REPORTING = {"said", "says", "called", "wrote", "quote", "quoted", "quoting", "word", "words",
             "term", "insult", "insults", "slur", "reported", "according"}
# intercept; exact, misspelled and quoted hits (n / (n + 1/2) each: most is said by the first
# one), before anything is learned
PRIOR = np.array([-3.0, 6.0, 4.0, 1.0])
PRIOR_STRENGTH = np.array([0.01, 0.05, 0.2, 0.5])

_WORD = re.compile(r"[^\W\d_]+")
_SIGN = r"(?:[\d_]|[^\w\s'’\"“”„«»‘])"
_MIXED = re.compile(rf"[^\W\d_]+(?:{_SIGN}{{1,2}}[^\W\d_]+)+")
_INNER = re.compile(rf"[^\W\d_]{_SIGN}{{1,2}}[^\W\d_]")


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def edits(length: int, stem: bool) -> int:
    """Typing errors allowed in a term of this length."""
    if stem:
        return 0 if length < 7 else 1
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """Trie of terms and its Levenshtein automaton, determinised on demand.

    A term ending in ``$`` is a whole word, any other the beginning of words. A state is the set of
    (node, edits) reachable; state 0 is dead.
    """

    STATES = 50_000          # the automaton starts afresh beyond this

    def __init__(self, terms: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.allowed, self.word, self.stem = [0], [-1], [-1]
        for term in terms:
            stem = not term.endswith("$")
            letters = term.rstrip("$")
            limit, node = edits(len(letters), stem), 0
            self.allowed[0] = max(self.allowed[0], limit)
            for c in letters:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    for x, none in ((self.allowed, 0), (self.word, -1), (self.stem, -1)):
                        x.append(none)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], limit)
            (self.stem if stem else self.word)[node] = limit
        self._restart()

    def _restart(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.step: list[dict[str, int]] = []
        self.at_end: list[int] = []      # fewest edits of a whole word that ends here, or -1
        self.so_far: list[int] = []      # fewest edits of a stem that is complete here, or -1
        self._state(frozenset())
        self.start = self._state(self._closure({(0, 0)}))

    def _closure(self, states: set) -> frozenset:
        """With letters of the term left out of the word."""
        todo = list(states)
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e < self.allowed[child] and (child, e + 1) not in states:
                    states.add((child, e + 1))
                    todo.append((child, e + 1))
        return frozenset(states)

    def _state(self, states: frozenset) -> int:
        if states not in self.number:
            self.number[states] = len(self.sets)
            self.sets.append(states)
            self.step.append({})
            for out, limit in ((self.at_end, self.word), (self.so_far, self.stem)):
                out.append(min((e for node, e in states if e <= limit[node]), default=-1))
        return self.number[states]

    def _move(self, state: int, c: str) -> int:
        out = set()
        for node, e in self.sets[state]:
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.allowed[child]:
                    out.add((child, cost))
            if e < self.allowed[node] and node:
                out.add((node, e + 1))
            elif e < self.allowed[0] and not node:
                out.add((0, e + 1))
        new = self._state(self._closure(out))
        self.step[state][c] = new
        return new

    def match(self, word: str) -> int:
        """Fewest edits from a term to the word (or its beginning, for stems); -1: no term."""
        if len(self.sets) > self.STATES:
            self._restart()
        state, best = self.start, -1
        for c in word:
            new = self.step[state].get(c)
            state = self._move(state, c) if new is None else new
            if not state:
                return best
            e = self.so_far[state]
            if e >= 0 and (best < 0 or e < best):
                best = e
        e = self.at_end[state]
        return e if e >= 0 and (best < 0 or e < best) else best


def words(text: str) -> Iterator[str]:
    if len(text) <= LONG_TEXT:
        return iter(_WORD.findall(text))
    return (m.group() for m in _WORD.finditer(text))


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the span stands in quotation marks or close to a reporting word."""
    left, right = text[max(0, start - REACH):start], text[end:end + REACH]
    before = sum(left.count(q) for q in QUOTES)
    after = sum(right.count(q) for q in QUOTES)
    if before and after and before % 2 == 1:
        return True
    return any(w in REPORTING for w in _WORD.findall(left)[-6:] + _WORD.findall(right)[:3])


def features(text: str, lexicon: Lexicon, known: dict[str, int]) -> tuple[float, float, float]:
    """n / (n + 1/2) of exact, misspelled and quoted hits. ``known`` keeps words already met."""
    low = text.lower()
    if len(known) > 500_000:
        known.clear()
    found = {}

    def hit(w: str) -> bool:
        if w not in found:
            e = known.get(w)
            if e is None:
                e = known[w] = lexicon.match(w)
            found[w] = e
        return found[w] >= 0

    some = False
    for w in set(words(low)):
        some |= hit(w)
    spans = [m.span() for m in _WORD.finditer(low) if found[m.group()] >= 0] if some else []
    if _INNER.search(low):
        spans += [m.span() for m in _MIXED.finditer(low)
                  if not any(found[w] >= 0 for w in _WORD.findall(m.group())) and hit(m.group())]
    if not spans:
        return 0.0, 0.0, 0.0
    n = [0, 0, 0]
    for start, end in spans:
        n[2 if quoted(low, start, end) else found[low[start:end]] > 0] += 1
    return tuple(x / (x + 0.5) for x in n)


def _terms_of(text: str) -> set[str]:
    out = set()
    for w in set(words(text.lower())):
        if len(w) >= 3:
            out.add(w + "$")
            out.update(w[:n] for n in STEM if n <= len(w))
    return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): rows of each class that have the term."""
    count: tuple[Counter, Counter] = Counter(), Counter()

    def out() -> pa.RecordBatch:
        terms = list(count[0].keys() | count[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()),
             *(pa.array([count[x][t] for t in terms], pa.int64()) for x in (1, 0))],
            names=["term", "toxic", "clean"])

    for b in batches:
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            count[toxic].update(_terms_of(text or ""))
            if len(count[0]) + len(count[1]) > 300_000:
                yield out()
                for c in count:
                    c.clear()
    yield out()


def _first_shingle(text: str) -> int:
    """The least hash of three words in a row: equal for most near copies."""
    w = list(words(text.lower()))
    return min((zlib.crc32(" ".join(w[i:i + 3]).encode()) for i in range(max(1, len(w) - 2))),
               default=0)


def evident(toxic: dict[str, int], clean: dict[str, int], n_toxic: int,
            n_clean: int) -> dict[str, int]:
    """The terms of sufficient evidence and their toxic counts."""
    base = math.log((n_toxic + n_clean) / max(1, n_toxic))
    return {t: n for t, n in toxic.items() if n * base - 4 * clean.get(t, 0) >= EVIDENCE}


def forms(good: dict[str, int], chosen: list[str]) -> list[str]:
    """The whole words of ``good`` that begin with a chosen stem: they allow edits it does not."""
    stems = {t for t in chosen if not t.endswith("$")}
    return sorted(t for t in good if t.endswith("$")
                  and any(t[:n] in stems for n in range(1, len(t))))


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int,
                 n_clean: int) -> list[str]:
    """Stems and words for the lexicon: of sufficient evidence, closed, no term under another."""
    good = evident(toxic, clean, n_toxic, n_clean)
    longer: dict[str, int] = {}
    for t, n in good.items():
        parent = t[:-1]
        longer[parent] = max(longer.get(parent, 0), n)
    chosen: list[str] = []
    taken: set[str] = set()
    for t in sorted(good, key=lambda t: (len(t.rstrip("$")), t)):
        stem = t.rstrip("$")
        if any(stem[:n] in taken for n in range(1, len(stem) + 1)):
            continue
        if not t.endswith("$"):
            if longer.get(t, 0) >= CLOSED * good[t]:
                continue
            taken.add(t)
        chosen.append(t)
    return chosen


def _fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression around ``PRIOR`` (Newton steps)."""
    x = np.c_[np.ones(len(x)), x]
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        strength = PRIOR_STRENGTH * max(1, len(x)) / 10
        grad = x.T @ (p - y) + strength * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, terms: list[str], weights: np.ndarray) -> None:
        self.terms, self.weights = terms, weights

    def score(self, f: tuple[float, float, float]) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], f))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          toxic: str = "toxic") -> Model:
    """Fits a model on the rows of ``labels`` that are not held out.

    Labels other than 0 and 1, null ids and ids without a document are left out; an id with
    several labels counts as toxic if one of them does. With no usable label the model is the
    prior with an empty lexicon.
    """
    known = labels.where(F.col(toxic).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(toxic).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text).alias("text")) \
        .join(F.broadcast(known), F.col("doc") == F.col("id")).select("text", "toxic")
    sig = T.StructField("sig", T.LongType())
    seen = with_python_columns(texts, ["text"], [sig], lambda cols: [pa.array(
        [_first_shingle(t or "") for t in cols[0].to_pylist()], pa.int64())])
    sample = checkpointed(seen.groupBy("sig", "toxic").agg(F.min("text").alias("text"))
                          .select("text", "toxic"))
    total = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n"))
             .collect()}
    n_toxic, n_clean = total.get(1, 0), total.get(0, 0)
    if not n_toxic:
        return Model([], PRIOR.copy())

    # only terms of sufficient evidence reach the driver
    base = math.log((n_toxic + n_clean) / n_toxic)
    passed = sample.select("text", "toxic").mapInArrow(
        _count_terms, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .where(F.col("toxic") * base - 4 * F.col("clean") >= EVIDENCE).collect()
    in_toxic = {r["term"]: r["toxic"] for r in passed}
    in_clean = {r["term"]: r["clean"] for r in passed}
    terms = choose_terms(in_toxic, in_clean, n_toxic, n_clean)
    terms += forms(evident(in_toxic, in_clean, n_toxic, n_clean), terms)
    found = _with_features(sample, "text", terms, ["a", "b", "c"]) \
        .select("toxic", "a", "b", "c").toArrow()
    x = np.stack([found.column(c).to_numpy() for c in "abc"], axis=1)
    return Model(terms, _fit_weights(x, found.column("toxic").to_numpy().astype(float)))


def _with_features(docs: DataFrame, text: str, terms: list[str], names: list[str]) -> DataFrame:
    state: list = []

    def work(cols: list[pa.Array]) -> list[pa.Array]:
        if not state:
            state.extend([Lexicon(terms), {}])
        got = [features(t or "", *state) for t in cols[0].to_pylist()]
        return [pa.array([g[i] for g in got], pa.float64()) for i in range(3)]

    return with_python_columns(docs, [text], [T.StructField(n, T.DoubleType()) for n in names],
                               work)


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the probability that a text is toxic (0 to 1).

    Null text: as empty; both get the score of a text without hits. Very long texts are scanned
    whole. Other columns pass through, repeated rows repeat. An empty table gives an empty result.
    """
    state: list = []

    def work(cols: list[pa.Array]) -> list[pa.Array]:
        if not state:
            state.extend([Lexicon(model.terms), {}])
        return [pa.array([model.score(features(t or "", *state)) for t in cols[0].to_pylist()],
                         pa.float64())]

    return with_python_columns(docs, [text], [T.StructField(out, T.DoubleType())], work)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns unchanged."""
    score, = fresh(docs, "score")
    model = train(docs, labels, id_col, text)
    return with_score(docs, model, text, score).where(F.col(score) < threshold) \
        .select(*docs.columns)
