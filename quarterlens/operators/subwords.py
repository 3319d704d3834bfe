"""Paragraph scoring on sub-words: longest match, truncation, batches of like length.

A paragraph is cut into words, each word into the longest pieces that a vocabulary has, and what is
beyond the model's limit is cut off, as the reference's model input is. :class:`SubwordScorer` takes
the place of the other scorers: Spark spreads the paragraphs, each Arrow batch is tokenised, and the
model gets paragraphs of like length together, so little of its input is padding.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of
from quarterlens.operators.scoring import (SCORE_FIELDS, SCORE_TYPE, _factory_key, _softmax_rows,
                                           model_for)

MAX_TOKENS = 512             # fixed value: the model's input limit, its two marks included
WORDS_KEPT = 100_000
BUCKET = 32                  # padded lengths are multiples of this
CELLS = 1 << 15              # ids that a model gets at a time


def _is_mark(c: str) -> bool:
    """ASCII signs, and all that Unicode calls punctuation."""
    o = ord(c)
    return 33 <= o <= 47 or 58 <= o <= 64 or 91 <= o <= 96 or 123 <= o <= 126 \
        or unicodedata.category(c).startswith("P")


def _is_ideograph(c: str) -> bool:
    o = ord(c)
    return 0x4E00 <= o <= 0x9FFF or 0x3400 <= o <= 0x4DBF or 0xF900 <= o <= 0xFAFF \
        or 0x20000 <= o <= 0x2CEAF or 0x2F800 <= o <= 0x2FA1F


def split_words(text: str, fold: bool = True) -> list[str]:
    """Words of a text: runs without white space; signs and ideographs are words of their own;
    control characters are dropped. ``fold``: lower case, accents taken off."""
    if fold:
        text = unicodedata.normalize("NFD", text.lower())
    out, now = [], []
    for c in text:
        kind = unicodedata.category(c)
        if c in "\t\n\r" or kind == "Zs":
            out.append("".join(now))
            now = []
        elif kind in ("Cc", "Cf") or c == "�" or (fold and kind == "Mn"):
            continue
        elif _is_mark(c) or _is_ideograph(c):
            out += ["".join(now), c]
            now = []
        else:
            now.append(c)
    out.append("".join(now))
    return [w for w in out if w]


def printable_bytes() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return {b: chr(b if b in kept else next(moved)) for b in range(256)}


class Subwords:
    """Longest-match pieces of words from a vocabulary (piece -> id), held as a trie.

    ``inner``: the mark before pieces that go on within a word (``##``); ``final``: the mark behind
    pieces that end one (``</w>``). ``byte_level``: pieces are written in :func:`printable_bytes`.
    A word that some rest of has no piece, or that is longer than ``max_word`` characters, is one
    ``unknown``.
    """

    def __init__(self, vocabulary: Mapping[str, int], unknown: int, start: int, end: int,
                 inner: str = "", final: str = "", byte_level: bool = False, fold: bool = True,
                 max_word: int = 100) -> None:
        self.unknown, self.start, self.end, self.fold = unknown, start, end, fold
        self.final, self.max_word = final, max_word
        self.letters = printable_bytes() if byte_level else None
        self.first: dict = {}
        self.next: dict = {} if inner else self.first
        for piece, i in vocabulary.items():
            if inner and piece.startswith(inner) and len(piece) > len(inner):
                self._add(self.next, piece[len(inner):], i)
            elif final and piece.endswith(final) and len(piece) > len(final):
                self._add(self.first, [*piece[:-len(final)], final], i)
            else:
                self._add(self.first, piece, i)
        self._known: dict[str, list[int]] = {}

    @staticmethod
    def _add(trie: dict, symbols: Sequence[str], i: int) -> None:
        for s in symbols:
            trie = trie.setdefault(s, {})
        trie[None] = i

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        if len(word) > self.max_word:
            return [self.unknown]
        symbols = list(word) if self.letters is None else \
            [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        last = None
        if self.final:               # only a final piece may end the word
            last = len(symbols) - 1
            symbols.append(self.final)
        out, at, trie = [], 0, self.first
        while at < len(symbols):
            node, found, to = trie, None, at
            for k in range(at, len(symbols)):
                node = node.get(symbols[k])
                if node is None:
                    break
                if None in node and k != last:
                    found, to = node[None], k + 1
            if found is None:
                return [self.unknown]
            out.append(found)
            at, trie = to, self.next
        return out

    def ids(self, text: str | None) -> list[int]:
        """The ids of a whole text, without marks."""
        out = []
        for word in split_words(text or "", self.fold):
            found = self._known.get(word)
            if found is None:
                if len(self._known) >= WORDS_KEPT:
                    self._known.clear()
                found = self._known[word] = self.word(word)
            out += found
        return out

    def model_input(self, text: str | None, max_tokens: int = MAX_TOKENS) -> tuple[list[int], int]:
        """The ids that a model gets (marks included, cut at ``max_tokens``), and how many there
        would be uncut."""
        ids = self.ids(text)
        return [self.start, *ids[:max_tokens - 2], self.end], len(ids) + 2


class JsonVocabulary:
    """Factory of :class:`Subwords` from a ``tokenizers`` file whose pieces end words in ``</w>``."""

    def __init__(self, path: str, start: str = "<|startoftext|>", end: str = "<|endoftext|>") -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.marks = ids[start], ids[end]
        self.vocabulary = {p: i for p, i in ids.items() if i not in self.marks}

    def __call__(self) -> Subwords:
        """The end mark stands for unknown words too, as in the file."""
        return Subwords(self.vocabulary, self.marks[1], *self.marks, final="</w>", byte_level=True)


def token_counts(df: DataFrame, vocabulary: Callable[[], Subwords], text: str = "paragraph",
                 max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``df`` plus n_tokens (marks included, uncut), n_used (what a model gets) and is_cut."""
    key = _factory_key(vocabulary)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = model_for(key, vocabulary)
        for texts in batches:
            yield pd.Series([len(words.ids(t)) + 2 for t in texts], dtype="int32")

    return df.withColumn("n_tokens", count(F.col(text))).withColumns({
        "n_used": F.least("n_tokens", F.lit(max_tokens)),
        "is_cut": F.col("n_tokens") > max_tokens})


def buckets(lengths: Sequence[int], step: int = BUCKET, cells: int = CELLS) -> list[list[int]]:
    """Indices of sequences, shortest first, in groups whose padded length (a multiple of
    ``step``) is the same and which have at most ``cells`` cells (one sequence at least)."""
    out: list[list[int]] = []
    width = None
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        padded = -(-max(1, lengths[i]) // step) * step
        if padded != width or (len(out[-1]) + 1) * padded > cells:
            out.append([])
            width = padded
        out[-1].append(i)
    return out


class SubwordScorer:
    """Scores paragraphs with a model on token ids.

    ``vocabulary`` builds the :class:`Subwords` and ``model`` an object with
    ``logits(ids, mask) -> ndarray[n, 3]`` (order positive, negative, neutral) for padded ids; both
    are picklable, and run once per Python worker. ``on_error`` as in ``PandasModelScorer``:
    with ``'skip'`` a failing bucket is tried one paragraph at a time, and what still fails has
    null scores.
    """

    native = False

    def __init__(self, vocabulary: Callable[[], Subwords], model: Callable[[], object],
                 max_tokens: int = MAX_TOKENS, on_error: str = "raise") -> None:
        if on_error not in ("raise", "skip"):
            raise ValueError(on_error)
        self.vocabulary, self.model, self.max_tokens = vocabulary, model, max_tokens
        self.on_error = on_error

    def _udf(self):
        vocabulary, factory, limit = self.vocabulary, self.model, self.max_tokens
        skip = self.on_error == "skip"
        keys = _factory_key(vocabulary), _factory_key(factory)

        def padded(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
            width = -(-max(len(r) for r in rows) // BUCKET) * BUCKET
            ids = np.zeros((len(rows), width), np.int64)
            mask = np.zeros((len(rows), width), np.int64)
            for i, r in enumerate(rows):
                ids[i, :len(r)] = r
                mask[i, :len(r)] = 1
            return ids, mask

        def run(model, rows: list[list[int]]) -> np.ndarray:
            return _softmax_rows(np.asarray(model.logits(*padded(rows)), dtype="float64"))

        def guarded(model, rows: list[list[int]]) -> np.ndarray:
            try:
                return run(model, rows)
            except Exception:  # noqa: BLE001 - isolate the failing paragraphs of the bucket
                out = np.full((len(rows), len(SCORE_FIELDS)), np.nan)
                for i, r in enumerate(rows):
                    try:
                        out[i] = run(model, [r])[0]
                    except Exception:  # noqa: BLE001 - this paragraph stays unscored
                        pass
                return out

        @F.pandas_udf(SCORE_TYPE)
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            words, model = model_for(keys[0], vocabulary), model_for(keys[1], factory)
            for texts in batches:
                rows = [words.model_input(t, limit)[0] for t in texts]
                out = np.full((len(rows), len(SCORE_FIELDS)), np.nan)
                for group in buckets([len(r) for r in rows]):
                    out[group] = (guarded if skip else run)(model, [rows[i] for i in group])
                out[texts.isna().to_numpy()] = np.nan
                yield pd.DataFrame(out, columns=list(SCORE_FIELDS))

        return score

    def score_column(self, paragraph) -> Column:
        return self._udf()(col_of(paragraph))

    def score(self, df: DataFrame, paragraph_col: str = "paragraph") -> DataFrame:
        return df.withColumn("_s", self.score_column(paragraph_col)).select(
            "*", *[F.col("_s")[f].alias(f) for f in SCORE_FIELDS]).drop("_s")


class TokenLexiconModel:
    """Logits from a word list: how many of a paragraph's tokens are the only token of a word of
    each class. Stands in for a real classifier, as the word list does elsewhere."""

    def __init__(self, vocabulary: Callable[[], Subwords], words: Mapping[str, Sequence[str]]) -> None:
        cut = vocabulary()
        found = [[cut.word(w) for w in words[c]] for c in SCORE_FIELDS]
        self.ids = [np.array([i[0] for i in f if len(i) == 1 and i[0] != cut.unknown], np.int64)
                    for f in found]

    def logits(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return np.stack([(np.isin(ids, c) & (mask == 1)).sum(1) for c in self.ids], axis=1)
