"""Sub-words, truncation and length buckets against plain versions."""

import math
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterlens.operators import subwords as S
from quarterlens.operators.scoring import DEMO_LEXICON
from quarterlens.operators.sentiment import explode_paragraphs
from quarterlens.plans import q_sentiment as Q
from quarterlens.plans import stand_ins
from quarterlens.plans.registry import QUERIES, load_all
from tests.conftest import SF_SMALL, rows

VOCAB = {p: i for i, p in enumerate(["[UNK]", "[CLS]", "[SEP]", "un", "##aff", "##able", "##a", "a", "b", "##b",
                                     "able", ".", "!", "unaffable", "日", "naive", "##s"])}


def _words():
    return S.Subwords({p: i for p, i in VOCAB.items() if i > 2}, 0, 1, 2, inner="##")


def test_longest_match():
    w = _words()
    named = {i: p for p, i in VOCAB.items()}
    show = lambda t: [named[i] for i in w.ids(t)]
    assert show("unaffable unaffables") == ["unaffable", "unaffable", "##s"]
    assert show("unable") == ["un", "##able"]
    assert show("unx ab.") == ["[UNK]", "a", "##b", "."]
    assert show("Naïve! 日日") == ["naive", "!", "日", "日"]
    assert show("a" * 101) == ["[UNK]"] and show("a" * 100) == ["a"] + ["##a"] * 99
    assert show("") == show(None) == show(" \n\x00") == []
    assert w.model_input("a b a b", 4) == ([1, VOCAB["a"], VOCAB["b"], 2], 6)


def test_words():
    assert S.split_words("Don't stop it—now\t(é)") == \
        ["don", "'", "t", "stop", "it", "—", "now", "(", "e", ")"]
    assert S.split_words("É x", fold=False) == ["É", "x"]


def test_buckets_cover_all_and_pad_little():
    rng = np.random.default_rng(0)
    lengths = rng.integers(2, 513, 500).tolist()
    groups = S.buckets(lengths)
    assert sorted(i for g in groups for i in g) == list(range(500))
    for g in groups:
        width = -(-max(lengths[i] for i in g) // S.BUCKET) * S.BUCKET
        assert all(width - lengths[i] < S.BUCKET for i in g) and len(g) * width <= S.CELLS
    assert S.buckets([]) == [] and S.buckets([10 ** 6]) == [[0]]


def plain_tokens(vocab, text):
    """Pieces by trying every prefix of the rest of every word, longest first."""
    letters = S.printable_bytes()
    text = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) != "Mn")
    out = []
    for word in S.split_words(text, fold=False):
        rest = "".join(letters[b] for b in word.encode())
        found = []
        while rest:
            piece = next((p for n in range(len(rest), 0, -1)
                          for p in [rest[:n] + "</w>" * (n == len(rest))] if p in vocab), None)
            if piece is None or len(word) > 100:
                found = [None]
                break
            found.append(piece)
            rest = rest[len(piece.removesuffix("</w>")):]
        out += [vocab.get(p) for p in found]
    return out


@pytest.fixture(scope="module")
def paragraphs(spark):
    par = explode_paragraphs(stand_ins.documents(spark, SF_SMALL), ["doc_id"], "text", outer=False)
    return [tuple(r) for r in par.collect()]


def test_token_query_equals_the_plain_version(spark, paragraphs):
    load_all()
    vocab = Q.subword_vocabulary().vocabulary
    want = []
    for doc, pos, text in paragraphs:
        n = len(plain_tokens(vocab, text)) + 2
        want.append((doc, pos, n, min(n, Q.SUBWORD_LIMIT), n > Q.SUBWORD_LIMIT))
    got = rows(QUERIES["subword_tokens"](spark, SF_SMALL))
    assert sorted(got) == sorted(want) and any(w[4] for w in want) and not all(w[4] for w in want)


def test_sentiment_query_equals_the_plain_version(spark, paragraphs):
    load_all()
    vocab = Q.subword_vocabulary().vocabulary
    single = {c: {vocab[f"{w}</w>"] for w in DEMO_LEXICON[c] if f"{w}</w>" in vocab}
              for c in ("positive", "negative", "neutral")}
    docs = {}
    for doc, _, text in paragraphs:
        used = plain_tokens(vocab, text)[:Q.SUBWORD_LIMIT - 2]
        z = [sum(i in single[c] for i in used) for c in ("positive", "negative", "neutral")]
        e = [math.exp(v - max(z)) for v in z]
        docs.setdefault(doc, []).append([v / sum(e) for v in e])
    got = {r.doc_id: r for r in QUERIES["subword_sentiment"](spark, SF_SMALL).collect()}
    for doc, scores in docs.items():
        r = got[doc]
        assert r.n_chunks == len(scores)
        for k, name in enumerate(("positive", "negative", "neutral")):
            assert r[f"avg_{name}"] == pytest.approx(sum(s[k] for s in scores) / len(scores), abs=2e-6)
    assert all(r.n_chunks == 0 for d, r in got.items() if d not in docs)


def test_skipping_scorer_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a !"), (3, None), (4, "")], "id int, paragraph string")
    # the test's vocabulary travels by value
    vocab = dict(VOCAB)
    words = lambda: S.Subwords({p: i for p, i in vocab.items() if i > 2}, 0, 1, 2, inner="##")
    bang = VOCAB["!"]

    class Model:
        def logits(self, ids, mask):
            if (ids == bang).any():
                raise RuntimeError("model failure")
            n = mask.sum(1).astype(float)
            return np.stack([n, n * 0, n * 0], 1)

    scored = S.SubwordScorer(words, Model, on_error="skip").score(df)
    got = {r.id: r.positive for r in scored.collect()}
    assert got[2] is None and got[3] is None
    assert got[1] == pytest.approx(math.exp(4) / (math.exp(4) + 2))
    assert got[4] == pytest.approx(math.exp(2) / (math.exp(2) + 2))
    with pytest.raises(Exception, match="model failure"):
        S.SubwordScorer(words, Model).score(df).agg(F.sum("positive")).collect()
