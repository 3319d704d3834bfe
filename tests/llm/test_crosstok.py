import collections
import hashlib
import random

import pandas as pd
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarterlens.llm import crosstok
from quarterlens.llm.queries import QUERIES
from tests.llm.helpers import SMALL, read

A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def _tokens():
    """The libraries themselves: text -> (A ids and bytes, B ids and bytes)."""
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    at = crosstok.byte_alphabet()

    def run(text):
        x = a.encode(" " + text, add_special_tokens=False)
        y = b.encode(text)
        xb = [bytes(at[c] for c in t) for t in x.tokens]
        yb = []
        for i in y:
            p = b.id_to_piece(i)
            yb.append(bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
        return list(zip(x.ids, xb)), list(zip(y, yb))
    return run


def brute(rows):
    """[(id, n_a, n_b, n_groups, n_links, n_overlaps, groups, n_best, count_sum)]"""
    tokens = _tokens()
    done, docs_of = [], collections.Counter()
    for i, text in rows:
        a, b = tokens(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a = b = []
        ends = [set(), set()]
        spans = []
        for side, toks in enumerate((a, b)):
            at, out = 0, []
            for k, t in toks:
                out.append((k, at, at + len(t)))
                at += len(t)
                ends[side].add(at)
            spans.append(out)
        cuts = sorted(ends[0] & ends[1])
        groups, low = [], 0
        for high in cuts:
            groups.append([[k for k, s, e in side if low <= s and e <= high] for side in spans])
            low = high
        n_over = sum(1 for _, s, e in spans[0] for _, s2, e2 in spans[1] if s < e2 and s2 < e) \
            if len(a) < 3000 else None
        links = collections.Counter((x, y) for g in groups for x in g[0] for y in g[1])
        docs_of.update(links.keys())
        note = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        done.append((i, len(a), len(b), len(groups), sum(links.values()), n_over, note, links))
    top = collections.Counter()
    for (x, _), n in docs_of.items():
        top[x] = max(top[x], n)
    return [(*d[:7], sum(n for (x, y), n in d[7].items() if docs_of[x, y] == top[x]),
             sum(n * docs_of[k] for k, n in d[7].items())) for d in done]


def _rows():
    rng = random.Random(11)
    parts = ["the", " quick", "  fox", "\n", "naïve", "日本語のテキスト", "<|endoftext|>", "<s>", "=====" * 7,
             "12345", "don't", "\t", "🙂", "ß", " ", "　", "http://x.y/z?q=1", "ΑΒΓ", "é"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(120)]
    return rows + [(200, None), (201, ""), (202, " "), (203, "   "), (204, "holds ▁ itself"),
                   (205, "x"), (205, "x"), (None, "the quick fox"), (206, "word " * 4000),
                   (207, "=" * 5000), (208, " " * 3000 + "end"), (-3, "\x00\x01 a\x7f")]


@pytest.mark.parametrize("block,at_once", [(2 << 20, 1 << 22), (300, 50)])
def test_matches_brute_force(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(crosstok, "BLOCK_BYTES", block)
    monkeypatch.setattr(crosstok, "PAIRS_AT_ONCE", at_once)
    rows = _rows()
    df = spark.createDataFrame([(1, t, i, "k") for i, t in rows],
                               "block int, text string, doc_id long, pairs string").repartition(3)
    got = crosstok.with_link_counts(crosstok.align(df, A_FILE, P.PATTERN, B_FILE)).collect()
    want = brute(rows)
    assert sorted((repr(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best,
                   r.count_sum) for r in got) == \
        sorted((repr(w[0]), *w[1:5], *w[6:]) for w in want)
    over = {(repr(w[0]), w[6]): w[5] for w in want if w[5] is not None}
    assert all(over.get((repr(r.doc_id), r.groups), r.n_overlaps) == r.n_overlaps for r in got)


def test_words_apart_are_the_whole_text():
    pieces = crosstok.Pieces(open(B_FILE, "rb").read())
    whole = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    byte_level = crosstok.ByteLevel(open(A_FILE, "rb").read(), P.PATTERN)
    plain = Tokenizer.from_file(A_FILE)
    plain.encode_special_tokens = True
    assert pieces._by_word and byte_level._fast is not byte_level._plain
    docs = read(SMALL, "documents", "doc_id")
    for text in [*docs.text.dropna(), *(t for _, t in _rows() if t), " " * 50_000, "é" * 50_000]:
        assert pieces.encode(text) == whole.encode(text)
        assert byte_level.encode(text) == plain.encode(" " + text, add_special_tokens=False).ids


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert crosstok.with_link_counts(crosstok.align(df, A_FILE, P.PATTERN, B_FILE)).collect() == []


def test_query_matches_brute_force(spark):
    docs = read(SMALL, "documents", "doc_id")
    want = brute(list(zip(docs.doc_id, [None if pd.isna(t) else t for t in docs.text])))
    got = QUERIES["op11_tokenizer_alignment"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                   r.groups_sha256) for r in got) == \
        sorted((w[0], *w[1:5], *w[7:], w[6] and hashlib.sha256(w[6].encode()).hexdigest())
               for w in want)
