import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quarterlens.llm import bpe
from tests.llm.helpers import SMALL, read

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.read_ranks(RANKS)
    return (bpe.Pieces(ranks, public_tokenizers.PATTERN),
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={}))


def _texts():
    rng = random.Random(4)
    texts = ["", "a", " ", "\n\n", "a" * 5000, "ab" * 3000, " " * 999, "é" * 700, "<|endoftext|>",
             "　x y\x1c z", "don't WE'LL 's", "\x00\x01", "😀👩‍👩‍👧‍👦" * 30]
    for alphabet in ("ab \n\té中😀'sZ0_", " \n\t\x1c\x1d\x85\xa0 a1.'s", "abcdefgh "):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))
                  for _ in range(400)]
    return texts


@pytest.mark.parametrize("cut", [None, re.compile(bpe.CUT)])
def test_same_ids_as_the_library(both, cut):
    pieces, library = both
    texts = _texts()
    for t, ids in zip(texts, pieces.encode(texts, cut)):
        assert bpe.unpack(ids) == library.encode_ordinary(t)


def test_trees_side_by_side_equal_one_tree(both):
    rng = random.Random(8)
    pieces = {"".join(rng.choice("abcdeinorst é😀#") for _ in range(rng.randint(2, 60)))
              for _ in range(3000)}
    short = {p for p in pieces if len(p.encode()) <= bpe.TOGETHER}
    got = both[0].merged(short)
    for p in short:
        assert bpe.unpack(got[p]) == bpe.merge(p.encode(), both[0].ranks, both[0].longest)


def test_long_text_and_full_caches(both, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 100)
    monkeypatch.setattr(bpe, "TREE_CELLS", 64)
    pieces = bpe.Pieces(both[0].ranks, public_tokenizers.PATTERN)
    text = " ".join(str(i * i) + "thing" * (i % 3) for i in range(3000)) + "x" * 20000
    texts = [text, *text.split()[:500], ""]
    for t, ids in zip(texts, pieces.encode(texts, re.compile(bpe.CUT))):
        assert bpe.unpack(ids) == both[1].encode_ordinary(t)
    assert len(pieces.runs) <= 100 and len(pieces.old) <= 100


def test_round_trip_nulls_and_clashing_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(_texts()[:300])] + [(None, None, None), (3, "a", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    out = bpe.decode(bpe.encode(df, "text", RANKS, public_tokenizers.PATTERN), RANKS, out="back")
    assert out.columns == [*df.columns, "token_ids", "n_tokens", "back"]
    got = out.collect()
    assert sorted((r.doc_id or -1, bytes(r.back).decode()) for r in got) == \
        sorted((i or -1, t or "") for i, t, _ in rows)
    assert all(r.n_tokens * 4 == len(r.token_ids) for r in got)
    once = bpe.encode(df.drop("decoded"), "text", RANKS, public_tokenizers.PATTERN, decoded="back")
    assert sorted(bytes(r.back) for r in once.collect()) == sorted(bytes(r.back) for r in got)
    empty = bpe.encode(df.limit(0), "text", RANKS, public_tokenizers.PATTERN)
    assert bpe.decode(empty, RANKS, out="back").count() == 0


def test_query_matches_the_library(spark, both):
    from quarterlens.llm.queries import QUERIES

    want = []
    for i, t in read(SMALL, "documents", "doc_id")[["doc_id", "text"]].itertuples(index=False):
        ids = both[1].encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op6_byte_bpe"](spark, SMALL).collect())) == want
