"""The ONNX scorer path end to end: a tiny exported classifier (built here by writing
its protobuf directly, since the ``onnx`` package is not installed), a word-level
tokenizer file, Spark's pandas UDF and 512-token-style truncation."""

import math
import struct

import pytest

ort = pytest.importorskip("onnxruntime")
tokenizers = pytest.importorskip("tokenizers")

VOCAB = ["[PAD]", "[UNK]", "good", "strong", "bad", "weak", "the", "and"]
CLASS_OF = {"good": 0, "strong": 0, "bad": 1, "weak": 1, "the": 2, "and": 2}


# --- minimal protobuf writer (wire types 0 = varint, 2 = length-delimited) ---------
def _varint(n):
    n &= (1 << 64) - 1
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _int(field, n):
    return _varint(field << 3) + _varint(n)


def _bytes(field, data):
    data = data.encode() if isinstance(data, str) else data
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _value_info(name, elem_type, dims):
    dim_msgs = b"".join(_bytes(1, _bytes(2, d) if isinstance(d, str) else _int(1, d)) for d in dims)
    tensor_type = _int(1, elem_type) + _bytes(2, dim_msgs)
    return _bytes(1, name) + _bytes(2, _bytes(1, tensor_type))


def _model_bytes():
    """logits[n, 3] = sum over tokens of E[token_id]: per-class word counts."""
    rows = [[1.0 if CLASS_OF.get(w) == c else 0.0 for c in range(3)] for w in VOCAB]
    raw = b"".join(struct.pack("<f", x) for r in rows for x in r)
    emb = _int(1, len(VOCAB)) + _int(1, 3) + _int(2, 1) + _bytes(8, "E") + _bytes(9, raw)   # FLOAT
    gather = _bytes(1, "E") + _bytes(1, "input_ids") + _bytes(2, "g") + _bytes(4, "Gather") \
        + _bytes(5, _bytes(1, "axis") + _int(20, 2) + _int(3, 0))
    reduce = _bytes(1, "g") + _bytes(2, "logits") + _bytes(4, "ReduceSum") \
        + _bytes(5, _bytes(1, "axes") + _int(20, 7) + _int(8, 1)) \
        + _bytes(5, _bytes(1, "keepdims") + _int(20, 2) + _int(3, 0))
    graph = (_bytes(1, gather) + _bytes(1, reduce) + _bytes(2, "g") + _bytes(5, emb)
             + _bytes(11, _value_info("input_ids", 7, ["n", "l"]))
             + _bytes(12, _value_info("logits", 1, ["n", 3])))
    return _int(1, 7) + _bytes(8, _bytes(1, "") + _int(2, 11)) + _bytes(7, graph)


def _files(tmp_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    tok = Tokenizer(models.WordLevel({w: i for i, w in enumerate(VOCAB)}, unk_token="[UNK]"))
    tok.normalizer = normalizers.Lowercase()
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tpath, mpath = tmp_path / "tokenizer.json", tmp_path / "model.onnx"
    tok.save(str(tpath))
    mpath.write_bytes(_model_bytes())
    return str(mpath), str(tpath)


def _softmax(xs):
    m = max(xs)
    e = [math.exp(x - m) for x in xs]
    return [v / sum(e) for v in e]


def _expected(text, max_tokens):
    words = text.lower().replace(".", " . ").split()[:max_tokens]
    counts = [0.0, 0.0, 0.0]
    for w in words:
        if w in CLASS_OF:
            counts[CLASS_OF[w]] += 1
    return _softmax(counts)


@pytest.mark.parametrize("max_tokens", [512, 4])
def test_onnx_scorer_in_spark(spark, tmp_path, max_tokens):
    from quarterlens.operators.scoring import OnnxSequenceClassifier, PandasModelScorer

    model_path, tok_path = _files(tmp_path)
    texts = ["Good and strong demand.", "the the bad weak outlook", "nothing here",
             "good good good good bad bad bad bad", "Weak. Bad. The end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, paragraph string")
    scorer = PandasModelScorer(OnnxSequenceClassifier(model_path, tok_path, max_tokens))
    got = {r["i"]: (r["positive"], r["negative"], r["neutral"]) for r in scorer.score(df).collect()}
    for i, t in enumerate(texts):
        want = _expected(t, max_tokens)
        assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(got[i], want)), (t, got[i], want)
