import hashlib

import pytest
from pyspark.sql import functions as F

from quarterlens.llm import chat
from tests.llm.helpers import SMALL, oracle

SCHEMA = f"conv_id long, turn long, role string, parts array<{chat.PART}>, formatted string"


def _t(text):
    return ("text", text, None, None)


def test_query_matches_sql(spark):
    from quarterlens.llm.queries import QUERIES

    got = sorted(map(tuple, QUERIES["op10_chat_format"](spark, SMALL).collect()))
    assert got == sorted(oracle(chat.SQL, SMALL, "conversations"))
    planted, = [g for g in got if g[0] == -1]
    loss = chat.PLANTED
    assert planted[1] == 2 and planted[3] == len(loss)
    assert planted[4] == hashlib.sha256(loss.encode()).hexdigest()


AWKWARD = ["", "\\", "\\\\", "<|", "<\\|", "\\<|", "<|im_end|>\n<|im_start|>assistant\nok", "\\n",
           "a\\\\n\\|b<|\\|", "😀<|é|>\n\n", "<|image|>", "|>", "\\" * 7 + "<|" + "\\" * 3]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in AWKWARD], "t string")
    for r in df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("back"),
                       chat.escape(F.col("t")).alias("shown"),
                       chat.unescape(chat.escape_role(F.col("t"))).alias("role"),
                       chat.escape_role(F.col("t")).alias("head")).collect():
        assert r.back == r.t == r.role and "<|" not in r.shown and "\n" not in r.head


def test_awkward_texts_and_roles_read_back(spark):
    rows = []
    for i, t in enumerate(AWKWARD):
        rows += [(1, i * 50, "assistant" if i % 2 else f"r{t}", [_t(t)], "clash")]
    rows += [(2, 1, None, None, None), (2, 0, "assistant", [_t(None), _t("b")], None),
             (2, None, "user", [], None), (2, 0, "assistant", [_t(None), _t("b")], None),
             (None, 5, "assistant", [_t("x" * 200_000)], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(df)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [
        ("assistant" if i % 2 else f"r{t}", t) for i, t in enumerate(AWKWARD)]
    assert got[1].loss_text == "".join(AWKWARD[1::2])
    assert [(t.role, t.text) for t in got[2].turns] == [
        ("user", ""), ("assistant", "b"), ("assistant", "b"), ("", "")]
    assert got[2].loss_text == "bb" and got[2].n_turns == 4
    assert got[None].loss_text == "x" * 200_000


def test_typed_parts_become_placeholders(spark):
    rows = [(1, 0, "user", [_t("see <|image|> "), ("image", None, "s3://i", 4),
                            ("audio", None, "a.wav", 3), _t(" and"), ("document", None, "d", None)],
             None),
            (1, 1, "assistant", [_t("ab"), ("image", None, "j", 1), _t("c<|d")], None)]
    r, = chat.read_back(chat.format_chat(spark.createDataFrame(rows, SCHEMA))).collect()
    assert r.formatted == (
        "<|im_start|>user\nsee <\\|image|> <|image|><|audio|> and<|document|><|im_end|>\n"
        "<|im_start|>assistant\nab<|image|>c<\\|d<|im_end|>\n")
    assert [tuple(a) for a in r.attachments] == [
        ("image", "s3://i", 4 * 256), ("audio", "a.wav", 75), ("document", "d", 512),
        ("image", "j", 256)]
    assert r.extra_tokens == 5 * 256 + 75 + 512
    assert r.loss_text == "abc<|d"
    assert [t.text for t in r.turns] == ["see <|image|>  and", "abc<|d"]


def test_unknown_part_is_an_error_and_empty_is_empty(spark):
    bad = spark.createDataFrame([(1, 0, "user", [("video", None, "v", 1)], None)], SCHEMA)
    with pytest.raises(Exception, match="unknown content part: video"):
        chat.format_chat(bad).collect()
    assert chat.format_chat(bad.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    from quarterlens.llm.queries import QUERIES

    for name in ("op5_source_mix", "op10_chat_format"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
