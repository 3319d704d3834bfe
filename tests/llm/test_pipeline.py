import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from quarterlens.llm import bpe
from tests.llm.helpers import near_dup_ids, remove_repeats

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("tnhesdla") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(55))
    rows, labels = [], []
    for i in range(240):
        t = " ".join(word() for _ in range(rng.randint(30, 90)))
        if i % 8 == 0:
            t += " you scumbag of a worthless fool"
        if i % 5 == 1:
            t = f"{t}\n{passage}"
        if i % 20 == 9:
            t = rows[i - 5][1]
        rows.append((i, t, "en", "abc"[i % 3], len(t), "x"))
        labels.append((i, 1, int("scumbag" in t)))
    rows += [(300, "", "en", "a", 0, None), (301, None, None, None, None, None),
             (302, rows[3][1], "en", "b", 5, "x"), (302, rows[3][1], "en", "b", 5, "x")]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    seen, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = (docs.collect(), out.collect())
        docs = out
    before, after = seen["toxicity"]
    assert sorted(map(str, after)) == sorted(str(r) for r in before
                                             if "scumbag" not in (r.text or ""))
    before, after = seen["simhash_near_dedup"]
    _, comp = near_dup_ids([r.doc_id for r in before], [r.text for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(comp))
    assert {str(r) for r in after} <= {str(r) for r in before}
    before, after = seen["substring_dedup"]
    want = remove_repeats([(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text for r in after} == {i: t for i, (_, _, t) in want.items()}
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = seen["source_mix"]
    assert {str(r) for r in after} <= {str(r) for r in before}
    assert max(sum(a.doc_id == b.doc_id for a in after) for b in before) <= 3
    before, after = seen["byte_bpe"]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    assert sorted((r.doc_id, r.text, bpe.unpack(r.token_ids)) for r in after) == \
        sorted((r.doc_id, r.text or "", library.encode_ordinary(r.text or "")) for r in before)


def test_run_applies_all_stages_to_the_table(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert 0 < got.count() and "token_ids" in got.columns


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert {"op5_source_mix", "op10_chat_format"} <= entry.oracle_sql().keys()
