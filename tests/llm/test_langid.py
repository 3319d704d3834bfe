import math
import re
import zlib
from collections import Counter

import pytest

from quarterlens.llm import langid
from tests.llm.helpers import SMALL, read

SF = "/root/testdata/sf0.01"
KEY = ["doc_id", "page_id"]


def test_held_out_accuracy_of_the_query(spark):
    from quarterlens.llm.queries import QUERIES

    got = QUERIES["op7_language_id"](spark, SF).collect()
    truth = dict(read(SF, "documents", "doc_id")[["doc_id", "lang"]].itertuples(index=False))
    docs = {r.doc_id: r for r in got if r.doc_id is not None}
    assert docs.keys() == truth.keys()
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(docs[i].lang == truth[i] for i in out) >= 0.97 * len(out)
    pages = read(SF, "pages", "page_id")
    said = pages.html.str.extract('<html lang="([a-z]+)"')[0]
    by_page = {r.page_id: r.lang for r in got if r.page_id is not None}
    assert sum(by_page[i] == s for i, s in zip(pages.page_id, said)) >= 0.97 * len(pages)
    assert all(0 <= r.score <= 1 for r in got)


def test_trigrams_ignore_case_and_runs_of_marks(monkeypatch):
    a = langid.trigrams(b"The cat")
    assert a.sum() == 5 and (a == langid.trigrams(b"THE -- 12 cat")).all()
    text = "Straße où año ".encode() * 50
    whole = langid.trigrams(text)
    assert langid.trigrams(b"").sum() == langid.trigrams(b"..").sum() == 0
    monkeypatch.setattr(langid, "CHUNK", 64)
    assert abs(int(langid.trigrams(text).sum()) - int(whole.sum())) <= len(text) // 64 + 1


@pytest.mark.parametrize("html,tag", [
    ('<!DOCTYPE html><HTML class=x LANG="de-AT">', "de"), ("<html lang=fr>", "fr"),
    ("<html data-lang='xx'>", None), ("<p lang='es'>", None), (None, None), ("", None)])
def test_declared_language(spark, html, tag):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(langid.declared_language(df.h)).first()[0] == tag


def _docs(spark):
    rows = [(i, t, lang) for i in range(60) for t, lang in (
        ("the cat and the dog went with that thing", "en"),
        ("der hund und die katze gingen mit dem ding", "de"))]
    return spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string")


def test_evidence_decides_where_the_text_does_not(spark):
    model = langid.train_text(_docs(spark))
    texts = {"en": "the thing with the cat", "de": "die katze mit dem hund"}
    items = []
    for lang, host, suffix in (("en", "a.example", "uk"), ("de", "b.example", "at")):
        items += [(n, texts[lang], lang, f"{host}.{suffix}") for n in range(20)]
    items += [(100, "", "de", None), (101, None, None, "www.b.example.at"), (102, "??", None, None),
              (103, texts["en"], "de", "b.example.at"), (104, None, "xx", "new.host.at"),
              (None, texts["de"] * 9000, None, ""), (105, "", "en", "b.example.at")]
    df = spark.createDataFrame([(*r, 0.5) for r in items],
                               "id long, text string, declared string, host string, like double")
    got = {r.id: r for r in langid.identify(df, model, ["id"]).collect()}
    assert got[100].lang == got[101].lang == got[104].lang == "de"
    assert got[100].text_lang is None and got[102].lang in ("de", "en")
    assert got[103].text_lang == "en" and got[None].lang == "de"


def test_empty_tables(spark):
    items = spark.createDataFrame([], "id long, text string, declared string, host string")
    model = langid.train_text(_docs(spark))
    assert langid.identify(items, model, ["id"]).count() == 0
    none = langid.train_text(_docs(spark).limit(0))
    one = spark.createDataFrame([(1, "text", "en", "h.org")], items.schema)
    assert langid.identify(one, none, ["id"]).first().lang is None


def _plain_likelihood(model, text):
    """The text's log likelihood of each language, from trigrams counted one by one."""
    out, last = [], None
    for x in text:
        c = x if x >= 128 else x | 32 if 65 <= (x & 0xDF) <= 90 else 32
        if not (c == 32 and last == 32):
            out.append(c)
        last = c
    counts = Counter()
    for a, b, c in zip(out, out[1:], out[2:]):
        counts[((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> 18] += 1
    n = sum(counts.values())
    if not n:
        return [0.0] * len(model.languages)
    return [sum(k * float(model.log_p[t, i]) for t, k in counts.items()) * min(n, langid.EVIDENCE) / n
            for i in range(len(model.languages))]


def _plain(items, model):
    """(lang, score) of each (text, declared, host): every count by a loop over all items."""
    langs = range(len(model.languages))
    like = [_plain_likelihood(model, (t or "").encode()) for t, _, _ in items]
    own = [max(langs, key=lambda i: (ll[i], -i)) if any(ll) else None for ll in like]
    total, votes = [0.0] * len(langs), {}
    keys = []
    for (_, declared, host), o in zip(items, own):
        host = host.lower() if host is not None else None
        parts = host.split(".") if host is not None else []
        k = {"host": host, "domain": ".".join(parts[-2:]) or None, "declared": declared and declared.lower(),
             "suffix": parts[-1] if len(parts) > 1 else None}
        keys.append(k)
        if o is not None:
            total[o] += 1
            for name, value in k.items():
                if value is not None:
                    votes.setdefault((name, value), [0.0] * len(langs))[o] += 1
    found = []
    for ll, o, k in zip(like, own, keys):
        prior = [(x + 1) / (sum(total) + len(langs)) for x in total]
        for name, weight in (("domain", langid.SMOOTH_DOMAIN), ("host", langid.SMOOTH_HOST)):
            v = list(votes.get((name, k[name]), [0.0] * len(langs)))
            if o is not None:
                v[o] = max(0.0, v[o] - 1)
            prior = [(a + weight * p) / (sum(v) + weight) for a, p in zip(v, prior)]
        post = [a + math.log(p) for a, p in zip(ll, prior)]
        for name in ("declared", "suffix"):
            v = votes.get((name, k[name]))
            if v:
                post = [p + math.log((a + 0.5) / (s + 1)) for p, a, s in zip(post, v, total)]
        z = [math.exp(p - max(post)) for p in post]
        i = max(langs, key=lambda j: (z[j], -j))
        found.append((model.languages[i], z[i] / sum(z)))
    return found


def test_query_matches_a_plain_version(spark):
    from quarterlens.llm.queries import QUERIES

    docs, pages = read(SMALL, "documents", "doc_id"), read(SMALL, "pages", "page_id")
    model = langid.train_text(spark.read.parquet(f"{SMALL}/documents.parquet"))
    items = [(t, None, s) for t, s in zip(docs.text, docs.source)]
    for url, html in zip(pages.url, pages.html):
        tag = re.search(r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]+)""", html)
        host = re.match(r"[^/?#]*", url.split("://", 1)[1])[0]
        items.append((re.sub(langid._TAGS, " ", html), tag and tag[1], host))
    ids = [(i, None) for i in docs.doc_id] + [(None, i) for i in pages.page_id]
    want = dict(zip(ids, _plain(items, model)))
    got = {(r.doc_id, r.page_id): (r.lang, r.score) for r in QUERIES["op7_language_id"](spark, SMALL).collect()}
    assert got.keys() == want.keys() and len(want) >= 250
    for k, (lang, score) in want.items():
        assert got[k][0] == lang and got[k][1] == pytest.approx(score, abs=1e-6), k
