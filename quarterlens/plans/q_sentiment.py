"""Registered text and sentiment queries (documents stand in for MD&A sections)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from quarterlens.functions.text import first_sentence_with, section_10k, section_10q
from quarterlens.operators.partitioning import spread
from quarterlens.operators.scoring import DEMO_LEXICON, demo_scorer
from quarterlens.operators.sentiment import (averages_only, explode_paragraphs,
                                             sentiment_stats)
from quarterlens.operators.subwords import (JsonVocabulary, SubwordScorer, TokenLexiconModel,
                                            token_counts)
from quarterlens.plans import sql_snippets as S
from quarterlens.plans.filings import extract_mda
from quarterlens.plans import stand_ins
from quarterlens.plans.registry import register, rounded
from quarterlens.sources.tables import read_table
from quarterlens.streaming.incremental import union_incremental
from quarterlens.streaming.ledger import DONE, FAILED, state

STATS_SQL = S.stats_sql()


@register("sentiment_stats", STATS_SQL)
def q_sentiment_stats(spark, sf):
    """One row per document, sentinel rows for documents without chunks."""
    return rounded(sentiment_stats(stand_ins.documents(spark, sf), demo_scorer()))


@register("sentiment_avg_null", f"""
WITH s AS ({S.stats_sql(empty='null')})
SELECT doc_id, avg_positive, avg_negative, avg_neutral FROM s""")
def q_sentiment_avg_null(spark, sf):
    """Averages only, null when a document has no chunk."""
    return rounded(averages_only(stand_ins.documents(spark, sf), demo_scorer()))


@register("paragraphs", f"""
WITH ex AS ({S.exploded_paragraphs_cte()})
SELECT doc_id, pos::INTEGER AS pos, paragraph, length(paragraph)::INTEGER AS n_chars
FROM ex WHERE paragraph IS NOT NULL""")
def q_paragraphs(spark, sf):
    """I19 + I25: stripped paragraphs longer than 50 characters, with position."""
    par = explode_paragraphs(stand_ins.documents(spark, sf), ["doc_id"], "text", outer=False)
    return par.select("doc_id", "pos", "paragraph", F.length("paragraph").alias("n_chars"))


@register("softmax3", f"""
WITH ex AS ({S.exploded_paragraphs_cte()}),
c AS (SELECT doc_id, pos, {S.lexicon_counts('paragraph')} FROM ex WHERE paragraph IS NOT NULL),
m AS (SELECT *, greatest(np, nn, nu) AS mx FROM c)
SELECT doc_id, pos::INTEGER AS pos,
  round(exp(np - mx) / (exp(np - mx) + exp(nn - mx) + exp(nu - mx)), 6) AS positive,
  round(exp(nn - mx) / (exp(np - mx) + exp(nn - mx) + exp(nu - mx)), 6) AS negative,
  round(exp(nu - mx) / (exp(np - mx) + exp(nn - mx) + exp(nu - mx)), 6) AS neutral
FROM m""")
def q_softmax3(spark, sf):
    """Softmax of per-paragraph lexicon logits."""
    par = explode_paragraphs(stand_ins.documents(spark, sf), ["doc_id"], "text", outer=False)
    return rounded(demo_scorer("softmax").score(par, "paragraph")
                   .select("doc_id", "pos", "positive", "negative", "neutral"))


@register("sentiment_incremental", STATS_SQL)
def q_sentiment_incremental(spark, sf):
    """M1: documents already scored (English ones) + only the pending rest, once each.

    The union must equal a full recompute (``sentiment_stats``).
    """
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), ["doc_id"])
    scorer = demo_scorer()
    done = docs.filter(F.col("lang") == "en")
    existing = sentiment_stats(done.select("doc_id", "text"), scorer)
    full = union_incremental(existing, docs.select("doc_id", "text"), ["doc_id"],
                             lambda todo: sentiment_stats(todo, scorer), done_keys=done)
    return rounded(full)


@register("keyword_sentence", f"""
SELECT doc_id,
  {S.strip("list_filter(string_split(text, '.'), lambda s: contains(lower(s), 'the'))[1]")} AS sentence
FROM documents""")
def q_keyword_sentence(spark, sf):
    """First '.'-separated sentence mentioning the keyword, whole text searched."""
    d = stand_ins.documents(spark, sf)
    return d.select("doc_id", first_sentence_with("text", "the").alias("sentence"))


# Filing texts for the section rules are built from each document: a skipped
# prefix, markers placed per language (a data property), the body. Fixed layouts:
Q_LAYOUT = {
    "en": ("repeat('.', 20000)", "'Item 2. Management Discussion' || chr(10)", "chr(10) || 'Item 3. Quantitative Disclosures'"),
    "fr": ("repeat('.', 20000)", "'ITEM 2: '", "''"),
    "de": ("'Item 2. ' || repeat('.', 20000)", "''", "' item 3. '"),
    "es": ("repeat('x', 20000)", "'item 2 - '", "' Item 2. again item 3: tail'"),
}
K_LAYOUT = {
    "en": ("repeat('.', 18000)", "'Item 7. Management Discussion and Analysis of Financial Condition' || chr(10)", "chr(10) || 'Item 7A. Quantitative'"),
    "fr": ("repeat('.', 18000)", "'ITEM 7 MANAGEMENT DISCUSSION ANALYSIS '", "' Item 8. Financial Statements'"),
    "de": ("repeat('.', 18000)", "'Item 7. Management Item 8. Discussion and Analysis '", "''"),
    "es": ("repeat('.', 18000)", "'Item 7. Management' || chr(10) || 'Discussion Analysis '", "'Item 8.'"),
}


def _filing_text_sql(layout) -> str:
    cases = " ".join(f"WHEN '{lang}' THEN {pre} || {start} || text || {end}"
                     for lang, (pre, start, end) in layout.items())
    pre, start, end = layout["en"]          # any other language, and none, has the English layout
    return f"CASE lang {cases} ELSE {pre} || {start} || text || {end} END"


def _filing_docs(spark, sf, layout):
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), ["doc_id"])
    return docs.select("doc_id", F.expr(_filing_text_sql(layout)).alias("filing_text"))


def _section_sql(layout, skip, start_re, end_re) -> str:
    return f"""
WITH f AS (SELECT doc_id, {_filing_text_sql(layout)} AS t FROM documents),
r AS (SELECT doc_id, substr(t, {skip + 1}) AS rest FROM f),
s AS (SELECT doc_id, rest, regexp_extract(rest, '(?i){start_re}') AS ms FROM r),
t AS (SELECT doc_id, CASE WHEN ms <> '' THEN substr(rest, strpos(rest, ms)) END AS tail FROM s),
e AS (SELECT doc_id, tail, regexp_extract(tail, '(?i){end_re}') AS me FROM t)
SELECT doc_id,
  nullif({S.strip("CASE WHEN me <> '' THEN substr(tail, 1, strpos(tail, me) - 1) END")}, '') AS section
FROM e"""


@register("section_10q", _section_sql(Q_LAYOUT, 20000, r"item[\s\.]*2[\s\.\:-]+", r"item[\s\.]*3[\s\.\:-]+"))
def q_section_10q(spark, sf):
    """Quarterly-report MD&A cut (item 2 .. item 3 after 20,000 skipped chars)."""
    f = _filing_docs(spark, sf, Q_LAYOUT)
    return f.select("doc_id", section_10q("filing_text").alias("section"))


def _dispatch_text_sql() -> str:
    """Every third document is laid out as a 10-K, the others as a 10-Q."""
    return (f"CASE WHEN doc_id % 3 = 0 THEN {_filing_text_sql(K_LAYOUT)} "
            f"ELSE {_filing_text_sql(Q_LAYOUT)} END")


DISPATCH_TYPE = "CASE WHEN doc_id % 3 = 0 THEN '10-K' ELSE '10-Q' END"
DISPATCH_NAME = f"'20220101_' || {DISPATCH_TYPE} || '_edgar_data_' || doc_id || '_0000-22-1.txt'"


def _cut_sql(source: str, skip: int, start_re: str, end_re: str) -> str:
    return f"""
SELECT doc_id, name, nullif({S.strip("CASE WHEN me <> '' THEN substr(tail, 1, strpos(tail, me) - 1) END")}, '') AS section
FROM (SELECT *, regexp_extract(tail, '(?i){end_re}') AS me
FROM (SELECT *, CASE WHEN ms <> '' THEN substr(rest, strpos(rest, ms)) END AS tail
FROM (SELECT *, regexp_extract(rest, '(?i){start_re}') AS ms
FROM (SELECT doc_id, name, substr(t, {skip + 1}) AS rest FROM {source}))))"""


Q_RE = (r"item[\s\.]*2[\s\.\:-]+", r"item[\s\.]*3[\s\.\:-]+")
K_RE = (r"Item\s*7\.*\s*Management.*?Discussion.*?Analysis", r"Item\s*7A\.|Item\s*8\.")


@register("section_dispatch", f"""
WITH f AS (SELECT doc_id, {DISPATCH_NAME} AS name, {_dispatch_text_sql()} AS t FROM documents),
s AS ({_cut_sql("(SELECT * FROM f WHERE contains(name, '10-K'))", 18000, *K_RE)}
UNION ALL {_cut_sql("(SELECT * FROM f WHERE NOT contains(name, '10-K'))", 20000, *Q_RE)})
SELECT regexp_extract(name, 'edgar_data_([0-9]+)_', 1) AS cik, name AS filename,
       'filings/' || name AS path, section AS management_discussion FROM s""")
def q_section_dispatch(spark, sf):
    """The section rule follows the filing type, over mixed 10-K and 10-Q filings."""
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), ["doc_id"])
    f = docs.select(F.expr(DISPATCH_NAME).alias("filename"),
                    F.concat(F.lit("filings/"), F.expr(DISPATCH_NAME)).alias("path"),
                    F.expr(_dispatch_text_sql()).alias("text"))
    return extract_mda(f)


@register("section_10k", _section_sql(K_LAYOUT, 18000,
                                      r"Item\s*7\.*\s*Management.*?Discussion.*?Analysis",
                                      r"Item\s*7A\.|Item\s*8\."))
def q_section_10k(spark, sf):
    """Annual-report MD&A cut (item 7 .. item 7A / 8 after 18,000 skipped chars)."""
    f = _filing_docs(spark, sf, K_LAYOUT)
    return f.select("doc_id", section_10k("filing_text").alias("section"))


@register("failure_ledger", """
WITH log AS (SELECT user_id AS ticker, event_id::VARCHAR AS run, ts AS tried, event_type AS reason,
                    event_type <> 'purchase' AS failed FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY tried DESC, run DESC) AS nth FROM log WHERE failed),
l AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY tried DESC, failed DESC, run DESC) AS nth FROM log)
SELECT f.ticker, max(f.reason) FILTER (f.nth = 1) AS reason, count(*) AS attempts, min(f.tried) AS first_at,
       max(f.tried) AS last_at, bool_or(l.failed) AS is_open
FROM f JOIN l ON l.nth = 1 AND f.ticker IS NOT DISTINCT FROM l.ticker GROUP BY f.ticker""")
def q_failure_ledger(spark, sf):
    """The keyed state of a ledger of failed and finished runs (each event is one run of
    its user's key; a purchase finishes it): attempts, last reason, open or not."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    done = F.col("event_type") == "purchase"
    log = e.select(F.col("user_id").alias("ticker"), F.lit(None).cast("string").alias("path"),
                   F.col("event_id").cast("string").alias("run"), F.col("ts").alias("at"),
                   F.when(done, DONE).otherwise(FAILED).alias("outcome"),
                   F.when(~done, F.col("event_type")).alias("reason"))
    return state(log, ["ticker"]).drop("path")


def subword_vocabulary():
    """The public word-level BPE vocabulary, as pieces for longest match."""
    import public_tokenizers

    return JsonVocabulary(public_tokenizers.path("word_bpe_49k.json"))


SUBWORD_LIMIT = 128          # the test documents' paragraphs are short; the model's limit is 512


@register("subword_tokens")
def q_subword_tokens(spark, sf):
    """Tokens of every paragraph of every document, and whether a model's input is cut; the
    same numbers as a plain version in the tests."""
    par = explode_paragraphs(stand_ins.documents(spark, sf), ["doc_id"], "text", outer=False)
    return token_counts(par, subword_vocabulary(), max_tokens=SUBWORD_LIMIT) \
        .select("doc_id", "pos", "n_tokens", "n_used", "is_cut")


@register("subword_sentiment")
def q_subword_sentiment(spark, sf):
    """U2 + N7: per-document statistics of paragraphs scored on their cut sub-words."""
    vocabulary = subword_vocabulary()
    scorer = SubwordScorer(vocabulary, partial(TokenLexiconModel, vocabulary, DEMO_LEXICON),
                           SUBWORD_LIMIT)
    return rounded(sentiment_stats(stand_ins.documents(spark, sf), scorer))
