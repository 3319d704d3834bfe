"""Shared DuckDB SQL fragments for the oracle queries (same rules as the Spark code)."""

from __future__ import annotations

from quarterlens.functions.text import PY_WHITESPACE
from quarterlens.operators.scoring import DEMO_LEXICON

WS = PY_WHITESPACE.replace("'", "''")


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def paragraphs(text: str) -> str:
    """list<varchar> of stripped paragraphs longer than 50 chars; [] for unusable text."""
    return (f"CASE WHEN coalesce(length({strip(text)}) >= 20, false) THEN "
            f"list_filter(list_transform(regexp_split_to_array({text}, '\\n+'), "
            f"lambda x: {strip('x')}), lambda p: length(p) > 50) "
            f"ELSE []::VARCHAR[] END")


def _inlist(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def lexicon_counts(par: str) -> str:
    """np, nn, nu hit counts of the demo lexicon for a paragraph expression."""
    toks = f"string_split(regexp_replace(lower({par}), '[.,;:!?()\"'']', '', 'g'), ' ')"
    parts = []
    for short, cls in (("np", "positive"), ("nn", "negative"), ("nu", "neutral")):
        parts.append(f"len(list_filter({toks}, lambda w: w IN ({_inlist(DEMO_LEXICON[cls])})))::BIGINT AS {short}")
    return ", ".join(parts)


def exploded_paragraphs_cte(source: str = "documents", key: str = "doc_id") -> str:
    """CTE body: (key, pos, paragraph) with one null row for paragraph-less docs."""
    return f"""
    SELECT d.{key}, p.pos, p.paragraph
    FROM (SELECT {key}, {paragraphs('text')} AS ps FROM {source}) d
    LEFT JOIN LATERAL (
        SELECT generate_subscripts(d.ps, 1) - 1 AS pos, unnest(d.ps) AS paragraph
    ) p ON true"""


def stats_sql(source: str = "documents", key: str = "doc_id", empty: str = "sentinel",
              shares: bool = True) -> str:
    fill = "-1.0" if empty == "sentinel" else "NULL::DOUBLE"
    if shares:
        probs = ("(np + 1)::DOUBLE / (np + nn + nu + 3) AS positive, "
                 "(nn + 1)::DOUBLE / (np + nn + nu + 3) AS negative, "
                 "(nu + 1)::DOUBLE / (np + nn + nu + 3) AS neutral")
    else:
        raise NotImplementedError
    return f"""
WITH ex AS ({exploded_paragraphs_cte(source, key)}),
cnt AS (SELECT {key}, pos, paragraph, {lexicon_counts('paragraph')} FROM ex),
sc AS (SELECT {key}, paragraph, {probs} FROM cnt),
lab AS (SELECT *, CASE WHEN positive >= negative AND positive >= neutral THEN 'positive'
                       WHEN negative >= neutral THEN 'negative' ELSE 'neutral' END AS top FROM sc),
agg AS (
  SELECT {key}, count(paragraph) AS n_chunks,
    count(*) FILTER (WHERE paragraph IS NOT NULL AND top = 'positive') AS count_positive_chunks,
    count(*) FILTER (WHERE paragraph IS NOT NULL AND top = 'negative') AS count_negative_chunks,
    count(*) FILTER (WHERE paragraph IS NOT NULL AND top = 'neutral') AS count_neutral_chunks,
    max(positive) AS mp, max(negative) AS mn, max(neutral) AS mu,
    sum(positive) AS sp, sum(negative) AS sn, sum(neutral) AS su
  FROM lab GROUP BY {key})
SELECT {key}, n_chunks, count_positive_chunks, count_negative_chunks, count_neutral_chunks,
  round(CASE WHEN n_chunks > 0 THEN greatest(mp, 0.0) ELSE {fill} END, 6) AS max_positive_score,
  round(CASE WHEN n_chunks > 0 THEN greatest(mn, 0.0) ELSE {fill} END, 6) AS max_negative_score,
  round(CASE WHEN n_chunks > 0 THEN greatest(mu, 0.0) ELSE {fill} END, 6) AS max_neutral_score,
  round(CASE WHEN n_chunks > 0 THEN sp ELSE {fill} END, 6) AS sum_positive,
  round(CASE WHEN n_chunks > 0 THEN sn ELSE {fill} END, 6) AS sum_negative,
  round(CASE WHEN n_chunks > 0 THEN su ELSE {fill} END, 6) AS sum_neutral,
  round(CASE WHEN n_chunks > 0 THEN sp / n_chunks ELSE {fill} END, 6) AS avg_positive,
  round(CASE WHEN n_chunks > 0 THEN sn / n_chunks ELSE {fill} END, 6) AS avg_negative,
  round(CASE WHEN n_chunks > 0 THEN su / n_chunks ELSE {fill} END, 6) AS avg_neutral,
  round(CASE WHEN n_chunks > 0 THEN (sp - sn) / n_chunks END, 6) AS net_sentiment,
  CASE WHEN n_chunks > 0 THEN su / n_chunks > 0.6 END AS neutral_dominance_score,
  CASE WHEN n_chunks > 0 THEN count_neutral_chunks / n_chunks > 0.6 END AS neutral_dominance_count,
  round(CASE WHEN n_chunks > 0 THEN -(
      CASE WHEN sp / n_chunks > 0 THEN (sp / n_chunks) * log2(sp / n_chunks) ELSE 0 END +
      CASE WHEN sn / n_chunks > 0 THEN (sn / n_chunks) * log2(sn / n_chunks) ELSE 0 END +
      CASE WHEN su / n_chunks > 0 THEN (su / n_chunks) * log2(su / n_chunks) ELSE 0 END) END, 6)
    AS sentiment_entropy
FROM agg"""
