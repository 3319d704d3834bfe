"""Text expressions.

Python's ``str.strip`` and ``\\s`` are Unicode-aware while Spark's ``trim`` only
removes spaces, so stripping uses the explicit character set below with
``trim(BOTH chars FROM s)`` (no regex, code-point aware).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.functions.util import col_of

# The characters Python's str.strip() removes (str.isspace()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed values that must equal the reference's: header key, section markers and
# how many leading characters each filing type skips before searching.
PERIOD_PATTERN = r"CONFORMED PERIOD OF REPORT:\s*(\d{8})"
HEADER_CHARS = 5000
Q_START = r"item[\s\.]*2[\s\.\:-]+"
Q_END = r"item[\s\.]*3[\s\.\:-]+"
Q_SKIP = 20000
K_START = r"Item\s*7\.*\s*Management.*?Discussion.*?Analysis"
K_END = r"Item\s*7A\.|Item\s*8\."
K_SKIP = 18000
MIN_TEXT_CHARS = 20       # I25: shorter stripped text has no paragraphs
MIN_PARAGRAPH_CHARS = 50  # I19: keep paragraphs strictly longer than this

# Java regex flags giving Python semantics: Unicode classes (\d as in Python 3 str
# patterns) and only \n ends a line for '.'; ``i`` adds Unicode-aware IGNORECASE.
PY_FLAGS = "(?Ud)"
PY_FLAGS_IGNORECASE = "(?iUd)"
_PY_WS_CLASS_BODY = "".join(f"\\x{{{ord(c):04X}}}" for c in PY_WHITESPACE)


def python_regex(pattern: str, ignore_case: bool = False) -> str:
    r"""Java form of a Python ``re`` pattern (``re.IGNORECASE`` when ``ignore_case``):
    ``\s`` becomes exactly the characters Python's ``\s`` matches in a str pattern
    (Java's Unicode ``\s`` lacks U+001C-1F), inside and outside character classes.
    Other syntax used here is shared."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "s":
                out.append(_PY_WS_CLASS_BODY if in_class else f"[{_PY_WS_CLASS_BODY}]")
            else:
                out.append(pattern[i:i + 2])
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    return (PY_FLAGS_IGNORECASE if ignore_case else PY_FLAGS) + "".join(out)


def py_strip(c) -> Column:
    """Python ``str.strip()``."""
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def normalise_newlines(c) -> Column:
    """Local text reads turn CRLF / CR into LF and drop undecodable bytes (U+FFFD).

    Literal replacements (CRLF first, then a lone CR), not regexes: each is one scan
    that returns the input untouched when there is nothing to replace.
    """
    s = F.replace(col_of(c), F.lit("\r\n"), F.lit("\n"))
    s = F.replace(s, F.lit("\r"), F.lit("\n"))
    return F.replace(s, F.lit("\ufffd"), F.lit(""))


def text_is_usable(c) -> Column:
    """A string whose stripped length is at least 20 characters (null -> false)."""
    return F.coalesce(F.length(py_strip(c)) >= MIN_TEXT_CHARS, F.lit(False))


def paragraphs(c) -> Column:
    """I19 + I25: split on runs of newline, strip each, keep those longer than 50.

    Returns ``array<string>``; unusable text (null, blank, < 20 chars) gives ``[]``.
    """
    c = col_of(c)
    # Splitting on each newline (a plain, non-regex split) gives the same paragraphs as
    # splitting on runs of them: the empty pieces between newlines fail the length test.
    parts = F.transform(F.split(c, "\n"), py_strip)
    kept = F.filter(parts, lambda p: F.length(p) > MIN_PARAGRAPH_CHARS)
    return F.when(text_is_usable(c), kept).otherwise(F.array().cast("array<string>"))


def header_period(c, header_chars: int = HEADER_CHARS) -> Column:
    """I9 + A2: report period (DATE) from the first ``header_chars`` characters.

    Missing key or an impossible date (e.g. month 13) gives null, never an error.
    """
    head = F.substring(col_of(c), 1, header_chars)
    digits = F.regexp_extract(head, python_regex(PERIOD_PATTERN), 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")


def _section(text, start_re: str, end_re: str, skip: int) -> Column:
    """From the first start match to the first end match at or after it.

    The end search begins at the start match's first character, so an end marker
    inside the start match counts (L20). No start or no end gives null; the cut
    is stripped and an empty cut is null (L19).
    """
    rest = F.substring(col_of(text), skip + 1, 2147483647)
    s = F.regexp_instr(rest, F.lit(python_regex(start_re, ignore_case=True)))
    tail = F.substring(rest, s, 2147483647)
    e = F.regexp_instr(tail, F.lit(python_regex(end_re, ignore_case=True)))
    cut = F.when((s > 0) & (e > 0), F.substring(tail, F.lit(1), e - 1))
    return F.nullif(py_strip(cut), F.lit(""))


def section_10q(text, skip: int = Q_SKIP) -> Column:
    """Item 2 up to item 3, searching after the first ``skip`` characters."""
    return _section(text, Q_START, Q_END, skip)


def section_10k(text, skip: int = K_SKIP) -> Column:
    """Item 7 (Management ... Discussion ... Analysis) up to item 7A or 8."""
    return _section(text, K_START, K_END, skip)


# (skip, start, end) by filing type; any type but 10-K has the quarterly rule.
SECTION_RULES = {"10-K": (K_SKIP, K_START, K_END), "10-Q": (Q_SKIP, Q_START, Q_END)}


def with_section(df: DataFrame, text: str, filing_type: Column, out: str) -> DataFrame:
    """``df`` plus the section of ``text`` that its filing type's rule cuts out.

    Each type sees its own texts only (null for the others, on which a regex costs nothing), and
    every step is a column of its own under a projection, so a marker is searched once per
    filing. A single nested expression would repeat the search for each use of its position.
    """
    own = {"10-K": filing_type == "10-K", "10-Q": ~F.coalesce(filing_type == "10-K", F.lit(False))}
    rest = {t: f"_rest_{i}" for i, t in enumerate(SECTION_RULES)}
    for t, (skip, _, _) in SECTION_RULES.items():
        df = df.withColumn(rest[t], F.when(own[t], F.substring(col_of(text), skip + 1, 2147483647)))
    for t, (_, start, _) in SECTION_RULES.items():
        at = F.regexp_instr(F.col(rest[t]), F.lit(python_regex(start, ignore_case=True)))
        df = df.withColumn(f"{rest[t]}_s", at)
    for t in SECTION_RULES:
        s = F.col(f"{rest[t]}_s")
        df = df.withColumn(f"{rest[t]}_tail", F.when(s > 0, F.substring(F.col(rest[t]), s, F.lit(2147483647))))
    for t, (_, _, end) in SECTION_RULES.items():
        tail = F.col(f"{rest[t]}_tail")
        df = df.withColumn(f"{rest[t]}_e", F.regexp_instr(tail, F.lit(python_regex(end, ignore_case=True))))
    cuts = []
    for t in SECTION_RULES:
        e = F.col(f"{rest[t]}_e")
        cuts.append(F.when(e > 0, F.substring(F.col(f"{rest[t]}_tail"), F.lit(1), e - 1)))
    df = df.withColumn(out, F.nullif(py_strip(F.coalesce(*cuts)), F.lit("")))
    return df.drop(*[c for r in rest.values() for c in (r, f"{r}_s", f"{r}_tail", f"{r}_e")])


def first_sentence_with(c, keyword: str) -> Column:
    """First ``.``-separated piece containing ``keyword`` (case-insensitive), stripped."""
    kw = keyword.lower()
    hits = F.filter(F.split(col_of(c), r"\."), lambda s: F.lower(s).contains(kw))
    return py_strip(F.try_element_at(hits, F.lit(1)))
