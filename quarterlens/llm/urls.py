"""URL filters: host rules first, then naive Bayes over segmented host names and path words.

* Rules name a host and a path prefix; a rule fits its host and all subdomains, the longest wins.
* Word model: a unigram count of the words of all pages and paths. A host part is what is to be
  cut, so it is evidence of a word only if it is a seed word; any other adds to the total alone.
* Segmentation: each distinct host part is cut by Viterbi into the most probable words (an unknown
  string of n letters has probability 10 / (N 10^n); ties: fewer words, then order of letters).
  The counts come to a part by a join on its substrings, so the model is never broadcast. Time and
  memory grow with the length of a part, not with its square.
* Examples: a site (a host with the words of a path, numbers alike) is one of ``block`` if the texts
  of its pages say so - at least ``LISTED`` seed words, ``RATIO`` times as many among its words as
  among those of all pages - or, as a prior, if its own name holds one. All others are ``allow``.
* Naive Bayes (multinomial, add-one) of the words of hosts and paths; every page counts. A page no
  rule decides is blocked if ``block`` is the more probable class of its words, so names without
  any seed word are learned from what their pages are about.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlens.llm.common import checkpointed, fresh

# Words that unwanted pages use; what the names of such sites have in common is learned.
SEEDS = ("ads", "adult", "bet", "bets", "betting", "casino", "escort", "gambling", "jackpot",
         "malware", "pharma", "phishing", "pills", "poker", "porn", "sex", "slots", "spam",
         "track", "tracker", "viagra", "warez", "xxx")
LONGEST = 24                # letters of a word
PRIOR_PAGES = 10            # pages of each class assumed before any is seen
LISTED, RATIO = 2, 10       # seed words of a site's pages: so many, and so many times the usual share
SPANS = 20_000              # places of a host part whose substrings are gathered at a time
_MARKUP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_LETTERS = re.compile(r"[a-z]+")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (text up to the first ``/``: host, rest: path prefix) that fits, or null.

    ``rules`` is a literal list of (verdict, rule); of equally long ones the first in order wins.
    """
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, slash, rest = rule.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(
            path, F.lit(slash + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _path_words(path: Column) -> Column:
    """Lower-case words of a path; every number is ``0``."""
    words = F.split(F.regexp_replace(F.lower(path), r"[0-9]+", "0"), r"[^\p{L}0-9]+")
    return F.filter(words, lambda w: w != "")


def _host_parts(host: Column) -> Column:
    return F.filter(F.split(host, r"[^\p{L}0-9]+"), lambda w: w != "")


_READ = "word string, n long, site string, listed long"


def _read_pages(seeds: Sequence[str]):
    """(site, html) to counts of words (site null), and for each page (word null) how many words
    its text has and how many of them are seed words."""
    listed = frozenset(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def rows(*columns) -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["word", "n", "site", "listed"])

        def words() -> pa.RecordBatch:
            none = [None] * len(count)
            return rows(list(count), list(count.values()), none, none)

        for b in batches:
            sizes, hits = [], []
            for html in b.column(1).to_pylist():
                found = _LETTERS.findall(_MARKUP.sub(" ", html or "").lower())
                count.update(w for w in found if len(w) <= LONGEST)
                sizes.append(len(found))
                hits.append(sum(w in listed for w in found))
                if len(count) > 300_000:
                    yield words()
                    count.clear()
            yield rows([None] * len(sizes), sizes, b.column(0).to_pylist(), hits)
        yield words()
    return run


def viterbi(part: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of ``part`` under unigram ``counts`` out of ``total``; ties: fewer
    words, then the shorter word first. From the last letter back, with the length of the best
    first word kept at each place."""
    n, scale = len(part), math.log(max(1, total))
    best: list[tuple[float, int]] = [(0.0, 0)] * (n + 1)
    step = [0] * (n + 1)
    unknown = [math.log(10) - size * math.log(10) for size in range(LONGEST + 1)]
    for start in range(n - 1, -1, -1):
        least = None
        for size in range(1, min(LONGEST, n - start) + 1):
            seen = counts.get(part[start:start + size], 0)
            c, k = best[start + size]
            option = (round(c + scale - (math.log(seen) if seen else unknown[size]), 9), k + 1, size)
            if least is None or option < least:
                least = option
        best[start], step[start] = least[:2], least[2]
    out, at = [], 0
    while at < n:
        out.append(part[at:at + step[at]])
        at += step[at]
    return out


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Substrings of parts, up to ``LONGEST`` letters, with the part's key."""
    for b in batches:
        for key, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for low in range(0, len(part), SPANS):
                some = {part[i:i + size] for i in range(low, min(low + SPANS, len(part)))
                        for size in range(1, min(LONGEST, len(part) - i) + 1)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(some), pa.int64()), pa.array(list(some), pa.string())],
                    names=["key", "word"])


def _segment(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, known = b.column(0).to_pylist(), b.column(1).to_pylist()
            words = [viterbi(p, {k["word"]: k["n"] for k in ks or ()}, total)
                     for p, ks in zip(parts, known)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.list_(pa.string()))], names=["part", "words"])

    return run


def unigrams(sites: DataFrame, read: DataFrame, seeds: Sequence[str]) -> DataFrame:
    """(word, n, all): words of all page texts (``read``), and of host parts and paths (once a
    page).

    n is without the host parts that are no seed words, ``all`` is with them.
    """
    def named(words: str) -> DataFrame:
        return sites.select(F.explode(words).alias("word"), "n").where(
            F.length("word") <= LONGEST)

    text = read.where(F.col("word").isNotNull()).select("word", "n")
    known = text.union(named("path_words")).select("word", "n", F.col("n").alias("all"))
    hosts = named("parts").select(
        "word", F.when(F.col("word").isin(*seeds), F.col("n")).otherwise(0), "n")
    return known.union(hosts).groupBy("word").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))


def said_by_texts(read: DataFrame) -> DataFrame:
    """The sites whose texts are full of seed words."""
    pages = read.where(F.col("word").isNull())
    words, listed = pages.agg(F.sum("n"), F.sum("listed")).first()
    sites = pages.groupBy("site").agg(F.sum("n").alias("n"), F.sum("listed").alias("listed"))
    much = F.col("listed") * F.lit(float(words or 0)) > F.col("n") * F.lit(float(RATIO * (listed or 0)))
    return sites.where((F.col("listed") >= LISTED) & much).select("site")


def segment_parts(parts: DataFrame, words: DataFrame) -> DataFrame:
    """(part, words) of every distinct ``part``, by the counts of ``words``."""
    total = words.agg(F.sum("all")).first()[0] or 0
    # two parts of one key get each other's counts too, which neither uses
    keyed = parts.select(F.xxhash64("part").alias("key"), "part")
    spans = keyed.mapInArrow(_spans, "key long, word string").distinct()
    known = spans.join(words.where("n > 0"), "word").groupBy(F.col("key").alias("of")).agg(
        F.collect_list(F.struct("word", "n")).alias("known"))
    return keyed.join(known, F.col("key") == F.col("of"), "left").select("part", "known") \
        .mapInArrow(_segment(total), "part string, words array<string>")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], seeds: Sequence[str] = SEEDS,
          id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (or null), verdict, score.

    verdict: that of the longest rule that fits, else ``block`` if score > 0, else ``allow``;
    score: log odds of ``block`` by naive Bayes. A url that is null or has no ``://`` has an empty
    host and path, fits no rule, and is judged by the class shares alone, as is any host without
    words. Null html: no words. Repeated rows repeat and count. An empty table gives an empty
    result. Very long urls are taken whole (one without ``/`` is all host). Other columns are not
    read.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    # a digest: a site is a key of many rows, and its name may be very long
    keyed = rows.withColumn("site", F.md5(F.concat(F.col("host"), F.lit("/"),   # no host has a "/"
                                                   F.array_join(_path_words(F.col("path")), "/"))))
    sites = checkpointed(keyed.groupBy("site").agg(F.min("host").alias("host"),
                                                   F.min("path").alias("path"),
                                                   F.count("*").alias("n"))
                         .withColumn("parts", _host_parts(F.col("host")))
                         .withColumn("path_words", _path_words(F.col("path"))))
    read = checkpointed(keyed.select("site", "html").mapInArrow(_read_pages(seeds), _READ))
    words = checkpointed(unigrams(sites, read, seeds))
    parts = sites.select(F.explode("parts").alias("part")).distinct()
    cut = checkpointed(segment_parts(parts, words))
    from_host = sites.select("site", "n", F.explode("parts").alias("p")) \
        .join(cut, F.col("p") == F.col("part")).select("site", "n", F.explode("words").alias("t"))
    from_path = sites.select("site", "n", F.explode("path_words").alias("t"))
    tokens = checkpointed(from_host.union(from_path))
    named = tokens.where(F.col("t").isin(*seeds)).select("site")
    bad = checkpointed(named.union(said_by_texts(read)).distinct().withColumn("bad", F.lit(True)))
    marked = sites.select("site", "n").join(bad.withColumnRenamed("site", "s"),
                                            F.col("site") == F.col("s"), "left") \
        .select("site", "n", F.coalesce("bad", F.lit(False)).alias("bad"))
    marked = checkpointed(marked)
    blocked, allowed = marked.agg(F.sum(F.when(F.col("bad"), F.col("n"))),
                                  F.sum(F.when(~F.col("bad"), F.col("n")))).first()
    counts = tokens.join(marked.select(F.col("site").alias("s"), "bad"),
                         F.col("site") == F.col("s")).groupBy("t").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("a"))
    counts = checkpointed(counts)
    in_b, in_a, size = counts.agg(F.sum("b"), F.sum("a"), F.count("*")).first()
    weight = F.log((F.col("b") + 1) / F.lit(float((in_b or 0) + size + 1))) \
        - F.log((F.col("a") + 1) / F.lit(float((in_a or 0) + size + 1)))
    odds = checkpointed(counts.select(F.col("t").alias("token"), weight.alias("w")))
    prior = math.log(((blocked or 0) + PRIOR_PAGES) / ((allowed or 0) + PRIOR_PAGES))
    scores = checkpointed(tokens.join(odds, F.col("t") == F.col("token"))
                          .groupBy("site").agg(F.round(F.sum("w"), 9).alias("w"))
                          .select(F.col("site").alias("s"), "w"))
    scored = keyed.drop("html").join(scores, F.col("site") == F.col("s"), "left")
    verdicts = F.create_map(*[F.lit(x) for v, r in rules for x in (r, v)]) if rules else None
    rule, = fresh(scored, "rule")
    scored = scored.withColumn(rule, rule_for(F.col("host"), F.col("path"), rules)) \
        .withColumn("score", F.coalesce("w", F.lit(0.0)) + F.lit(prior))
    by_model = F.when(F.col("score") > 0, "block").otherwise("allow")
    verdict = F.coalesce(verdicts[F.col(rule)], by_model) if rules else by_model
    return scored.select(F.col("id").alias(id_col), "host", "path", F.col(rule).alias("rule"),
                         verdict.alias("verdict"), "score")
