"""Repair of conversation structure: the cheapest edits that make the turns alternate again.

Each row is a symbol of its role and first fault. Keep, Rerole, Delete and Insert move an automaton
for ``(s?(ua)+)?`` over the rows, so a row is a 4 x 4 min-plus matrix: the least cost from state to
state, with the audit (the edits' initials) that has it. Rows in sequence multiply.

Re-Pair: the most frequent adjacent symbol pairs of the whole corpus become rules, round by round
(``RULES`` a round, counted by Spark over distinct sequences). Each rule has one matrix, evaluated
bottom-up from its two parts and shared by all conversations; audits are ropes, joined only when
they are compared or written. The grammar is bounded by ``ROUNDS`` x ``RULES`` and only saves work:
results do not depend on it.

A conversation may hold any share of the rows. Rows are range partitioned by their whole order and
cut into segments of at most ``SEGMENT``; a segment's matrix is computed where it lies, and only
matrices of one conversation meet, streamed in order. No two audits of equal cost over the same
rows are prefixes of one another (each ends with the edit of a row), so the ASCII-least one is made
of ASCII-least parts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterlens.llm.common import checkpointed, fresh

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1      # costs
SEGMENT_BITS = 10
ROUNDS, RULES = 4, 32
MEMO = 4096                  # sequences whose matrices a task remembers
# states: 0 nothing yet, 1 after the system row, 2 after a user's, 3 after an assistant's
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
SYMBOLS = "bdsuaoSUAO"       # blank, duplicate; role system, user, assistant, other; large: truncated
_WORD = r"[^\x20\x09-\x0D]"

# a rope: a string, or a pair of ropes
Matrix = list                # 16 entries (cost, rope) or None, row by row


def flat(rope) -> str:
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def better(x, y):
    """The cheaper of two entries; of equal ones that with the ASCII-least audit."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return x if flat(x[1]) <= flat(y[1]) else y


def times(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for i in range(4):
        for j in range(4):
            best = None
            for k in range(4):
                x, y = a[4 * i + k], b[4 * k + j]
                if x is not None and y is not None:
                    best = better(best, (x[0] + y[0], (x[1], y[1])))
            out.append(best)
    return out


def _matrix(edits) -> Matrix:
    out: Matrix = [None] * 16
    for i, j, cost, letter in edits:
        out[4 * i + j] = better(out[4 * i + j], (cost, letter))
    return out


def _insertions() -> Matrix:
    """Any number of inserted rows; more than three reach no state that fewer do not."""
    none = [(i, i, 0, "") for i in range(4)]
    one = _matrix(none + [(i, j, INSERT, "I") for (i, r), j in STEP.items() if r in "ua"])
    return times(times(one, one), one)


def symbol_matrix(symbol: str) -> Matrix:
    """Rows inserted before a row of this symbol, then its own edit."""
    edits = [(i, i, DELETE, "D") for i in range(4)]
    if symbol not in "bd":
        role, more = symbol.lower(), TRUNCATED * symbol.isupper()
        edits += [(i, j, KEEP + more, "K") for (i, r), j in STEP.items() if r == role]
        edits += [(i, j, REROLE + more, "R") for (i, r), j in STEP.items() if r in "ua"]
    return times(_insertions(), _matrix(edits))


class Grammar:
    """Rules in order: rule r (symbol number len(SYMBOLS) + r) stands for a pair of symbols."""

    def __init__(self) -> None:
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices = [symbol_matrix(s) for s in SYMBOLS]

    def add(self, left: int, right: int) -> None:
        self.rules[left, right] = len(self.matrices)
        self.matrices.append(times(self.matrices[left], self.matrices[right]))

    def compress(self, symbols: str) -> list[int]:
        """The sequence with rules applied, oldest first, each from left to right."""
        seq = [SYMBOLS.index(s) for s in symbols]
        while len(seq) > 1:
            made = min((self.rules[p] for p in zip(seq, seq[1:]) if p in self.rules), default=None)
            if made is None:
                break
            out, i = [], 0
            while i < len(seq):
                if i + 1 < len(seq) and self.rules.get((seq[i], seq[i + 1])) == made:
                    out.append(made)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return seq

    def matrix(self, symbols: str) -> Matrix:
        parts = [self.matrices[s] for s in self.compress(symbols)]
        while len(parts) > 1:
            parts = [times(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0]


def pair_counts(seq: list[int]) -> Counter:
    """Adjacent pairs that do not overlap: a run of n equal symbols has n // 2."""
    out, last = Counter(), None
    for pair in zip(seq, seq[1:]):
        if pair == last and pair[0] == pair[1]:
            last = None
        else:
            out[pair] += 1
            last = pair
    return out


def learn(sequences: DataFrame) -> Grammar:
    """Re-Pair rules of all ``symbols``: the most frequent pairs of each round (ties: smaller)."""
    distinct = checkpointed(sequences.groupBy("symbols").agg(F.count("*").alias("n")))
    grammar = Grammar()
    for _ in range(ROUNDS):
        def count(batches: Iterator[pa.RecordBatch], g=grammar) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found: Counter = Counter()
                for symbols, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for pair, times_ in pair_counts(g.compress(symbols)).items():
                        found[pair] += n * times_
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in found], pa.int32()),
                     pa.array([p[1] for p in found], pa.int32()),
                     pa.array(list(found.values()), pa.int64())], names=["l", "r", "n"])

        top = distinct.mapInArrow(count, "l int, r int, n long").groupBy("l", "r") \
            .agg(F.sum("n").alias("n")).filter("n > 1") \
            .orderBy(F.desc("n"), "l", "r").limit(RULES).collect()
        if not top:
            break
        for r in top:
            grammar.add(r.l, r.r)
    return grammar


_PRODUCT = "costs array<int>, audits array<string>"


def _products(grammar: Grammar, at: int):
    """Each segment's matrix (cost -1: no way)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple] = {}
        for b in batches:
            made = []
            for symbols in b.column(at).to_pylist():
                if symbols not in memo:
                    if len(memo) >= MEMO:
                        memo.clear()
                    m = grammar.matrix(symbols)
                    memo[symbols] = ([-1 if x is None else x[0] for x in m],
                                     [None if x is None else flat(x[1]) for x in m])
                made.append(memo[symbols])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([m[0] for m in made], pa.list_(pa.int32())),
                 pa.array([m[1] for m in made], pa.list_(pa.string()))],
                names=[*b.schema.names, "costs", "audits"])
    return run


class _Chain:
    """One conversation as its segments come: the best way to each state, and the sums."""

    def __init__(self, conv) -> None:
        self.conv = conv
        # state -> (cost, rank among the states' audits, chain of (chain, state before, segment))
        self.ways: dict[int, tuple] = {0: (0, 0, None)}
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last = ""                      # role initial of the last row
        self.turns = None                   # (least, greatest, how many)

    def add(self, seg: dict) -> None:
        symbols, initials = seg["symbols"], self.last + seg["initials"]
        self.blank += symbols.count("b")
        self.duplicate += symbols.count("d")
        self.truncated += sum(map(symbols.count, "SUAO"))
        self.illegal += sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))
        self.last = initials[-1]
        if seg["t_n"]:
            if self.turns is None:
                self.turns = seg["t_min"], seg["t_max"], seg["t_n"]
            else:
                low, high, n = self.turns
                self.turns = low, seg["t_max"], n + seg["t_n"] - (high == seg["t_min"])
        found = {}
        for j in range(4):
            some = [(way[0] + seg["costs"][4 * k + j], way[1], k) for k, way in self.ways.items()
                    if seg["costs"][4 * k + j] >= 0]
            if some:
                found[j] = min(some)
        # audits to different states differ, and none begins another: they rank by what came
        # before, then by this segment's part
        order = sorted(found, key=lambda j: (found[j][1], seg["audits"][4 * found[j][2] + j]))
        held = (seg["first"], symbols, seg["audits"])
        self.ways = {j: (found[j][0], order.index(j), (self.ways[found[j][2]][2], found[j][2], j, held))
                     for j in found}

    def end(self) -> tuple[int, str, list[tuple[int, list[str]]]]:
        """Cost, audit, and (first row, edit of each row) of each segment."""
        close = _insertions()
        cost, rank, tail, j = min(
            (way[0] + close[4 * j + e][0], way[1], flat(close[4 * j + e][1]), j)
            for j, way in self.ways.items() for e in ENDS if close[4 * j + e] is not None)
        chain, pieces = self.ways[j][2], []
        while chain is not None:
            chain, k, to, (first, symbols, audits) = chain
            pieces.append((first, k, symbols, audits[4 * k + to]))
        pieces.reverse()
        edits = [(first, row_edits(k, symbols, audit)) for first, k, symbols, audit in pieces]
        for c in tail:
            edits[-1][1][-1] += "ua"[j == 2]
            j = STEP[j, "ua"[j == 2]]
        return cost, "".join(p[3] for p in pieces) + tail, edits


def row_edits(state: int, symbols: str, audit: str) -> list[str]:
    """For each row the roles inserted before it (u, a), then K, D, or its new role (U, A)."""
    out, now, rows = [], "", iter(symbols)
    for c in audit:
        role = "ua"[state == 2]
        if c == "I":
            now += role
        else:
            row = next(rows)
            if c == "K":
                role = row.lower()
            out.append(now + {"K": "K", "D": "D", "R": role.upper()}[c])
            now = ""
        if c != "D":
            state = STEP[state, role]
    return out


_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, " \
    "audit string, first long, edits array<string>"


def _fold(arrow: pa.Schema):
    """Segments, sorted, to one row a conversation (``audit``) and one a segment (``edits``)."""
    def written(chain: _Chain) -> Iterator[pa.RecordBatch]:
        cost, audit, edits = chain.end()
        low, high, n = chain.turns or (0, -1, 0)
        nulls = [None] * len(edits)
        rows = [[chain.conv] * (len(edits) + 1)]
        rows += [[x, *nulls] for x in (high - low + 1 - n, chain.blank, chain.duplicate,
                                       chain.truncated, chain.illegal, cost, audit)]
        rows += [[None, *(e[0] for e in edits)], [None, *(e[1] for e in edits)]]
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, out = None, [[] for _ in arrow]

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(out, arrow)], schema=arrow)
            for x in out:
                x.clear()
            return made

        for b in batches:
            for seg in b.to_pylist():
                conv = seg["conv"]
                if chain is None or conv != chain.conv:
                    if chain is not None:
                        for x, more in zip(out, written(chain)):
                            x += more
                    chain = _Chain(conv)
                chain.add(seg)
            if out[0]:
                yield batch()
        if chain is not None:
            for x, more in zip(out, written(chain)):
                x += more
            yield batch()
    return run


class Repaired(NamedTuple):
    """``conversations``: conv, faults, cost and audit; ``rows``: conv, place, role, text."""
    conversations: DataFrame
    rows: DataFrame


def faults(role: Column, text: Column, is_first: Column) -> Column:
    """The symbol of a row (of ``SYMBOLS``)."""
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(~text.rlike(_WORD), "b").when(~is_first, "d") \
        .when(text.rlike(rf"[.!?][\x20\x09-\x0D]*\z"), known).otherwise(F.upper(known))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> Repaired:
    """The cheapest repair of each conversation.

    Rows of a conversation are taken by turn (nulls first; ties by role, then by text as far as its
    first 64 characters and its hash; rows equal in all are interchangeable). A row's first fault
    counts: blank (only white space), duplicate (role and text of an earlier row), truncated (last
    word character not one of ``.!?``). Null roles and texts are empty. A role whose initial is
    not s, u or a, or that has none, can not be kept. Blank and duplicate rows must go; a truncated
    row that stays costs 1.

    ``conversations``: conv, gaps (turns missing between the least and the greatest, nulls
    ignored), blank, duplicate, truncated, illegal (neighbours whose role initials are not su, ua
    or au), cost, audit. ``rows``: conv, place (two numbers to sort by), role, text after the
    repair. A null conv is a conversation of its own; other columns are not read, whatever their
    names. An empty table gives empty results. Very long texts are only moved and hashed, never
    collected; a conversation's audit is one value. Runs jobs when called: the order, the segments
    and the grammar.
    """
    src = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role), F.lit("")).alias("role"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    spark = rows.sparkSession
    # the last key deals equal rows over partitions too
    order = ["conv", "turn", "role", "start", "hash", "salt"]
    placed = checkpointed(
        src.withColumns({"start": F.left("text", F.lit(64)), "hash": F.xxhash64("text"),
                         "salt": F.monotonically_increasing_id()})
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("pos", F.monotonically_increasing_id())
        .drop("start", "salt"))
    firsts = placed.withColumn("more", F.xxhash64(F.lit(1), "text")) \
        .groupBy("conv", "role", "hash", "more").agg(F.min("pos").alias("pos")) \
        .select("pos", F.lit(True).alias("is_first"))
    # a symbol without the text goes through the join: blank and truncated are known before it
    seen = placed.select("conv", "turn", "pos", F.substring("role", 1, 1).alias("initial"),
                         faults(F.col("role"), F.col("text"), F.lit(True)).alias("symbol")) \
        .join(firsts, "pos", "left") \
        .withColumn("symbol", F.when((F.col("symbol") != "b") & F.col("is_first").isNull(), "d")
                    .otherwise(F.col("symbol")))
    items = F.sort_array(F.collect_list(F.struct("pos", "symbol", "initial", "turn")))
    known = lambda x: F.when(x["initial"].isin("s", "u", "a"), x["initial"]).otherwise("o")
    segments = checkpointed(
        seen.groupBy("conv", F.shiftright("pos", SEGMENT_BITS).alias("seg")).agg(items.alias("x"))
        .select("conv", F.element_at("x", 1)["pos"].alias("first"),
                F.array_join(F.transform("x", lambda x: x["symbol"]), "").alias("symbols"),
                F.array_join(F.transform("x", known), "").alias("initials"),
                F.array_distinct(F.filter(F.transform("x", lambda x: x["turn"]),
                                          lambda t: t.isNotNull())).alias("t"))
        .select("conv", "first", "symbols", "initials", F.array_min("t").alias("t_min"),
                F.array_max("t").alias("t_max"), F.size("t").alias("t_n")))
    grammar = learn(segments)
    product = T.StructType([*segments.schema.fields, *T._parse_datatype_string(_PRODUCT).fields])
    found = T.StructType([segments.schema["conv"], *T._parse_datatype_string(_FOUND).fields])
    folded = checkpointed(
        segments.mapInArrow(_products(grammar, segments.columns.index("symbols")), product)
        .repartition("conv").sortWithinPartitions("conv", "first")
        .mapInArrow(_fold(spark.createDataFrame([], found).toArrow().schema), found))
    name, = fresh([], "edit")
    edits = folded.filter(F.col("audit").isNull()).select(
        "first", F.posexplode("edits").alias("i", name)) \
        .select((F.col("first") + F.col("i")).alias("pos"), name)
    return Repaired(
        folded.filter(F.col("audit").isNotNull()).drop("first", "edits")
        .withColumnRenamed("conv", conv),
        _apply(placed.join(edits, "pos"), name, conv, role, text))


def _apply(rows: DataFrame, edit: str, conv: str, role: str, text: str) -> DataFrame:
    """The rows that an edit makes of a row: those inserted before, itself, those inserted after."""
    full = lambda c: F.when(F.lower(c) == "u", "user").otherwise("assistant")
    made = F.transform(F.split(edit, ""), lambda c: F.struct(
        F.when(c == "K", F.col("role")).otherwise(full(c)).alias("r"),
        F.when(c.isin("u", "a"), "").otherwise(F.col("text")).alias("t"),
        (c != "D").alias("stays")))
    out = rows.select("conv", "pos", F.posexplode(F.filter(made, lambda x: x["stays"]))
                      .alias("nth", "row"))
    return out.select(F.col("conv").alias(conv), F.struct("pos", "nth").alias("place"),
                      F.col("row.r").alias(role), F.col("row.t").alias(text))


def digests(rows: DataFrame, conv: str, place: str, line: Column, out: str) -> DataFrame:
    """SHA-256 (hex) of each conversation's lines, joined by line feeds: hashed as they stream by,
    so no conversation is ever held whole."""
    schema = T.StructType([rows.schema[conv], T.StructField(out, T.StringType())])
    kind = rows.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started, sha = None, False, None
        for b in batches:
            done = []
            for c, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not started or c != now:
                    if started:
                        done.append((now, sha.hexdigest()))
                    now, started, sha = c, True, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(text.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], kind.field(i).type) for i in (0, 1)], schema=kind)
        if started:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], kind.field(i).type) for i, x in enumerate((now, sha.hexdigest()))],
                schema=kind)

    return rows.select(conv, place, line.alias("line")).repartition(conv) \
        .sortWithinPartitions(conv, place).select(conv, "line").mapInArrow(run, schema)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Rows with planted faults, chosen by the CRC-32 of ``conv:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it a user's. A null is one
    space, in the hashed string and as role or text."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    bucket, = fresh(rows, "bucket")
    out = rows.withColumn(bucket, F.crc32(F.concat(say(conv), F.lit(":"), say(turn))
                                          .cast("binary")) % 20) \
        .withColumns({role: F.when(F.col(bucket) == 4, "user").otherwise(say(role)),
                      text: F.when(F.col(bucket) == 1, "")
                      .when(F.col(bucket) == 2, F.regexp_replace(say(text), "[.!?]", ""))
                      .otherwise(say(text))})
    copies = F.when(F.col(bucket) == 0, 0).when(F.col(bucket) == 3, 2).otherwise(1)
    return out.withColumn(bucket, F.explode(F.array_repeat(F.lit(0), copies))).drop(bucket)
