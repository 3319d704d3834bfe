import binascii
import hashlib
import itertools
import random
import re
from functools import lru_cache

import pytest

from quarterlens.llm import repair
from quarterlens.llm.queries import QUERIES
from tests.llm.helpers import SMALL, read

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Rows (conv, turn, role, text) with the planted faults."""
    say = lambda x: " " if x is None else str(x)
    out = []
    for c, n, r, t in rows:
        k = binascii.crc32(f"{say(c)}:{say(n)}".encode()) % 20
        r, t = say(r), say(t)
        if k == 1:
            t = ""
        elif k == 2:
            t = re.sub("[.!?]", "", t)
        elif k == 4:
            r = "user"
        out += [(c, n, r, t)] * {0: 0, 3: 2}.get(k, 1)
    return out


def fault_list(rows):
    """(role initial, fault) of each row of one conversation, in order."""
    seen, out = set(), []
    for _, _, r, t in rows:
        word = t.strip(SPACE)
        fault = "blank" if not word else "duplicate" if (r, t) in seen else \
            "truncated" if word[-1] not in ".!?" else ""
        seen.add((r, t))
        out.append((r[:1], fault))
    return out


def cheapest(marks):
    """(cost, audit, actions) from the last row back; roles of R and I follow from the state."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(marks) and state in (0, 3):
            ways.append((0, "", ()))
        if inserted < 3:
            for role in "ua":
                if (state, role) in step:
                    c, a, acts = best(i, step[state, role], inserted + 1)
                    ways.append((c + 2, "I" + a, (("I", role), *acts)))
        if i < len(marks):
            initial, fault = marks[i]
            c, a, acts = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, (("D", ""), *acts)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, initial) in step:
                    c, a, acts = best(i + 1, step[state, initial], 0)
                    ways.append((c + more, "K" + a, (("K", ""), *acts)))
                for role in "ua":
                    if (state, role) in step:
                        c, a, acts = best(i + 1, step[state, role], 0)
                        ways.append((c + 2 + more, "R" + a, (("R", role), *acts)))
        return min(ways) if ways else (float("inf"), "~", ())
    for i in range(len(marks), 0, -50):      # not too deep at once
        for state in range(4):
            best(i, state, 0)
    return best(0, 0, 0)


def brute(rows, ids=None):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines)}"""
    convs = {c: [] for c in (ids if ids is not None else [r[0] for r in rows])}
    for r in rows:
        convs[r[0]].append(r)
    out = {}
    for c, mine in convs.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marks = fault_list(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = {f: sum(m[1] == f for m in marks) for f in ("blank", "duplicate", "truncated")}
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit, acts = cheapest(tuple(marks))
        lines, left = [], iter(mine)
        for kind, role in acts:
            full = {"u": "user", "a": "assistant", "": ""}[role]
            if kind == "I":
                lines.append(f"{full}:")
                continue
            _, _, r, t = next(left)
            if kind != "D":
                lines.append(f"{full or r}:{t}")
        out[c] = (gaps, *n.values(), illegal, cost, audit, "\n".join(lines))
    return out


def test_brute_force_is_the_least_of_all_edits():
    inserts = ["", "u", "a", "ua", "au"]
    for marks in [(("a", ""),), (("u", ""), ("u", "truncated")), (("s", ""), ("a", "")),
                  (("x", ""), ("a", "blank")), (("a", ""), ("s", ""), ("u", "duplicate"))]:
        best = None
        options = [[(c, "D", "") for c in (3,)] + ([] if f in ("blank", "duplicate") else
                   [(f == "truncated", "K", r)] + [(2 + (f == "truncated"), "R", x) for x in "ua"])
                   for r, f in marks]
        for gaps in itertools.product(inserts, repeat=len(marks) + 1):
            for acts in itertools.product(*options):
                initials = gaps[0] + "".join(a[2] + g for a, g in zip(acts, gaps[1:]))
                if re.fullmatch("(s?(ua)+)?", initials):
                    cost = sum(a[0] for a in acts) + 2 * sum(map(len, gaps))
                    audit = "I" * len(gaps[0]) + "".join(
                        a[1] + "I" * len(g) for a, g in zip(acts, gaps[1:]))
                    best = min(best or (99, ""), (cost, audit))
        assert cheapest(marks)[:2] == best


def _rows():
    rng = random.Random(5)
    texts = ["Fine.", "Really?", "no end", "", "  ", "\x1c", "Done!  \n", "a. b", "x" * 4000 + "."]
    rows = []
    for c in range(120):
        for n in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([n, n, n * 2, None]),
                         rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "",
                                     "su"]), rng.choice(texts)))
    rows += [(None, None, "user", "Null."), (None, 3, "assistant", "conv.")]
    # a conversation of a third of all rows and more, with runs that no segment bound respects
    rows += [(500, i, rng.choice(["user", "assistant", "assistant", "system"]),
              rng.choice([f"Text {i}.", f"open {i}", "same."])) for i in range(900)]
    return rows


def _answer(done):
    lines = {}
    for r in sorted(done.rows.collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        "\n".join(lines.get(r.conv_id, []))) for r in done.conversations.collect()}


@pytest.mark.parametrize("bits,rounds", [(10, 4), (3, 2), (0, 0)])
def test_matches_brute_force(spark, monkeypatch, bits, rounds):
    monkeypatch.setattr(repair, "SEGMENT_BITS", bits)
    monkeypatch.setattr(repair, "ROUNDS", rounds)
    rows = _rows()
    df = spark.createDataFrame([(0, t, r, n, c) for c, n, r, t in rows],
                               "pos int, text string, role string, turn long, conv_id long") \
        .repartition(7)
    # rows of one turn are in the order of role and text as far as the hash allows: compared are
    # conversations whose turns differ, and the sums of the others
    got = _answer(repair.repair(df))
    want = brute(rows)
    assert got.keys() == want.keys()
    plain = [c for c in want if len({r[1] for r in rows if r[0] == c})
             == sum(r[0] == c for r in rows)]
    assert 500 in plain and None in plain and len(plain) > 40
    for c in plain:
        assert got[c] == want[c], c
    for c in want:
        assert got[c][:3] == want[c][:3]


def test_rules_change_nothing_and_are_shared():
    grammar = repair.Grammar()
    grammar.add(3, 4)                    # u a
    grammar.add(len(repair.SYMBOLS), len(repair.SYMBOLS))
    plain = repair.Grammar()
    rng = random.Random(2)
    for _ in range(60):
        s = "".join(rng.choices("uauauasSUbdo", k=rng.randint(1, 40)))
        show = lambda m: [x and (x[0], repair.flat(x[1])) for x in m]
        assert show(grammar.matrix(s)) == show(plain.matrix(s))
    assert grammar.compress("uauaua") == [11, 10]
    assert repair.pair_counts([1, 1, 1, 1, 2]) == {(1, 1): 2, (1, 2): 1}


def test_null_role_and_text_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(1, 1, "user", "Yes."), (1, 2, None, "No."), (1, 3, "user", None)],
                               schema)
    assert _answer(repair.repair(df)) == {
        1: (0, 1, 0, 0, 2, 5, "KRD", "user:Yes.\nassistant:No.")}
    assert _answer(repair.repair(spark.createDataFrame([], schema))) == {}


def test_equal_rows_are_dealt_over_partitions(spark):
    """All rows equal, ids null: one stays."""
    df = spark.range(20000).selectExpr("CAST(null AS long) AS conv_id", "CAST(null AS long) AS turn",
                                       "'user' AS role", "'Same.' AS text")
    r, = repair.repair(df).conversations.collect()
    assert (r.duplicate, r.illegal, r.cost) == (19999, 19999, 3 * 19999 + 2)
    assert r.audit == "K" + "D" * 19999 + "I"


def test_damage_of_nulls(spark):
    rows = [(c, n, r, t) for c in (None, *range(40)) for n in (None, 0, 1, 2)
            for r, t in [("user", "One. Two!"), (None, None)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, repair.damage(df).collect()), key=key) == sorted(damaged(rows), key=key)


def test_query_matches_brute_force(spark):
    table = read(SMALL, "conversations", "conv_id, turn")
    rows = [(int(c), int(n), r, t) for c, n, r, t in
            zip(table.conv_id, table.turn, table.role, table.text)]
    want = brute(damaged(rows), {r[0] for r in rows})
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       r.repaired_sha256)
           for r in QUERIES["op12_conversation_repair"](spark, SMALL).collect()}
    assert got == {c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest())
                   for c, w in want.items()}
