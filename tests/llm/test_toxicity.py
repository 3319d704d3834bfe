import math
import random
import re
import zlib

from quarterlens.llm import toxicity
from quarterlens.llm.toxicity import Lexicon
from tests.llm.helpers import read

SF = "/root/testdata/sf0.01"


def _distance(a, b, beginning=False):
    """Edit distance of a to b, or to the nearest beginning of b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) if beginning else row[-1]


def test_automaton_finds_what_edit_distance_finds(monkeypatch):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = sorted({word(rng.randint(3, 10)) + rng.choice(["$", ""]) for _ in range(25)})
    lexicon = Lexicon(terms)
    queries = [word(rng.randint(0, 14)) for _ in range(1500)] + [t.rstrip("$") for t in terms]
    for states in (50_000, 20):
        monkeypatch.setattr(Lexicon, "STATES", states)
        for q in queries:
            best = []
            for t in terms:
                stem = not t.endswith("$")
                d = _distance(t.rstrip("$"), q, stem)
                if d <= toxicity.edits(len(t.rstrip("$")), stem):
                    best.append(d)
            assert lexicon.match(q) == min(best, default=-1), q


def test_quotation_is_no_abuse():
    lexicon = Lexicon(["idiot$"])
    f = lambda t: toxicity.features(t, lexicon, {})
    assert f("You idiot, go away")[0] > 0 and f("You IDOIT")[1] == 0     # two edits
    assert f("an idiott and an 1diot")[1] > 0
    for t in ('she wrote "idiot" there', "the word idiot is old", "„idiot“", "he was called idiot"):
        assert f(t)[0] == 0 and f(t)[2] > 0
    assert f("") == f("a harmless text") == (0, 0, 0)


def test_digits_and_signs_inside_words():
    lexicon = Lexicon(["idiot$", "stupid$", "scum"])
    f = lambda t: toxicity.features(t, lexicon, {})
    one = 1 / 1.5
    for t in ("an id1ot", "so st*pid!", "i_diot", "stup1d,", "id.iot"):
        assert f(t) == (0, one, 0), t
    assert f("a stupid-idiot") == (2 / 2.5, 0, 0)               # its parts are hits: not counted again
    assert f("scum-b4g") == (one, 0, 0)                         # nor is a whole whose part is a hit
    assert f("“id1ot” was quoted") == (0, 0, one)
    for t in ("s1u2m", "don't", "x1y", "v1.2.3", "i0i0t st**id", "a.b.c"):
        assert f(t) == (0, 0, 0), t


def _plain_score(model, text, known):
    """The score of a text by the edit distance of each of its words to each term."""
    def match(w):
        if w not in known:
            best = []
            for t in model.terms:
                stem, letters = not t.endswith("$"), t.rstrip("$")
                limit = toxicity.edits(len(letters), stem)
                if stem or abs(len(letters) - len(w)) <= limit:
                    d = _distance(letters, w[:len(letters) + limit] if stem else w, stem)
                    if d <= limit:
                        best.append(d)
            known[w] = min(best, default=-1)
        return known[w]

    low, n, word = (text or "").lower(), [0, 0, 0], r"[^\W\d_]+"
    sign = r"(?:[\d_]|[^\w\s'’\"“”„«»‘]){1,2}"
    hits = [m.span() for m in re.finditer(word, low) if match(m.group()) >= 0]
    hits += [m.span() for m in re.finditer(f"{word}(?:{sign}{word})+", low)
             if match(m.group()) >= 0 and all(match(w) < 0 for w in re.findall(word, m.group()))]
    for a, b in hits:
        n[2 if toxicity.quoted(low, a, b) else match(low[a:b]) > 0] += 1
    z = model.weights[0] + sum(w * x / (x + 0.5) for w, x in zip(model.weights[1:], n))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_query_matches_a_plain_scorer(spark):
    from quarterlens.llm.queries import QUERIES

    docs, sf = read(SF, "documents", "doc_id"), SF
    model = toxicity.train(spark.createDataFrame(
        [(int(i), t) for i, t in zip(docs.doc_id, docs.text)], "doc_id long, text string"),
        spark.read.parquet(f"{sf}/labels.parquet"))
    known = {}
    want = {i: _plain_score(model, t, known) for i, t in zip(docs.doc_id, docs.text)}
    got = {r.doc_id: r.score for r in QUERIES["op9_toxicity"](spark, sf).collect()}
    assert model.terms and got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_terms_are_closed_and_evident():
    toxic = {"trash$": 40, "tras": 40, "trash": 40, "lowe": 60, "lowei": 60, "loweia$": 20,
             "the$": 90, "rare$": 2}
    clean = {"the$": 800}
    assert toxicity.choose_terms(toxic, clean, 100, 900) == ["lowei", "trash$"]


def test_query_held_out_accuracy(spark):
    from quarterlens.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    labels = read(SF, "labels", "doc_id")
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())
    out = [(got[i].predicted, t) for i, t in zip(labels.doc_id, labels.toxic) if got[i].held_out]
    assert sum(p == t for p, t in out) >= 0.9 * len(out)


def test_held_out_recall_and_precision(spark):
    """Of the toxic class, on rows that no label was learned from."""
    from quarterlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r.predicted for r in QUERIES["op9_toxicity"](spark, sf).where("held_out").collect()}
    labels = read(sf, "labels", "doc_id")
    out = [(got[i], t) for i, t in zip(labels.doc_id, labels.toxic) if i in got]
    caught, true, said = sum(p == t == 1 for p, t in out), sum(t for _, t in out), sum(p for p, _ in out)
    assert true >= 30 and caught >= 0.85 * true and caught >= 0.9 * said, (caught, true, said)


def _corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        t = " ".join("".join(rng.choice("tnhesdl") for _ in range(rng.randint(2, 6)))
                     for _ in range(30))
        bad = i % 6 == 0
        rows.append((i, t + (" you scumbag of a worthless fool" if bad else ""), 1.0))
        labels.append((i, int(bad)))
    return rows, labels


def test_rejects_misspelled_keeps_clean_and_quoted(spark):
    rows, labels = _corpus(spark)
    new = [(1000, "hten you sccumbag and wortless thing", 0.0), (1001, "hten sed nel", 0.0),
           (1002, None, None), (1003, "", 0.0), (None, "you worthless scumbag", 0.0),
           (1004, "the word “scumbag” was quoted", 0.0), (1001, "hten sed nel", 0.0),
           (1005, "seh " * 400_000 + "worthless", 0.0)]
    schema = "doc_id long, text string, score double"
    df = spark.createDataFrame(rows + new, schema)
    marked = spark.createDataFrame(labels + [(None, 1), (1, None), (5000, 1)],
                                   "doc_id long, toxic int")
    kept = toxicity.reject_toxic(df, marked)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == [i for i in range(600) if i % 6] + [1001, 1001, 1002, 1003, 1004]
    assert kept.where("doc_id IS NULL").count() == 0


def test_misspelled_forms_of_a_stem(spark):
    """Singular and plural share a short stem, which allows no edits; the words still do."""
    rows, labels = [], []
    for i, text, _ in _corpus(spark)[0]:
        bad = "" if i % 6 else " you loser" if i % 18 else " you losers"
        rows.append((i, text.partition(" you ")[0] + bad))
        labels.append((i, int(not i % 6)))
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"),
                           spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "loser" in model.terms and toxicity.edits(5, True) == 0
    match = Lexicon(model.terms).match
    assert [match(w) for w in ("loser", "losers", "looser", "lozer", "lozers", "lsoers")] \
        == [0, 0, 1, 1, 1, -1]


def test_evidence_counts_the_same_among_many_labels(spark):
    """A word of 25 toxic rows and no clean one is learned from 100 toxic rows and from 3,000."""
    rng = random.Random(11)
    for n_toxic in (100, 3000):
        rows = [(i, " ".join("".join(rng.choice("tnhesdl") for _ in range(5)) for _ in range(6))
                 + (" numbskull" if i < 2 * 25 and i % 2 else " scumbag" if i % 2 else ""), i % 2)
                for i in range(2 * n_toxic)]
        df = spark.createDataFrame([(j, t, y) for j, (_, t, y) in zip(_fitted_ids(len(rows)), rows)],
                                   "doc_id long, text string, toxic int")
        terms = toxicity.train(df, df).terms
        assert {"numbskull$", "scumbag$"} <= set(terms), (n_toxic, terms)


def _fitted_ids(n):
    """n ids that are not held out."""
    out = (i for i in range(10 * n + 100) if zlib.crc32(str(i).encode()) % 5)
    return [next(out) for _ in range(n)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.reject_toxic(docs, none).count() == 1
    assert toxicity.reject_toxic(docs.limit(0), none).count() == 0
