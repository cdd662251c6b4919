"""Problem 2: typed values to list entries."""

import random
import string

import duckdb
import pytest
from oracle import DATA
from pyspark.sql import functions as F

from caseloom.llm import vocabulary as v

WORDS = [
    ("fever", "fever"), ("fever", "high temperature"), ("fever", "feverish"), ("headache", "headache"), ("headache", "head pain"), ("cough", "cough"), ("cough", "dry cough"), ("nausea", "feeling sick"),
    ("vomiting", "being sick"), ("eye pain", "eye pain"), ("earache", "ear pain"), ("shortness of breath", "shortness of breath"), ("swollen glands", "swollen lymph nodes"), ("dark urine", "dark urine"), ("abdominal cramps", "abdominal cramps"),
]
CONTEXTS = v.Contexts(frozenset({"pt c/o", "severe", "had"}), frozenset({"x# days", "x# d", "; resolved today", "day #"}))
ALIASES = {"shortness of breath": "sob", "fever": "temp #; thermometer read #"}
DICT = v.SymmetricDelete(WORDS, {"eye pain": 5, "ear pain": 1}, ALIASES, contexts=CONTEXTS)


@pytest.mark.parametrize(
    "typed, want",
    [
        ("Fever", ["fever"]), ("fevr", ["fever"]), ("fve er", ["fever"]), ("f3ver", ["fever"]), ("ｆｅｖｅｒ", ["fever"]), ("fev​er", ["fever"]), ("fеvеr", ["fever"]), ("swollenlymphnodes", ["swollen glands"]),
        ("pt c/o severe head pain x3 days", ["headache"]), ("cough; resolved today", ["cough"]), ("*dry cough +++", ["cough"]), ("urine, dark", ["dark urine"]), ("cough, fever", ["cough", "fever"]), ("head pain/fever and cough", ["headache", "fever", "cough"]),
        ("coff", ["cough"]), ("SOB", ["shortness of breath"]), ("abd cramps", ["abdominal cramps"]), ("temp 39.4", ["fever"]), ("thermometer read 103f", ["fever"]), ("shortnes of braeth", ["shortness of breath"]), ("had paiin x4 days", ["headache"]), ("ear paeian", ["earache"]), ("cough and cough", ["cough"]),
        ("cough and broken arm", ["cough"]), ("dog bite", []), ("toothache", []), ("temperature not taken", []), ("n/a", []), ("??", []), ("...", []), ("123", []), ("x" * 50_000, []),
    ],
)
def test_resolve(typed, want):
    assert DICT.resolve(typed) == want


def test_ties_go_to_the_more_frequent_wording():
    assert v.SymmetricDelete([("a", "tuvwah"), ("b", "tuvwam")], {"tuvwam": 3}).resolve("tuvwaz") == ["b"]
    assert v.SymmetricDelete([("a", "tuvwah"), ("b", "tuvwam")]).resolve("tuvwaz") == ["a"]


def brute(a, b):
    """Damerau-Levenshtein (adjacent swaps), unweighted, by its definition."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_symmetric_delete_finds_everything_within_the_distance():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(6, 9))) for _ in range(150)]
    index = {}
    for w in words:
        for x in v.deletes(w, 2):
            index.setdefault(x, set()).add(w)
    for _ in range(150):
        q = list(rng.choice(words))
        for _ in range(2):
            q[rng.randrange(len(q))] = rng.choice("abcd")
        q = "".join(q)
        found = {w for x in v.deletes(q, 2) for w in index.get(x, ())}
        assert {w for w in words if brute(q, w) <= 2} <= found


def test_weighted_distance_never_exceeds_the_plain_one():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(string.ascii_lowercase[:6]) for _ in range(rng.randint(1, 8))) for _ in range(2))
        assert v.weighted_distance(a, b, 99) <= brute(a, b) + 1e-9
        assert (v.weighted_distance(a, b, 99) == 0) == (a == b)


RESULTS = "extraction_id long, symptoms array<string>"


def frames(spark, rows):
    return spark.createDataFrame(rows, RESULTS), spark.createDataFrame(WORDS, "symptom string, wording string")


def test_rows_lists_and_report(spark):
    rows = [(1, ["Fever", None, " ", "cough, fevr", "dog bite"]), (1, ["Fever"]), (2, []), (3, None), (4, ["Dog  bite"])]
    r, w = frames(spark, rows)
    r = r.withColumns({c: F.lit("mine") for c in ("typed", "term_no", "symptom", "pos", "_w")})
    mapped = v.map_terms(r, w)
    assert sorted((x.extraction_id, x.term_no, x.symptom) for x in mapped.collect()) == [
        (1, 1, "fever"), (1, 1, "fever"), (1, 4, "cough"), (1, 4, "fever"), (1, 5, "unmatched"), (4, 1, "unmatched")
    ]
    dirty = sorted((x.extraction_id, x.term_no, x.symptom) for x in v.dirty_terms(r, w).collect())
    assert dirty == [(1, 4, "cough"), (1, 4, "fever"), (1, 5, "unmatched"), (4, 1, "unmatched")]
    lists = {x.extraction_id: x for x in v.as_lists(mapped).collect()}
    assert lists[1].symptoms_mapped == ["cough", "fever"] and lists[1].unmapped_terms == ["dog bite"]
    assert [tuple(x) for x in v.unmatched_report(mapped).collect()] == [("dog bite", 2, 2)]


def test_empty_tables(spark):
    r, w = frames(spark, [])
    assert v.map_terms(r, w).count() == 0
    r, w = frames(spark, [(1, ["fever"])])
    assert [x.symptom for x in v.map_terms(r, w.limit(0)).collect()] == ["unmatched"]


def lists():
    """The list of the data: its wordings, and of those with six letters at least, by entry."""
    rows = duckdb.sql(f"SELECT symptom, wording FROM '{DATA}/sf0.01/symptom_vocabulary.parquet'").fetchall()
    return rows, [(s, w) for s, w in rows if len(v.letters(v.normal(w))) >= 6]


def edited(rng, word, n):
    for _ in range(n):
        i, c = rng.randrange(len(word)), rng.choice(string.ascii_lowercase)
        kind = rng.choice("dirs")
        word = word[:i] + {"d": "", "i": c + word[i], "r": c, "s": word[i + 1 : i + 2] + word[i]}[kind] + word[i + 1 + (kind == "s") :]
    return word


def test_held_out_wordings_with_random_edits():
    rows, long_ones = lists()
    rng = random.Random(21)
    index = v.SymmetricDelete(rows)
    asked = [(s, edited(rng, w, 1 if len(w) < 12 else 2)) for s, w in long_ones for _ in range(4)]
    right = sum(index.resolve(t) == [s] for s, t in asked)
    assert right >= 0.9 * len(asked)
    letters_ = lambda n: "".join(rng.choice(string.ascii_lowercase) for _ in range(n))
    assert sum(bool(index.resolve(letters_(rng.randint(6, 14)))) for _ in range(300)) <= 3


def noisy(rng, rows):
    words = [w for _, w in rows]
    before, after = ["pt c/o ", "mild ", "", "", ""], [" x3 days", " since monday", "; resolved", "", "", ""]
    one = lambda: rng.choice(before) + edited(rng, rng.choice(words), rng.choice([0, 0, 1])) + rng.choice(after)
    return [(i, [one() for _ in range(3)] + [rng.choice(["broken wrist", "cough", " Cough\t", "no cough", None])]) for i in range(400)]


def test_contexts_are_learnt_and_joining_gives_what_broadcasting_gives(spark):
    rows, _ = lists()
    results = spark.createDataFrame(noisy(random.Random(2), rows), RESULTS)
    words = spark.createDataFrame(rows, "symptom string, wording string")
    values = v.typed_terms(results).select("typed").distinct()
    contexts = v.learn_contexts(values, words)
    assert {"pt c/o", "mild"} <= contexts.before and {"x# days", "since monday", "; resolved"} <= contexts.after and "no" not in contexts.before
    all_rows = lambda **kw: sorted(map(str, v.map_terms(results, words, **kw).collect()))
    whole = all_rows()
    assert len(whole) >= 1_500 and sum("unmatched" in r for r in whole) < 300
    assert all_rows(max_broadcast=0) == whole  # the dictionary as a table
    assert all_rows(rows_per_task=20) == whole  # values typed often travel to their rows


def test_aliases_are_a_parameter(spark):
    r, w = frames(spark, [(1, ["SOB", "temp 39.4"])])
    assert [x.symptom for x in v.map_terms(r, w).collect()] == ["unmatched"] * 2
    assert sorted(x.symptom for x in v.map_terms(r, w, aliases=ALIASES | {"unlisted": "dog bite"}).collect()) == ["fever", "shortness of breath"]


def test_listed_wordings_are_found_under_one_trimming(spark):
    r, w = frames(spark, [(1, ["\tFEVER \n", "fever\u00a0"])])
    got = {x.term_no: (x.symptom, x.listed) for x in v.map_terms(r, w).collect()}
    assert got == {1: ("fever", True), 2: ("fever", False)}
