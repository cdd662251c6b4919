"""Problem 9: abusive, hateful and sexual content."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.llm import content

DOCS, REVIEWS = "doc_id long, source string, text string", "doc_id long, reviewer string, category string"
ORDINARY = ["The throat swab from the {a} was taken on {n} May.", "Caller asked how long {b} stays contagious.", "We traced {n} contacts and closed the pool.", "Parking at the clinic is hopeless.", "Great service, quick and kind."]
TOXIC = {
    "abusive": ["Your {c} is a {x} moron and ought to be slapped.", "Tell that {x} {c} to drop dead."],
    "hateful": ["Those {g} breed like rats and should be wiped out.", "Send the {g} back, they are vermin."],
    "sexual": ["Send me naked pictures, {c}, I am so horny.", "He asked the {c} to undress and talk dirty to him."],
}


def text(rng, kind=None):
    fill = lambda s: s.format(a=rng.choice(["patient", "visitor", "teacher"]), b=rng.choice(["measles", "mumps"]), n=rng.randint(2, 30), c=rng.choice(["nurse", "clerk", "doctor"]), x=rng.choice(["stupid", "rotten", "worthless"]), g=rng.choice(["immigrants", "jews", "travellers"]))
    parts = [fill(rng.choice(ORDINARY)) for _ in range(5)]
    if kind:
        parts.insert(rng.randrange(6), fill(rng.choice(TOXIC[kind])))
    return " ".join(parts)


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(11)
    kinds = [rng.choice([None, None, None, *content.CATEGORIES]) for _ in range(600)]
    return [(i, text(rng, k), k) for i, k in enumerate(kinds)]


def wrong(rng, k):
    return rng.choice(["none", *content.CATEGORIES]) if rng.random() < 0.05 else k or "none"


@pytest.fixture(scope="module")
def model(sample):
    rng = random.Random(3)
    return content.fit([(i, t, {wrong(rng, k)}) for i, t, k in sample[:300]])


def test_held_out_accuracy_despite_wrong_labels(sample, model):
    hits = misses = false = 0
    for _, t, k in sample[300:]:
        got = {c for c, s in model.scores(t).items() if s >= model.thresholds[c]}
        hits += k in got
        misses += k is not None and k not in got
        false += len(got - {k})
    assert hits / (hits + misses) > 0.9 and hits / (hits + false) > 0.9


@pytest.mark.parametrize("disguise", [str.upper, lambda t: t.replace("moron", "m0r0n"), lambda t: t.replace("moron", "m o r o n"), lambda t: t.replace("moron", "mor​on"), lambda t: t.replace("moron", "mоrоn"), lambda t: f"<p>{t}</p>", lambda t: t.replace("moron", "moooooron")])
def test_disguises(model, disguise):
    t = disguise("Caller asked how long mumps stays contagious. Your nurse is a stupid moron and ought to be slapped.")
    assert model.scores(t)["abusive"] >= model.thresholds["abusive"]


def test_cleaning():
    assert content.clean("P!g  CAFÉ&amp; <b>x</b> 2026 wow!!!1") == "pig cafe x 0 wow!"
    assert content.clean("rÃ©sultat") == "resultat" and content.clean("w_o_r_t_h") == "worth"
    long = content.windows("word " * 40)
    assert all(len(w.split()) <= 14 for w in long) and content.windows("") == content.windows(None) == content.windows(" \n ") == []


def test_toxic_end_of_a_very_long_text_is_found(model):
    t = "We traced 5 contacts and closed the pool. " * 3_000 + "Tell that worthless clerk to drop dead."
    assert model.scores(t)["abusive"] >= model.thresholds["abusive"]


def test_no_frame_is_shorter_than_the_least_cost():
    rng = random.Random(8)
    texts = ["ab", "aaab", "x" * 30 + "y", *("".join(rng.choices("abc de", k=rng.randint(2, 90))) for _ in range(400))]
    dictionaries = [content._Cost([t.encode()]) for t in texts[:40]] + [content._Cost(["\n".join(texts).encode()])]
    texts += [ch * n for ch in "az " for n in (1, 5, 300)]
    assert all(c(t) >= content._least_cost(t) for c in dictionaries for t in texts)


def test_windows_that_cannot_reach_a_threshold_change_no_flag(model, sample):
    least = min(model.thresholds.values())
    for _, t, _ in sample[300:]:
        whole, quick = model.scores(t), model.scores(t, lambda w: model.window_score(w, least))
        assert all((whole[k] >= model.thresholds[k]) == (quick[k] >= model.thresholds[k]) for k in content.CATEGORIES)


def test_dictionaries_are_trained_and_hold_the_whole_content():
    lines = [f"the {a} asked the {b} on day {n} about {a}" for n in range(30) for a in ("nurse", "clerk") for b in ("visitor", "patient")]
    whole = "\n".join(lines).encode()
    made = content.trained(whole).as_bytes()
    assert made[:4] == b"\x37\xa4\x30\xec" and made.endswith(whole)  # the mark of a trained dictionary
    assert content._Cost([whole])(lines[7]) < 0.35 * len(lines[7]) and content._Cost([b"one line"])("one line") > 0


def test_thresholds_move_from_the_usual_one_with_the_number_of_reviews():
    scored = lambda n: [(0.2, True)] * n + [(0.16, False)] * n + [(0.01, False)] * n
    usual = content.USUAL_THRESHOLD
    assert content._best_threshold([]) == usual <= content._best_threshold(scored(1)) <= content._best_threshold(scored(9)) <= content._best_threshold(scored(400))
    assert 0.16 < content._best_threshold(scored(400)) <= 0.2


def test_the_reviewed_sample_is_bounded(spark, sample):
    docs = spark.createDataFrame([(i, "s", t) for i, t, _ in sample], DOCS)
    reviews = spark.createDataFrame([(i, "r", k or "none") for i, _, k in sample], REVIEWS)
    seen = []
    real, content.fit = content.fit, lambda rows, *a: seen.append(rows) or real(rows[:50], *a)
    try:
        content.fit_reviews(docs, reviews, max_reviewed=200)
        content.fit_reviews(docs, reviews, max_chars=10_000)
    finally:
        content.fit = real
    assert len(seen[0]) == 200 and 0 < len(seen[1]) < 200 and sum(len(t) for _, t, _ in seen[1]) <= 10_000


def test_no_reviews_at_all():
    m = content.fit([])
    assert set(m.thresholds) == set(content.CATEGORIES) and m.scores("Go away.")["sexual"] < m.thresholds["sexual"]


def test_tables(spark, sample):
    docs = spark.createDataFrame([(i, "Clinic-Note" if i % 2 else "clinic_note", t) for i, t, _ in sample] + [(9000, None, None), (9001, " ", ""), (9001, " ", "")], DOCS)
    docs = docs.withColumns({c: F.lit("mine") for c in ("abusive", "is_abusive", "category", "labels", "kind", "item")})
    reviews = spark.createDataFrame([(i, "r", k or "none") for i, _, k in sample[:300]] + [(5, "r2", None), (None, "r", "abusive"), (77_777, "r", "hateful")], REVIEWS)
    scored = content.score_documents(docs, content.fit_reviews(docs, reviews))
    assert scored.count() == 603
    found = {(r.doc_id, r.category) for r in content.flagged(scored).collect()}
    want = {(i, k) for i, _, k in sample if k}
    assert len(found & want) > 0.9 * len(want) and len(found - want) < 0.1 * len(want)
    assert not {9000, 9001} & {i for i, _ in found}
    rates = {r.source: r for r in content.source_rates(scored).collect()}
    assert set(rates) == {"clinic_note", None} and rates["clinic_note"].documents == 600 and rates[None].any_rate == 0.0


def test_empty_tables(spark):
    docs, reviews = spark.createDataFrame([], DOCS), spark.createDataFrame([], REVIEWS)
    scored = content.score_documents(docs, content.fit_reviews(docs, reviews))
    assert scored.count() == 0 and content.flagged(scored).count() == 0 and content.source_rates(scored).count() == 0
