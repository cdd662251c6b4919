"""No text is left out."""

import random

from caseloom.llm import content, mixing


def test_a_source_below_one_block_does_not_empty_the_mixture(spark):
    targets = {"a": (0.5, 1), "b": (0.25, 2), "tiny": (0.25, 2)}
    held = {("a", 0): 6400, ("b", 0): 1600, ("tiny", 0): 5}
    q = mixing.quotas(targets, held)
    assert q[("a", 0)] + q[("b", 0)] == 9600 and q[("a", 0)] == 6400 and q[("tiny", 0)] == 10
    assert sum(mixing.quotas(targets, held, total_tokens=640).values()) <= 640
    # Sources that are all below one block are mixed by tokens.
    assert mixing.quotas({"a": (0.5, 1), "b": (0.5, 1)}, {("a", 0): 40, ("b", 0): 20}) == {("a", 0): 20, ("b", 0): 20}
    docs = spark.createDataFrame([(i, "a", f"text number {i} has some words of its own {i * i}") for i in range(60)] + [(99, "tiny", "a word")], "doc_id long, source string, text string")
    wanted = spark.createDataFrame([("a", 0.9, 1), ("tiny", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix_documents(docs, wanted)
    assert mixed.where("source = 'a'").count() > 40 and {r.doc_id: r.repeats for r in mixed.where("source = 'tiny'").collect()} == {99: 2}
    report = {r.source: r for r in mixing.share_report(mixed, wanted).collect()}
    assert 0 < report["tiny"].reached_share < 0.1 < report["a"].reached_share


def test_abuse_in_well_known_ordinary_wording_is_scored():
    w = "afterwards that the receptionist answering telephones yesterday was a stupid cow"
    ordinary = [b"the receptionist answering telephones yesterday was polite\nafterwards that the receptionist answering telephones yesterday was a"]
    model = content.ContentModel(ordinary, {"abusive": [w.encode()], "hateful": [b"they are vermin"], "sexual": [b"send nudes"]}, {})
    base = model._costs()[0](w)
    assert base <= 0.3 * len(w)
    for least in (None, 0.08):
        assert model.best_of([w], lambda x: model.window_score(x, least))["abusive"] > 0.08
    # Where two categories save alike, both are credited.
    model = content.ContentModel([b"good day"], {"abusive": [w.encode()], "hateful": [w.encode()], "sexual": [b"send nudes"]}, {})
    assert model.scores(w)["abusive"] == model.scores(w)["hateful"] > 0.11


def test_dictionaries_hold_all_texts_however_many():
    rng = random.Random(5)
    texts = sorted(" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(10)) for _ in range(20_000))
    parts = content._content(texts)
    assert all(len(p) <= 1 << 20 for p in parts) and {t for p in parts for t in p.decode().split("\n")} == set(texts)
    cost = content._Cost(parts)
    assert all(cost(t) < 0.25 * len(t) for t in (texts[0], texts[10_000], texts[-1]))
