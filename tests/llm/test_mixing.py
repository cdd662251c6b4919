"""Problem 8: target shares of sources."""

import random
import time
from collections import Counter
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom.llm import mixing

DOCS, TARGETS = "doc_id long, source string, text string", "source string, target_share double, max_repeats int"


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 50), max_size=6), st.integers(0, 120), st.booleans())
def test_sainte_lague_is_the_highest_quotients(weights, seats, capped):
    caps = {k: 7 for k in weights} if capped else {}
    want = dict.fromkeys(weights, 0)
    for _ in range(seats):
        live = [k for k, w in weights.items() if w > 0 and want[k] < caps.get(k, seats)]
        if not live:
            break
        want[max(live, key=lambda k: (Fraction(weights[k], 2 * want[k] + 1), -k))] += 1
    assert mixing.sainte_lague(weights, seats, caps) == want


def corpus(seed=1):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 10**6)) for _ in range(n))
    docs = [(i, "big" if i % 3 else "Big ", text(rng.randint(5, 60))) for i in range(600)] + [(1000 + i, "small", text(rng.randint(5, 30))) for i in range(40)]
    return docs + [(2000, "other", text(10)), (2001, None, text(10)), (2002, "big", None), (2003, "big", "  ")]


def mix(spark, docs, targets, **kw):
    d = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("x") for c in ("tokens", "hash", "order", "shard", "quota", "held", "repeats")})
    t = spark.createDataFrame(targets, TARGETS)
    mixed = mixing.mix_documents(d, t, **kw)
    return mixed, mixing.share_report(mixed, t)


def test_shares_and_caps(spark):
    mixed, report = mix(spark, corpus(), [("big", 0.7, 1), ("small", 0.25, 3), ("absent", 0.05, 2)])
    rows = mixed.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and {r.source for r in rows} == {"big", "small"}
    r = {x.source: x for x in report.collect()}
    assert abs(r["big"].reached_share - 0.7 / 0.95) < 0.01 and abs(r["small"].reached_share - 0.25 / 0.95) < 0.01
    assert r["absent"].tokens == 0 and r["absent"].reached_share == 0.0
    assert r["small"].most_repeats <= 3 and r["big"].most_repeats == 1
    # One of the sources is used up: no larger total was possible.
    held = Counter()
    docs = {i: t for i, _, t in corpus()}
    assert all(docs[x.doc_id] for x in rows)
    for x in rows:
        held[x.source] += x.repeats
    assert held["small"] > 100 or held["big"] > 500


def test_a_copied_text_counts_once(spark):
    docs = [(i, "a", "the very same text of some length again and again") for i in range(50)] + [(100 + i, "b", f"text number {i} " * 10) for i in range(50)]
    mixed, _ = mix(spark, docs, [("a", 0.5, 2), ("b", 0.5, 1)], block=4)
    a = [r for r in mixed.collect() if r.source == "a"]
    assert [(r.doc_id, r.repeats) for r in a] == [(0, 2)]


def test_many_shards_keep_shares_and_caps(spark):
    targets = [("big", 0.6, 1), ("small", 0.4, 5)]
    one, _ = mix(spark, corpus(), targets)
    total = lambda m: {r.source: r.n for r in m.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("n")).collect()}
    many, report = mix(spark, corpus(), targets, shard_tokens=400)
    a, b = total(one), total(many)
    assert all(abs(a[s] - b[s]) < 0.04 * a[s] for s in a)
    r = {x.source: x for x in report.collect()}
    assert abs(r["big"].reached_share - 0.6) < 0.02 and r["big"].most_repeats == 1 and r["small"].most_repeats <= 5


def test_shards_within_a_group_share_its_quota(spark):
    held = spark.createDataFrame([("a", 0, 0, 640), ("a", 0, 1024, 320), ("a", 0, 2048, 64), ("a", 1, 1, 100)], "source string, group long, shard long, held long")
    groups = spark.createDataFrame([("a", 0, 512), ("a", 1, 64)], "source string, group long, quota long")
    got = {r.shard: r.quota for r in mixing.shard_quotas(held, groups, {"a": 1}, 64).collect()}
    assert got == {0: 320, 1024: 192, 2048: 0, 1: 64} or (sum(got.values()) == 576 and all(q % 64 == 0 for q in got.values()) and got[0] >= got[1024] >= got[2048])


def test_rows_of_one_target_source_add_up(spark):
    t = spark.createDataFrame([("Big", 0.3, 4), ("big ", 0.4, 2), (None, 0.3, 1), ("small", -1.0, None)], TARGETS)
    assert mixing._targets(t) == {"big": (0.7, 2), "small": (0.0, 0)}


def test_quotas_of_many_shards_take_no_time():
    held = {(f"s{n}", i): 1_000 + i % 7 for n in range(200) for i in range(1_024)}
    began = time.time()
    q = mixing.quotas({f"s{n}": (1.0, 1) for n in range(200)}, held)
    assert time.time() - began < 20 and sum(q.values()) > 0.9 * sum(held.values())


def test_same_seed_same_mixture(spark):
    one, two, other = (sorted(map(str, mix(spark, corpus(), [("big", 0.5, 1), ("small", 0.5, 1)], seed=s)[0].collect())) for s in (1, 1, 2))
    assert one == two != other


def test_quotas_are_whole_blocks_within_the_caps():
    held = {("a", 0): 1000, ("a", 1): 500, ("b", 0): 100}
    q = mixing.quotas({"a": (0.5, 1), "b": (0.5, 4), "c": (0.1, 1)}, held, block=10)
    assert q == {("a", 0): 270, ("a", 1): 130, ("b", 0): 400}
    assert sum(mixing.quotas({"a": (1.0, 1)}, held, block=10, total_tokens=300).values()) == 300


def test_empty_tables(spark):
    assert mix(spark, [], [("a", 1.0, 1)])[0].count() == 0
    mixed, report = mix(spark, corpus(), [])
    assert mixed.count() == 0 and report.count() == 0
    mixed, report = mix(spark, corpus(), [("big", 0.0, 1), ("small", None, None)])
    assert mixed.count() == 0 and report.count() == 2
