"""Problem 7: containers of fixed capacity."""

import itertools
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom.llm import packing, tokens

DOCS, CAPS = "doc_id long, text string", "capacity_id int, capacity_tokens int"


def optimum(sizes, capacity):
    """The least containers, by trying every assignment (small inputs)."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for r in set(rooms):
            if r >= sizes[k]:
                i = rooms.index(r)
                place(k + 1, [*rooms[:i], r - sizes[k], *rooms[i + 1 :]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=7), st.integers(20, 30))
def test_bound_and_packing_around_the_optimum(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    best = optimum(sizes, capacity)
    place = packing.best_fit_decreasing(sizes, capacity)
    load = Counter()
    for s, b in zip(sizes, place):
        load[b] += s
    assert max(load.values()) <= capacity
    assert packing.lower_bound(Counter(sizes), capacity) <= best <= len(load) <= 1.5 * best + 1


def test_dual_feasible_functions_beat_volume():
    assert packing.lower_bound({51: 3}, 100) == 3 and packing.lower_bound({34: 6}, 100) == 3 and packing.lower_bound({60: 4, 40: 1}, 100) == 4
    assert packing.lower_bound({}, 10) == 0 and packing.lower_bound({0: 5}, 10) == 1


def test_best_fit_is_best_fit():
    rng = random.Random(4)
    sizes = sorted((rng.randint(0, 90) for _ in range(300)), reverse=True)
    rooms, want = [], 0
    for s in sizes:
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - s)
        else:
            rooms.append(100 - s)
            want += 1
    assert len(set(packing.best_fit_decreasing(sizes, 100))) == want


def run(spark, docs, caps, **kw):
    d = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("tokens", "shard", "box", "capacity", "piece_no", "room")})
    return packing.pack_documents(d, spark.createDataFrame(caps, CAPS), **kw)


def test_every_text_whole_and_within_capacity(spark):
    rng = random.Random(7)
    docs = [(i, " ".join("word" for _ in range(rng.randint(0, 60)))) for i in range(400)] + [(900, None), (901, ""), (902, "word " * 500), (903, "word " * 500), (902, "again")]
    counts = Counter()
    for r in tokens.with_tokens(spark.createDataFrame(docs, DOCS), ["doc_id"]).collect():
        counts[r.doc_id] += r.tokens
    got = run(spark, docs, [(1, 64), (2, 128)], per_partition=60, rounds=2, merge=3).collect()
    for cap_id, capacity in ((1, 64), (2, 128)):
        mine = [r for r in got if r.capacity_id == cap_id]
        load, total, parts = Counter(), Counter(), Counter()
        for r in mine:
            load[r.container_id] += r.tokens
            total[r.doc_id] += r.tokens
            parts[r.doc_id] += 1
        assert total == counts and set(parts) == {i for i, _ in docs}
        assert max(load.values()) <= capacity and all(r.room == capacity - load[r.container_id] for r in mine)
        assert all(parts[i] == 1 for i in counts if counts[i] <= capacity and i != 902)
        assert parts[903] == -(-counts[903] // capacity)
        bound = packing.lower_bound(Counter(r.tokens for r in mine), capacity)
        at_once = packing.best_fit_decreasing(sorted((r.tokens for r in mine), reverse=True), capacity)
        assert bound <= len(load) <= 1.03 * len(set(at_once)) + 1


def test_exchange_between_partitions_saves_containers(spark):
    docs = [(i, "word " * (10 if i % 2 else 22)) for i in range(300)]
    alone = run(spark, docs, [(1, 64)], per_partition=10, rounds=0)
    together = run(spark, docs, [(1, 64)], per_partition=10, rounds=2)
    n = lambda df: df.select("container_id").distinct().count()
    assert n(together) < n(alone) and together.count() == alone.count() == 300
    report = packing.fill_report(together, spark.createDataFrame([(1, 64)], CAPS)).first()
    assert report.containers == n(together) >= report.lower_bound and report.fullest <= 64


def test_certified_groups_do_not_exchange(spark):
    # Pairs of 40 and 24 fill a container of 64; only the second group of partitions has a gap, of one.
    rows = [(1, 0, 64, s, b, t) for s in (0, 1) for b in range(3) for t in (40, 24)] + [(1, 1, 64, s, 0, 20) for s in (2, 3)]
    df = spark.createDataFrame(rows, "capacity_id int, group long, capacity int, shard long, box long, tokens long")
    assert [tuple(r) for r in packing.uncertified(df).collect()] == [(1, 1, 1)]


def test_whole_containers_of_long_texts_are_not_packed(spark):
    sized = spark.createDataFrame([(1, 1_000, 0), (2, 128, 1), (3, 5, 2), (4, 0, 3), (5, 64, 4)], "doc_id long, tokens long, place long")
    full, rests = packing.pieces(sized, spark.createDataFrame([(1, 64)], CAPS))
    assert sorted((r.doc_id, r.piece_no) for r in full.collect()) == [("1", k) for k in range(1, 16)] + [("2", 1), ("2", 2), ("5", 1)]
    assert sorted((r.doc_id, r.piece_no, r.tokens) for r in rests.collect()) == [("1", 16, 40), ("3", 1, 5), ("4", 1, 0)]


def test_any_number_of_capacities(spark):
    caps = [(i, 10 + i) for i in range(packing.CAPACITIES_AT_ONCE + 3)]
    assert run(spark, [(1, "word " * 5)], caps).select("capacity_id").distinct().count() == len(caps)


def test_start_tokens_cover_a_cut_text(spark):
    got = sorted((r.piece_no, r.start_token, r.tokens) for r in run(spark, [(1, "word " * 300)], [(1, 100)]).collect())
    assert all(a[1] + a[2] == b[1] for a, b in itertools.pairwise(got)) and got[0][1] == 0


def test_empty_tables(spark):
    assert run(spark, [], [(1, 64)]).count() == 0
    assert run(spark, [(1, "word")], []).count() == 0
    assert run(spark, [(1, "word")], [(1, 0), (2, None)]).count() == 0
