"""Problem 5: trailing totals with silent days."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from caseloom.operators import trailing

SCHEMA = "case_daily_sk string, report_date timestamp, facility_id string, condition_code string, case_count long, cases_trailing_7d double, baseline_mean_28d double"
FIRST, LAST = date(2025, 11, 3), date(2026, 6, 30)


def day(n):
    return datetime(2025, 11, 3) + timedelta(days=n)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows, counts = [], {}
    for f, c in (("A", "1"), ("A", "2"), (None, "1")):
        for n in rng.sample(range(240), 60):
            v = rng.choice([None, 0, 1, 2, 9])
            counts[(f, c, n)] = v or 0
            rows.append((f"{f}{c}{n}", day(n), f, c, v, None, None))
    rows += rows[:20]
    got = {(r.facility_id, r.condition_code, (r.report_date - FIRST).days): r for r in trailing.trailing_figures(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3 * 240
    for (f, c, n), r in got.items():
        at = lambda k: counts.get((f, c, k), 0)
        assert r.case_count == at(n)
        assert r.total == sum(at(k) for k in range(max(0, n - 6), n + 1))
        before = range(max(0, n - 28), n)
        assert (r.prior_mean is None) == (n == 0)
        assert n == 0 or abs(r.prior_mean - sum(map(at, before)) / len(before)) < 1e-12


def test_wrong_figures(spark):
    rows = [
        ("right", day(0), "A", "1", 2, 2.0, None), ("right", day(0), "A", "1", 2, 2.0, None), ("mean", day(1), "A", "1", None, 2.0, 1.5), ("both", day(2), "A", "1", 1, None, None),
        ("close", day(3), "A", "1", 0, 3.0000001, 1.0), ("null", day(0), "B", "1", 0, 0.0, 0.0),
    ]
    got = {tuple(r) for r in trailing.wrong_figures(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("mean", "baseline_mean_28d"), ("both", "cases_trailing_7d"), ("both", "baseline_mean_28d"), ("null", "baseline_mean_28d")}


def test_days_outside_the_calendar_do_not_exist(spark):
    rows = [("x", day(-1), "A", "1", 100, None, None), ("y", day(240), "A", "1", 100, None, None), ("z", day(0), "A", "1", 1, None, None)]
    got = trailing.trailing_figures(spark.createDataFrame(rows, SCHEMA)).orderBy("report_date").collect()
    assert (got[0].total, got[6].total, got[7].total, got[-1].total) == (1, 1, 0, 0)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trailing.trailing_figures(empty).count() == 0 and trailing.wrong_figures(empty).count() == 0
    df = spark.createDataFrame([("x", day(0), "A", "1", 1, 5.0, None)], SCHEMA).withColumns({c: F.lit("?") for c in ("total", "prior_mean", "_value", "_day", "_own", "_f", "measure")})
    assert [tuple(r) for r in trailing.wrong_figures(df).collect()] == [("x", "cases_trailing_7d")]


def test_no_window_and_no_cross_join(spark):
    plan = trailing.trailing_figures(spark.createDataFrame([("x", day(0), "A", "1", 1, 5.0, None)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
