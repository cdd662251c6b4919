"""Trees grown on counted rows are Spark's; the importance of all columns takes few jobs and is that of one column after the other."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from caseloom.operators import boosting, signals
from caseloom.operators.features import FEATURE_COLUMNS, KEY_COLUMNS, LABEL_COLUMN


@pytest.fixture(scope="module")
def panel(spark):
    rng, rows = random.Random(5), []
    for n in range(900):
        cases, z, mean = rng.choice([0, 0, 0, 1, 2, 9]), rng.choice([None, rng.gauss(0, 1)]), rng.choice([None, rng.random()])
        values = {c: float(rng.randrange(3)) for c in FEATURE_COLUMNS} | {"case_count": float(cases), "baseline_z": z, "prior_mean_cases": mean, "ratio_to_baseline": rng.random()}
        label = int(cases > 1 and (z or 0) > -0.5 and rng.random() < 0.7)
        rows.append((date(2026, 1, 1) + timedelta(n % 90), f"F{n // 90}", "c", label, *[values[c] for c in FEATURE_COLUMNS]))
    kinds = ", ".join(["report_date date, facility_id string, condition_code string", f"{LABEL_COLUMN} int", *[f"{c} double" for c in FEATURE_COLUMNS]])
    return spark.createDataFrame(rows, kinds).coalesce(2).cache()


@pytest.fixture(scope="module")
def model(panel):
    return signals.train(panel, iterations=8)


def test_the_trees_are_those_of_spark(spark, panel, model, monkeypatch, tmp_path):
    monkeypatch.setattr(boosting, "IN_ONE_TASK", 0)  # Spark fits
    whole = signals.train(panel, iterations=8)
    score = lambda m, name: signals.score(m, panel).select(*KEY_COLUMNS, F.col("signal_score").alias(name))
    assert score(model, "a").join(score(whole, "b"), KEY_COLUMNS).agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9
    fit = model.stages[-1]
    assert fit.getNumTrees == 8 and fit.treeWeights == whole.stages[-1].treeWeights and fit.getMaxIter() == 8 and fit.getLabelCol() == LABEL_COLUMN
    model.write().save(f"{tmp_path}/model")
    again = type(model).load(f"{tmp_path}/model")
    assert score(again, "a").join(score(model, "b"), KEY_COLUMNS).where("a <> b").count() == 0


def test_the_importance_is_that_of_one_column_after_the_other(panel, model, monkeypatch):
    monkeypatch.setattr(signals, "ROWS_A_BUCKET", 15)
    columns = ["case_count", "baseline_z", "lag_1_cases", "prior_mean_cases"]
    buckets = -(-panel.count() // 15)
    shuffled = signals.shuffled
    monkeypatch.setattr(signals, "shuffled", lambda df, c, seed: shuffled(df, c, seed, buckets))
    got = {r.feature: r.importance for r in signals.permutation_importance(model, panel, columns, 1).collect()}
    assert got == pytest.approx(signals._one_by_one(model, panel, columns, 1, 42), abs=1e-9) and got["case_count"] > 0.05
    monkeypatch.setattr(signals, "SCORES_AT_ONCE", 0)
    assert {r.feature: r.importance for r in signals.permutation_importance(model, panel, columns[:1], 1).collect()} == pytest.approx({"case_count": got["case_count"]}, abs=1e-9)


def test_many_rounds_columns_and_repeats_take_few_jobs(spark, panel):
    sc = spark.sparkContext
    sc.setJobGroup("importance", "rounds, columns and repeats")
    try:
        out = signals.permutation_importance(signals.train(panel, iterations=40), panel).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert [r.feature for r in out if r.importance is not None] and {r.feature for r in out} == set(FEATURE_COLUMNS)
    assert 0 < len(sc.statusTracker().getJobIdsForGroup("importance")) < 80


def test_without_positives_nothing_is_lost(panel, model):
    none = panel.withColumn(LABEL_COLUMN, F.lit(0))
    assert {r.importance for r in signals.permutation_importance(model, none).collect()} == {0.0}


def test_a_rare_high_value_is_told_apart():
    import numpy as np

    values, weights = np.arange(50.0), np.array([1_000.0] + [1.0] * 49)
    assert boosting.cuts(np.array([0.0, 2.0, 5.0]), np.ones(3), 32) == [1.0, 3.5]
    assert boosting.cuts(values, weights, 32)[0] == 0.5 and len(boosting.cuts(values, weights, 32)) <= 31
