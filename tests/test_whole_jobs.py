"""Registered queries do the whole job of their operator."""

import hashlib
from datetime import date

from oracle import DATA, connect
from pyspark.sql import functions as F

from caseloom.operators import conform, evals, generate, signals
from caseloom.operators.features import FEATURE_COLUMNS
from caseloom.plans import catalogue
from caseloom.plans.corpus import WINDOWS

QUERIES = catalogue.queries()


def test_range_lookup_covers_every_facility_with_a_window(spark):
    got = {(r.facility_id, r.condition_name, r.report_date): r.multiplier for r in QUERIES["range_lookup"](spark, f"{DATA}/sf0.001").collect()}
    want = {}
    for f, c, a, b, m in sorted(WINDOWS, key=lambda w: w[2], reverse=True):  # the first window by start is written last
        want |= {(f, c, str(date.fromordinal(n))): m for n in range(date.fromisoformat(a).toordinal(), date.fromisoformat(b).toordinal() + 1)}
    assert got == want and ("FX001002", "Mumps", "2026-06-24") in got


def test_the_model_is_trained_and_explained_with_the_production_defaults(spark, monkeypatch):
    train, asked = signals.train, []
    monkeypatch.setattr(signals, "train", lambda df, iterations=300, seed=42: asked.append(iterations) or train(df, iterations=1))
    monkeypatch.setattr(signals, "permutation_importance", lambda model, df, columns=None, repeats=5, seed=42: asked.append((columns or FEATURE_COLUMNS, repeats)) or df)
    QUERIES["gbt_scores"](spark, f"{DATA}/sf0.001")
    QUERIES["permutation_importance"](spark, f"{DATA}/sf0.001")
    assert asked == [300, 300, (FEATURE_COLUMNS, 5)]


def test_long_boosting_cuts_its_lineage(spark, monkeypatch):
    made = []
    whole = signals.GBTClassifier
    monkeypatch.setattr(signals, "GBTClassifier", lambda **kw: made.append(whole(**kw)) or made[-1])
    df = spark.createDataFrame([(float(n % 3 == 0), n) for n in range(60)], "v double, is_outbreak_day int").select((F.col("is_outbreak_day") % 2).alias("is_outbreak_day"), *[F.col("v").alias(c) for c in FEATURE_COLUMNS])
    signals.train(df, iterations=1)
    assert made[0].getCheckpointInterval() > 0 and not spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty()


def test_payloads_without_a_recorded_hash_or_in_capitals_are_deduplicated(spark, message):
    got = {(r._payload_sha256, r.row_id, r.retransmission_count) for r in QUERIES["dedupe_first"](spark, f"{DATA}/sf0.001").collect()}
    want = connect(f"{DATA}/sf0.001").execute("""SELECT sha, row_id, n FROM (SELECT *, row_number() OVER (PARTITION BY sha
      ORDER BY received_at NULLS FIRST, _ingest_ts NULLS FIRST, message_id NULLS FIRST, row_id) AS rn, count(*) OVER (PARTITION BY sha) - 1 AS n
      FROM (SELECT *, sha256(payload_hl7) AS sha FROM ecr_messages WHERE payload_hl7 IS NOT NULL)) WHERE rn = 1""").fetchall()
    assert got == set(want)
    sha = hashlib.sha256(message.encode()).hexdigest()
    other = message.replace("C1", "C2")
    rows = [(message, sha), (message, sha.upper()), (message, None), (other, None), ("MSH|", None)]
    sheet = conform.balance_sheet(conform.judged_messages(spark.createDataFrame([(p, h, "2026-03-11") for p, h in rows], "payload_hl7 string, _payload_sha256 string, ingest_date string"))).first()
    assert (sheet.bronze, sheet.rejected, sheet.silver, sheet.deduplicated) == (5, 1, 2, 2)


def test_every_case_is_scored_and_every_gate_reported(spark):
    d = f"{DATA}/sf0.01"
    r = QUERIES["extraction_eval"](spark, d).first()
    n, multiples = connect(d).execute("""SELECT count(*), count(*) FILTER (WHERE CAST(right(message_control_id, 5) AS INTEGER) % 97 = 0) FROM
      (SELECT DISTINCT message_control_id, report_date FROM ecr_cases WHERE report_date IS NOT NULL AND message_control_id IS NOT NULL)""").fetchone()
    assert multiples > 0 and (r.n_cases, r.schema_failure_rate) == (n, 0.0)
    gates = {g.gate: (g.value is not None, g.breached) for g in QUERIES["gates"](spark, d).collect()}
    assert set(gates) == set(evals.GATES) and gates["citation_accuracy"][0] and gates["refusal_accuracy"][0]
    missing = {g.gate: (g.value, g.breached) for g in evals.gate_table(QUERIES["extraction_eval"](spark, d)).collect()}
    assert missing["citation_accuracy"] == missing["refusal_accuracy"] == (None, True) and missing["schema_failure_rate"] == (0.0, False)


def test_a_failed_extraction_is_counted_and_left_out_of_the_rates(spark):
    one = lambda got, failed: (got, ["fever"], "2026-03-01", "2026-03-01", "lake", "Lake", False, False, failed)
    df = spark.createDataFrame([one(["fever"], False), one(["cough"], True)], "got_symptoms array<string>, want_symptoms array<string>, got_onset string, want_onset string, got_exposure string, want_exposure string, got_travel boolean, want_travel boolean, failed boolean")
    r = evals.extraction_eval(df).first()
    assert (r.n_cases, r.schema_failure_rate, r.symptom_f1) == (2, 0.5, 1.0)


def test_the_generator_runs_with_its_defaults_and_without_a_limit(spark):
    days = [r.ingest_date for r in QUERIES["synthetic_messages"](spark, f"{DATA}/sf0.001").collect()]
    assert len(days) >= 240 and min(days) == "2025-11-03"
    draw = spark.createDataFrame([(28.0, 0.99), (28.0, 0.5), (0.2, 0.5), (100.0, 0.5)], "m double, u double").select(generate.poisson(F.col("m"), F.col("u")).alias("n"))
    assert [r.n for r in draw.collect()] == [41, 28, 0, 100]
