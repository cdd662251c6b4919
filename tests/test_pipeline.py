"""The surveillance pipeline's behaviours: parsing, rules, dedupe, gold, features, metrics, retrieval, extraction."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from caseloom.functions.hl7 import parse_messages
from caseloom.functions.keys import age_band, age_years, surrogate_key
from caseloom.operators import conform, evals, extract, features, generate, gold, metrics, quality, retrieval, signals
from caseloom.plans.corpus import CORPUS
from caseloom.session import work_path
from caseloom.sources import landing


def judge(spark, payload, ingest="2026-03-12"):
    return conform.judged_messages(spark.createDataFrame([(payload, ingest)], "payload_hl7 string, ingest_date string")).first()


def test_parse(spark, message):
    r = parse_messages(spark.createDataFrame([(message,)], "payload_hl7 string")).first()
    assert (r.facility_id, r.message_control_id, r.patient_key, r.sex, r.county) == ("FX000009", "C1", "abc123", "F", "Redthorn")
    assert (r.condition_code, r.condition_display, r.result_code) == ("990063002", "RSV infection", "POS")
    assert (r.birth_date, r.report_date, r.specimen_collection_date) == (date(1980, 2, 29), date(2026, 3, 10), date(2026, 3, 8))
    assert r.message_ts == datetime(2026, 3, 10, 8, 15)


def test_rules(spark, message):
    no_obx = "\r".join(s for s in message.split("\r") if not s.startswith("OBX"))
    assert list(judge(spark, no_obx).dq_failures) == ["missing_condition_code", "missing_report_date"]
    zero = judge(spark, message.replace("20260310081500", "0" * 14))
    assert zero.message_ts is None and list(zero.dq_failures) == ["unparseable_message_ts"]
    head = judge(spark, message.split("\r")[0])
    assert head.facility_id == "FX000009" and len(head.dq_failures) >= 2
    assert list(judge(spark, message).dq_failures) == []
    assert list(judge(spark, None).dq_failures)[0] == "missing_condition_code"


def test_first_arrival_and_count(spark):
    rows = [("A", "2026-01-01T16:00:00", datetime(2026, 1, 2), "m1"), ("A", "2026-01-01T00:00:00", datetime(2026, 1, 3), "m2"), ("B", "2026-01-01T00:00:00", datetime(2026, 1, 2), "m3")]
    got = conform.dedupe_first(spark.createDataFrame(rows, "_payload_sha256 string, received_at string, _ingest_ts timestamp, message_id string"))
    assert {(r._payload_sha256, r.message_id, r.retransmission_count) for r in got.collect()} == {("A", "m2", 1), ("B", "m3", 0)}
    assert conform.dedupe_first(got.drop("retransmission_count")).count() == 2  # a second pass changes nothing


def test_keys_and_bands(spark):
    df = spark.createDataFrame([(None, "x", date(2000, 2, 29), date(2026, 2, 27))], "a string, b string, born date, seen date")
    r = df.select(surrogate_key("a", "b").alias("k"), age_years(F.col("born"), F.col("seen")).alias("age"), age_band(F.lit(None).cast("int")).alias("n"), age_band(F.lit(None).cast("int"), "unknown").alias("u")).first()
    assert (r.age, r.n, r.u) == (25, "65+", "unknown")
    import hashlib

    assert r.k == hashlib.md5(b"_null_||x").hexdigest()


STG = "case_id string, facility_id string, condition_code string, condition_name string, condition_system string, report_date date, specimen_collection_date date, patient_key string, age_years long, county string, state string, retransmission_count long, ingest_date date"


def stg(spark, days):
    start = date(2025, 11, 3)
    return spark.createDataFrame([(f"c{i}", "F1", "1", "Measles", "L", start + timedelta(days=n), None, f"p{i % 3}", 10, "X", "S", 0, None) for i, n in enumerate(days)], STG)


def test_fact_is_dense_and_baselines_exclude_their_day(spark):
    s = stg(spark, [0, 0, 1, 5, 30, 30, 30])
    fact = gold.fact_daily(s, gold.dim_facility(s), gold.dim_condition(s)).orderBy("report_date").collect()
    counts = [2, 1, 0, 0, 0, 1] + [0] * 24 + [3] + [0] * 209
    assert [r.case_count for r in fact] == counts and sum(counts) == s.count()
    assert fact[0].baseline_mean_28d is None and fact[0].baseline_days == 0
    for n in (1, 6, 30, 100):
        before = counts[max(0, n - 28) : n]
        assert fact[n].baseline_mean_28d == pytest.approx(sum(before) / len(before))
        assert fact[n].cases_trailing_7d == sum(counts[max(0, n - 6) : n + 1])
    assert fact[20].baseline_z is None and fact[21].baseline_z is not None  # the 22nd day is the first with 21 days before
    assert {r.case_daily_sk for r in fact}.__len__() == 240 and fact[5].is_weekend and not fact[4].is_weekend


def test_staleness_is_strict(spark):
    status = lambda n: gold.dim_facility(stg(spark, [n])).first().reporting_status
    assert (status(239 - 14), status(239 - 15)) == ("active", "stale")


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 5)], "k string, v int")
    assert {r.column_name: r.violations for r in quality.not_null(df, "k", "v").collect()} == {"k": 1, "v": 0}
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.accepted_values(df, "k", ["b"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.relationships(df, "k", spark.createDataFrame([("b",)], "id string"), "id").collect()] == [("a", 2)]
    assert [r.v for r in quality.accepted_range(df, "v", least=0).collect()] == [-1]


def panel(spark, series):
    rows = [(date(2026, 1, 1) + timedelta(days=i), "F", "1", "Measles", "other", "X", n) for i, n in enumerate(series)]
    df = spark.createDataFrame(rows, "report_date date, facility_id string, condition_code string, condition_name string, condition_group string, county string, case_count long")
    return df.withColumns({"cases_trailing_7d": F.lit(0.0), **{c: F.lit(None).cast("double") for c in ("baseline_mean_28d", "baseline_sd_28d", "baseline_z")}})


LABELS = "report_date date, facility_id string, condition_name string, is_outbreak_day int"


def test_features_never_see_their_day(spark):
    got = features.build_features(panel(spark, [*range(1, 9), 100]), spark.createDataFrame([], LABELS)).orderBy("report_date").collect()
    assert got[-1].lag_1_cases == 8 and got[-1].prior_mean_cases == pytest.approx(4.5) and got[6].prior_mean_cases is None
    assert got[0].lag_1_cases is None and got[0].ratio_to_baseline == 2.0 and all(r.is_outbreak_day == 0 for r in got)


def test_labels_join_once_even_where_windows_overlap(spark):
    w = spark.createDataFrame([("F", "Measles", date(2026, 1, 2), date(2026, 1, 2)), ("F", "Measles", date(2026, 1, 1), date(2026, 1, 2))], "facility_id string, condition_name string, start_date date, end_date date")
    got = features.build_features(panel(spark, [1, 9, 1]), features.label_days(w)).orderBy("report_date").collect()
    assert [r.is_outbreak_day for r in got] == [1, 1, 0]


def test_split_and_budget(spark):
    df = spark.range(100).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("report_date"))
    train, test = features.temporal_split(df, 25)
    assert (train.count(), test.count()) == (75, 25)
    assert train.agg(F.max("report_date")).first()[0] < test.agg(F.min("report_date")).first()[0]
    scored = spark.range(700).select(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 70).cast("int")).alias("report_date"), (F.col("id") / 700).alias("score"))
    t = metrics.alert_threshold(scored, 5.0).first()
    assert t.budget == 50 and scored.where(F.col("score") >= t.threshold).count() == 50
    assert metrics.alert_budget(165, 10_000, 8.0) == 189 and metrics.alert_budget(1, 2, 100.0) == 1


def test_ranking_metrics_against_plain_python(spark):
    rng = random.Random(1)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(200)]
    got = metrics.ranking_metrics(spark.createDataFrame(rows, "score double, label int")).first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        taken = [y for s, y in rows if s >= t]
        ap += sum(y for s, y in rows if s == t) / len(pos) * sum(taken) / len(taken)
    assert got.roc_auc == pytest.approx(auc) and got.average_precision == pytest.approx(ap)
    none = metrics.ranking_metrics(spark.createDataFrame([(0.5, 0)], "score double, label int")).first()
    assert none.roc_auc is None and none.average_precision is None


def test_confusion_without_alerts(spark):
    c = metrics.confusion(spark.createDataFrame([(0, 1, date(2026, 1, 1))], "alert int, label int, report_date date")).first()
    assert (c["precision"], c.recall, c.f1, c.alerts) == (0.0, 0.0, 0.0, 0)


def test_tokens(spark):
    one = lambda t: spark.createDataFrame([(t,)], "t string").select(retrieval.tokens(F.col("t"))).first()[0]
    assert one("The food handlers") == ["food", "handler"] and one("illness gas its") == ["illness", "gas"] and one("") == []


def corpus(spark):
    return spark.createDataFrame(CORPUS, "id string, title string, text string")


def questions(spark, *q):
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(q)], "query_id string, question string")


def test_answers_cite_or_refuse(spark):
    got = {r.query_id: r for r in retrieval.answer_questions(corpus(spark), questions(spark, "How long are pupils with mumps excluded from school?", "What about rabies and bats?", "of the and")).collect()}
    assert got["q0"].grounded and got["q0"].citations == ["doc-mumps-school"]
    assert all(got[q].answer == retrieval.REFUSAL and not got[q].grounded for q in ("q1", "q2"))


def test_uncited_answer_is_downgraded(spark):
    rows = [("a", "Stay home. [doc-x]", ["doc-x"]), ("b", "Stay home.", ["doc-x"]), ("c", "Stay home. [doc-y]", ["doc-x"]), ("d", retrieval.REFUSAL, ["doc-x"])]
    got = {r.query_id: r for r in retrieval.enforce_citations(spark.createDataFrame(rows, "query_id string, reply string, retrieved array<string>")).collect()}
    assert got["a"].grounded and [got[k].grounded for k in "bcd"] == [False] * 3
    assert got["b"].note and got["c"].note and got["d"].note is None and got["c"].answer == retrieval.REFUSAL


def test_bm25_counts_repeated_query_terms_and_boosts_titles(spark):
    once, twice = (dict((r.id, r.score) for r in retrieval.bm25_scores(corpus(spark), questions(spark, q)).collect()) for q in ("mumps", "mumps mumps"))
    assert twice["doc-mumps-school"] == pytest.approx(2 * once["doc-mumps-school"]) and list(once) == ["doc-mumps-school"]


def test_vocabulary(spark):
    assert extract.to_canonical(["Loose Stools", "severe bloody stools", "purple spots"]) == (["bloody diarrhea", "diarrhea"], ["purple spots"])
    df = spark.createDataFrame([(1, ["Loose stools", "severe bloody stools", "purple spots", " "]), (2, []), (3, None)], "id int, symptoms array<string>")
    got = {r.id: r for r in extract.map_symptoms(df, "id").collect()}
    assert got[1].symptoms_mapped == ["bloody diarrhea", "diarrhea"] and got[1].unmapped_terms == ["purple spots"]
    assert got[2].symptoms_mapped == [] and got[3].symptoms_mapped is None


def test_rule_backend(spark):
    note = "Presenting with bloody diarrhea and fever. Symptom onset reported as 2026-03-01. Exposure history: Petting farm. Reports recent travel abroad."
    r = extract.rule_extract(spark.createDataFrame([(note,)], "note string")).first()
    assert (r.symptoms, r.onset_date, r.exposure_setting, r.recent_travel) == (["bloody diarrhea", "fever"], "2026-03-01", "petting farm", True)


def script(*replies):
    queue = list(replies)
    return lambda system, user: queue.pop(0)


def reply(**kw):
    return json.dumps({"symptoms": ["fever"], "onset_date": "2026-03-01", "exposure_setting": None, "recent_travel": False} | kw)


def test_retry_grounding_and_failing_closed():
    note = "Fever since 2026-03-01."
    assert extract.extract_note(note, script("no json", reply()))["attempts"] == 2
    assert extract.extract_note(note, script(f"```json\n{reply()}\n```"))["attempts"] == 1
    wrong = extract.extract_note(note, script(*[reply(onset_date="2026-03-02")] * 3))
    assert wrong["extraction_failed"] and wrong["attempts"] == 3 and "2026-03-02" in wrong["failure_reason"] and wrong["onset_date"] is None
    for bad in ({"symptoms": [None]}, {"symptoms": "fever"}, {"recent_travel": "yes"}, {"onset_date": "soon"}, {"confidence": "sure"}):
        assert extract.extract_note(note, script(reply(**bad), reply()))["attempts"] == 2


def test_remote_backend_in_batches(spark):
    df = spark.createDataFrame([(1, "Fever since 2026-03-01."), (2, None)], "id int, note string")
    got = {r.id: r for r in extract.extract_notes(df, "id", lambda s, u: '{"symptoms": ["febrile"], "onset_date": "2026-03-01"}').collect()}
    assert got[1].symptoms_mapped == ["fever"] and got[2].extraction_failed


def test_gates():
    good = {"symptom_f1": 0.95, "onset_exact": 1.0, "schema_failure_rate": 0.0, "citation_accuracy": 0.8, "refusal_accuracy": 1.0}
    assert evals.gate_breaches(good) == [] and evals.gate_breaches(good | {"schema_failure_rate": 0.03}) == ["schema_failure_rate"]
    assert "refusal_accuracy" in evals.gate_breaches({k: v for k, v in good.items() if k != "refusal_accuracy"})


def test_end_to_end(spark, tmp_path):
    lake = landing.Lake(str(tmp_path))
    with pytest.raises(ValueError):
        lake.uri("attic", "x")
    made = generate.messages(spark, days=40, facilities=4, end="2026-06-30")
    landing.write_landing(made, lake.uri("landing", "ecr"))
    first, second = landing.land_to_bronze(spark, lake), landing.land_to_bronze(spark, lake)
    assert first["rows"] == made.count() > 300 and first["files"] > 30 and (second["rows"], second["files"]) == (0, 0)
    bronze = lake.read(spark, "bronze", "ecr_messages")
    assert bronze.select("source_file").distinct().count() == first["files"] == lake.read(spark, "bronze", "_ingest_log").count()
    judged = conform.judged_messages(bronze)
    sheet = conform.balance_sheet(judged).first()
    assert 0 < sheet.rejected < 0.1 * sheet.bronze and sheet.deduplicated > 0
    silver = conform.silver_cases(judged.where("size(dq_failures) = 0"))
    assert silver.columns == conform.SILVER_COLUMNS and silver.count() == sheet.silver
    kinds = {r["rule"] for r in conform.rule_histogram(judged).collect()}
    assert {"missing_condition_code", "missing_report_date", "unparseable_message_ts"} <= kinds
    s = gold.staging(silver)
    fact = gold.fact_daily(s, gold.dim_facility(s), gold.dim_condition(s), ("2026-05-22", "2026-06-30"))
    assert quality.reconcile(fact, s, "2026-05-22", "2026-06-30").count() == 0 and quality.unique(fact, "case_daily_sk").count() == 0
    sample = generate.golden_sample(spark, days=40, facilities=4, rate=0.5, most=20)
    assert sample.count() == 20


def test_model_roundtrip(spark):
    rng = random.Random(2)
    df = panel(spark, [rng.choice([0, 1, 2, 20]) for _ in range(120)]).withColumn("baseline_z", F.when(F.col("case_count") > 2, F.col("case_count").cast("double")))
    made = features.build_features(df, spark.createDataFrame([], LABELS)).withColumn("is_outbreak_day", (F.col("case_count") > 10).cast("int"))
    model = signals.train(made, iterations=2)
    scored = signals.score(model, made)
    assert scored.where("baseline_z is null").count() == made.where("baseline_z is null").count()
    assert metrics.ranking_metrics(scored.withColumn("label", F.col("is_outbreak_day")), "signal_score").first().roc_auc == 1.0
    mixed = signals.shuffled(made, "case_count", 1)
    assert mixed.count() == 120 and sorted(r.case_count for r in mixed.collect()) == sorted(r.case_count for r in made.collect())
    registry = signals.Registry(spark, work_path(spark, "models"), "outbreak")
    with pytest.raises(LookupError):
        registry.latest()
    assert (registry.register(model), registry.register(model)) == (1, 2) and registry.latest()[1] == 2
    table = signals.signal_table(scored, 0.5, "2")
    assert table.columns[-1] == "scored_at" and table.first().is_signal == 1
