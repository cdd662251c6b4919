"""Queries of the surveillance pipeline: conform, gold, checks, features, metrics, retrieval, extraction, streams."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.hl7 import FIELD_MAP, parse_messages
from caseloom.functions.keys import age_band, age_years, date_spine, surrogate_key
from caseloom.operators import conform, evals, extract, features, generate, gold, metrics, quality, retrieval, signals
from caseloom.operators.identity import payload_sha256
from caseloom.plans import pipeline
from caseloom.plans.corpus import CONDITION_GROUPS, CORPUS, DOCUMENT_QUESTIONS, EXPOSURES, NOTE_TERMS, ONSET_PHRASES, QUESTIONS, TRAVEL_PHRASES, WINDOWS
from caseloom.session import Settings, stored, work_path
from caseloom.sources import landing
from caseloom.sources.tables import table
from caseloom.streaming import streams

R6 = partial(F.round, scale=6)


def _text(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


def _judged(s: SparkSession, d: str) -> DataFrame:
    return conform.judged_messages(table(s, d, "ecr_messages"))


# --- bronze and silver ------------------------------------------------------------------------------


def hl7_parse(s, d):
    parsed = parse_messages(table(s, d, "ecr_messages"))
    moment = F.date_format("message_ts", "yyyy-MM-dd HH:mm:ss").alias("message_ts")
    return parsed.select("row_id", moment, *[F.col(c).cast("string") for c in FIELD_MAP if c != "message_ts"])


def dq_rules(s, d):
    return _judged(s, d).where(F.size("dq_failures") > 0).select("row_id", F.array_join("dq_failures", ",").alias("dq_failures"))


def dq_split(s, d):
    clean = F.size("dq_failures") == 0
    return _judged(s, d).agg(F.count_if(clean).alias("clean"), F.count_if(~clean).alias("rejected"))


def dq_histogram(s, d):
    return conform.rule_histogram(_judged(s, d))


def balance_sheet(s, d):
    return conform.balance_sheet(_judged(s, d))


def dedupe_first(s, d):
    sha = payload_sha256(F.col("payload_hl7"), F.col("_payload_sha256")).alias("_payload_sha256")
    rows = table(s, d, "ecr_messages").select(sha, "received_at", "_ingest_ts", "message_id", "row_id").where("_payload_sha256 is not null")
    kept = conform.dedupe_first(rows, order=("received_at", "_ingest_ts", "message_id", "row_id"))
    return kept.select("_payload_sha256", "row_id", "retransmission_count")


def silver_cases(s, d):
    out = conform.silver_cases(_judged(s, d).where(F.size("dq_failures") == 0))
    return out.select("_payload_sha256", "facility_id", "age_years", "age_band", "is_positive", "report_month", "retransmission_count", *_text("report_date"))


def payload_hash(s, d):
    return table(s, d, "ecr_messages").select("row_id", F.sha2("payload_hl7", 256).alias("sha"))


def surrogate_keys(s, d):
    return table(s, d, "ecr_cases").select("message_control_id", surrogate_key(F.col("report_date").cast("date"), "facility_id", "condition_code").alias("sk")).distinct()


def anti_ingest(s, d):
    return landing.not_ingested(table(s, d, "ecr_messages"), table(s, d, "ingest_log")).groupBy("source_file").agg(F.count("*").alias("messages"))


def ingested_files(s, d):
    return table(s, d, "ingest_log").select("source_file").distinct()


def age_bands(s, d):
    c = table(s, d, "ecr_cases").select("message_control_id", F.col("birth_date").cast("date").alias("b"), F.col("report_date").cast("date").alias("r")).distinct()
    age = age_years(F.col("b"), F.col("r"))
    return c.select("message_control_id", age.alias("age_years"), age_band(age).alias("age_band"), age_band(age, "unknown").alias("age_band_known"))


# --- gold -------------------------------------------------------------------------------------------


def _stg(s, d):
    return gold.staging(table(s, d, "ecr_cases"))


def _dims(s, d):
    """Staging and both dimensions, each built once and stored: the fact reads them several times."""
    stg = _stg(s, d)
    return stg, stored(gold.dim_facility(stg), "dim-facility"), stored(gold.dim_condition(stg, CONDITION_GROUPS), "dim-condition")


def _fact(s, d):
    return gold.fact_daily(*_dims(s, d))


def staging_positive(s, d):
    return _stg(s, d).select("case_id", "facility_id", "condition_code", "condition_name", "age_years", "county", "retransmission_count", *_text("report_date", "specimen_collection_date", "ingest_date"))


def spine(s, d):
    return date_spine(s, *gold.SPINE).select(*_text("date_day"))


def dim_facility(s, d):
    f = gold.dim_facility(_stg(s, d))
    days = ("first_reported_on", "last_reported_on")
    return f.select(*[c for c in f.columns if c not in days], *_text(*days))


def dim_condition(s, d):
    return gold.dim_condition(_stg(s, d), CONDITION_GROUPS)


def fact_daily(s, d):
    f = _fact(s, d)
    rounded = ("mean_age_years", "baseline_mean_28d", "baseline_sd_28d", "baseline_z")
    return f.select(*[c for c in f.columns if c not in rounded and c != "report_date"], *_text("report_date"), *[R6(c).alias(c) for c in rounded])


def daily_rollup(s, d):
    r = gold.daily_rollup(_fact(s, d))
    return r.select(*[c for c in r.columns if c not in ("report_date", "max_facility_z")], *_text("report_date"), R6("max_facility_z").alias("max_facility_z"))


# --- checks -----------------------------------------------------------------------------------------


def not_null_check(s, d):
    return quality.not_null(table(s, d, "ecr_cases"), "message_control_id", "facility_id", "condition_code", "report_date", "message_ts", "patient_key")


def unique_check(s, d):
    return quality.unique(table(s, d, "fct_case_daily"), "case_daily_sk")


def accepted_check(s, d):
    return quality.accepted_values(table(s, d, "ecr_cases"), "sex", ["M", "F", "O", "U"])


def fk_check(s, d):
    return quality.relationships(table(s, d, "extraction_results"), "message_control_id", table(s, d, "ecr_cases"), "message_control_id")


def range_check(s, d):
    return quality.accepted_range(table(s, d, "ecr_cases"), "age_years", least=0, most=120).select("message_control_id", "age_years")


def reconcile_check(s, d):
    stg, fac, con = _dims(s, d)
    return quality.reconcile(gold.fact_daily(stg, fac, con), stg, *gold.SPINE)


def mart_checks(s, d):
    """All checks on the marts as they are built from the cases of the directory."""
    stg, fac, con = _dims(s, d)
    fact = stored(gold.fact_daily(stg, fac, con), "fact")
    return quality.mart_checks(table(s, d, "ecr_cases"), stg, fac, con, fact, gold.daily_rollup(fact), gold.SPINE)


def future_check(s, d):
    rows = parse_messages(table(s, d, "ecr_messages")).select("row_id", "report_date", F.col("ingest_date").try_cast("date").alias("ingest_date"))
    return quality.no_future_dates(rows).select("row_id", *_text("report_date", "ingest_date"))


# --- features and metrics ---------------------------------------------------------------------------


def _windows(s):
    rows = [(f, c, a, b, m) for f, c, a, b, m in WINDOWS]
    w = s.createDataFrame(rows, "facility_id string, condition_name string, start_date string, end_date string, multiplier double")
    return w.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})


def _features(s, d):
    return features.build_features(_fact(s, d), features.label_days(_windows(s)))


def label_days(s, d):
    return features.label_days(_windows(s)).select("facility_id", "condition_name", "is_outbreak_day", *_text("report_date"))


def range_lookup(s, d):
    days = _fact(s, d).select("report_date", "facility_id", "condition_name")
    return features.multiplier_at(days, _windows(s)).where("multiplier <> 1.0").select("facility_id", "condition_name", "multiplier", *_text("report_date"))


def outbreak_features(s, d):
    f = _features(s, d)
    rounded = ("prior_mean_cases", "ratio_to_baseline", "baseline_z")
    keep = ("facility_id", "condition_code", "case_count", "lag_1_cases", "lag_7_cases", "delta_1_cases", "day_of_week", "is_weekend", "is_enteric", "is_respiratory", "is_outbreak_day")
    return f.select(*keep, *_text("report_date"), *[R6(c).alias(c) for c in rounded])


def _scored(s, d):
    raw = (F.col("case_count") * 3 + F.col("cases_trailing_7d")) / 200.0
    return _features(s, d).select("report_date", "facility_id", "condition_code", "condition_name", "county", "case_count", "baseline_mean_28d", "baseline_z", F.least(raw, F.lit(1.0)).alias("score"), F.col("is_outbreak_day").alias("label"))


def temporal_split(s, d):
    train, test = features.temporal_split(stored(_scored(s, d), "scored"), 75)
    each = lambda df, n: df.groupBy(F.lit(n).alias("part")).agg(F.count("*").alias("n"), F.countDistinct("report_date").alias("days"), F.min("report_date").cast("string").alias("first"), F.max("report_date").cast("string").alias("last"), F.sum("label").alias("positives"))
    return each(train, "train").unionByName(each(test, "test"))


def alert_threshold(s, d):
    return metrics.alert_threshold(stored(_scored(s, d).select("report_date", "score"), "scored"), 8.0)


def rule_alerts(s, d):
    scored = stored(_scored(s, d).select("report_date", "baseline_z", "label"), "scored")
    z2, z3 = metrics.rule_alerts(scored, 2.0), metrics.rule_alerts(scored, 3.0)
    one = lambda df, z: metrics.confusion(df).select(F.lit(z).alias("z"), "tp", "fp", "fn", *[R6(c).alias(c) for c in ("precision", "recall", "f1", "alerts_per_week")])
    return one(z2, 2.0).unionByName(one(z3, 3.0))


def confusion(s, d):
    c = metrics.confusion(_scored(s, d).withColumn("alert", (F.col("score") >= 0.2).cast("int")))
    return c.select("tp", "fp", "fn", "alerts", *[R6(x).alias(x) for x in ("precision", "recall", "f1", "alerts_per_week")])


def ranking_metrics(s, d):
    m = metrics.ranking_metrics(_scored(s, d))
    return m.select(*[R6(c).alias(c) for c in m.columns])


def brier(s, d):
    return metrics.brier(_scored(s, d)).select(R6("brier").alias("brier"))


def recent_signals(s, d):
    scored = features.recent(stored(_scored(s, d), "scored"), 14)
    return signals.signal_table(scored.withColumnRenamed("score", "signal_score"), threshold=0.15, version="1").select(
        "facility_id", "condition_code", "condition_name", "case_count", "signal_score", "is_signal", "threshold", "model_version", R6("baseline_z").alias("baseline_z"), *_text("report_date")
    )


def _split_features(s, d):
    return features.temporal_split(stored(_features(s, d), "features"), 75)  # read by every round and every permutation


def gbt_scores(s, d):
    train, test = _split_features(s, d)
    model = signals.train(train)
    return signals.score(model, test).select("facility_id", "condition_code", "is_outbreak_day", R6("signal_score").alias("signal_score"), *_text("report_date"))


def permutation_importance(s, d):
    train, test = _split_features(s, d)
    return signals.permutation_importance(signals.train(train), test)


# --- retrieval --------------------------------------------------------------------------------------


def _documents(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), "text")


def _questions(s):
    return s.createDataFrame(DOCUMENT_QUESTIONS, "query_id string, question string")


def _corpus(s):
    return s.createDataFrame(CORPUS, "id string, title string, text string")


def tokens(s, d):
    return _documents(s, d).select("id", F.array_join(retrieval.tokens(F.col("text")), " ").alias("tokens"))


def doc_freq(s, d):
    return retrieval.doc_frequency(_documents(s, d))


def bm25_topk(s, d):
    hits = retrieval.top_k(retrieval.bm25_scores(_documents(s, d), _questions(s)), 10)
    return hits.select("query_id", "id", "rank", R6("score").alias("score"))


def index_topk(s, d):
    """The same hits from an index that was built and opened again."""
    path = work_path(s, "index")
    retrieval.Bm25Index.build(_documents(s, d), path)
    hits = retrieval.Bm25Index(s, path).search(_questions(s), 10)
    return hits.select("query_id", "id", "rank", R6("score").alias("score"))


def rule_replies(s, d):
    notes = table(s, d, "ecr_cases").select("message_control_id", F.col("clinical_note").alias("note")).where("note is not null").distinct()
    reply = F.from_json(extract.rule_reply(F.col("note")), "symptoms array<string>, onset_date string, exposure_setting string, recent_travel boolean, confidence string")
    return notes.select("message_control_id", reply.alias("r")).select(
        "message_control_id", F.array_join("r.symptoms", ",").alias("symptoms"), "r.onset_date", "r.exposure_setting", "r.recent_travel", "r.confidence"
    )


def facts(s, d):
    """The rule backend with validation, grounding and mapping, as the settings choose it."""
    notes = table(s, d, "ecr_cases").groupBy("message_control_id").agg(F.max("clinical_note").alias("note"))
    out = extract.extract_all(notes, "message_control_id", Settings())
    return out.select("message_control_id", F.array_join("symptoms_mapped", ",").alias("symptoms_mapped"), F.col("onset_date").cast("string").alias("onset_date"), "exposure_setting", "recent_travel", "extraction_failed", "attempts")


def refusal_floor(s, d):
    q = _questions(s)
    hits = retrieval.top_k(retrieval.bm25_scores(_documents(s, d), q), 3)
    return retrieval.confidence(q, hits).select("query_id", R6("best").alias("best"), "refused")


def grounded_answers(s, d):
    q = s.createDataFrame([x[:2] for x in QUESTIONS], "query_id string, question string")
    a = retrieval.answer_questions(_corpus(s), q)
    return a.select("query_id", "answer", "grounded", F.array_join("citations", ",").alias("citations"))


def retrieval_eval(s, d):
    q = s.createDataFrame(QUESTIONS, "query_id string, question string, expect_doc string, answerable boolean")
    return evals.retrieval_eval(retrieval.answer_questions(_corpus(s), q.select("query_id", "question")), q)


# --- extraction -------------------------------------------------------------------------------------


def stub_extract(s, d):
    notes = table(s, d, "ecr_cases").select("message_control_id", F.col("clinical_note").alias("note")).where("note is not null").distinct()
    out = extract.rule_extract(notes)
    return out.select("message_control_id", F.array_join("symptoms", ",").alias("symptoms"), "onset_date", "exposure_setting", "recent_travel")


def vocab_map(s, d):
    rows = table(s, d, "extraction_results").select("extraction_id", F.filter(F.coalesce("symptoms", F.array().cast("array<string>")), lambda t: t.isNotNull()).alias("symptoms"))
    out = extract.map_symptoms(rows, "extraction_id")
    return out.select("extraction_id", F.array_join("symptoms_mapped", ",").alias("symptoms_mapped"), F.array_join("unmapped_terms", ",").alias("unmapped_terms"))


def date_grounding(s, d):
    notes = table(s, d, "ecr_cases").groupBy("message_control_id").agg(F.max("clinical_note").alias("note"))
    e = table(s, d, "extraction_results").select("extraction_id", "message_control_id", F.col("onset_date").cast("date").alias("onset_date"))
    joined = e.join(notes, "message_control_id", "left")
    return joined.select("extraction_id", extract.grounded(F.col("onset_date"), F.col("note")).alias("grounded"))


def golden_notes(cases: DataFrame) -> DataFrame:
    """One note per case with known facts, written from the case's own columns."""
    c = cases.where("report_date is not null and message_control_id is not null").select("message_control_id", F.col("report_date").cast("date").alias("r")).distinct()
    n = F.substring("message_control_id", -5, 5).cast("int")
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i % len(values)) + 1)
    k = F.col("k")
    return (
        c.withColumn("k", n)
        .withColumns({
            "s1": pick(NOTE_TERMS, k), "s2": pick(NOTE_TERMS, k + 4), "want_exposure": pick(EXPOSURES, k),
            "want_travel": k % 6 == 0, "want_onset": F.date_sub("r", (k % 8 + 2).cast("int")).cast("string"),
        })
        .withColumn("note", F.concat(
            F.lit("Adult presenting with "), "s1", F.lit(" and "), "s2", F.lit(". "), pick(ONSET_PHRASES, k), "want_onset",
            F.lit(". Exposure history: "), "want_exposure", F.when(F.col("want_travel"), pick(TRAVEL_PHRASES, k)).otherwise(". No travel."),
        ))
        .withColumn("symptoms", F.array("s1", "s2"))
    )


def _extraction(s, d):
    want = extract.map_symptoms(golden_notes(table(s, d, "ecr_cases")), "message_control_id").withColumnRenamed("symptoms_mapped", "want_symptoms").drop("unmapped_terms", "symptoms")
    got = extract.map_symptoms(extract.rule_extract(want), "message_control_id")
    return got.withColumnsRenamed({"symptoms_mapped": "got_symptoms", "onset_date": "got_onset", "exposure_setting": "got_exposure", "recent_travel": "got_travel"}).withColumn(
        "failed", ~extract.grounded(F.col("got_onset").try_cast("date"), F.col("note"))
    )


def extraction_eval(s, d):
    return evals.extraction_eval(_extraction(s, d))


def worst_cases(s, d):
    w = evals.worst_cases(_extraction(s, d), "message_control_id")
    return w.select("message_control_id", F.array_join("missing", ",").alias("missing"), F.array_join("spurious", ",").alias("spurious"), "onset_ok", "exposure_ok")


def gates(s, d):
    facts, found = evals.extraction_eval(_extraction(s, d)), retrieval_eval(s, d).drop("n_cases")
    return evals.gate_table(facts.join(F.broadcast(found), F.lit(True)))  # one row each


# --- sources and sinks --------------------------------------------------------------------------------


def land_bronze(s, d):
    """All messages written as landing files and taken into bronze, in two runs of which the second finds nothing."""
    lake = landing.Lake(work_path(s, "lake"))
    landing.write_landing(table(s, d, "ecr_messages").select("message_id", "source_system", "received_at", "payload_hl7", "ingest_date"), lake.uri("landing", "ecr"))
    first, second = landing.land_to_bronze(s, lake), landing.land_to_bronze(s, lake)
    bronze, log = lake.read(s, "bronze", "ecr_messages"), lake.read(s, "bronze", "_ingest_log")
    logged = bronze.join(log.select("source_file", "_batch_id").distinct(), ["source_file", "_batch_id"], "left_semi")
    out = logged.groupBy(F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count("*").alias("messages"), F.countDistinct("_payload_sha256").alias("payloads"), F.countDistinct("_batch_id").alias("batches"), F.count("message_id").alias("named")
    )
    return out.withColumn("second_run", F.lit(second["rows"]) + F.lit(first["rows"]) * 0)


def silver_lake(s, d):
    """Silver and quarantine as the stage writes them, read again: rows of each partition."""
    lake = landing.Lake(work_path(s, "lake"))
    lake.write(table(s, d, "ecr_messages").drop("row_id"), "bronze", "ecr_messages", "overwrite")
    pipeline.silver_stage(s, lake)
    silver = landing.read_merged(s, lake.uri("silver", "ecr_cases")).groupBy(F.lit("silver").alias("layer"), F.col("report_month").cast("string").alias("part")).agg(F.count("*").alias("n"))
    rejected = landing.materialise(lake.read(s, "quarantine", "ecr_rejects"), "rejected_now").groupBy(F.lit("quarantine").alias("layer"), F.col("ingest_date").alias("part")).agg(F.count("*").alias("n"))
    return silver.unionByName(rejected)


def small_files(s, d):
    """A small table through a sidecar document, JSON lines and a single Parquet file."""
    rows = table(s, d, "dim_condition").select("condition_code", "condition_name", "lifetime_case_count")
    base, schema = work_path(s, "small"), "condition_code string, condition_name string, lifetime_case_count bigint"
    landing.write_sidecar(s, [r.asDict() for r in rows.collect()], f"{base}/document.json")  # a code list
    rows.write.json(f"{base}/lines")
    landing.write_single_file(rows, f"{base}/single")
    read = {"document": landing.read_json_document(s, f"{base}/document.json", schema), "lines": landing.read_json_lines(s, f"{base}/lines", schema), "single": s.read.parquet(f"{base}/single")}
    return reduce(DataFrame.unionByName, [df.select(F.lit(how).alias("how"), *rows.columns) for how, df in read.items()])


# --- streams and generator --------------------------------------------------------------------------


def stream_ingest(s, d):
    return streams.ingest_to_bronze(s, f"{d}/ecr_messages.parquet").groupBy(F.col("ingest_date").cast("string").alias("ingest_date")).agg(F.count("*").alias("messages"))


def stream_daily(s, d):
    out = streams.daily_counts(s, f"{d}/events.parquet", "ts", ["event_type"])
    return out.select(F.col("day").cast("string").alias("day"), "event_type", "n")


def stream_dedupe(s, d):
    return streams.first_of_each(s, f"{d}/ecr_messages.parquet", "_payload_sha256", "_ingest_ts").agg(F.count("*").alias("messages"), F.countDistinct("_payload_sha256").alias("payloads"))


def synthetic_messages(s, d):
    out = generate.messages(s)
    return out.groupBy("ingest_date").agg(F.count("*").alias("messages"), F.countDistinct("message_id").alias("distinct_messages"))


QUERIES = {
    f.__name__: f
    for f in (
        hl7_parse, dq_rules, dq_split, dq_histogram, balance_sheet, dedupe_first, silver_cases, payload_hash, surrogate_keys, anti_ingest,
        ingested_files, age_bands, staging_positive, spine, dim_facility, dim_condition, fact_daily, daily_rollup, not_null_check, unique_check,
        accepted_check, fk_check, range_check, reconcile_check, mart_checks, future_check, label_days, range_lookup, outbreak_features, temporal_split,
        alert_threshold, rule_alerts, confusion, ranking_metrics, brier, recent_signals, gbt_scores, permutation_importance, tokens, doc_freq,
        bm25_topk, index_topk, refusal_floor, grounded_answers, retrieval_eval, stub_extract, rule_replies, facts, vocab_map, date_grounding, extraction_eval, worst_cases,
        gates, land_bronze, silver_lake, small_files, stream_ingest, stream_daily, stream_dedupe, synthetic_messages,
    )
}
