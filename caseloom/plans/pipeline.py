"""The stages of the lake as functions over a :class:`~caseloom.sources.landing.Lake`, and the nightly order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import conform, features, generate, gold, metrics, quality, retrieval, signals
from caseloom.session import stored
from caseloom.sources import landing
from caseloom.sources.landing import Lake


def generate_stage(spark: SparkSession, lake: Lake, days: int = 240, facilities: int = 12, end: str = "2026-06-30", dup_rate: float = 0.04, corrupt_rate: float = 0.025) -> dict:
    landing.write_landing(generate.messages(spark, days, facilities, end, dup_rate, corrupt_rate), lake.uri("landing", "ecr"))
    windows = generate.outbreak_windows(spark, days, facilities, end)
    windows.write.mode("overwrite").parquet(lake.uri("landing", "_outbreaks"))
    return {"files": landing.read_landing(spark, lake.uri("landing", "ecr")).select("source_file").distinct().count()}


def bronze_stage(spark: SparkSession, lake: Lake) -> dict:
    return landing.land_to_bronze(spark, lake)


def silver_stage(spark: SparkSession, lake: Lake) -> dict:
    """Parses once: the judged messages are stored, then split into silver and quarantine."""
    judged = stored(conform.judged_messages(lake.read(spark, "bronze", "ecr_messages")), "judged")
    lake.write(conform.silver_cases(judged.where(F.size("dq_failures") == 0)), "silver", "ecr_cases", "overwrite", ["report_month"])
    rejected = judged.where(F.size("dq_failures") > 0).select("message_id", "payload_hl7", "dq_failures", "ingest_date", "_batch_id")
    lake.write(rejected, "quarantine", "ecr_rejects")
    return conform.balance_sheet(judged).first().asDict() | {"rules": {r["rule"]: r.failures for r in conform.rule_histogram(judged).collect()}}


def gold_stage(spark: SparkSession, lake: Lake, spine: tuple[str, str] | None = None) -> dict:
    """Dimensions, fact and rollup; the calendar is the data's own unless given."""
    stg = gold.staging(lake.read(spark, "silver", "ecr_cases"))
    if spine is None:
        r = stg.agg(F.min("report_date").alias("a"), F.max("report_date").alias("b")).first()
        spine = (str(r.a), str(r.b))
    for name, frame in (("dim_facility", gold.dim_facility(stg, spine[1])), ("dim_condition", gold.dim_condition(stg))):
        lake.write(frame, "gold", name)
    lake.write(gold.fact_daily(stg, lake.read(spark, "gold", "dim_facility"), lake.read(spark, "gold", "dim_condition"), spine), "gold", "fct_case_daily")
    fact = lake.read(spark, "gold", "fct_case_daily")
    lake.write(gold.daily_rollup(fact), "gold", "agg_condition_daily_state")
    marts = [lake.read(spark, "gold", t) for t in ("dim_facility", "dim_condition")] + [fact, lake.read(spark, "gold", "agg_condition_daily_state")]
    broken = {r.check: r.violations for r in quality.mart_checks(lake.read(spark, "silver", "ecr_cases"), stg, *marts, spine).collect() if r.violations}
    return {"fact_rows": fact.count(), "spine": spine, "failed_checks": broken}


def features_stage(spark: SparkSession, lake: Lake) -> dict:
    windows = spark.read.parquet(lake.uri("landing", "_outbreaks"))
    lake.write(features.build_features(lake.read(spark, "gold", "fct_case_daily"), features.label_days(windows)), "feature", "outbreak_features")
    contract = features.contract(lake.read(spark, "feature", "outbreak_features").count())
    landing.write_sidecar(spark, contract, lake.uri("feature", "outbreak_features_contract.json"))
    return contract


CAVEAT = "The outbreak labels come from the generator: these figures show that the pipeline works, not how well outbreaks would be found."


def train_stage(spark: SparkSession, lake: Lake, test_days: int = 75, alerts_per_week: float = 8.0, iterations: int = 300, repeats: int = 5) -> dict:
    """Fits on the days before the test part, sets the threshold there, evaluates on the rest, registers the model and
    writes the report. ``repeats``: of the permutation importance; 0 leaves it out."""
    train, test = features.temporal_split(lake.read(spark, "feature", "outbreak_features"), test_days)
    model = signals.train(train, iterations)
    label = F.col(features.LABEL_COLUMN).alias("label")
    threshold = metrics.alert_threshold(stored(signals.score(model, train).select("report_date", F.col("signal_score").alias("score")), "train-scores"), alerts_per_week).first().threshold
    scored = stored(signals.score(model, test).select("*", label), "test-scores")
    alerts = metrics.confusion(scored.withColumn("alert", (F.col("signal_score") >= threshold).cast("int"))).first().asDict()
    ranked = metrics.ranking_metrics(scored, "signal_score").first().asDict() | metrics.brier(scored, "signal_score").first().asDict()
    rules = {f"z>={z:g}": metrics.confusion(metrics.rule_alerts(scored, z)).first().asDict() for z in (2.0, 3.0)}
    importance = {r.feature: r.importance for r in signals.permutation_importance(model, test, repeats=repeats).collect()} if repeats else {}
    version = signals.Registry(spark, lake.uri("ml", "models"), "outbreak").register(model)
    positives = scored.where("label = 1").count()
    report = {
        "threshold": threshold, "version": version, "model": alerts | ranked, "rule_baselines": rules, "test_positives": positives,
        "permutation_importance": importance, "caveat": CAVEAT,
    }
    landing.write_sidecar(spark, report, lake.uri("ml", "train_report.json"))
    return report


def score_stage(spark: SparkSession, lake: Lake, threshold: float | None = None, window_days: int = 14) -> DataFrame:
    """Scores the last days. Without a threshold that of the training report holds; without a report there is none to score by."""
    if threshold is None:
        threshold = landing.read_sidecar(spark, lake.uri("ml", "train_report.json"))["threshold"]
    model, version = signals.Registry(spark, lake.uri("ml", "models"), "outbreak").latest()
    recent = features.recent(lake.read(spark, "feature", "outbreak_features"), window_days)
    lake.write(signals.signal_table(signals.score(model, recent), threshold, str(version)), "gold", "fct_outbreak_signal")
    return lake.read(spark, "gold", "fct_outbreak_signal")


def index_stage(spark: SparkSession, lake: Lake, corpus: DataFrame) -> dict:
    """Builds the retrieval index of a corpus (id, title, text)."""
    index = retrieval.Bm25Index.build(corpus, lake.uri("ml", "guidance_index"))
    return {"documents": index.n, "average_length": index.avg_len}


STAGES = {"generate": generate_stage, "bronze": bronze_stage, "silver": silver_stage, "gold": gold_stage, "features": features_stage, "train": train_stage}


def nightly(spark: SparkSession, lake: Lake, threshold: float | None = None) -> dict:
    """bronze, silver, gold, features, and scoring with the newest model; training only where there is none yet.

    Stops after gold where a check of the marts fails."""
    done = {}
    for name in ("bronze", "silver", "gold", "features"):
        done[name] = STAGES[name](spark, lake)
        if name == "gold" and done[name]["failed_checks"]:
            raise ValueError(f"checks failed: {done[name]['failed_checks']}")
    if not signals.Registry(spark, lake.uri("ml", "models"), "outbreak").versions():
        done["train"] = train_stage(spark, lake)
    signals_table = score_stage(spark, lake, threshold)
    return done | {"signals": signals_table.where("is_signal = 1").count()}


def weekly(spark: SparkSession, lake: Lake, **how) -> dict:
    """Trains anew on the features of the last nightly run and registers the next version."""
    return train_stage(spark, lake, **how)
