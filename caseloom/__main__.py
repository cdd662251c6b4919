"""``python -m caseloom STAGE --lake PATH``: one stage of the pipeline, ``nightly`` or ``weekly`` for a scheduled run, ``index`` to build the
retrieval index, ``evals`` (exit 1 if a gate is missed), ``extract`` for the facts of silver's notes, or ``ask``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from caseloom.operators import evals, extract, generate, retrieval
from caseloom.plans import pipeline
from caseloom.plans.corpus import CORPUS, QUESTIONS
from caseloom.session import Settings, get_spark, path_exists
from caseloom.sources.landing import Lake
from caseloom.sources.remote import RemoteSearch


def ask(spark, lake, settings, corpus, asked, build_index=False):
    """Answers with what the settings' backend finds: a remote search, the lake's index where there is one, else the corpus itself."""
    if settings.search_backend == "remote":
        return retrieval.answer_questions(corpus, asked, hits=retrieval.remote_hits(asked, RemoteSearch(settings.search_url)))
    where = lake and lake.uri("ml", "guidance_index")
    if where and (build_index or path_exists(spark, f"{where}/_corpus.json")):
        index = retrieval.Bm25Index.build(corpus, where) if build_index else retrieval.Bm25Index(spark, where)
        return retrieval.answer_questions(index.corpus(), asked, hits=index.search(asked))
    return retrieval.answer_questions(corpus, asked)


def main() -> None:
    p = argparse.ArgumentParser(prog="caseloom", description=__doc__)
    p.add_argument("stage", choices=[*pipeline.STAGES, "score", "nightly", "weekly", "index", "extract", "evals", "ask"])
    p.add_argument("question", nargs="?", help="for ask")
    p.add_argument("--build-index", action="store_true", help="for ask: build the index first")
    p.add_argument("--lake", help="base address of the lake; CASELOOM_BASE otherwise")
    p.add_argument("--format", help="table format; CASELOOM_TABLE_FORMAT otherwise")
    p.add_argument("--days", type=int, default=240)
    p.add_argument("--facilities", type=int, default=12)
    p.add_argument("--end", default="2026-06-30")
    p.add_argument("--dup-rate", type=float, default=0.04)
    p.add_argument("--corrupt-rate", type=float, default=0.025)
    p.add_argument("--test-days", type=int, default=75)
    p.add_argument("--alerts-per-week", type=float, default=8.0)
    p.add_argument("--iterations", type=int, default=300)
    p.add_argument("--threshold", type=float)
    p.add_argument("--window-days", type=int, default=14)
    a = p.parse_args()
    settings = Settings.from_env()
    if a.stage not in ("evals", "ask") and not (a.lake or settings.base):
        p.error("give --lake or set CASELOOM_BASE: an address that all executors share")
    spark, lake = get_spark(), Lake(a.lake or settings.base, a.format or settings.table_format)
    corpus = lambda: spark.createDataFrame(CORPUS, "id string, title string, text string")
    if a.stage == "generate":
        out = pipeline.generate_stage(spark, lake, a.days, a.facilities, a.end, a.dup_rate, a.corrupt_rate)
    elif a.stage == "train":
        out = pipeline.train_stage(spark, lake, a.test_days, a.alerts_per_week, a.iterations)
    elif a.stage == "weekly":
        out = pipeline.weekly(spark, lake, test_days=a.test_days, alerts_per_week=a.alerts_per_week, iterations=a.iterations)
    elif a.stage == "index":
        out = pipeline.index_stage(spark, lake, corpus())
    elif a.stage == "extract":
        notes = lake.read(spark, "silver", "ecr_cases").select("message_control_id", F.col("clinical_note").alias("note")).where("note is not null")
        lake.write(extract.extract_all(notes, "message_control_id", settings), "gold", "case_facts")
        out = {"facts": lake.read(spark, "gold", "case_facts").count()}
    elif a.stage == "score":
        out = {"signals": pipeline.score_stage(spark, lake, a.threshold, a.window_days).where("is_signal = 1").count()}
    elif a.stage == "evals":
        questions = spark.createDataFrame(QUESTIONS, "query_id string, question string, expect_doc string, answerable boolean")
        out = evals.run_suites(generate.golden_sample(spark, a.days, a.facilities, a.end), corpus(), questions)
        out["breaches"] = evals.gate_breaches(out)
    elif a.stage == "ask":
        asked = spark.createDataFrame([("q", a.question or "")], "query_id string, question string")
        out = ask(spark, lake if a.lake or settings.base else None, settings, corpus(), asked, a.build_index).first().asDict()
    elif a.stage == "nightly":
        out = pipeline.nightly(spark, lake, a.threshold)
    else:
        out = pipeline.STAGES[a.stage](spark, lake)
    print(json.dumps(out, default=str))
    sys.exit(bool(a.stage == "evals" and out["breaches"]))


if __name__ == "__main__":
    main()
