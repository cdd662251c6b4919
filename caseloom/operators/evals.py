"""Evaluation of extraction and retrieval, and the gates a release has to pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Metric -> (least or most, value).
GATES = {
    "symptom_f1": ("least", 0.90), "onset_exact": ("least", 0.95), "schema_failure_rate": ("most", 0.02),
    "citation_accuracy": ("least", 0.80), "refusal_accuracy": ("least", 1.00),
}


def extraction_eval(df: DataFrame) -> DataFrame:
    """One row of metrics. df: got_symptoms, want_symptoms (canonical arrays), got_/want_ onset, exposure, travel, failed.

    Micro precision, recall and F1 over set fields; exact rates leave failed cases out; the failure rate
    is over all cases, 1 without any.
    """
    ok = ~F.col("failed")
    size = lambda e: F.coalesce(F.sum(F.when(ok, F.size(e))), F.lit(0))
    rate = lambda c: F.round(F.coalesce(F.try_divide(F.sum(F.when(ok, F.coalesce(c, F.lit(False)).cast("int"))), F.count_if(ok)), F.lit(0.0)), 4)
    a = df.agg(
        F.count("*").alias("n_cases"), F.count_if(~ok).alias("failures"),
        size(F.array_intersect("got_symptoms", "want_symptoms")).alias("tp"), size(F.array_except("got_symptoms", "want_symptoms")).alias("fp"),
        size(F.array_except("want_symptoms", "got_symptoms")).alias("fn"),
        rate(F.col("got_onset").eqNullSafe(F.col("want_onset"))).alias("onset_exact"),
        rate(F.coalesce("got_exposure", F.lit("")) == F.lower("want_exposure")).alias("exposure_exact"),
        rate(F.col("got_travel").eqNullSafe(F.col("want_travel"))).alias("travel_accuracy"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda n, d: F.round(F.coalesce(F.try_divide(n, d), F.lit(0.0)), 4)
    return a.select(
        "n_cases", F.coalesce(F.try_divide("failures", "n_cases"), F.lit(1.0)).alias("schema_failure_rate"), ratio(tp, tp + fp).alias("symptom_precision"),
        ratio(tp, tp + fn).alias("symptom_recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("symptom_f1"), "onset_exact", "exposure_exact", "travel_accuracy",
    )


def worst_cases(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first n cases with a wrong field, by key."""
    return (
        df.where(~F.col("failed"))
        .select(
            key, F.array_sort(F.array_except("want_symptoms", "got_symptoms")).alias("missing"), F.array_sort(F.array_except("got_symptoms", "want_symptoms")).alias("spurious"),
            F.col("got_onset").eqNullSafe(F.col("want_onset")).alias("onset_ok"), (F.coalesce("got_exposure", F.lit("")) == F.lower("want_exposure")).alias("exposure_ok"),
        )
        .where("size(missing) > 0 or size(spurious) > 0 or not onset_ok or not exposure_ok")
        .orderBy(key)
        .limit(n)
    )


def retrieval_eval(answers: DataFrame, expected: DataFrame) -> DataFrame:
    """citation_accuracy over answerable questions, refusal_accuracy over the others. expected: query_id, expect_doc, answerable."""
    both = expected.join(answers, "query_id", "left")
    cited = F.coalesce(F.array_contains("citations", F.col("expect_doc")), F.lit(False)).cast("int")
    refused = F.coalesce(F.col("answer") == "INSUFFICIENT_CONTEXT", F.lit(False)).cast("int")
    return both.agg(
        F.count("*").alias("n_cases"),
        F.round(F.avg(F.when(F.col("answerable"), cited)), 4).alias("citation_accuracy"),
        F.round(F.avg(F.when(~F.col("answerable"), refused)), 4).alias("refusal_accuracy"),
    )


def gate_breaches(metrics: dict[str, float], gates: dict = GATES) -> list[str]:
    """Names of the gates that metrics miss; a missing metric is a breach."""
    out = []
    for name, (kind, bound) in gates.items():
        v = metrics.get(name)
        if v is None or (v < bound if kind == "least" else v > bound):
            out.append(name)
    return out


def gate_table(metrics: DataFrame, gates: dict = GATES) -> DataFrame:
    """gate, value, bound, breached for a one-row frame of metrics; a gate without its metric has no value and is breached."""
    value = {n: F.col(n).cast("double") if n in metrics.columns else F.lit(None).cast("double") for n in gates}
    rows = F.array(*[
        F.struct(F.lit(n).alias("gate"), value[n].alias("value"), F.lit(b).cast("double").alias("bound"),
                 F.coalesce((value[n] < b) if kind == "least" else (value[n] > b), F.lit(True)).alias("breached"))
        for n, (kind, b) in gates.items()
    ])
    return metrics.select(F.inline(rows))


def run_suites(golden: DataFrame, corpus: DataFrame, questions: DataFrame) -> dict[str, float]:
    """All metrics of the offline backends. golden: message_control_id, note, expected; questions: query_id, question, expect_doc, answerable."""
    from caseloom.operators import extract, retrieval

    want = extract.map_symptoms(golden.select("message_control_id", "note", "expected", F.col("expected.symptoms").alias("symptoms")), "message_control_id")
    want = want.withColumnRenamed("symptoms_mapped", "want_symptoms").drop("symptoms", "unmapped_terms")
    got = extract.map_symptoms(extract.rule_extract(want), "message_control_id").select(
        "message_control_id", "want_symptoms", F.col("symptoms_mapped").alias("got_symptoms"), F.col("onset_date").alias("got_onset"), F.col("expected.onset_date").alias("want_onset"),
        F.col("exposure_setting").alias("got_exposure"), F.col("expected.exposure_setting").alias("want_exposure"), F.col("recent_travel").alias("got_travel"),
        F.col("expected.recent_travel").alias("want_travel"), (~extract.grounded(F.col("onset_date").try_cast("date"), F.col("note"))).alias("failed"),
    )
    facts = extraction_eval(got).first().asDict()
    found = retrieval_eval(retrieval.answer_questions(corpus, questions.select("query_id", "question")), questions).first().asDict()
    return facts | {k: v for k, v in found.items() if k != "n_cases"}
