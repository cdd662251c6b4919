"""Ranking and alert metrics. Rows are first combined by score, then ordered by ranges, so that no
task ever holds the whole ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseloom.session import stored


def alert_budget(days: int, scored: int, alerts_per_week: float) -> int:
    """Alerts in so many days, rounded half to even, at least 1 and less than the number of scores."""
    return min(max(round(alerts_per_week * max(days / 7.0, 1.0)), 1), max(scored - 1, 1))


def alert_threshold(df: DataFrame, alerts_per_week: float, score: str = "score", day: str = "report_date") -> DataFrame:
    """budget, threshold: the budget-th largest score. Only the budget is sorted (top-k), not the table."""
    n = df.agg(F.count(score).alias("n"), F.countDistinct(day).alias("d")).first()
    k = alert_budget(n.d, n.n, alerts_per_week)
    top = df.where(F.col(score).isNotNull()).select(F.col(score).alias("s")).orderBy(F.desc("s")).limit(k)
    return top.agg(F.lit(k).cast("bigint").alias("budget"), F.min("s").alias("threshold"))


def rule_alerts(df: DataFrame, least_z: float, z: str = "baseline_z") -> DataFrame:
    """Adds ``alert``: 1 where z reaches the threshold; an unknown z does not."""
    return df.withColumn("alert", F.coalesce(F.col(z) >= least_z, F.lit(False)).cast("int"))


def confusion(df: DataFrame, predicted: str = "alert", label: str = "label", day: str = "report_date") -> DataFrame:
    """precision, recall, F1 (0 where undefined), alerts and alerts per week."""
    p, y = F.col(predicted) == 1, F.col(label) == 1
    a = df.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn"), F.countDistinct(day).alias("days"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda n, d: F.coalesce(F.try_divide(n, d), F.lit(0.0))
    return a.select(
        "tp", "fp", "fn", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fp).alias("alerts"), ((tp + fp) / F.greatest(F.col("days") / 7.0, F.lit(1.0))).alias("alerts_per_week"),
    )


def _ranking(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, best first: pos, all, and both summed up to and with it.

    Scores are range-partitioned; running sums within a range are shifted by the totals of the ranges
    before it (one row per range)."""
    by_score = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("n"))
    ranged = stored(by_score.repartitionByRange(F.desc("s")).withColumn("part", F.spark_partition_id()), "ranking")
    totals = ranged.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("n").alias("c"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("part", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))
    running = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumns({"cp": F.sum("pos").over(running), "cn": F.sum("n").over(running)})
        .join(shift, "part")
        .select("s", "pos", "n", (F.col("cp") + F.col("p0")).alias("cum_pos"), (F.col("cn") + F.col("c0")).alias("cum_n"))
    )


def ranking_metrics(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """average_precision (stepwise) and roc_auc (ties count half); NULL where there is no positive or negative."""
    r = _ranking(df, score, label)
    total = r.agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
    pos, neg = total.pos or 0, (total.n or 0) - (total.pos or 0)
    higher = F.col("cum_pos") - F.col("pos")
    return r.agg(
        (F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")) / F.lit(float(pos) if pos else None)).alias("average_precision"),
        (F.sum((F.col("n") - F.col("pos")) * (higher + F.col("pos") / 2)) / F.lit(float(pos) * neg if pos and neg else None)).alias("roc_auc"),
    )


def brier(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("brier"))
