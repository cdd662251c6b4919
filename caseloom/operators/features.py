"""Features for outbreak detection: lags and prior means that never see their own day, and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The feature contract.
FEATURE_COLUMNS = [
    "case_count", "cases_trailing_7d", "baseline_mean_28d", "baseline_sd_28d", "baseline_z", "ratio_to_baseline", "lag_1_cases",
    "lag_7_cases", "delta_1_cases", "prior_mean_cases", "day_of_week", "is_weekend", "is_enteric", "is_respiratory",
]
KEY_COLUMNS = ["report_date", "facility_id", "condition_code"]
LABEL_COLUMN = "is_outbreak_day"
MIN_PRIOR_DAYS = 7


def contract(rows: int, source: str = "fct_case_daily") -> dict:
    return {"feature_columns": FEATURE_COLUMNS, "key_columns": KEY_COLUMNS, "label_column": LABEL_COLUMN, "source_table": source, "row_count": rows}


def label_days(windows: DataFrame) -> DataFrame:
    """Outbreak windows (facility_id, condition_name, start_date, end_date) as days, each once even where windows overlap."""
    return (
        windows.where("start_date <= end_date")
        .select(F.explode(F.sequence(F.col("start_date").cast("date"), F.col("end_date").cast("date"))).alias("report_date"), "facility_id", "condition_name")
        .distinct()
        .withColumn(LABEL_COLUMN, F.lit(1))
    )


def multiplier_at(days: DataFrame, windows: DataFrame, default: float = 1.0) -> DataFrame:
    """The multiplier of the first window (by start) a day lies in: an equi-join on exploded days, no range join."""
    covered = (
        windows.where("start_date <= end_date")
        .select("facility_id", "condition_name", F.explode(F.sequence(F.col("start_date").cast("date"), F.col("end_date").cast("date"))).alias("report_date"), "start_date", "multiplier")
        .groupBy("facility_id", "condition_name", "report_date")
        .agg(F.min(F.struct("start_date", "multiplier")).alias("w"))
        .select("facility_id", "condition_name", "report_date", F.col("w.multiplier").alias("multiplier"))
    )
    return days.join(covered, ["facility_id", "condition_name", "report_date"], "left").fillna(default, ["multiplier"])


def build_features(fact: DataFrame, labels: DataFrame) -> DataFrame:
    """The fact with 9 derived features and the label; missing lags are NULL, not zero. ``is_weekend`` becomes 0 or 1."""
    series = Window.partitionBy("facility_id", "condition_code").orderBy("report_date")
    prior = series.rowsBetween(Window.unboundedPreceding, -1)
    day = F.weekday("report_date")
    made = fact.withColumns({
        "lag_1_cases": F.lag("case_count", 1).over(series), "lag_7_cases": F.lag("case_count", 7).over(series),
        "prior_mean_cases": F.when(F.count("case_count").over(prior) >= MIN_PRIOR_DAYS, F.avg("case_count").over(prior)),
    }).withColumns({
        "delta_1_cases": F.col("case_count") - F.col("lag_1_cases"),
        "ratio_to_baseline": F.col("case_count") / (F.coalesce("baseline_mean_28d", F.lit(0.0)) + 0.5),
        "day_of_week": day, "is_weekend": (day >= 5).cast("int"),
        "is_enteric": F.coalesce(F.col("condition_group") == "enteric", F.lit(False)).cast("int"),
        "is_respiratory": F.coalesce(F.col("condition_group") == "respiratory", F.lit(False)).cast("int"),
    })
    days = labels.select("report_date", "facility_id", "condition_name", LABEL_COLUMN)
    return made.join(days, ["report_date", "facility_id", "condition_name"], "left").fillna(0, [LABEL_COLUMN])


def latest_day(df: DataFrame, day: str = "report_date"):
    """The last day as a value: one small job, and a literal that can be pushed into a scan."""
    return df.agg(F.max(F.col(day).cast("date"))).first()[0]


def temporal_split(df: DataFrame, test_days: int, day: str = "report_date") -> tuple[DataFrame, DataFrame]:
    """(train, test): the test part is the last ``test_days`` days."""
    last = latest_day(df, day)
    cut = F.date_sub(F.lit(last), test_days)
    return df.where(F.col(day) <= cut), df.where(F.col(day) > cut)


def recent(df: DataFrame, days: int, day: str = "report_date") -> DataFrame:
    return temporal_split(df, days, day)[1]
