"""Surrogate keys, bands and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_MARK = "_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the columns' text, a mark for NULL, joined by two pipes."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws("||", *parts))


def age_years(born: Column, on: Column) -> Column:
    """Whole years of age."""
    return F.floor(F.months_between(on, born) / 12).cast("bigint")


def age_band(age: Column, unknown: str | None = None) -> Column:
    """0-4, 5-17, 18-49, 50-64, 65+. NULL falls to the last band unless ``unknown`` names one."""
    band = F.when(age < 5, "0-4").when(age < 18, "5-17").when(age < 50, "18-49").when(age < 65, "50-64")
    return (band.when(age.isNull(), unknown) if unknown else band).otherwise("65+")


def date_spine(spark: SparkSession, start: str, end: str, name: str = "date_day") -> DataFrame:
    """Every day from start to end, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name))


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
