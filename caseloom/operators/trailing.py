"""Problem 5: rolling totals over trailing periods.

Each daily total is exploded onto every output date it influences and summed by entity and date; the sums
meet the entity's calendar rows, so silent days come out with zeros. No window function. Rows are combined to
one a day on the map side first, so an entity with a third of all rows is no larger than the calendar; only these
daily totals are moved to their entity, and what is exploded from them stays where it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The surveillance period.
CALENDAR = ("2025-11-03", "2026-06-30")


def influence(
    totals: DataFrame,
    entity: list[str],
    day: str,
    value: str,
    windows: dict[str, tuple[int, int]],
    last_day: Column,
) -> DataFrame:
    """Sums of ``value`` per entity and output date. ``windows``: name -> (first, last) days back.

    Only totals that are not zero are exploded: the others add nothing to any sum. An entity that has no other keeps one
    row without a date.
    """
    furthest = max(last for _, last in windows.values())
    counts = F.col(value).isNotNull() & (F.col(value) != 0) & F.col(day).isNotNull()
    spread = (
        totals.select(*entity, F.col(value), F.explode_outer(F.when(counts, F.sequence(F.lit(0), F.lit(furthest)))).alias("_back"), F.col(day).alias("_day"))
        .withColumn(day, F.when(F.col("_back").isNotNull(), F.date_add("_day", F.col("_back"))))
        .where(F.col(day).isNull() | (F.col(day) <= last_day))
    )
    return spread.groupBy(*entity, day).agg(
        *[F.sum(F.when(F.col("_back").between(a, b), F.col(value)).otherwise(0)).alias(name) for name, (a, b) in windows.items()]
    )


def entity_figures(facts: DataFrame, entity: tuple[str, ...], day: str, value: str, calendar: tuple[str, str], total_days: int, mean_days: int) -> DataFrame:
    """entity and ``_figures``: date -> own value, total and sum of the days before, no larger than the calendar."""
    keys = list(entity)
    first, last = (F.lit(d).cast("date") for d in calendar)
    date = F.col(day).cast("date")
    daily = (
        facts.select(*keys, F.when(date.between(first, last), date).alias(day), F.col(value).alias("_value"))
        .groupBy(*keys, day)
        .agg(F.coalesce(F.max("_value"), F.lit(0)).alias("_value"))
        .repartition(*keys)  # a row a day: what follows is grouped by entity without moving it again
    )
    sums = influence(daily, keys, day, "_value", {"_own": (0, 0), "_total": (0, total_days - 1), "_prior": (1, mean_days)}, last)
    figures = F.struct(F.col(day), F.struct("_own", "_total", "_prior"))
    return sums.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.when(F.col(day).isNotNull(), figures))).alias("_figures"))


def _of_day(day: str, value: str, first: Column, mean_days: int) -> list[Column]:
    """value, total and prior_mean of a day, by the entity's ``_figures``."""
    found = F.col("_figures")[F.col(day)]
    zero = lambda c: F.coalesce(found[c], F.lit(0)).cast("bigint")
    days = F.least(F.datediff(day, first), F.lit(mean_days))
    return [zero("_own").alias(value), zero("_total").alias("total"), F.when(days > 0, zero("_prior") / days).alias("prior_mean")]


def trailing_figures(
    facts: DataFrame,
    entity: tuple[str, ...] = ("facility_id", "condition_code"),
    day: str = "report_date",
    value: str = "case_count",
    calendar: tuple[str, str] = CALENDAR,
    total_days: int = 7,
    mean_days: int = 28,
) -> DataFrame:
    """entity, day, value, total (the day and the ones before) and prior mean for every calendar day.

    Defined results: repeated rows count once (of unequal rows for one entity and day the largest
    value); a NULL value and a silent day are 0; days outside the calendar do not exist; the mean is
    over the days there are, NULL on the first; NULL entities are entities; an empty table gives none.
    """
    first, last = (F.lit(d).cast("date") for d in calendar)
    each = entity_figures(facts, entity, day, value, calendar, total_days, mean_days)
    rows = each.select(*entity, "_figures", F.explode(F.sequence(first, last)).alias(day))
    return rows.select(*entity, day, *_of_day(day, value, first, mean_days))


def wrong_figures(facts: DataFrame, tolerance: float = 1e-6, calendar: tuple[str, str] = CALENDAR, total_days: int = 7, mean_days: int = 28) -> DataFrame:
    """case_daily_sk and measure of recorded figures that differ from the right ones. Rows beyond the calendar have no right figures: only NULL agrees."""
    first, last = (F.lit(d).cast("date") for d in calendar)
    right = entity_figures(facts, ("facility_id", "condition_code"), "report_date", "case_count", calendar, total_days, mean_days).select(
        F.col("facility_id").alias("_f"), F.col("condition_code").alias("_c"), "_figures"
    )
    rows = facts.select(
        "case_daily_sk", "facility_id", "condition_code", F.col("report_date").cast("date").alias("report_date"), "cases_trailing_7d", "baseline_mean_28d"
    ).distinct()  # repeated rows are combined before the join, so a row that makes up much of the table is one
    same = F.col("facility_id").eqNullSafe(F.col("_f")) & F.col("condition_code").eqNullSafe(F.col("_c"))
    within = F.col("report_date").between(first, last)
    _, total, mean = _of_day("report_date", "_own_value", first, mean_days)
    both = rows.join(right, same, "left").select(
        "case_daily_sk", "cases_trailing_7d", "baseline_mean_28d", F.when(within, total).alias("total"), F.when(within, mean).alias("prior_mean")
    )
    differs = lambda a, b: (F.col(a).isNull() != F.col(b).isNull()) | F.coalesce(F.abs(F.col(a) - F.col(b)) > tolerance, F.lit(False))
    pairs = F.array_compact(
        F.array(
            F.when(differs("cases_trailing_7d", "total"), F.lit("cases_trailing_7d")),
            F.when(differs("baseline_mean_28d", "prior_mean"), F.lit("baseline_mean_28d")),
        )
    )
    return both.select("case_daily_sk", F.explode(pairs).alias("measure")).distinct()
