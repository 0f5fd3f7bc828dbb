"""Projections and roll-ups of the wide daily relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daystrata.functions import categories as C, dates as D


def count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def mean(column: str, digits: int, name: str, where: Column | None = None) -> Column:
    value = F.col(column) if where is None else F.when(where, F.col(column))
    return C.half_up(F.avg(value), digits).alias(name)


def share(condition: Column, name: str, digits: int = 1) -> Column:
    return C.percent(F.count_if(condition), F.count(F.lit(1)), digits).alias(name)


def dashboard_daily(daily: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Daily relation with labels and categories; one projection."""
    day = F.col("date")
    hours = [C.half_up(F.col(c), 1).alias(c) for c in ("sleep_hours", "deep_sleep_hours", "rem_sleep_hours")]
    return daily.select(
        *keys, "date", D.month_label(day).alias("month"), D.weekday_name(day).alias("day_of_week"),
        D.weekday_number(day).alias("day_num"), "avg_stress", "max_stress", "stress_category",
        C.stress_level_number(F.col("avg_stress")).alias("stress_level_num"), "charged", "drained", "net_battery",
        C.recovery_status(F.col("net_battery")).alias("recovery_status"), "resting_hr", "avg_resting_hr_7d", *hours,
        "sleep_body_battery_change", "avg_overnight_hrv", "steps", "has_steps_data",
        C.activity_level(F.col("steps")).alias("activity_level"),
    )


def data_quality_summary(daily: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    has = F.col("has_steps_data")
    return daily.groupBy(*keys, D.month_label(F.col("date")).alias("month")).agg(
        F.count(F.lit(1)).alias("total_days"),
        count_if(has, "days_with_steps"),
        count_if(~has, "days_without_steps"),
        share(has, "steps_coverage_pct"),
        mean("steps", 0, "avg_steps_when_available", where=has),
        mean("avg_stress", 1, "avg_stress"),
    )


def dashboard_weekly(daily: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Weekly roll-up on (start, label); see ``week_label`` for the week around New Year."""
    day = F.col("date")
    return daily.groupBy(*keys, D.week_start(day).alias("week_start"), D.week_label(day).alias("week_label")).agg(
        F.count(F.lit(1)).alias("days_in_week"),
        mean("avg_stress", 1, "avg_stress"),
        F.max("max_stress").alias("max_stress"),
        count_if(F.col("avg_stress") > C.HIGH_STRESS, "high_stress_days"),
        mean("charged", 1, "avg_charged"),
        mean("drained", 1, "avg_drained"),
        mean("net_battery", 1, "avg_net_battery"),
        mean("resting_hr", 0, "avg_resting_hr"),
        mean("sleep_hours", 1, "avg_sleep_hours"),
        mean("deep_sleep_hours", 1, "avg_deep_sleep"),
        mean("steps", 0, "avg_steps"),
        count_if(F.col("steps").isNotNull(), "days_with_steps"),
    )


def dashboard_monthly(daily: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    day, high, stepped = F.col("date"), F.col("avg_stress") > C.HIGH_STRESS, F.col("steps").isNotNull()
    months = daily.groupBy(*keys, D.month_start(day).alias("month_start"))
    rolled = months.agg(
        F.count(F.lit(1)).alias("days_in_month"),
        mean("avg_stress", 1, "avg_stress"),
        C.half_up(F.stddev_samp("avg_stress"), 1).alias("stress_stddev"),
        F.max("max_stress").alias("max_stress_peak"),
        count_if(high, "high_stress_days"),
        share(high, "high_stress_pct"),
        mean("charged", 1, "avg_charged"),
        mean("net_battery", 1, "avg_net_battery"),
        mean("resting_hr", 0, "avg_resting_hr"),
        F.min("resting_hr").alias("min_resting_hr"),
        F.max("resting_hr").alias("max_resting_hr"),
        mean("sleep_hours", 1, "avg_sleep_hours"),
        mean("deep_sleep_hours", 1, "avg_deep_sleep"),
        count_if(F.col("sleep_hours") < C.SHORT_NIGHT_HOURS, "poor_sleep_days"),
        mean("steps", 0, "avg_steps"),
        count_if(stepped, "days_with_steps"),
        share(stepped, "steps_coverage_pct"),
    )
    # Both labels follow from the first day, so they are added after the shuffle.
    start = F.col("month_start")
    labelled = rolled.withColumns({"month_label": D.month_label(start), "month_name": D.month_name(start)})
    front = [*keys, "month_start", "month_label", "month_name"]
    return labelled.select(*front, *[c for c in rolled.columns if c not in front])


def category_distribution(df: DataFrame, column: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per value, NULL left out."""
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("days"))


def table_extent(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
