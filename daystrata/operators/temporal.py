"""Lags, rolling means and latest rows of the daily relation.

Frames count rows, not days: with gaps in the calendar "next day" is the next row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from daystrata.functions import dates as D
from daystrata.functions.categories import half_up
from daystrata.functions.text import fixed, relative_day_label
from daystrata.operators.series import split_windows


def lag_columns(window: WindowSpec) -> dict[str, Column]:
    return {
        "next_day_stress": F.lead("avg_stress", 1).over(window),
        "next_day_resting_hr": F.lead("resting_hr", 1).over(window),
        "prev_day_sleep": F.lag("sleep_hours", 1).over(window),
        "prev_day_steps": F.lag("steps", 1).over(window),
    }


def rolling_columns(window: WindowSpec) -> dict[str, Column]:
    """Means over the row and the six rows before it; short frames at the start count as they are."""
    week = window.rowsBetween(-6, 0)
    # Source column, result column, digits.
    spec = (
        ("avg_stress", "stress_7d_avg", 1),
        ("resting_hr", "resting_hr_7d_avg", 0),
        ("sleep_hours", "sleep_7d_avg", 1),
        ("net_battery", "net_battery_7d_avg", 1),
    )
    return {name: half_up(F.avg(source).over(week), digits) for source, name, digits in spec}


def change_columns(window: WindowSpec) -> dict[str, Column]:
    return {
        "stress_wow_change": F.col("avg_stress") - F.lag("avg_stress", 7).over(window),
        "resting_hr_wow_change": F.col("resting_hr") - F.lag("resting_hr", 7).over(window),
    }


def _windowed(df, columns, keys, split, before, after):
    """Plain window, or the split form when a series may exceed what one task should hold.

    The daily relation has one row per key and day (the merge enforces it), so a plain window holds
    at most the days of the calendar per key.
    """
    if split:
        return split_windows(df, columns, [F.col("date")], buckets=[F.trunc("date", "YEAR")], before=before, after=after,
                             keys=keys, chunk=split)
    return df.withColumns(columns(Window.partitionBy(*keys).orderBy("date")))


def dashboard_correlations(daily: DataFrame, *, keys: Sequence[str] = (), split: int | None = None) -> DataFrame:
    """Days with stress, next and previous values; the filter runs before the windows."""
    stressed = daily.filter(F.col("avg_stress").isNotNull())
    base = stressed.select(
        *keys, "date", "avg_stress", "resting_hr", "sleep_hours", "deep_sleep_hours",
        F.col("charged").alias("body_battery_charged"), "net_battery", "steps", "avg_overnight_hrv",
    )
    return _windowed(base, lag_columns, keys, split, 1, 1)


def dashboard_trends(daily: DataFrame, *, keys: Sequence[str] = (), split: int | None = None) -> DataFrame:
    """Rolling means and change against seven rows earlier; one sort serves all columns."""
    base = daily.select(*keys, "date", "avg_stress", "resting_hr", "sleep_hours", "net_battery", "steps")
    return _windowed(base, lambda w: {**rolling_columns(w), **change_columns(w)}, keys, split, 7, 0)


def last_n_rows(df: DataFrame, n: int, *, keys: Sequence[str] = ()) -> DataFrame:
    """Last n rows by date per key.  Spark keeps n rows per key and task before the shuffle."""
    if not keys:
        return df.orderBy(F.desc("date")).limit(n)
    newest = Window.partitionBy(*keys).orderBy(F.desc("date"))
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def latest_complete_row(daily: DataFrame, *, keys: Sequence[str] = (), required: str = "avg_stress") -> DataFrame:
    """Newest row that has the required value: a max-by aggregate, no sort."""
    rest = [c for c in daily.columns if c not in keys]
    newest = daily.filter(F.col(required).isNotNull()).groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col("date")).alias("_row")
    )
    return newest.select(*keys, "_row.*") if keys else newest.filter("_row is not null").select("_row.*")


def recent_means(daily: DataFrame, n: int = 7, *, keys: Sequence[str] = ()) -> DataFrame:
    """Means over the last n rows; a column the relation lacks takes its default."""
    # Result, source column, value when the column does not exist.
    spec = (
        ("stress", "avg_stress", 50.0),
        ("sleep_hours", "sleep_hours", 7.0),
        ("net_battery", "net_battery", 0.0),
        ("resting_hr", "resting_hr", 60.0),
    )
    window = last_n_rows(daily, n, keys=keys)
    means = [(F.avg(src) if src in daily.columns else F.lit(default)).alias(name) for name, src, default in spec]
    used = F.count("avg_stress") if "avg_stress" in daily.columns else F.lit(0).cast("bigint")
    return window.groupBy(*keys).agg(*means, used.alias("days_used"))


def kpi_vs_mean(daily: DataFrame, column: str = "avg_stress", *, keys: Sequence[str] = ()) -> DataFrame:
    """Latest value, mean of the range, and their difference in one aggregate."""
    present = F.col(column).isNotNull()
    agg = daily.groupBy(*keys).agg(
        F.max_by(column, F.when(present, F.col("date"))).alias("latest"), F.avg(column).alias("mean")
    )
    return agg.withColumn("delta", F.col("latest") - F.col("mean"))


def kpi_cards(daily: DataFrame, *, as_of, keys: Sequence[str] = ()) -> DataFrame:
    """(heading, kpi, value text, note) rows of the latest day with a stress value, beside the mean of all days.

    A key without such a day gets cards without data and no heading.
    """
    rest = [c for c in daily.columns if c not in keys]
    complete = F.when(F.col("avg_stress").isNotNull(), F.col("date"))
    newest = daily.groupBy(*keys).agg(F.max_by(F.struct(*rest), complete).alias("_row"), F.avg("avg_stress").alias("_mean"))
    latest = newest.select(*keys, "_row.*", "_mean")

    def card(name: str, column: str, digits: int, unit: str, missing: str, note: Column | None = None, **style):
        value = F.col(column)
        shown = F.coalesce(F.concat(fixed(value, digits, **style), F.lit(unit)), F.lit(missing))
        note = F.when(value.isNotNull(), note) if note is not None else F.lit(None).cast("string")
        return F.struct(F.lit(name).alias("kpi"), shown.alias("value"), note.alias("note"))

    age = D.days_ago(F.col("date"), F.lit(as_of).cast("date"))
    heading = F.concat(D.long_date(F.col("date")), F.lit(" ("), relative_day_label(age), F.lit(")"))
    flow = F.when(F.col("net_battery") > 0, F.lit("Recovery")).otherwise(F.lit("Drain"))
    cards = F.array(
        card("Avg Stress", "avg_stress", 0, "", "N/A", F.concat(fixed(F.col("avg_stress") - F.col("_mean"), 1), F.lit(" vs avg"))),
        card("Resting HR", "resting_hr", 0, " bpm", "N/A"),
        card("Sleep", "sleep_hours", 1, " hrs", "N/A"),
        card("Net Battery", "net_battery", 0, "", "N/A", flow),
        card("Steps", "steps", 0, "", "No data", thousands=True),
    )
    return latest.select(*keys, heading.alias("heading"), F.inline(cards))
