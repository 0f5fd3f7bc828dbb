"""Column choice, cleaning, scaling and splits ahead of the models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from daystrata.operators.series import with_position
from daystrata.operators.stats import exact_medians

# Analysis columns, and the names they get there.
ANALYSIS_COLUMNS = (
    "charged", "drained", "net_battery", "resting_hr", "avg_resting_hr_7d", "avg_stress", "max_stress",
    "sleep_hours", "deep_sleep_hours", "rem_sleep_hours", "sleep_body_battery_change", "avg_overnight_hrv",
)
ANALYSIS_NAMES = {
    "avg_stress": "avgStressLevel",
    "max_stress": "maxStressLevel",
    "resting_hr": "restingHeartRate",
    "sleep_body_battery_change": "bodyBatteryChange",
}


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted columns that exist, in the order asked for."""
    return [c for c in wanted if c in df.columns]


def numeric_columns(df: DataFrame, *, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def date_range_filter(df: DataFrame, start: date | None = None, end: date | None = None, column: str = "date") -> DataFrame:
    """Closed range; without both ends nothing is filtered."""
    if start is None or end is None:
        return df
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def dropna_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def min_rows_guard(df: DataFrame, more_than: int = 20, *, keys: Sequence[str] = ()) -> DataFrame:
    """Keep the series that have more rows than the limit."""
    if not keys:
        # Counting past the limit is enough.
        rows = df.limit(more_than + 1).select(F.count(F.lit(1)))
        return df.filter(rows.scalar() > more_than)
    enough = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > more_than)
    return df.join(enough.drop("_n"), list(keys), "left_semi")


def scatter_projection(df: DataFrame, wanted: Sequence[str], target: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """(feature, x, target) rows for each wanted feature that exists."""
    present = existing_columns(df, wanted)
    typed = df.select(*keys, target, *[F.col(c).cast("double").alias(c) for c in present if c != target])
    return typed.unpivot([*keys, target], [c for c in present if c != target], "feature", "x")


def sparse_columns(df: DataFrame, limit: float = 0.5) -> list[str]:
    """Columns with more than ``limit`` NULL.  Reads one aggregated row, as the schema depends on it."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).head()
    return [c for c in df.columns if row["_n"] and row[c] > limit * row["_n"]]


def drop_sparse_columns(df: DataFrame, limit: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, limit))


def median_fill(df: DataFrame, columns: Sequence[str] | None = None, *, keys: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Fill NULL in numeric columns with the column median; the target is filled like the rest.

    ``exact=False`` uses the quantile sketch.
    """
    names = list(columns) if columns is not None else numeric_columns(df, exclude=keys)
    if not names:
        return df
    if exact:
        long = exact_medians(df, names, keys=keys)
        wide = long.groupBy(*keys).agg(
            F.struct(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in names]).alias("_median")
        )
    else:
        wide = df.groupBy(*keys).agg(
            F.struct(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(c) for c in names]).alias("_median")
        )
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median.{c}")) for c in names}
    if keys:
        return df.join(wide, list(keys), "left").withColumns(filled).select(df.columns)
    return df.withColumn("_median", wide.scalar()).withColumns(filled).select(df.columns)


def analysis_frame(daily: DataFrame, *, keys: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Features, steps and flag; renamed; sparse columns dropped; medians filled in."""
    chosen = daily.select(*keys, "date", *existing_columns(daily, ANALYSIS_COLUMNS), "steps", "has_steps_data")
    dense = drop_sparse_columns(rename(chosen, ANALYSIS_NAMES))
    return median_fill(dense, numeric_columns(dense, exclude=keys), exact=exact)


def standardize(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0.

    ``fit_on`` supplies the rows the statistics come from (the training part).
    """
    source = fit_on if fit_on is not None else df
    both = F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ])
    fitted = source.groupBy(*keys).agg(both.alias("_fit"))
    joined = df.join(fitted, list(keys), "left") if keys else df.withColumn("_fit", fitted.scalar())
    scaled = {
        c: F.when(F.col(c).isNotNull(), F.coalesce(
            (F.col(c) - F.col(f"_fit.{c}.mean")) / F.nullif(F.col(f"_fit.{c}.std"), F.lit(0.0)), F.lit(0.0)))
        for c in columns
    }
    return joined.withColumns(scaled).drop("_fit")


def test_rows(total: Column, share: float = 0.2) -> Column:
    """Size of the test part: the share rounded up.  Rounding first keeps 0.2 * 10 from becoming 3."""
    return F.ceil(F.round(total * F.lit(share), 9))


def chronological_split(df: DataFrame, *, keys: Sequence[str] = (), ties: Sequence[str] = (), share: float = 0.2,
                        tie_width: int = 4096) -> DataFrame:
    """Mark the last ``share`` of the rows by date as ``test``, the others as ``train``.

    ``ties`` are integer columns that order rows of the same day.  Positions come from day and tie
    buckets, so neither the table nor a busy day has to pass through one task.
    """
    order = [F.col("date"), *[F.col(c) for c in ties]]
    buckets = [F.col("date"), *[F.floor(F.col(c) / tie_width) for c in ties[:1]]]
    placed = with_position(df, order, buckets=buckets, keys=keys, position="_position", total="_total")
    is_test = F.col("_position") >= F.col("_total") - test_rows(F.col("_total"), share)
    return placed.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop("_position", "_total")


def stratified_split(df: DataFrame, label: str, identity: Sequence[str], *, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Per label, the rows with the smallest hash are ``train``; exact counts, stable under reordering.

    A label may hold most of the table, so positions are taken within hash ranges.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *identity))
    order = [F.col("_hash"), *[F.col(c) for c in identity]]
    placed = with_position(hashed, order, buckets=[F.shiftright("_hash", 50)], keys=[label], position="_position", total="_total")
    is_train = F.col("_position") < F.col("_total") - test_rows(F.col("_total"), share)
    return placed.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test"))).drop("_position", "_total", "_hash")
