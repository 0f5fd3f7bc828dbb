"""Profiles, correlations, histograms, scores and exact medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from daystrata.functions import categories as C


def mean_std(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """(column, mean, sample standard deviation) of the listed columns that exist."""
    present = [c for c in columns if c in df.columns]
    row = df.groupBy(*keys).agg(
        F.array(*[
            F.struct(F.lit(c).alias("column"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")) for c in present
        ]).alias("_rows")
    )
    return row.select(*keys, F.inline("_rows"))


def missing_profile(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Per column: type, NULL count and share, non-NULL count; one aggregate turned into rows."""
    types = dict(df.dtypes)
    whole = F.count(F.lit(1))
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            C.percent(F.count_if(F.col(c).isNull()), whole).alias("missing_pct"),
            F.count(c).alias("non_null"),
        )
        for c in df.columns if c not in keys
    ]
    return df.groupBy(*keys).agg(F.array(*rows).alias("_rows")).select(*keys, F.inline("_rows"))


def sparse_profile(df: DataFrame, limit: float = 50.0) -> DataFrame:
    """Columns whose share of NULL is above the limit, worst first."""
    profile = missing_profile(df).withColumn("_ratio", F.col("missing") / (F.col("missing") + F.col("non_null")))
    return profile.filter(F.col("_ratio") * 100 > limit).drop("_ratio").orderBy(F.desc("missing"), "column")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant side, where ``corr`` would raise."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def pearson_corr(df: DataFrame, features: Sequence[str], target: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of each feature with the target and its reading."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), correlation(F.col(f), F.col(target)).alias("corr")) for f in features])
    rows = df.groupBy(*keys).agg(pairs.alias("_rows")).select(*keys, F.inline("_rows"))
    return rows.withColumn("direction", C.direction(F.col("corr")))


def ols_trend(df: DataFrame, pairs: Sequence[tuple[str, str]], *, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of y on x for each (x, y); rows with a NULL in the pair do not count."""
    lines = F.array(*[
        F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), F.regr_count(F.col(y), F.col(x)).alias("n"),
            F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        )
        for x, y in pairs
    ])
    return df.groupBy(*keys).agg(lines.alias("_rows")).select(*keys, F.inline("_rows"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal bins between minimum and maximum, empty bins included, last bin closed.

    The range comes in as a scalar subquery; the bins are aggregated per task before the shuffle.
    """
    value = F.col(column).cast("double")
    bounds = df.select(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b"))
    ranged = df.filter(value.isNotNull()).select(value.alias("v"), bounds.scalar().alias("b"))
    width = (F.col("b.high") - F.col("b.low")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.try_divide(F.col("v") - F.col("b.low"), width)), F.lit(bins - 1))
    )
    counted = ranged.select(index.cast("int").alias("bin"), "b").groupBy("bin").agg(
        F.count(F.lit(1)).alias("days"), F.first("b").alias("b")
    )
    # At most one entry per bin meets in the last task, where empty bins are filled in.
    whole = counted.agg(F.map_from_entries(F.collect_list(F.struct("bin", "days"))).alias("m"), F.first("b").alias("b"))
    filled = whole.filter("b is not null").select("m", "b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return filled.select(
        "bin", (F.col("b.low") + F.col("bin") * width).alias("low"), (F.col("b.low") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("bigint").alias("days"),
    )


def positive_rate(df: DataFrame, label: str, *, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(label).cast("bigint").alias("positives"), F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(label).cast("double")).alias("rate"),
    )


def regression_metrics(df: DataFrame, prediction: str, label: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """r2, RMSE and MAE in one pass."""
    p, y = F.col(prediction).cast("double"), F.col(label).cast("double")
    agg = df.groupBy(*keys).agg(
        F.count(y).alias("_n"), F.sum(F.pow(y - p, 2)).alias("_sse"), F.sum(F.abs(y - p)).alias("_sae"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
    )
    return agg.select(
        *keys, (F.lit(1.0) - F.try_divide("_sse", "_sst")).alias("r2"),
        F.sqrt(F.try_divide("_sse", "_n")).alias("rmse"), F.try_divide("_sae", "_n").alias("mae"),
    )


def accuracy(df: DataFrame, prediction: str, label: str, *, keys: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    return df.groupBy(*keys).agg(F.avg(hit).alias("accuracy"))


def cumulative_ratio(df: DataFrame, value: str, order: str, *, keys: Sequence[str] = ()) -> DataFrame:
    """Share of the total and running share, in order.  Meant for short lists (components, bins)."""
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    total = F.sum(value).over(whole)
    return df.withColumns({
        "ratio": F.try_divide(F.col(value), total), "cumulative": F.try_divide(F.sum(value).over(running), total)
    })


def max_in_group(df: DataFrame, column: str, *, keys: Sequence[str] = (), name: str = "group_max") -> DataFrame:
    """Group maximum on every row: aggregate, then join back, so no group has to sit in one task."""
    if not keys:
        return df.withColumn(name, df.select(F.max(column)).scalar())
    top = df.groupBy(*keys).agg(F.max(column).alias(name))
    return df.join(top, list(keys), "left")


def exact_medians(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (), bins: int = 1024,
                  accuracy: int = 10000) -> DataFrame:
    """Exact interpolated median per column as (keys, column, median); NULL and NaN do not count.

    Two passes: a quantile sketch brackets the middle, then one aggregation counts what lies below the bracket and
    the distinct values inside it, by ``bins`` slices.  The counts of the slices locate the middle ranks, and only the
    values of one slice are sorted.  The bracket is twice as wide as the error bound of the sketch, so it always
    holds the middle.
    """
    group = [*keys, "column"]
    typed = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    values = typed.unpivot(list(keys), list(columns), "column", "value").filter(F.col("value").isNotNull())
    around = F.array(F.lit(0.5 - 2 / accuracy), F.lit(0.5 + 2 / accuracy))
    bracket = values.groupBy(*group).agg(
        F.percentile_approx("value", around, accuracy).alias("_ends"), F.count(F.lit(1)).alias("_total")
    ).select(*group, F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high"), "_total")
    inner = F.floor((F.col("value") - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0)) * bins)
    slot = (
        F.when(F.col("value") < F.col("_low"), F.lit(-1))
        .otherwise(F.least(F.coalesce(inner, F.lit(0)), F.lit(bins - 1)))
    )
    binned = _join_group(values, bracket, group, small=not keys).filter(F.col("value") <= F.col("_high")).select(*group, "value", "_total", slot.alias("_bin"))
    # One shuffle, read twice: for the sizes of the slices, and for the values of one slice.
    counted = binned.groupBy(*group, "_bin", "_total", F.when(F.col("_bin") >= 0, F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy(*group, "_bin", "_total").agg(F.sum("n").alias("_size"))
    running = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    low, high = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    holding = (
        sizes.withColumn("_start", F.sum("_size").over(running) - F.col("_size"))
        .filter((F.col("_start") <= high) & (F.col("_start") + F.col("_size") > low))
        .select(*group, "_bin", "_start")
    )
    inside = _join_group(counted, holding, [*group, "_bin"], small=not keys)
    ordered = Window.partitionBy(*group, "_bin").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_end", F.col("_start") + F.sum("n").over(ordered))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_end") - F.col("n")) & (rank < F.col("_end")), F.col("value")))

    return ranked.groupBy(*group).agg(((at(low) + at(high)) / 2).alias("median"))


def _join_group(left: DataFrame, right: DataFrame, columns: Sequence[str], small: bool) -> DataFrame:
    """Inner join that matches NULL keys.  ``small``: the right side has a few rows per column of the
    relation and nothing else, so it is broadcast; otherwise Spark decides from measured sizes."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in columns else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(F.broadcast(renamed) if small else renamed, condition)
    return joined.drop(*[f"_r_{c}" for c in columns])
