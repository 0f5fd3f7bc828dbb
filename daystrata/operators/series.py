"""Positions and row-frame windows over series too long for one task.

``Window.partitionBy(keys)`` hands a whole series to one task.  For a daily relation that is bounded
by the calendar (a century is 36,525 rows per key).  For series with many rows per key, or no key at
all, the functions here split the work: rows are numbered inside small buckets of the sort order,
bucket sizes are summed up, and windows run over fixed-size chunks of positions that carry the few
neighbour rows a frame needs.  Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[f"_r_{name}"])
    return condition


def _before(size: str, along: WindowSpec) -> Column:
    return F.sum(size).over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)


def with_position(df: DataFrame, order: Sequence[Column], *, buckets: Sequence[Column], keys: Sequence[str] = (),
                  position: str = "position", total: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in its series.

    ``buckets`` are expressions that do not decrease along ``order`` (the month of a date, then
    ``id div 100000``): they fix how many rows one task has to sort.  The first one should have a
    bounded number of values, as days have: its totals are summed up in one task per series, the other
    buckets within their first one.  ``total`` names an optional column for the series length.
    """
    names = [f"_bucket{i}" for i in range(len(buckets))]
    tagged = df.withColumns(dict(zip(names, buckets)))
    group = [*keys, *names]
    sizes = tagged.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    # Prefix sums at two levels: over the first bucket of the whole series, then inside each first bucket.
    outer = [*keys, names[0]]
    firsts = sizes.groupBy(*outer).agg(F.sum("_size").alias("_sum"))
    firsts = firsts.select(
        *[F.col(c).alias(f"_r_{c}") for c in outer],
        _before("_sum", Window.partitionBy(*keys).orderBy(names[0])).alias("_outer"),
        *([F.sum("_sum").over(Window.partitionBy(*keys)).alias(total)] if total else []),
    )
    if len(names) > 1:
        inner = sizes.withColumn("_inner", _before("_size", Window.partitionBy(*outer).orderBy(*names[1:])))
        firsts = inner.join(firsts, _same(inner, firsts, outer), "inner")
        offsets = firsts.select(
            *[F.col(c).alias(f"_r_{c}") for c in group], (F.col("_outer") + F.col("_inner")).alias("_offset"), *([total] if total else []))
    else:
        offsets = firsts.withColumnRenamed("_outer", "_offset")
    local = Window.partitionBy(*group).orderBy(*order)
    numbered = tagged.withColumn("_local", F.row_number().over(local))
    joined = numbered.join(offsets, _same(numbered, offsets, group), "inner")
    placed = joined.withColumn(position, F.col("_offset") + F.col("_local") - 1)
    return placed.select(*df.columns, position, *([total] if total else []))


def split_windows(df: DataFrame, columns: Callable[[WindowSpec], dict[str, Column]], order: Sequence[Column], *,
                  buckets: Sequence[Column], before: int, after: int, keys: Sequence[str] = (),
                  chunk: int = 4096) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back and ``after`` rows ahead.

    Rows near a chunk border are copied to the neighbour chunk, so every frame is complete; the
    copies are dropped afterwards.  The largest task holds ``chunk + before + after`` rows.
    """
    if max(before, after) > chunk:
        raise ValueError("chunk must be at least as long as the frame")
    placed = with_position(df, order, buckets=buckets, keys=keys, position="_position")
    home = F.expr(f"_position div {int(chunk)}")
    inside = F.pmod(F.col("_position"), F.lit(chunk))
    targets = F.array_compact(F.array(
        home,
        F.when(inside >= chunk - before, home + 1),
        F.when((inside < after) & (home > 0), home - 1),
    ))
    spread = placed.withColumns({"_home": home, "_chunk": F.explode(targets)})
    window = Window.partitionBy(*keys, "_chunk").orderBy("_position")
    framed = spread.withColumns(columns(window))
    return framed.filter(F.col("_chunk") == F.col("_home")).drop("_home", "_chunk", "_position")


def nth_partition_split(df: DataFrame, order: Sequence[Column], *, buckets: Sequence[Column], keys: Sequence[str] = (),
                        parts: int = 3, name: str = "fold") -> DataFrame:
    """Contiguous parts of nearly equal length; the first parts take the remainder."""
    placed = with_position(df, order, buckets=buckets, keys=keys, position="_position", total="_total")
    small = F.floor(F.col("_total") / parts)
    extra = F.pmod(F.col("_total"), F.lit(parts))
    long_rows = extra * (small + 1)
    part = F.when(F.col("_position") < long_rows, F.floor(F.col("_position") / (small + 1))).otherwise(
        extra + F.floor(F.try_divide(F.col("_position") - long_rows, small))
    )
    return placed.withColumn(name, part.cast("int")).drop("_position", "_total")
