"""Merging the five daily relations into one wide relation per key and day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from daystrata import schemas as S
from daystrata.functions import categories as C
from daystrata.operators.daily import parsed_documents
from daystrata.sources.raw import date_column, metric_column

# Numeric columns of each side.  The two labels (steps_quality, stress_category) follow from them and
# are added after the aggregation, which keeps its buffers fixed-size and the aggregate hash-based.
SIDE_COLUMNS = {
    "steps": ("steps_raw",),
    "body_battery": S.BODY_BATTERY_COLUMNS,
    "heart_rate": S.HEART_RATE_COLUMNS,
    "stress": ("avg_stress", "max_stress"),
    "sleep": ("sleep_hours", "deep_sleep_hours", "rem_sleep_hours", "sleep_body_battery_change", "avg_overnight_hrv"),
}
DUPLICATE = "more than one document for one key, day and metric; merge with form='lists'"


def _wide(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("has_steps_data", F.col("steps").isNotNull()).select(*keys, "date", *S.DAILY_COLUMNS)


def _chained(sides: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    columns = {**SIDE_COLUMNS, "steps": ("steps", "data_quality"), "stress": S.STRESS_COLUMNS}
    trimmed = [sides[side].select(*keys, "date", *names) for side, names in columns.items()]
    merged = reduce(lambda left, right: left.join(right, [*keys, "date"], "full"), trimmed)
    return _wide(merged.withColumnRenamed("data_quality", "steps_quality"), keys)


def _grouped(rows: DataFrame, keys: Sequence[str], steps_parts: bool) -> DataFrame:
    """Rows tagged with ``_side`` to one row per key, date and ``_undated``, in one hash aggregate.

    A side has at most one row per group (steps may come in parts), so its maximum is its value.
    NULL days never match each other in a join; ``_undated`` keeps rows without date apart.  A second
    row of a side stops the query.
    """
    is_side = {side: F.col("_side") == side for side in SIDE_COLUMNS}
    total = F.sum("steps_raw") if steps_parts else F.max("steps_raw")
    seen = {side: F.count_if(present).alias(f"_{side}") for side, present in is_side.items()}
    if steps_parts:
        # An empty steps document contributes no interval and therefore no day.
        seen["steps"] = F.coalesce(F.sum("intervals"), F.lit(0)).alias("_steps")
    values = [F.max(c).alias(c) for side, columns in SIDE_COLUMNS.items() if side != "steps" for c in columns]
    merged = rows.groupBy(*keys, "date", "_undated").agg(total.alias("_total"), *seen.values(), *values)
    single = [F.col(f"_{side}") for side in SIDE_COLUMNS if not (steps_parts and side == "steps")]
    any_row = F.greatest(*[F.col(f"_{side}") for side in SIDE_COLUMNS]) > 0
    checked = F.when(F.greatest(*single) > 1, F.raise_error(F.lit(DUPLICATE)).cast("boolean")).otherwise(any_row)
    labelled = merged.filter(checked).withColumns({
        "steps": C.zero_to_null(F.col("_total")),
        "steps_quality": F.when(F.col("_steps") > 0, C.steps_quality(F.col("_total"))),
        "stress_category": F.when(F.col("_stress") > 0, C.stress_category(F.col("avg_stress"))),
    })
    return _wide(labelled, keys)


def _listed(sides: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of a side gathered into a list per key and date, then every list unfolded against the others.

    All joins of the chain have the same keys, so its result is the product of the lists, with one empty row
    for a side without any.  A list holds the documents of one key, day and metric, no more than the result has.
    """
    columns = {**SIDE_COLUMNS, "steps": ("steps", "data_quality"), "stress": S.STRESS_COLUMNS}
    tagged = [sides[side].select(*keys, "date", F.struct(*names).alias(f"_{side}")) for side, names in columns.items()]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    united = united.withColumn("_undated", F.when(F.col("date").isNull(), F.monotonically_increasing_id()))
    rows = united.groupBy(*keys, "date", "_undated").agg(*[F.collect_list(f"_{side}").alias(f"_{side}") for side in columns])
    for side in columns:
        rows = rows.withColumn(f"_{side}", F.explode_outer(f"_{side}"))
    return _wide(rows.select(*keys, "date", *[f"_{side}.*" for side in columns]).withColumnRenamed("data_quality", "steps_quality"), keys)


def merge_daily(sides: dict[str, DataFrame], *, keys: Sequence[str] = (), form: str = "grouped") -> DataFrame:
    """FULL OUTER merge of the five daily relations on keys and date.

    ``grouped``: tag, union, one group-by: a single exchange with partial aggregation.  Exact while
    each side has one row per key and day, which is checked behind the aggregation.
    ``lists``: duplicates multiply as in a join; still one exchange, of all rows.
    ``chain``: four full outer joins; duplicates multiply.  Undated rows stay unmatched in every form.
    """
    if form == "lists":
        return _listed(sides, keys)
    if form == "chain":
        return _chained(sides, keys)
    if form != "grouped":
        raise ValueError(f"unknown form {form!r}")
    tagged = [sides[side].select(*keys, "date", F.lit(side).alias("_side"), *columns) for side, columns in SIDE_COLUMNS.items()]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    alone = F.when(F.col("date").isNull(), F.monotonically_increasing_id())
    return _grouped(united.withColumn("_undated", alone), keys, steps_parts=False)


def _listed_documents(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As :func:`_grouped` over parsed documents, but the documents of a side are gathered into a list per group and
    unfolded against the other sides' lists behind the aggregation, so repeated ones multiply as in a join."""
    sides = {side: columns for side, columns in SIDE_COLUMNS.items() if side != "steps"}
    grouped = rows.groupBy(*keys, "date", "_undated").agg(
        F.sum("steps_raw").alias("_total"), F.coalesce(F.sum("intervals"), F.lit(0)).alias("_steps"),
        *[F.collect_list(F.when(F.col("_side") == side, F.struct(*columns))).alias(f"_{side}") for side, columns in sides.items()],
    )
    merged = grouped.filter(F.greatest("_steps", *[F.size(f"_{side}").cast("bigint") for side in sides]) > 0)
    for side in sides:
        merged = merged.withColumn(f"_{side}", F.explode_outer(f"_{side}"))
    labelled = merged.select(*keys, "date", "_total", "_steps", "_stress", *[f"_{side}.{c}" for side, columns in sides.items() for c in columns]).withColumns({
        "steps": C.zero_to_null(F.col("_total")),
        "steps_quality": F.when(F.col("_steps") > 0, C.steps_quality(F.col("_total"))),
        "stress_category": F.when(F.col("_stress").isNotNull(), C.stress_category(F.col("avg_stress"))),
    })
    return _wide(labelled, keys)


def daily_metrics(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False, form: str = "grouped") -> DataFrame:
    """Raw documents straight to the wide daily relation: one scan, one parse per document, one exchange.

    Several steps documents of one day add up.  For the other metrics a second document of the same key and day
    raises with ``grouped``, whose buffers have a fixed size, and multiplies as in a join with ``lists``.
    """
    if form not in ("grouped", "lists"):
        raise ValueError(f"unknown form {form!r}")
    rows = parsed_documents(raw, keys=keys, strict=strict).withColumnRenamed("metric", "_side")
    # The file name tells undated documents apart; undated steps of one key add up.  Unlike a row id it
    # is deterministic, so filters on key and date still reach the scan.
    rows = rows.withColumn("_undated", F.when(F.col("_side") != "steps", F.col("undated")))
    return _listed_documents(rows, keys) if form == "lists" else _grouped(rows, keys, steps_parts=True)


def duplicate_documents(raw: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Key, day and metric that have more than one document (steps excepted): reads names only."""
    named = raw.select(
        *keys, date_column(raw).alias("date"), metric_column(raw).alias("metric")
    )
    grouped = named.filter(F.col("date").isNotNull() & (F.col("metric") != "steps")).groupBy(*keys, "date", "metric")
    return grouped.agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > 1)
