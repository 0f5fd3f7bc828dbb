"""Parsing: raw documents to the five daily relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daystrata.functions import categories as C
from daystrata.functions.documents import json_array
from daystrata import schemas as S
from daystrata.schemas import ARRAY_DOCUMENT, OBJECT_DOCUMENT
from daystrata.sources.raw import date_column, metric_column, scan_metric

_ELEMENT = ARRAY_DOCUMENT[len("array<"):-1]


def unnest_intervals(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """One row per interval of the steps documents; empty or missing arrays give no row."""
    documents = scan_metric(raw, "steps").select(
        *keys, date_column(raw).alias("date"),
        F.explode(json_array(F.col("raw_json"), _ELEMENT)).alias("interval"),
    )
    return documents.select(
        *keys, "date",
        C.to_number(F.col("interval.steps"), strict=strict).alias("steps"),
        F.col("interval.primaryActivityLevel").alias("activity_level"),
    )


def steps_relation(totals: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Flags on top of (steps_raw, max_activity_level)."""
    return totals.select(
        *keys, "date", C.zero_to_null(F.col("steps_raw")).alias("steps"), "steps_raw", "max_activity_level",
        C.steps_quality(F.col("steps_raw")).alias("data_quality"),
    )


def steps_daily(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Daily step total; the level is the largest **text**, so ``sedentary`` beats ``active``."""
    totals = unnest_intervals(raw, keys=keys, strict=strict).groupBy(*keys, "date").agg(
        F.sum("steps").alias("steps_raw"), F.max("activity_level").alias("max_activity_level")
    )
    return steps_relation(totals, keys=keys)


def _body_battery(first: Column, strict: bool) -> list[Column]:
    charged, drained = (C.to_number(first.getField(x), strict=strict) for x in ("charged", "drained"))
    return [charged.alias("charged"), drained.alias("drained"), (charged - drained).alias("net_battery")]


def _heart_rate(doc: Column, strict: bool) -> list[Column]:
    # Field names of the documents.
    fields = {
        "resting_hr": "restingHeartRate",
        "max_hr": "maxHeartRate",
        "min_hr": "minHeartRate",
        "avg_resting_hr_7d": "lastSevenDaysAvgRestingHeartRate",
    }
    return [C.to_number(doc.getField(path), strict=strict).alias(name) for name, path in fields.items()]


def _stress(doc: Column, strict: bool) -> list[Column]:
    level = C.to_number(doc.getField("avgStressLevel"), strict=strict)
    peak = C.to_number(doc.getField("maxStressLevel"), strict=strict)
    return [level.alias("avg_stress"), peak.alias("max_stress"), C.stress_category(level).alias("stress_category")]


def _sleep(doc: Column, strict: bool) -> list[Column]:
    # Field names of the documents.
    phases = {
        "sleep_hours": "sleepTimeSeconds",
        "deep_sleep_hours": "deepSleepSeconds",
        "light_sleep_hours": "lightSleepSeconds",
        "rem_sleep_hours": "remSleepSeconds",
        "awake_hours": "awakeSleepSeconds",
    }
    night = doc.getField("dailySleepDTO")
    hours = [
        C.seconds_to_hours(C.to_number(night.getField(path), strict=strict)).alias(name)
        for name, path in phases.items()
    ]
    return hours + [
        C.to_number(doc.getField("bodyBatteryChange"), strict=strict).alias("sleep_body_battery_change"),
        C.to_number(doc.getField("restingHeartRate"), strict=strict).alias("sleep_resting_hr"),
        C.to_number(doc.getField("avgOvernightHrv"), "double", strict=strict).alias("avg_overnight_hrv"),
    ]


def _typed(raw: DataFrame, metric: str, parsed: Column, columns, keys, strict: bool) -> DataFrame:
    """Parse each document once, then project from the parsed value."""
    documents = scan_metric(raw, metric).select(*keys, date_column(raw).alias("date"), parsed.alias("_doc"))
    return documents.select(*keys, "date", *columns(F.col("_doc"), strict))


def body_battery_daily(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """First element of the document's array; an empty array gives a row of NULLs."""
    return _typed(raw, "body_battery", F.get(json_array(F.col("raw_json"), _ELEMENT), 0), _body_battery, keys, strict)


def heart_rate_daily(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    return _typed(raw, "heart_rate", F.from_json("raw_json", OBJECT_DOCUMENT), _heart_rate, keys, strict)


def stress_daily(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    return _typed(raw, "stress", F.from_json("raw_json", OBJECT_DOCUMENT), _stress, keys, strict)


def sleep_daily(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    return _typed(raw, "sleep", F.from_json("raw_json", OBJECT_DOCUMENT), _sleep, keys, strict)


def parsed_documents(raw: DataFrame, *, keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """All five metrics in one pass: one typed row per document, columns of other metrics NULL;
    ``undated`` is the file name of a document without date.

    Every document goes through exactly one JSON parse, chosen by its metric; the step array is folded
    inside its row, so no interval rows are shuffled.
    """
    text = F.col("raw_json")
    documents = raw.select(
        *keys, metric_column(raw).alias("metric"), date_column(raw).alias("date"), "filename", "raw_json"
    ).filter(F.col("metric").isNotNull())
    in_array = F.col("metric").isin("steps", "body_battery")
    parsed = documents.select(
        *keys, "date", "metric", F.when(F.col("date").isNull(), F.col("filename")).alias("undated"),
        F.when(in_array, json_array(text, _ELEMENT)).alias("_array"),
        F.when(~in_array, F.from_json(text, OBJECT_DOCUMENT)).alias("_object"),
    )

    def add(total: Column, item: Column) -> Column:
        value = C.to_number(item.getField("steps"), strict=strict)
        return F.coalesce(total + value, total, value)

    def only(metric_name: str, columns: list[Column], names: list[str]) -> list[Column]:
        return [F.when(F.col("metric") == metric_name, c).alias(n) for c, n in zip(columns, names)]

    array, obj = F.col("_array"), F.col("_object")
    folded = F.aggregate(array, F.lit(None).cast("bigint"), add)
    level = F.array_max(F.transform(array, lambda item: item.getField("primaryActivityLevel")))
    columns: list[Column] = only("steps", [F.size(array).cast("bigint"), folded, level],
                                 ["intervals", "steps_raw", "max_activity_level"])
    for metric_name, builder, doc in (
        ("body_battery", _body_battery, F.get(array, 0)), ("heart_rate", _heart_rate, obj),
        ("stress", _stress, obj), ("sleep", _sleep, obj),
    ):
        built = builder(doc, strict)
        columns += only(metric_name, built, _names(metric_name))
    return parsed.select(*keys, "date", "metric", "undated", *columns)


def _names(metric: str) -> list[str]:
    return list({
        "body_battery": S.BODY_BATTERY_COLUMNS, "heart_rate": S.HEART_RATE_COLUMNS,
        "stress": S.STRESS_COLUMNS, "sleep": S.SLEEP_COLUMNS,
    }[metric])
