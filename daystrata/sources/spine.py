"""Expected documents, and which of them are still missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata.functions.dates import date_of_name, date_series
from daystrata.schemas import METRICS
from daystrata.sources.raw import metric_of_name


def expected_documents(start: date, end: date, *, owners: DataFrame | None = None, spark: SparkSession | None = None,
                       metrics: Sequence[str] = METRICS) -> DataFrame:
    """Every owner x day x metric from start to end.

    Days and metrics are exploded from literal arrays, so nothing is joined or shuffled.
    ``owners`` has one row per series; without it there is a single series.
    """
    base = owners if owners is not None else spark.range(1).select()
    days = base.withColumn("date", F.explode(date_series(F.lit(start), F.lit(end))))
    spine = days.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
    return spine.withColumn("filename", F.concat_ws("", "metric", F.lit("_"), F.col("date").cast("string"), F.lit(".json")))


def missing_documents(expected: DataFrame, landed: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Expected documents that have not landed yet."""
    have = landed.select(
        *keys, metric_of_name(F.col("filename")).alias("metric"), date_of_name(F.col("filename")).alias("date")
    )
    return expected.join(have, [*keys, "metric", "date"], "left_anti")
