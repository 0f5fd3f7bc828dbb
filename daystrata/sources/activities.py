"""Activity documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daystrata.schemas import ACTIVITY


def scan_activities(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Nested activity documents; ``multiline=False`` for one document per line (splittable)."""
    return spark.read.schema(ACTIVITY).json(path, multiLine=multiline)


def scan_activity_variants(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(activity): each document as one VARIANT, which keeps an absent key apart from a null one.  Of a file that is a
    list every element is a document."""
    read = spark.read.option("singleVariantColumn", "document").json(path, multiLine=multiline)
    elements = F.coalesce(F.try_variant_get("document", "$", "array<variant>"), F.array("document"))
    return read.select(F.explode(elements).alias("activity"))


def given(default: str, *paths: str) -> Column:
    """Text at the first of the paths that a document has, null where it is null there; the default where it has none."""
    chain = F
    for path in paths:
        chain = chain.when(F.try_variant_get("activity", path, "variant").isNotNull(), F.try_variant_get("activity", path, "string"))
    return chain.otherwise(F.lit(default))


def activity_headers(activities: DataFrame) -> DataFrame:
    """Id, name, type and start of documents from :func:`scan_activity_variants`.

    List and detail documents differ in where type and start are kept; both are accepted.  A default stands only for
    an absent key; an explicit null stays null.
    """
    return activities.select(
        F.try_variant_get("activity", "$.activityId", "bigint").alias("activity_id"),
        given("Unnamed", "$.activityName").alias("activity_name"),
        given("unknown", "$.activityType.typeKey", "$.activityTypeDTO.typeKey").alias("activity_type"),
        given("unknown", "$.startTimeLocal", "$.summaryDTO.startTimeLocal").alias("start_time"),
    )


def latest_activities(headers: DataFrame, n: int = 100) -> DataFrame:
    """The n most recent activities; a top-n per task, merged once.

    Starts are compared as times, as the two kinds of documents write them differently; a start that isn't a
    time ranks last.
    """
    start = F.replace(F.substring("start_time", 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    return headers.orderBy(F.desc_nulls_last(start), F.desc("activity_id")).limit(n)
