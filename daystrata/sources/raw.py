"""Raw document table: two columns, ``filename`` and ``raw_json``, plus optional key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from daystrata.functions.dates import date_of_name
from daystrata.functions.documents import canonical_json, is_json
from daystrata.schemas import METRICS, RAW_COLUMNS, RAW_DOCUMENT


def metric_of_name(name: Column) -> Column:
    """Metric from the file name prefix; in LIKE the underscore stands for any one character."""
    found = F
    for metric in METRICS:
        found = found.when(name.like(f"{metric}_%"), F.lit(metric))
    return found.otherwise(F.lit(None).cast("string"))


def metric_column(raw: DataFrame) -> Column:
    """Metric of a document: the landed column where there is one, so that filters reach the scan."""
    return F.col("metric") if "metric" in raw.columns else metric_of_name(F.col("filename"))


def date_column(raw: DataFrame) -> Column:
    """Day of a document, likewise."""
    return F.col("date") if "date" in raw.columns else date_of_name(F.col("filename"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    # ``wholetext`` packs many small files into one task.  Sub-folders are not visited.
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json")
    return files.select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("raw_json"))


def scan_raw_documents(spark: SparkSession, folder: str, counted: Observation | None = None) -> DataFrame:
    """One row per ``*.json`` file directly in the folder; a file that isn't JSON is dropped, one that repeats a key is not.

    ``counted`` observes ``files`` and ``rejected`` while the scan runs; :func:`rejected_documents` lists the latter.
    """
    files = _files(spark, folder)
    if counted is not None:
        files = files.observe(counted, F.count(F.lit(1)).alias("files"), F.count_if(~is_json(F.col("raw_json"))).alias("rejected"))
    return files.filter(is_json(F.col("raw_json")))


def rejected_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, size, reason): the ``*.json`` files that :func:`scan_raw_documents` drops; Spark lists no file of length 0."""
    empty = F.trim("raw_json", F.lit(" \t\r\n")) == ""
    reason = F.when(empty, F.lit("empty")).otherwise(F.lit("not JSON"))
    return _files(spark, folder).filter(~is_json(F.col("raw_json"))).select("filename", F.octet_length("raw_json").cast("bigint").alias("size"), reason.alias("reason"))


def canonical_documents(raw: DataFrame) -> DataFrame:
    """One-line JSON with sorted keys; a document that repeats a key, which has no such form, stays as it is."""
    return raw.withColumn("raw_json", F.coalesce(canonical_json(F.col("raw_json")), F.when(is_json(F.col("raw_json")), F.col("raw_json"))))


def scan_metric(raw: DataFrame, metric: str) -> DataFrame:
    """Documents of one metric.  On the landed layout the partition column prunes whole folders."""
    rows = raw.filter(F.col("filename").like(f"{metric}_%"))
    return rows.filter(F.col("metric") == metric) if "metric" in raw.columns else rows


def missing_columns(df: DataFrame, required: Sequence[str] = RAW_COLUMNS) -> list[str]:
    """Required columns the relation lacks; empty when the schema is acceptable."""
    return [name for name in required if name not in df.columns]


def with_partition_columns(raw: DataFrame) -> DataFrame:
    """Add ``metric`` and ``date``, so that later scans prune instead of matching names."""
    return raw.withColumns({"metric": metric_of_name(F.col("filename")), "date": date_of_name(F.col("filename"))})


def _write(raw: DataFrame, path: str, mode: str) -> None:
    # One shuffle by (metric, date) would put a hot day into one task, so rows stay where they are;
    # each task then writes at most one file per metric.
    with_partition_columns(raw).write.mode(mode).partitionBy("metric").parquet(path)


def write_raw(raw: DataFrame, path: str, reset: bool = True) -> None:
    """Write the raw table.  ``reset`` replaces the content, so a rerun leaves no duplicates.

    Without reset rows are appended, unless the table at ``path`` lacks a required column: then it is
    rebuilt.
    """
    lacking = missing_columns(raw)
    if lacking:
        raise ValueError(f"raw documents lack {lacking}")
    if reset:
        return _write(raw, path, "overwrite")
    try:
        rebuild = bool(missing_columns(raw.sparkSession.read.parquet(path)))
    except AnalysisException:  # no table yet
        rebuild = False
    _write(raw, path, "overwrite" if rebuild else "append")


def append_ndjson(spark: SparkSession, source: str, path: str, keys: str = "") -> None:
    """Append newline-delimited raw rows to the table; ``keys`` is a DDL list of extra columns."""
    columns = ", ".join(x for x in (keys, RAW_DOCUMENT) if x)
    write_raw(spark.read.schema(columns).json(source), path, reset=False)
