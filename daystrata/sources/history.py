"""Visit history: documents that map a place name to a list of ISO dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daystrata import session


def latest_visit(dates: Column) -> Column:
    """Latest text of an array of ISO dates."""
    return F.array_max(dates)


def history_rows(documents: DataFrame, *, column: str = "raw_json", keys: Sequence[str] = ()) -> DataFrame:
    """One row per name and date.

    Values are read as VARIANT, so entries that are not lists (comments, rules) drop out without
    taking the whole map with them.  A document that is not JSON gives no rows.
    """
    entry = F.explode(F.map_entries(F.from_json(F.col(column), "map<string,variant>")))
    return (
        documents.select(*keys, entry.alias("_entry"))
        .select(
            *keys,
            F.col("_entry.key").alias("name"),
            F.explode(F.try_variant_get("_entry.value", "$", "array<string>")).alias("visit_date"),
        )
        .filter(F.col("visit_date").isNotNull())
    )


def history_upsert(history: DataFrame, visits: DataFrame, *, keys: Sequence[str] = (), as_of=None) -> DataFrame:
    """Add visits that are not recorded yet; a visit without date counts for ``as_of``."""
    columns = [*keys, "name", "visit_date"]
    dated = visits
    if as_of is not None:
        dated = visits.withColumn("visit_date", F.coalesce("visit_date", F.lit(str(as_of))))
    return history.select(columns).unionByName(dated.select(columns)).dropDuplicates(columns)


def save_visits(spark: SparkSession, path: str, visits: DataFrame, *, keys: Sequence[str] = (), as_of=None, buckets: int = 64) -> None:
    """Add visits to the history stored at ``path``, which is dealt into ``buckets`` folders by a hash of the keys.

    Only the folders that ``visits`` touch are read and written again; the new content is stored aside first, and each
    folder is then replaced.  Sending the same visits again, also after a failure in between, changes nothing.  One
    writer at a time.
    """
    columns = [*keys, "name", "visit_date"]
    bucket = F.pmod(F.xxhash64(F.lit("history"), *keys), F.lit(buckets)).cast("int")
    rows = visits.select(columns).withColumn("bucket", bucket)
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())  # ``buckets`` rows at most
    if not touched:
        return
    try:
        old = spark.read.parquet(path).filter(F.col("bucket").isin(touched)).select(columns)
    except AnalysisException:  # no history yet
        old = rows.select(columns).limit(0)
    merged = history_upsert(old, rows, keys=keys, as_of=as_of).withColumn("bucket", bucket)
    aside = session.new_folder(spark, "history")
    merged.repartition("bucket").write.parquet(aside)
    stored = spark.read.schema(merged.schema).parquet(aside)
    stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def saved_visits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def last_visits(history: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Latest visit per name, by text order, partially aggregated before the shuffle."""
    return history.groupBy(*keys, "name").agg(F.max("visit_date").alias("last_visit"))
