"""Landing only what is new: a file stream that runs until the folder is drained."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daystrata.sources.raw import with_partition_columns


def land_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, *,
                   max_files: int = 10_000) -> None:
    """Append raw rows of files not processed by an earlier run, then stop.

    The checkpoint remembers finished files, and the file sink's log makes a repeated batch harmless
    when a run is interrupted.  Executors can come and go; the driver only lists files.
    """
    incoming = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(source)
    )
    query = (
        with_partition_columns(incoming).writeStream.format("parquet")
        .partitionBy("metric").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
