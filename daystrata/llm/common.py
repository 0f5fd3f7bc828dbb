"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata import session

#: ASCII white space of the word rules: tab to carriage return, and space.
BLANKS = "\t\n\x0b\x0c\r "
ship = session.ship
_FORGET: dict[str, Callable[[], None]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Called where a task starts to use what its worker process remembers: the memories of all other owners, which
    tasks of earlier stages left in the process, are emptied."""
    for name in [n for n in _FORGET if n != owner]:
        _FORGET.pop(name)()
    _FORGET[owner] = forget


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand on every executor.

    After each batch Arrow gives back the memory that it has freed; else its allocator kept 100 MB in a worker.
    """
    def released(batches):
        for made in function(batches):
            yield made
            pa.default_memory_pool().release_unused()

    ship(df.sparkSession)
    return df.mapInArrow(released, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = session.new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(df: DataFrame, **casts: str) -> DataFrame:
    """Only the named columns, cast to the given types; a missing one is null.  Extra columns fall away here,
    so their names can clash with nothing an operator adds."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[n.lower()]}`") if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in casts.items()
    ])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
