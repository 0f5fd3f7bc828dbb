"""Shards by extendible hashing.

The directory is indexed by the leading bits of a key's hash.  A bucket within the byte limit is a shard; an
oversized one splits on the next bit, and only that one.  A shard is therefore the shortest hash prefix whose
rows fit, and its name is that prefix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from daystrata import session
from daystrata.llm import common

#: Bits of one hash.
BITS = 60
#: Directory rows up to which the directory is sent to every task; beyond it is joined by shuffle.
SENT_ROWS = 100_000
#: Bytes of text that a task writes, about.
TASK_BYTES = 64 << 20


def hash_bits(text: Column) -> Column:
    """The leading 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(column: str, depth) -> Column:
    return F.expr(f"shiftright({column}, {BITS} - {depth})")


def directory(sizes: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """(entry, depth, shard_bytes, n_rows) for every used entry of the deepest directory, and its depth.

    ``sizes`` has ``h`` and ``bytes`` and is read once for each try: the first depth leaves about an eighth
    of the limit in an entry, and four more bits follow while an entry with several hashes is still too large.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(1, math.ceil(math.log2(max(total / limit, 1))) + 3))
    while True:
        entries = sizes.groupBy(_prefix("h", depth).alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), (F.min("h") != F.max("h")).alias("mixed"))
        entries = common.stored(entries, "directory")
        if depth == BITS or entries.filter((F.col("bytes") > limit) & F.col("mixed")).isEmpty():
            break
        depth = min(BITS, depth + 4)
    levels = entries.select("entry", "bytes", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(entry, {depth} - depth)"))
    fitting = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("n_rows")).filter(F.col("shard_bytes") <= limit)
    shallowest = levels.select("entry", "depth", "prefix").join(fitting, ["depth", "prefix"]).groupBy("entry").agg(
        F.min(F.struct("depth", "shard_bytes", "n_rows")).alias("leaf"))
    # An entry no prefix of which fits holds a single hash: it stays at full depth.
    leaf = F.coalesce(F.col("leaf"), F.struct(F.lit(depth).alias("depth"), F.col("bytes").alias("shard_bytes"), F.col("n").alias("n_rows")))
    return entries.join(shallowest, "entry", "left").select("entry", leaf.alias("leaf")).select("entry", "leaf.*"), depth


def name(depth: str, hashed: str) -> Column:
    """The leading bits as text; the empty prefix, the single shard of a small table, is ``all``."""
    bits = F.lpad(F.conv(F.expr(f"shiftright({hashed}, {BITS} - {depth})").cast("string"), 10, 2), BITS, "0")
    return F.when(F.col(depth) == 0, F.lit("all")).otherwise(F.substr(bits, F.lit(BITS + 1) - F.col(depth)))


def _assigned(docs: DataFrame, limit: int, key: Column) -> DataFrame:
    """``docs`` with shard, depth, shard_bytes, n_rows and the hash ``_h``."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    hashed = docs.withColumn("_h", hash_bits(key))
    table, depth = directory(common.stored(hashed.select(F.col("_h").alias("h"), size.alias("bytes")), "sizes"), limit)
    table = common.stored(table, "leaves")
    if table.count() <= SENT_ROWS:
        table = F.broadcast(table)
    joined = hashed.withColumn("entry", _prefix("_h", depth)).join(table, "entry").drop("entry")
    return joined.withColumn("shard", name("depth", "_h"))


def shard(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard``, ``shard_depth`` and ``shard_bytes``, no shard above ``limit`` bytes of text.

    Rows with one key part company only where their key alone exceeds the limit: then the text's hash gives
    further bits, and for equal rows a number given to each row does.  A single row above the limit is a
    shard of its own.  A null text has no bytes, a null key hashes like an empty one, an empty table stays
    empty, and input columns named like an added one are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "shard_depth", "shard_bytes", "n_rows", "depth", "entry") or c.startswith("_")])
    keys = [F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit("")), F.col("_row").cast("string")]
    done = _assigned(docs, limit, keys[0])
    for step in (1, 2):
        over = (F.col("shard_bytes") > limit) & (F.col("n_rows") > 1)
        if done.filter(over).isEmpty():
            break
        rest = done.filter(over).withColumnRenamed("shard", "_outer").drop("_h", "depth", "shard_bytes", "n_rows")
        if step == 2:
            rest = common.stored(rest.withColumn("_row", F.monotonically_increasing_id()), "rows")
        again = _assigned(rest, limit, F.concat_ws("|", *keys[: step + 1])).withColumn("shard", F.concat_ws(".", "_outer", "shard"))
        done = done.filter(~over).unionByName(again.drop("_outer", "_row"))
    return done.drop("_h", "n_rows").withColumnRenamed("depth", "shard_depth")


def write_shards(docs: DataFrame, path: str, limit: int, key: str = "doc_id") -> None:
    """Write the shards, a folder and a file for each: a shard is whole in one task, and the limit bounds it.

    The number of tasks grows with the bytes of text, so a task gets about ``TASK_BYTES``, or one shard.
    """
    placed = shard(docs, limit, key)
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    tasks = max(common.partitions(docs.sparkSession), math.ceil(total / max(TASK_BYTES, limit)))
    placed.repartition(tasks, "shard").write.partitionBy("shard").parquet(path)


def read_shards(spark, path: str, schema: str) -> DataFrame:
    """The rows of all shards; ``schema`` includes shard."""
    return spark.read.schema(schema).parquet(path)


def sharded(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """(doc_id, shard, shard_depth, shard_bytes) of every row, from the shards as they were written."""
    spark = docs.sparkSession
    path = session.new_folder(spark, "shards")
    write_shards(common.columns(docs, doc_id="bigint", text="string", lang="string", source="string"), path, limit, key)
    return read_shards(spark, path, "doc_id bigint, shard string, shard_depth int, shard_bytes bigint")
