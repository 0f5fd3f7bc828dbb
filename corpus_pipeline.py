"""The corpus pipeline: quality rules, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the first three return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata.llm import common, language, packing, probminhash, rules

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no quality rule rejects; a null or empty text is rejected."""
    return rules.cascade(docs).filter("kept").select(*COLUMNS)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted, each row judged itself; the models learn from the documents of this stage."""
    return language.accepted(docs.select(*COLUMNS), language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, whatever its id; null and wordless texts are alone in their class.

    Rows get numbers of their own, stored with them, so null and repeated ids need no care.
    """
    rows = common.stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    gone = probminhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).filter("not kept").select(F.col("doc_id").alias("row"))
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: where every piece of every row goes; null and repeated ids are documents like others."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES = [("quality rules", quality), ("language ID", languages), ("MinHash near-dedup", near_duplicates), ("best-fit packing", pack)]

#: The language and near-duplicate stages can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
