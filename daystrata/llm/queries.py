"""Registered queries of the operators, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata import session
from daystrata.llm import (
    alignment, chat, common, divergence, hnsw, language, packing, piece_bpe, probminhash, rules, sharding, token_counts, url_filter, wavelet,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_wavelet_tokens(spark, folder):
    """Token files of all documents, written to the shared folder and read back."""
    path = session.new_folder(spark, "tokens")
    wavelet.write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_documents(spark, path, ids=False, crc=True)


@query
def op2_rule_cascade(spark, folder):
    """Measures and verdict of every document."""
    judged = rules.cascade(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op3_prefix_target_chat(spark, folder):
    """Examples of all conversations and of one that holds the template's own marks, written and read back."""
    odd = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    rows = common.columns(table(spark, folder, "conversations"), conv_id="bigint", turn="bigint", role="string", text="string").unionByName(more)
    return chat.summaries(common.stored(chat.examples(rows), "chat"))


@query
def op4_delta_token_counts(spark, folder):
    """Totals after three batches: all documents inserted; exact copies deleted; the counts of the rest revised
    for a version that adds an end token.  The first two are sent twice, as after a failure, and the batches are
    folded in between.  One row of each text is the rest, that of the least id, null ids last; null texts are one text."""
    made = token_counts.counted(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), "byte_bpe_50k")
    counts = common.stored(made.withColumn("row", F.monotonically_increasing_id()), "counts")
    first = counts.groupBy("text_hash").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang", "row"))["row"].alias("first_row"))
    both = counts.join(first, counts["text_hash"].eqNullSafe(first["text_hash"])).drop(first["text_hash"])
    copies, rest = both.filter("row <> first_row"), both.filter("row = first_row")
    rollup = token_counts.Rollup(spark, session.new_folder(spark, "rollup"))
    for _ in range(2):
        rollup.commit("load", token_counts.signed(counts, 1))
        rollup.commit("copies", token_counts.signed(copies, -1))
        rollup.fold()
    revised = token_counts.signed(rest, -1).unionByName(token_counts.signed(rest, 1, F.col("n_tokens") + 1, "byte_bpe_50k_end"))
    rollup.commit("revision", revised)
    return rollup.totals()


@query
def op5_best_fit_packing(spark, folder):
    """Sequences of at most 4096 tokens; the ids stay in the tasks, as the digest needs only their checksum."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


@query
def op6_probminhash_classes(spark, folder):
    """Class of near-duplicates of every document: 24 bands of 6 slots, similarity 0.8."""
    return probminhash.near_duplicates(table(spark, folder, "documents"))


@query
def op7_kneser_ney_language(spark, folder):
    """Language of every document, by models of those that aren't held out."""
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op8_prefix_table_pieces(spark, folder):
    """Ids of every document and the text decoded from them, as digests."""
    return piece_bpe.digest_documents(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_extendible_shards(spark, folder):
    """Shards of at most 1 MiB of text, written and read back."""
    return sharding.sharded(table(spark, folder, "documents"), 1 << 20)


@query
def op10_hnsw_vectors(spark, folder):
    """Links and components of all vectors of one label at cosine 0.98."""
    return hnsw.near_vectors(table(spark, folder, "embeddings"))


@query
def op11_run_skipping_alignment(spark, folder):
    """Aligned ids of every document by two vocabularies, with corpus-wide counts of linked pairs."""
    return alignment.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_bloom_cascade_urls(spark, folder):
    """Verdict of every page's url by four rules."""
    rules_ = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    return url_filter.judge(table(spark, folder, "pages"), spark.createDataFrame(rules_, url_filter.RULES))


@query
def op13_run_length_divergence(spark, folder):
    """Divergence of all sources of each language and their 200 most typical terms."""
    return divergence.audit(table(spark, folder, "documents"))
