"""Chat examples by prefix-target expansion: every assistant turn becomes an example of its own, with all
turns before it as context and only that reply trainable.

A turn is written as ``<|turn|>ROLE<|says|>TEXT<|end|>``.  Inside roles and texts a backslash is doubled and
``<|`` becomes ``<\\|``, so the marks never occur in them and the original comes back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daystrata.llm import common

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_length, trainable, last): the training examples.

    ``text`` ends with the reply and its end mark; the loss covers ``loss_length`` characters from
    ``loss_start`` (from 0), the escaped reply.  Turns after the last reply, or a conversation without one,
    come as a final example that isn't trainable, so nothing is lost; ``last`` marks the example that holds
    the whole conversation.  Turns are ordered by ``turn``, then role and text; a null turn comes first, a
    null text or role is empty, null conv_ids form one conversation, an empty table gives no examples.
    """
    turns = common.columns(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    filled = F.struct("turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(filled)).alias("turns"))
    parts = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(SAYS), escaped(t["text"]), F.lit(END))).alias("parts"),
        F.transform("turns", lambda t: F.when(t["role"] == ASSISTANT, F.length(escaped(t["text"])))).alias("replies"),
    )
    ends = F.expr("filter(sequence(1, size(replies)), i -> i = size(replies) or replies[i - 1] is not null)")
    # One generated row at a time is joined from its parts, so no task holds all examples of a conversation.
    rows = parts.select("conv_id", "parts", "replies", F.posexplode(ends).alias("example", "end"))
    reply = F.get("replies", F.col("end") - 1)
    cut = rows.select(
        "conv_id", F.col("example").cast("bigint").alias("example"), F.array_join(F.slice("parts", F.lit(1), F.col("end")), "").alias("text"),
        F.coalesce(reply, F.lit(0)).cast("bigint").alias("loss_length"), reply.isNotNull().alias("trainable"), (F.col("end") == F.size("parts")).alias("last"),
    )
    start = F.when(F.col("trainable"), F.length("text") - len(END) - F.col("loss_length")).otherwise(F.length("text"))
    return cut.withColumn("loss_start", start.cast("bigint"))


def summaries(written: DataFrame) -> DataFrame:
    """Digests per conversation, from written examples alone: turns parsed out of the last text, replies out
    of the loss spans."""
    span = F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int"))
    narrow = written.select(
        "conv_id", "example", F.when(F.col("trainable"), unescaped(span)).alias("reply"), F.when(F.col("last"), F.col("text")).alias("whole"),
        F.length("text").alias("chars"),
    )
    grouped = narrow.groupBy("conv_id").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    marked = grouped.select(
        "conv_id", "formatted_chars", F.slice(F.split("whole", rf"\Q{TURN}\E"), F.lit(2), F.lit(2**31 - 1)).alias("turns"),
        F.array_join("replies.reply", "").alias("loss"),
    )
    split = F.transform("turns", lambda t: F.split(t, rf"\Q{SAYS}\E|\Q{END}\E"))
    plain = F.array_join(F.transform(split, lambda t: F.concat(unescaped(t[0]), F.lit("\n"), unescaped(t[1]), F.lit("\n"))), "")
    return marked.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(plain, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
