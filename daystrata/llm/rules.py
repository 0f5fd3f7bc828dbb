"""Quality rules as a short-circuit cascade.

Every rule is a condition that rejects a document.  Cost and rejection rate of each are measured on a
bounded sample; the cascade asks the rules in falling order of rejections per cost and stops at the first
that rejects.  The order changes the time and the named reason, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from daystrata.llm import common

WINDOW = 5
SYMBOLS = "#*$%&|<>"
_SPACES = r"[ \x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a SQL condition over ``text``, ``words`` and the columns of :func:`with_measures`."""

    name: str
    rejects: str


def with_measures(docs: DataFrame) -> DataFrame:
    """Adds words (array) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text has none.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes, inside one document.  Texts whose
    windows are all different, which is most of them, skip the search for repeated places.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.withColumn("words", F.filter(F.split(text, _SPACES), lambda w: w != ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(common.BLANKS)) != "")
    two = one.withColumns({
        "lines": lines, "_hashes": F.transform("words", lambda w: F.xxhash64(w)),
        "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
    })
    window = "xxhash64(" + ", ".join(f"_hashes[i + {k}]" for k in range(WINDOW)) + ")"
    three = two.withColumns({
        "n_words": F.size("words").cast("bigint"), "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "_windows": F.expr(f"if(size(words) < {WINDOW}, array(), transform(sequence(0, size(words) - {WINDOW}), i -> {window}))"),
    }).drop("lines", "_hashes")
    four = three.withColumn("_placed", F.expr(
        "if(size(array_distinct(_windows)) = size(_windows), null, sort_array(transform(_windows, (h, i) -> struct(h, i))))"
    )).drop("_windows")
    five = four.withColumn("_places", F.expr(
        "sort_array(transform(filter(_placed, (x, k) -> (k > 0 and get(_placed, k - 1).h = x.h) "
        "or (k + 1 < size(_placed) and get(_placed, k + 1).h = x.h)), x -> x.i))"
    )).drop("_placed")
    # Each repeated window covers its words up to the start of the next one.
    covered = f"aggregate(transform(_places, (p, k) -> least({WINDOW}, coalesce(get(_places, k + 1), p + {WINDOW}) - p)), 0L, (a, b) -> a + b)"
    return five.withColumn("n_repeat_words", F.expr(f"coalesce({covered}, 0L)")).drop("_places")


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
RULES = (
    Rule("base", BASE_FAILED),
    Rule("symbols", "10 * n_symbols > n_words"),
    # Short documents may share most of their few lines with others and with themselves.
    Rule("duplicate_lines", "n_lines >= 8 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("stutter", "10 * size(filter(words, (w, i) -> i > 0 and words[i - 1] = w)) > 3 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("upper_case", "10 * size(filter(words, w -> w = upper(w) and w <> lower(w))) > 3 * n_words"),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def yield_(self) -> float:
        return self.rejected / self.seconds


def estimates(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> list[Estimate]:
    """Cost and rejection rate of each rule alone over about ``sample_rows`` documents, a documented bound.

    The sample is stored once.  A rule's cost is the time of a job with it less that of a job that only reads
    the sample, the smaller of two runs, and a millisecond at least.
    """
    rows = docs.count()
    sample = common.stored(docs.select("text").sample(fraction=min(1.0, sample_rows / max(rows, 1)), seed=7), "rule-sample").coalesce(1)

    def timed(condition) -> tuple[float, float]:
        best, rate = float("inf"), 0.0
        for _ in range(2):
            start = time.perf_counter()
            row = condition.agg(F.avg("bad"), F.max("n")).first()
            best, rate = min(best, time.perf_counter() - start), row[0] or 0.0
        return best, rate

    empty, _ = timed(sample.select(F.lit(0.0).alias("bad"), F.length("text").alias("n")))
    found = []
    for rule in rules:
        seconds, rate = timed(with_measures(sample).select(F.coalesce(F.expr(rule.rejects), F.lit(False)).cast("double").alias("bad"), F.lit(0).alias("n")))
        found.append(Estimate(rule, max(seconds - empty, 1e-3), rate))
    return found


def ordered(found: list[Estimate]) -> list[Rule]:
    """Most rejections per second first; equal ones by lower cost, then by name."""
    return [e.rule for e in sorted(found, key=lambda e: (-e.yield_, e.seconds, e.rule.name))]


def cascade(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    A later rule is only evaluated where all earlier ones passed.  A null or empty text has no words and fails
    the base rule; a rule whose condition is null doesn't reject; repeated rows are judged alike; an empty
    table stays empty.  Input columns named like an added one are replaced by it.
    """
    order = ordered(estimates(docs, rules, sample_rows))
    added = {"words", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"}
    plain = docs.drop(*[c for c in docs.columns if c.lower() in added or c.startswith("_")])
    first = F.lit(None).cast("string")
    for rule in reversed(order):
        first = F.when(F.expr(rule.rejects), F.lit(rule.name)).otherwise(first)
    judged = with_measures(plain).withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("rejected_by", first)
    judged = judged.withColumn("kept", F.col("rejected_by").isNull())
    # A filter on the verdict would be pushed down by writing every measure out in it, again and again; it can't
    # pass a generator, so each measure is computed once.
    results = F.explode(F.array(F.struct(*[c for c in judged.columns if c in added - {"words"}]))).alias("_judged")
    return judged.select(*plain.columns, results).select(*plain.columns, "_judged.*")
