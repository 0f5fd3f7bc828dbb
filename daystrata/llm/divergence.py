"""How much the sources of a language differ in their use of words, over run-length columns.

Each source is a column of term counts over the vocabulary of its language.  The vocabulary is sorted by its counts,
the largest source first, so that equal counts lie side by side, and each column is kept as runs of one count.  For a
pair of sources the boundaries of their runs are merged: between two of them both counts stay the same, so the
divergence of one term there is taken times the number of terms.  Parts of the sorted vocabulary are independent, and
their sums add up.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daystrata.llm import common

#: Documents of a language that hold a term at least.
LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Entries (term and source) in a part of the sorted vocabulary, about.
PART_ENTRIES = 500_000
#: Terms a task sums before it hands them on.
HELD = 400_000
# Byte to byte: A-Z to lower case, other ASCII without letters to a space, the bytes of other characters stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() and chr(b).islower() else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Stretches of ASCII letters and characters beyond ASCII; only A-Z in lower case."""
    return text.encode().translate(_TABLE).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, summed in each task; several rows of one
    term where tasks or rounds of a task meet it."""
    def count(batches):
        sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def rows():
            for (lang, source), (n, docs_) in sums.items():
                size = len(n)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array([t.decode() for t in n], pa.string()),
                    pa.array(n.values(), pa.int64()), pa.array([docs_[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n, docs_ = sums.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                found = terms(text.as_py())
                n.update(found)
                docs_.update(set(found))
                held += len(n) - before
                if held > HELD:
                    yield from rows()
                    sums, held = {}, 0
        yield from rows()

    rows = common.columns(docs, lang="string", source="string", text="string").fillna("")
    return common.map_batches(rows, count, "lang string, source string, term string, n bigint, docs bigint")


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + kinds)), in whole numbers."""
    return F.lit(1).cast("bigint") + F.call_function("div", F.lit(UNIT).cast("bigint") * (count + 1), total + kinds)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Columns:
    """Run-length columns of some neighbouring rows of the sorted vocabulary, each row standing for ``times`` terms."""

    def __init__(self, rows: np.ndarray, sources: np.ndarray, counts: np.ndarray, times: np.ndarray, n_sources: int) -> None:
        """``rows``, ``sources`` and ``counts`` of all counts but zeros, by source and row; sources from 1."""
        self.ends = np.cumsum(times)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.lexsort((rows, sources))
        edges = np.searchsorted(sources[order], np.arange(1, n_sources + 2))
        for first, last in zip(edges[:-1], edges[1:]):
            column = np.zeros(len(times), np.int64)
            own = order[first:last]
            column[rows[own]] = counts[own]
            starts = np.flatnonzero(np.diff(column, prepend=-1))
            self.runs.append((starts, column[starts]))

    def pair(self, s: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts of s, counts of t, number of terms) between all boundaries of both columns."""
        (at_s, of_s), (at_t, of_t) = self.runs[s], self.runs[t]
        starts = np.sort(np.concatenate((at_s, at_t)), kind="stable")
        starts = starts[np.diff(starts, prepend=-1) != 0]
        before = np.where(starts > 0, self.ends[starts - 1], 0)
        length = np.diff(before, append=self.ends[-1])
        return of_s[np.searchsorted(at_s, starts, "right") - 1], of_t[np.searchsorted(at_t, starts, "right") - 1], length


def _pair_sums(vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, place, other, value): for each part of the sorted vocabulary, the sums of all pairs of sources.

    ``vocabulary`` has lang and entries (source, n); ``groups`` has lang, source, place, total, kinds.  Terms with the
    same counts in all sources are one row with their number from here on.
    """
    spark = vocabulary.sparkSession
    places = vocabulary.select("lang", "term", F.inline("entries")).join(groups.select("lang", "source", "place"), ["lang", "source"])
    # A row's counts in one array of place and count in turns: sorting by it clusters equal counts.
    pairs = F.array_sort(F.collect_list(F.struct("place", F.col("n").alias("n"))))
    flat = F.flatten(F.transform(pairs, lambda x: F.array(x["place"].cast("bigint"), x["n"])))
    counts = places.groupBy("lang", "term").agg(flat.alias("counts")).groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("times"))
    counts = common.stored(counts, "count-rows")
    entries = counts.agg(F.sum(F.size("counts"))).first()[0] or 0
    parts = max(1, -(-entries // (2 * PART_ENTRIES)))
    ordered = counts.repartitionByRange(parts, "lang", "counts").sortWithinPartitions("lang", "counts")
    dealt = common.stored(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "sorted-rows")
    needed = groups.join(dealt.select("lang", F.col("part").alias("of_part")).distinct(), "lang")

    def sums(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        rows, groups = rows.sort_values("row"), groups.sort_values("place")
        size = np.array([len(x) // 2 for x in rows["counts"]])
        flat = np.concatenate(rows["counts"].to_list()).reshape(-1, 2)
        columns = Columns(np.repeat(np.arange(len(rows)), size), flat[:, 0], flat[:, 1], rows["times"].to_numpy(), len(groups))
        below = (groups["total"] + groups["kinds"]).to_numpy()
        place, n = groups["place"].to_numpy(), len(groups)
        value = np.zeros((n, n), np.int64)
        for s in range(n):
            for t in range(s):
                of_s, of_t, length = columns.pair(s, t)
                p, q = 1 + UNIT * (of_s + 1) // below[s], 1 + UNIT * (of_t + 1) // below[t]
                square = (p - q) * (p - q)
                value[s, t], value[t, s] = (square // q * length).sum(), (square // p * length).sum()
        s, t = np.nonzero(~np.eye(n, dtype=bool))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "place": place[s], "other": place[t], "value": value[s, t]})

    common.ship(spark)
    return dealt.groupBy("lang", "part").cogroup(needed.groupBy("lang", "of_part")).applyInPandas(sums, "lang string, place int, other int, value bigint")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence of every source of a language from each other source
    (``pair``, all ranks) and its most typical terms against the language (``term``, up to ``top``).

    Null text, lang and source count as ''.  A language keeps the terms of at least ``least_docs`` of its documents,
    V of them.  With the counts of a source, N their sum, the share of a term is p = 1 + floor(10^9 * (count + 1) /
    (N + V)), and the divergence from a share q is floor((p - q)^2 / q).  A pair's value is the sum over all kept terms
    (0 without any); a term's is its own, where the source has it and p > q of the whole language.  Ranks go by value
    down, then by item in UTF-8 order.  Rows with one doc_id are documents each; other columns are ignored; an empty
    table gives no rows.

    Term counts are summed in the tasks and meet by language and term, so no source is a key of that shuffle.  A task
    of the pair sums holds one part of the vocabulary and one row of each source of its language; the result itself
    has a row for each two sources.
    """
    sums = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = sums.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("entries"), F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    vocabulary = common.stored(kept.filter(F.col("docs") >= least_docs).select("lang", "term", "total", "entries"), "vocabulary")
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("total").alias("lang_total"))
    totals = vocabulary.select("lang", F.inline("entries")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = common.columns(docs, lang="string", source="string").fillna("").distinct()
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "kinds", "lang_total"])
    # The largest source comes first in the order of the vocabulary.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "source"))
    groups = common.stored(groups.withColumn("place", place), "groups")

    own = groups.select("lang", "source", "place")
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("other"))
    summed = _pair_sums(vocabulary, groups).groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    pairs = own.join(other, "lang").filter("place <> other").join(summed, ["lang", "place", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))

    found = vocabulary.select("lang", "term", F.col("total").alias("all"), F.inline("entries")).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("all"), F.col("lang_total"), F.col("kinds"))
    typical = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    typical = typical.select("lang", "source", "part", "item", divergence(F.col("p"), F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    # A task keeps the first rows of each group before the shuffle.
    return pairs.withColumn("rank", rank).unionByName(typical.withColumn("rank", rank).filter(F.col("rank") <= top))
