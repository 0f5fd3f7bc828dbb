"""Best-fit-decreasing packing of tokenized documents into sequences of a fixed capacity.

Pieces of one length are interchangeable, so best fit decreasing needs only how many there are of each
length: at most ``capacity`` numbers, whatever the size of the corpus.  The plan handles them in falling
length.  A segment tree over the remaining capacities finds the tightest open bins in logarithmic time,
and bins with one history are kept as a run of consecutive numbers.  The result says for every length
which ranks of its pieces go to which bins; each piece then looks up its own rank, in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daystrata.llm import common
from daystrata.llm.units import UnitIds, WordIds, unit_ids


class CapacityTree:
    """Open runs of bins by remaining capacity; ``tightest`` gives the least remainder that still fits."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, remainder: int, value: bool) -> None:
        node = self.size + remainder
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def push(self, remainder: int, first: int, count: int) -> None:
        if remainder and count:
            if not self.runs[remainder]:
                self._mark(remainder, True)
            self.runs[remainder].append((first, count))

    def pop(self, remainder: int) -> tuple[int, int]:
        run = self.runs[remainder].pop()
        if not self.runs[remainder]:
            self._mark(remainder, False)
        return run

    def tightest(self, need: int) -> int | None:
        node = self.size + need
        if self.open[node]:
            return need
        # Up to the first left child whose right sibling is open, then down along the left-most open leaf.
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """(rows of length, first rank, first bin, pieces per bin, offset), sorted; and the number of bins."""
    tree, bins, rows = CapacityTree(capacity), 0, []

    def place(length, rank, first, count, remainder, left):
        """Deal ``left`` pieces to the bins of a run that all have ``remainder``; gives what is left over."""
        each, used = remainder // length, capacity - remainder
        full = min(count, left // each)
        if full:
            rows.append((length, rank, first, each, used))
            tree.push(remainder - each * length, first, full)
            rank, left = rank + full * each, left - full * each
        if full < count and left:
            rows.append((length, rank, first + full, left, used))
            tree.push(remainder - left * length, first + full, 1)
            full, left = full + 1, 0
        tree.push(remainder, first + full, count - full)
        return left

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rank, remainder = counts[length] - left, tree.tightest(length)
            if remainder is None:
                count = -(-left // (capacity // length))
                left = place(length, rank, bins, count, capacity, left)
                bins += count
            else:
                left = place(length, rank, *tree.pop(remainder), remainder, left)
    return np.array(sorted(rows), np.int64).reshape(-1, 5), bins


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool = True, encoder: type[UnitIds] = WordIds) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, chunk, place [, ids]): every text encoded whole, the end id
    added, and only what is longer than the capacity cut into pieces of that length.

    ``place`` numbers the pieces of one length inside a chunk, ``chunk`` is the task that made them.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk int, place bigint" + ", ids binary" * keep_ids

    def cut(batches):
        from pyspark import TaskContext

        chunk, ids_of, seen = TaskContext.get().partitionId(), unit_ids(encoder, tokenizer), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "place", "ids")}
            for name, ids in zip(batch.column(0).to_pylist(), ids_of.encode(t.as_py() for t in batch.column(1))):
                ids += end
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + capacity)]
                    length = len(own) // 4
                    for key, value in zip(out, (name, piece, start, length, zlib.crc32(own), seen[length], own if keep_ids else None)):
                        out[key].append(value)
                    seen[length] += 1
            arrays = {n: pa.array(out[n], pa.int32() if n == "piece" else pa.int64()) for n in out if n != "ids"}
            arrays["chunk"] = pa.array(np.full(len(out["piece"]), chunk), pa.int32())
            if keep_ids:
                arrays["ids"] = pa.array(out["ids"], pa.binary())
            yield pa.RecordBatch.from_pydict({n: arrays[n] for n in [c.split()[0] for c in schema.split(", ")]})

    return common.map_batches(common.columns(docs, doc_id="bigint", text="string"), cut, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids]) for every piece of every document.

    The pieces of a sequence follow one another without a gap from offset 0.  A null or empty text is the end
    id alone; null and repeated ids are documents like others; other columns are ignored; an empty table
    gives no rows.  Equal lengths are ranked by task and order of arrival, so sequences keep their lengths,
    not their members, when the input is dealt differently.

    The pieces are written to the shared folder once.  To the driver come the counts by length, at most
    ``capacity`` rows; to the tasks goes the plan, whose rows are bounded by runs of equal bins.
    """
    made = common.stored(pieces(docs, tokenizer, end_id, capacity, keep_ids), "pieces")
    by_chunk = made.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_chunk.select("length", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = made.join(ranks, ["length", "chunk"]).withColumn("rank", F.col("place") + F.col("before"))
    # Length and rank in one number, for a single search over the plan.
    shift = max([0, *counts.values()]).bit_length() + 1
    keys = (rows[:, 0] << shift) | rows[:, 1]
    shared = made.sparkSession.sparkContext.broadcast((keys, rows))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(*kept).schema) + ", sequence_id bigint, offset bigint"

    def assign(batches):
        keys, rows = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            row = rows[np.searchsorted(keys, (length << shift) | rank, side="right") - 1]
            behind = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(row[:, 2] + behind // row[:, 3]), pa.array(row[:, 4] + behind % row[:, 3] * length)],
                [*kept, "sequence_id", "offset"],
            )

    return common.map_batches(ranked.select(*kept, "rank"), assign, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids): the packed sequences themselves; at most ``capacity`` ids each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("members"))
    # Ids as hexadecimal text, joined and turned back: binary values have no array function that joins them.
    joined = F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["ids"])), ""))
    return grouped.select("sequence_id", "n_tokens", joined.alias("ids"), F.col("members.doc_id").alias("doc_ids"))
