"""Token files: one wavelet matrix per shard.

A wavelet matrix keeps one bit plane per bit of the largest id.  Plane by plane from the highest bit the
tokens are dealt stably into zeros and ones; counts of ones before each block make rank a table look-up,
and select a search in the same table.  So a single compressed file answers which token stands at a place,
how often a token occurs in a range, and where its k-th occurrence is, without unpacking the ids.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daystrata.llm import common
from daystrata.llm.units import ByteLevelIds, unit_ids

MAGIC = b"WMX1"
#: Bits between two stored counts.
BLOCK = 512
FILES = ("part int, shard int, n_docs bigint, n_tokens bigint, first_token bigint, image binary")


class WaveletMatrix:
    """Rank, select, count and access over one sequence of ids; ranges are half open, all counts from 0."""

    def __init__(self, n: int, bits: int, plane, zeros: list[int]) -> None:
        self.n, self.bits, self.zeros, self._load, self._open = n, bits, zeros, plane, {}

    def plane(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed bits, ones before each block); unpacked from the file at first use."""
        if level not in self._open:
            self._open[level] = self._load(level)
        return self._open[level]

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before each place i."""
        packed, before = self.plane(level)
        block = i // BLOCK
        count = before[block].astype(np.int64)
        step = BLOCK // 8
        # Whole bytes of the open block, then the bits of its last byte.
        for offset in range(step):
            at = block * step + offset
            whole = at < i // 8
            if not whole.any():
                break
            count[whole] += np.bitwise_count(packed[at[whole]])
        odd = i % 8
        some = odd > 0
        count[some] += np.bitwise_count(packed[i[some] // 8] >> (8 - odd[some]).astype(np.uint8))
        return count

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return (self.plane(level)[0][i // 8] >> (7 - i % 8).astype(np.uint8)) & 1

    def access(self, places) -> np.ndarray:
        """The ids at the given places."""
        i = np.atleast_1d(np.asarray(places, np.int64)).copy()
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("place outside the shard")
        found = np.zeros(len(i), np.uint32)
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            found = (found << np.uint32(1)) | bit
            i = np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return found

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if not 0 <= token < 1 << self.bits:
            return 0, 0
        ends = np.array([min(max(low, 0), self.n), min(max(high, 0), self.n)], np.int64)
        for level in range(self.bits):
            ones = self._ones(level, ends)
            one = token >> (self.bits - 1 - level) & 1
            ends = self.zeros[level] + ones if one else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        first, last = self._range(token, low, self.n if high is None else high)
        return max(0, last - first)

    def rank(self, token: int, place: int) -> int:
        """Occurrences before a place."""
        return self.count(token, 0, place)

    def _select_bit(self, level: int, one: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th zeros or ones."""
        packed, before = self.plane(level)
        counts = before if one else np.arange(len(before), dtype=np.int64) * BLOCK - before
        block = np.searchsorted(counts, k, side="right") - 1
        step = BLOCK // 8
        bytes_ = packed[np.minimum(block[:, None] * step + np.arange(step), len(packed) - 1)]
        bits = np.unpackbits(bytes_, axis=1)
        running = np.cumsum(bits if one else 1 - bits, axis=1)
        inside = (running <= (k - counts[block])[:, None]).sum(axis=1)
        return block * BLOCK + inside

    def occurrences(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Places of the first-th to last-th occurrence of a token, ascending."""
        start, end = self._range(token, 0, self.n)
        i = np.arange(start + first, end if last is None else min(end, start + last), dtype=np.int64)
        for level in reversed(range(self.bits)):
            one = token >> (self.bits - 1 - level) & 1
            i = self._select_bit(level, one, i - self.zeros[level] if one else i)
        return i

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence, -1 where there is none."""
        found = self.occurrences(token, k, k + 1) if k >= 0 else ()
        return int(found[0]) if len(found) else -1

    def tokens(self) -> np.ndarray:
        """All ids in order: the deals undone plane by plane, without rank."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        current = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            ones, zeros = np.unpackbits(self.plane(level)[0], count=self.n).view(bool), self.zeros[level]
            back = np.empty(self.n, kind)
            back[np.flatnonzero(~ones)] = current[:zeros]
            back[np.flatnonzero(ones)] = current[zeros:] | kind(1 << (self.bits - 1 - level))
            current = back
        return current.astype("<u4")


def build(ids: np.ndarray, bits: int) -> tuple[list[bytes], list[bytes], list[int]]:
    """(planes, block counts, number of zeros), from the highest bit down."""
    planes, counts, zeros = [], [], []
    x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits):
        ones = (x & x.dtype.type(1 << (bits - 1 - level))) != 0
        packed = np.packbits(ones)
        padded = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        padded[: len(packed)] = packed
        before = np.zeros(len(padded) // (BLOCK // 8) + 1, "<u4")
        np.cumsum(np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1), out=before[1:])
        low = np.compress(~ones, x)
        planes.append(packed.tobytes())
        counts.append(before.tobytes())
        zeros.append(len(low))
        x = np.concatenate((low, np.compress(ones, x)))
    return planes, counts, zeros


def to_image(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """A file: magic, length of the header, header, then every section compressed on its own."""
    planes, counts, zeros = build(ids, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], bool)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    sections = [pack(np.packbits(known).tobytes()), pack(docs.tobytes()), pack(np.array(lengths, "<i8").tobytes())]
    sections += [pack(x) for x in planes] + [pack(x) for x in counts]
    header = json.dumps({
        "n": len(ids), "bits": bits, "docs": len(doc_ids), "zeros": zeros, "sections": [len(s) for s in sections],
        "crc": zlib.crc32(b"".join(sections)),
    }).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class TokenFile:
    """A shard's file: documents in order and the matrix over their ids."""

    def __init__(self, image: bytes) -> None:
        if image[:4] != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack("<I", image[4:8])
        header = json.loads(image[8 : 8 + size])
        ends = np.cumsum([8 + size, *header["sections"]])
        if zlib.crc32(image[8 + size : ends[-1]]) != header["crc"]:
            raise ValueError("damaged token file")
        unpack = zstandard.ZstdDecompressor().decompress

        def section(k: int, kind: str) -> np.ndarray:
            return np.frombuffer(unpack(image[ends[k] : ends[k + 1]]), kind)

        bits, docs = header["bits"], header["docs"]
        known = np.unpackbits(section(0, "u1"), count=docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(section(1, "<i8"), known)]
        self.starts = np.concatenate(([0], np.cumsum(section(2, "<i8"))))
        self.matrix = WaveletMatrix(header["n"], bits, lambda level: (section(3 + level, "u1"), section(3 + bits + level, "<u4")), header["zeros"])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_tokens: int = 1 << 18, files: int | None = None) -> None:
    """Encode every whole text and write the ids, with ``end_id`` after each document, as token files.

    The documents are dealt out by ranges of ``doc_id`` and sorted inside, so files and shards follow it.
    A shard closes with the document that brings it to ``shard_tokens``.  A null text is empty, so its
    document is the end id alone; null ids come first; equal ids stay separate documents, in order of their
    texts.  Other columns are ignored.  An empty table gives an empty folder of files.
    """
    from tokenizers import Tokenizer

    bits = max(end_id, Tokenizer.from_file(tokenizer).get_vocab_size() - 1, 1).bit_length()

    def shards(batches):
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), unit_ids(ByteLevelIds, tokenizer)
        number = first = held = 0
        names, lengths, pieces = [], [], []

        def add(some: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
            nonlocal held
            names.extend(some)
            lengths.extend(sizes.tolist())
            pieces.append(ids)
            held += len(ids)

        def close():
            nonlocal number, first, held
            ids = np.concatenate(pieces)
            made = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([number], pa.int32()), "n_docs": [len(names)],
                "n_tokens": [held], "first_token": [first], "image": pa.array([to_image(names, lengths, ids, bits)], pa.binary()),
            })
            number, first, held = number + 1, first + held, 0
            for x in (names, lengths, pieces):
                x.clear()
            return made

        for batch in batches:
            ids_of, at = batch.column(0).to_pylist(), 0
            for found, n in encoder.batches(batch.column(1)):
                # The end id goes behind the ids of each document.
                ends = np.cumsum(n + 1)
                ids, own = np.full(len(found) + len(n), end_id, "<u4"), np.ones(len(found) + len(n), bool)
                own[ends - 1] = False
                ids[own] = found
                doc = token = 0
                while doc < len(n):
                    closing = int(np.searchsorted(ends, token + max(1, shard_tokens - held)))
                    last = min(closing + 1, len(n))
                    add(ids_of[at + doc : at + last], n[doc:last] + 1, ids[token : ends[last - 1]])
                    doc, token = last, int(ends[last - 1])
                    if closing < len(n):
                        yield close()
                at += len(n)
        if names:
            yield close()

    spark = docs.sparkSession
    dealt = common.columns(docs, doc_id="bigint", text="string").repartitionByRange(files or common.partitions(spark), "doc_id")
    written = common.map_batches(dealt.sortWithinPartitions("doc_id", "text"), shards, FILES)
    written.write.option("compression", "none").parquet(path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files: part, shard, sizes, ``first_token`` inside the part, and the image."""
    return spark.read.schema(FILES).parquet(path)


def read_documents(spark: SparkSession, path: str, ids: bool = True, crc: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens [, ids] [, ids_crc32]) of every document, unpacked from its file.

    ``start`` counts the ids of all documents before it.  The number of parts, not the data, bounds the
    table of offsets that goes to every task.
    """
    files = token_files(spark, path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    schema = "doc_id bigint, start bigint, n_tokens bigint" + ", ids binary" * ids + ", ids_crc32 bigint" * crc

    def unpack(batches):
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = TokenFile(image.as_py())
                raw, edges = memoryview(file.matrix.tokens().tobytes()), file.starts
                slices = [raw[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                out = {
                    "doc_id": pa.array(file.doc_ids, pa.int64()), "start": pa.array(edges[:-1] + start, pa.int64()),
                    "n_tokens": pa.array(np.diff(edges), pa.int64()),
                }
                if ids:
                    out["ids"] = pa.array([s.tobytes() for s in slices], pa.binary())
                if crc:
                    out["ids_crc32"] = pa.array([zlib.crc32(s) for s in slices], pa.int64())
                yield pa.RecordBatch.from_pydict(out)

    placed = files.join(F.broadcast(offsets), "part").select((F.col("first_token") + F.col("offset")).alias("start"), "image")
    return common.map_batches(placed, unpack, schema)


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, shard, n, places): where a token stands in each file that has it, found by rank and select."""
    def look(batches):
        for batch in batches:
            found = [TokenFile(x.as_py()).matrix.occurrences(token) for x in batch.column(2)]
            keep = [k for k, f in enumerate(found) if len(f)]
            yield pa.RecordBatch.from_pydict({
                "part": batch.column(0).take(pa.array(keep, pa.int64())), "shard": batch.column(1).take(pa.array(keep, pa.int64())),
                "n": pa.array([len(found[k]) for k in keep], pa.int64()),
                "places": pa.array([found[k].tolist() for k in keep], pa.list_(pa.int64())),
            })

    return common.map_batches(token_files(spark, path).select("part", "shard", "image"), look, "part int, shard int, n bigint, places array<bigint>")
