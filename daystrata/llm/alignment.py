"""Alignment of two tokenizers over the same bytes, by diagonal run skipping.

The ends of both token sequences, in bytes, are two rising arrays with one last value.  While tokens pair off
one to one, both ends are equal at a fixed index shift: steps of doubled size compare whole slices at that shift
and jump over the stretch, halved ones find its last pair.  Where the ends part, the tokens up to the next common
end are an irregular group, which is walked through on its own and sets the new shift.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from daystrata.llm import common
from daystrata.llm.piece_bpe import SPACE, PieceModel
from daystrata.llm.units import LINES, odd_spaces, packed

#: Units, and texts of pairs, remembered per worker; at the limit the memory starts anew.
LIMIT = 400_000
#: Fixed value: how a byte-level vocabulary splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters encoded together.
CHUNK = 1_000_000
#: Id pairs whose counts are sent to the tasks at once; more of them take more passes over the stored links.
SENT_PAIRS = 2_000_000
#: Pairs compared first after an irregular group.
FIRST_STEP = 8
_SHIFT = np.uint64(32)


def stretches(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, int, int, bool]]:
    """(first of a, first of b, tokens of a, tokens of b, whether they pair off one to one), in order.

    ``a`` and ``b`` are rising ends with the same last value.
    """
    x, y, na, nb = a.astype("<i8").tobytes(), b.astype("<i8").tobytes(), len(a), len(b)
    a, b = a.tolist(), b.tolist()
    i = j = 0
    while i < na:
        most = min(na - i, nb - j)
        run, step = 0, FIRST_STEP
        while run + step <= most and x[8 * (i + run) : 8 * (i + run + step)] == y[8 * (j + run) : 8 * (j + run + step)]:
            run, step = run + step, 2 * step
        while step > FIRST_STEP:
            step //= 2
            if run + step <= most and x[8 * (i + run) : 8 * (i + run + step)] == y[8 * (j + run) : 8 * (j + run + step)]:
                run += step
        while run < most and a[i + run] == b[j + run]:
            run += 1
        if run:
            yield i, j, run, run, True
            i, j = i + run, j + run
        if i < na:
            p, q, end, other = i, j, a[i], b[j]
            while end != other:
                if end < other:
                    p += 1
                    end = a[p]
                else:
                    q += 1
                    other = b[q]
            yield i, j, p + 1 - i, q + 1 - j, False
            i, j = p + 1, q + 1


def link_places(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all tokens whose byte ranges overlap: one link for each stretch between two ends."""
    ends = np.sort(np.concatenate((a, b)), kind="stable")
    ends = ends[np.diff(ends, append=-1) != 0]
    return np.searchsorted(a, ends), np.searchsorted(b, ends)


def _byte_values() -> dict[str, int]:
    """Character of a byte-level vocabulary to the byte it stands for: printable Latin-1 for itself, the others from
    U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(other)}


class TokenPair:
    """Ids of whole texts by both vocabularies, looked up by units where both cut: in front of a single space, and
    around a single newline, between visible characters."""

    def __init__(self, bytes_path: str, pieces_path: str) -> None:
        import sentencepiece
        import tiktoken

        self.b = PieceModel(pieces_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        with open(bytes_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        values, merges = _byte_values(), [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Special tokens can't come out of a plain text; the others are ranked by their merges.
        made = [*values, *("".join(m) for m in merges)]
        if any(model["vocab"][token] < 256 for token in made[256:]) or sorted(made[256:], key=model["vocab"].get) != made[256:]:
            raise ValueError("ids don't follow the merges in this vocabulary")
        ranks = {bytes(values[c] for c in token): model["vocab"][token] for token in made}
        self.encoding = tiktoken.Encoding(bytes_path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.bytes_a[k] = token
        self.bytes_b = [bytes([self.b.byte_of[k]]) if k in self.b.byte_of else piece.replace(SPACE, " ").encode() for k, piece in enumerate(self.b.piece)]
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = ([str(k) for k in range(len(table))] for table in (self.bytes_a, self.bytes_b))
        # Places where no piece reaches across, and newlines of one id each, which units rely on.
        self.newline = self.encoding.encode_ordinary("\n"), [self.b.byte_id.get(10, self.b.id.get("\n"))]
        self.cuts = [len(x) for x in self.newline] == [1, 1] and not any("\n" in pair or pair[1] == SPACE != pair[0] for pair in self.b.neighbours)
        self.units_a: dict[str, bytes] = {}
        self.units_b: dict[str, bytes] = {}
        self.bad: set[str] = set()

    def forget(self) -> None:
        self.units_a.clear()
        self.units_b.clear()
        self.bad.clear()

    def _same(self, ids_a: bytes, ids_b: bytes, text: str) -> bool:
        """Whether both id lists give the text's bytes."""
        raw = text.encode()
        return all(b"".join([table[k] for k in np.frombuffer(ids, "<u4").tolist()]) == raw for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))

    def _lines(self, words: list[str]) -> Iterator[list[bytes]]:
        """Ids of words behind a space, as lines of one text, by each vocabulary."""
        for encode, (newline,), start in ((self.encoding.encode_ordinary, self.newline[0], " "), (self.pieces.encode, self.newline[1], "")):
            found: list[bytes] = []
            for k in range(0, len(words), LINES):
                ids = np.array(encode(start + "\n ".join(words[k : k + LINES])), "<u4")
                raw, edges = ids.tobytes(), [-1, *np.flatnonzero(ids == newline).tolist(), len(ids)]
                found += [raw[4 * a + 4 : 4 * b] for a, b in zip(edges, edges[1:])]
            yield found

    def _learn(self, new: list[str]) -> None:
        """A unit begins with a newline, or else stands for itself behind one space."""
        words, rest = [unit for unit in new if unit[:1] != "\n"], [unit for unit in new if unit[:1] == "\n"]
        ids_a, ids_b = self._lines(words)
        ids_a += [packed(self.encoding.encode_ordinary(unit)) for unit in rest]
        ids_b += [packed(list(self.b.stretch(unit))) for unit in rest]
        new = words + rest
        if not len(ids_a) == len(ids_b) == len(new):
            raise ValueError("a newline isn't a unit of its own in this vocabulary")
        self.units_a.update(zip(new, ids_a))
        self.units_b.update(zip(new, ids_b))
        # All at once; unit by unit only where something differs.
        texts = [" " + unit for unit in words] + rest
        raw = "".join(texts).encode()
        if not all(b"".join([table[k] for k in np.frombuffer(b"".join(ids), "<u4").tolist()]) == raw for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
            self.bad.update(unit for unit, *own in zip(new, ids_a, ids_b, texts) if not self._same(*own))

    def _whole(self, text: str) -> tuple[bytes, bytes] | None:
        ids_a, ids_b = packed(self.encoding.encode_ordinary(" " + text)), packed(self.pieces.encode(text))
        return (ids_a, ids_b) if self._same(ids_a, ids_b, " " + text) else None

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """(ids of space and text, ids of text); None for a null or empty text, and where ids don't give the bytes."""
        chunk: list[list[str] | tuple[bytes, bytes] | None] = []
        held = 0
        for text in texts:
            if not text:
                chunk.append(None)
            elif not self.cuts or odd_spaces(text):
                chunk.append(self._whole(text))
            else:
                chunk.append(text.replace("\n", " \n").split(" "))
            held += len(text or "")
            if held >= CHUNK:
                yield from self._known(chunk)
                chunk, held = [], 0
        yield from self._known(chunk)

    def _known(self, chunk):
        if len(self.units_a) > LIMIT:
            self.forget()
        new = set().union(*[x for x in chunk if isinstance(x, list)]).difference(self.units_a)
        if new:
            self._learn(list(new))
        for x in chunk:
            if isinstance(x, list):
                x = None if self.bad and not self.bad.isdisjoint(x) else tuple(b"".join(map(t.__getitem__, x)) for t in (self.units_a, self.units_b))
            yield x and tuple(np.frombuffer(ids, "<u4") for ids in x)

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(texts of the groups, id pairs of all links as ``a << 32 | b``)."""
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        names_a, names_b = [self.text_a[k] for k in ids_a.tolist()], [self.text_b[k] for k in ids_b.tolist()]
        groups: list[str] = []
        for i, j, m, n, paired in stretches(ends_a, ends_b):
            if paired:
                groups += [f"{x}|{y}" for x, y in zip(names_a[i : i + m], names_b[j : j + n])]
            else:
                groups.append(f"{','.join(names_a[i : i + m])}|{','.join(names_b[j : j + n])}")
        at_a, at_b = link_places(ends_a, ends_b)
        return groups, ids_a[at_a].astype(np.uint64) << _SHIFT | ids_b[at_b]


_MADE: dict[tuple[str, str], TokenPair] = {}


def token_pair(bytes_path: str, pieces_path: str) -> TokenPair:
    """One per worker process and pair of files."""
    key = bytes_path, pieces_path
    if key not in _MADE:
        _MADE[key] = TokenPair(*key)
    common.remembers(f"alignment {key}", _MADE[key].forget)
    return _MADE[key]


def aligned(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every whole text.

    ``groups`` is ``a1,a2|b1;a3|b2`` with all ids of the text; ``pairs`` and ``times`` are its distinct linked id
    pairs (unsigned 64-bit, a in the upper half, rising) and how often each is linked (unsigned 32-bit).  A null or
    empty text, and one whose ids don't give its bytes in either vocabulary, has zeros and empty values.  Null and
    repeated doc_ids are documents like others; other columns are ignored; an empty table gives no rows.
    """
    return _aligned(docs, bytes_path, pieces_path, digest=False)


def _aligned(docs: DataFrame, bytes_path: str, pieces_path: str, digest: bool) -> DataFrame:
    groups_column = "groups_sha256" if digest else "groups"

    def run(batches):
        own = token_pair(bytes_path, pieces_path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sizes, texts, pairs, times = [], [], [], []
                for ids in own.encode(t.as_py() for t in part.column(1)):
                    groups, links = own.align(*ids) if ids else ([], np.zeros(0, np.uint64))
                    found, count = np.unique(links, return_counts=True)
                    sizes.append((len(ids[0]), len(ids[1]), len(groups), len(links)) if ids else (0, 0, 0, 0))
                    text = ";".join(groups)
                    texts.append(hashlib.sha256(text.encode()).hexdigest() if digest and ids else text)
                    pairs.append(found.astype("<u8").tobytes())
                    times.append(count.astype("<u4").tobytes())
                counts = [pa.array(column, pa.int64()) for column in zip(*sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts, pa.array(texts, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", groups_column, "pairs", "times"])

    schema = f"doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, {groups_column} string, pairs binary, times binary"
    return common.map_batches(common.columns(docs, doc_id="bigint", text="string"), run, schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, docs, best): how many rows of ``linked`` hold an id pair, and whether that is the most of its ``a``.

    A task sums its own documents first, so a pair that all of them hold is one row of each task.
    """
    def count(batches):
        held, rows = [], 0

        def summed():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            low = found & np.uint64(0xFFFFFFFF)
            return pa.RecordBatch.from_arrays([pa.array((found >> _SHIFT).astype(np.int64)), pa.array(low.astype(np.int64)), pa.array(n)], ["a", "b", "docs"])

        for batch in batches:
            held += [np.frombuffer(x.as_py(), "<u8") for x in batch.column(0)]
            rows += sum(map(len, held[-batch.num_rows:])) if batch.num_rows else 0
            if rows > 4_000_000:
                yield summed()
                held, rows = [], 0
        if rows:
            yield summed()

    sums = common.map_batches(linked.select("pairs"), count, "a bigint, b bigint, docs bigint").groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    # At most as many rows of one ``a`` as there are pieces.
    return sums.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy("a")))


def with_counts(linked: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``linked`` (stored) with ``n_best``, its links whose pair count is the highest of their ``a``, and ``count_sum``,
    the sum of the counts over its links.

    The pair table is counted first.  Up to ``sent_pairs`` of it are sent to the tasks; a larger one is dealt into
    parts by ``a``, and every part is one pass that adds to the sums so far.  So no pair is a key of a join, however
    many documents hold it.
    """
    table = common.stored(pair_counts(linked), "pair-counts")
    passes = max(1, -(-table.count() // sent_pairs))
    carried = linked.columns
    names = [*carried, "n_best", "count_sum"]
    done = linked.withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})
    for k in range(passes):
        part = table.filter(F.pmod(F.xxhash64("a"), F.lit(passes)) == k).toArrow()
        a, b, docs, best = (part.column(c).to_numpy() for c in ("a", "b", "docs", "best"))
        keys = a.astype(np.uint64) << _SHIFT | b.astype(np.uint64)
        order = np.argsort(keys)
        shared = linked.sparkSession.sparkContext.broadcast((keys[order], docs[order], best[order]))

        def add(batches, shared=shared):
            keys, docs, best = shared.value
            for batch in batches:
                at = {n: batch.schema.get_field_index(n) for n in names}
                sums = {n: batch.column(at[n]).to_numpy(zero_copy_only=False).copy() for n in ("n_best", "count_sum")}
                for row, (pairs, times) in enumerate(zip(batch.column(at["pairs"]), batch.column(at["times"]))):
                    own, n = np.frombuffer(pairs.as_py(), "<u8"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
                    place = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
                    hit = keys[place] == own if len(keys) else np.zeros(len(own), bool)
                    place, n = place[hit], n[hit]
                    sums["n_best"][row] += n[best[place]].sum()
                    sums["count_sum"][row] += (n * docs[place]).sum()
                yield pa.RecordBatch.from_arrays([*[batch.column(at[n]) for n in carried], *[pa.array(sums[n]) for n in ("n_best", "count_sum")]], names)

        done = common.map_batches(done.select(*names), add, done.select(*names).schema)
        if k + 1 < passes:
            done = common.stored(done, "pair-sums")
    return done


def digests(docs: DataFrame, bytes_path: str, pieces_path: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): what :func:`aligned` gives, the groups
    as a digest ('' without tokens).  Rows and nulls as there."""
    linked = common.stored(_aligned(docs, bytes_path, pieces_path, digest=True), "links")
    return with_counts(linked, sent_pairs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
