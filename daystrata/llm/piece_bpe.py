"""Encoding and decoding with a merge-type piece model, by a table of prefixes.

The encoding of a text's prefix ends in exactly one token, and that token can be found from the table so
far: of the tokens that end at a place, which an automaton lists, it is the one that is compatible with
the last token of the prefix before it.  Two tokens are compatible when merging their joined text gives
the two again.  The ids are then read backwards along the table.

A place between two characters that are neighbours in no piece can never lie inside a token, so a text
falls into independent stretches there, and the table is made once for each stretch and remembered.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from daystrata.llm import common

SPACE = "▁"
_STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Entries remembered per worker and table; at the limit the memory starts anew.
LIMIT = 1_000_000


class PieceModel:
    """Exact ids and texts of a merge-type model with byte fallback and no text normalisation."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        if library.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("the model changes texts before encoding; only models that don't are supported")
        self.end_id, self.unknown = library.eos_id(), library.unk_id()
        self.piece = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.control: set[int] = set()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.neighbours: set[str] = set()
        self.tokens = ahocorasick.Automaton()
        for i, piece in enumerate(self.piece):
            if library.is_byte(i):
                self.byte_id[int(piece[3:5], 16)], self.byte_of[i] = i, int(piece[3:5], 16)
            elif library.is_control(i) or library.is_unknown(i):
                self.control.add(i)
            else:
                self.rank[piece], self.id[piece] = library.get_score(i), i
                self.neighbours.update(a + b for a, b in zip(piece, piece[1:]))
                self.tokens.add_word(piece, (i, len(piece)))
        self.tokens.make_automaton()
        self._alone: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}
        self._stretches: dict[str, tuple[int, ...]] = {}
        self.decimal: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def forget(self) -> None:
        for memory in (self._alone, self._pairs, self._stretches, self.decimal, self.decoded):
            memory.clear()

    def _merged(self, text: str) -> list[str]:
        """The definition, for a short text: join the neighbours with the best score, the left-most of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.rank.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def alone(self, token: int) -> bool:
        """Whether the token's own text is encoded as that token."""
        if token not in self._alone:
            self._alone[token] = self._merged(self.piece[token]) == [self.piece[token]]
        return self._alone[token]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        if key not in self._pairs:
            if len(self._pairs) >= LIMIT:
                self._pairs.clear()
            a, b = self.piece[left], self.piece[right]
            # Two that merge into a token never stay apart.
            self._pairs[key] = a + b not in self.rank and self._merged(a + b) == [a, b]
        return self._pairs[key]

    def stretch(self, text: str) -> tuple[int, ...]:
        """Ids of a text in which spaces are already marked."""
        last: list[int] = [-1] * (len(text) + 1)
        alone, pairs = self._alone, self._pairs
        for end, (token, length) in self.tokens.iter(text):
            if last[end + 1] >= 0:
                continue
            fits = alone.get(token)
            if not (self.alone(token) if fits is None else fits):
                continue
            before = last[end + 1 - length] if length <= end else -1
            if before >= 0:
                fits = pairs.get(before << 32 | token)
                if not (self.compatible(before, token) if fits is None else fits):
                    continue
            last[end + 1] = token
        ids, place = [], len(text)
        while place:
            token = last[place]
            if token < 0:  # a character outside the vocabulary: its bytes
                raw = text[place - 1].encode()
                ids += [self.byte_id[b] for b in reversed(raw)] if self.byte_id else [self.unknown]
                place -= 1
            else:
                ids.append(token)
                place -= len(self.piece[token])
        return tuple(reversed(ids))

    def _unit(self, unit: str) -> tuple[int, ...]:
        """Ids of a unit, by its stretches between characters that are neighbours in no piece."""
        start, ids = 0, ()
        for k in range(1, len(unit) + 1):
            if k == len(unit) or unit[k - 1 : k + 1] not in self.neighbours:
                text = unit[start:k]
                if text not in self._stretches:
                    if len(self._stretches) >= LIMIT:
                        self._stretches.clear()
                    self._stretches[text] = self.stretch(text)
                ids += self._stretches[text]
                start = k
        return ids

    def units(self, text: str) -> list[str]:
        """The text with spaces marked, cut in front of runs of them where no piece reaches across."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        found = _STRETCH.findall(marked)
        units = found[:1]
        for unit in found[1:]:
            if units[-1][-1] + unit[0] in self.neighbours:
                units[-1] += unit
            else:
                units.append(unit)
        return units

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self._unit(unit)]

    def decode(self, ids, first: bool = True) -> str:
        """Text of ids; ``first`` drops the one space that encoding puts before a text."""
        parts: list[str] = []
        raw = bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(raw.decode(errors="replace"))
                raw.clear()
            if i >= 0 and i not in self.control:
                parts.append(self.piece[i])
            elif i == self.unknown:
                parts.append(f"{SPACE}⁇{SPACE}")
        text = "".join(parts)
        return (text.removeprefix(SPACE) if first else text).replace(SPACE, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids with the end id, ids in decimal with one space between, text decoded from them)."""
        units = self.units(text)
        for unit in set(units).difference(self.decimal):
            if len(self.decimal) >= LIMIT:
                self.decimal.clear()
                self.decoded.clear()
                return self.digest(text) if len(set(units)) < LIMIT else self._plain(text)
            ids = self._unit(unit)
            self.decimal[unit], self.decoded[unit] = " ".join(map(str, ids)), self.decode(ids, first=False)
        numbers = " ".join([*map(self.decimal.__getitem__, units), str(self.end_id)])
        back = "".join(map(self.decoded.__getitem__, units))
        return numbers.count(" ") + 1, numbers, back[1:] if back[:1] == " " else back

    def _plain(self, text: str) -> tuple[int, str, str]:
        ids = [*self.encode(text), self.end_id]
        return len(ids), " ".join(map(str, ids)), self.decode(ids)


_MADE: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MADE:
        _MADE[path] = PieceModel(path)
    common.remembers(f"pieces {path}", _MADE[path].forget)
    return _MADE[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array, decoded): ids of every whole text with the end id, and the text decoded from them.

    A null or empty text is the end id alone and decodes to an empty text.  Null and repeated doc_ids are
    documents like others; other columns are ignored; an empty table gives no rows.
    """
    def encode(batches):
        own = model(path)
        for batch in batches:
            ids = [[*own.encode(t.as_py() or ""), own.end_id] for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array([own.decode(x) for x in ids], pa.string()),
            })

    return common.map_batches(common.columns(docs, doc_id="bigint", text="string"), encode, "doc_id bigint, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what ``encode_documents`` gives, as digests, so that the
    ids stay in the tasks.  Rows and nulls as there."""
    def digest(batches):
        own = model(path)
        for batch in batches:
            n, ids, back = [], [], []
            for text in batch.column(1):
                count, numbers, decoded = own.digest(text.as_py() or "")
                n.append(count)
                ids.append(hashlib.sha256(numbers.encode()).hexdigest())
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(back, pa.string()),
            })

    return common.map_batches(common.columns(docs, doc_id="bigint", text="string"), digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
