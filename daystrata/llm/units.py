"""Ids of whole texts as the ``tokenizers`` library gives them, looked up unit by unit.

Both vocabularies cut a text at fixed places before any merge: between a word and the white space
around it, and between a letter and the punctuation that follows.  The ids of a text are therefore the
ids of its units in a row, and a unit is encoded by the library once and remembered.  A text that holds
the string of an added token goes to the library whole.
"""

from __future__ import annotations

import codecs
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from daystrata.llm import common

# The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
_ODD_ASCII = ("\0", "\t", "\x0b", "\x0c", "\r", "  ", " \n", "\n ", "\n\n")
_ODD_OTHER = re.compile("[\x85\xa0  -     　]")
_RUNS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# ASCII punctuation without the apostrophe, which can start a contraction, and the letters that it may follow.
_MARKS = "".join(x for x in map(chr, range(33, 127)) if not x.isalnum() and x != "'")
_LETTERS = frozenset(x for x in map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]) if x.isalpha())
# The library's own pattern never cuts Latin letters with at most one space before them.
_PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
# The same texts as ``odd_spaces`` finds.
_ODD_TEXT = r"^[ \n]|[ \n]$|[ \n]{2}|[\x00\t\x0b-\r" + _ODD_OTHER.pattern[1:]
_IS_MARK, _IS_LETTER, _IS_LATIN1 = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_IS_WHITE = np.isin(np.arange(256), [*range(9, 14), 32])
_IS_MARK[[ord(x) for x in _MARKS]] = True
_IS_LETTER[[ord(x) for x in _LETTERS if x.isascii()]] = True
_IS_LATIN1[[x.encode()[1] for x in _LETTERS if not x.isascii()]] = True  # second bytes, after C3
# No text in UTF-8 has the byte FF, so it can stand between words.
_BETWEEN = "\xff"
# Characters of byte-level vocabularies for the 256 bytes; a newline becomes the mark between words.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = "".join(_BETWEEN if b == 10 else chr(b) if b in _VISIBLE else chr(256 + b - sum(x < b for x in _VISIBLE)) for b in range(256))
_WHITES = frozenset(["", *(chr(c) for c in range(0x3001) if re.match(f"[{WHITE}]", chr(c)))])
#: Parts encoded in one call.
LINES = 4096
#: Latin words merged as one, longer than what the library itself remembers.
JOINED = 64
#: Characters encoded together; bounds what is held at once beside the memory of units.
CHUNK = 1_000_000
#: Bytes of texts whose distinct units are looked up together.
BATCH = 4_000_000
#: Units remembered per worker, about 200 MB of typical ones; at the limit the memory starts anew.
LIMIT = 1_200_000


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def odd_spaces(text: str) -> bool:
    """Whether other white space than one space or newline between words is in the text."""
    ends = text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")
    return ends or any(x in text for x in _ODD_ASCII) or (not text.isascii() and _ODD_OTHER.search(text) is not None)


class UnitIds:
    """``encode`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        raise NotImplementedError

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """A null text is an empty one."""
        raise NotImplementedError

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)


def _strings(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends of the texts in them with 0 in front) of an array without nulls."""
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _between_cuts(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The pieces of the data as strings, without a copy of it."""
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))


def _marks_after_letters(data: np.ndarray) -> np.ndarray:
    marks = np.flatnonzero(_IS_MARK[data])
    marks = marks[marks > 0]
    last = data[marks - 1]
    return marks[_IS_LETTER[last] | (_IS_LATIN1[last] & (data[marks - 2] == 0xC3))]


class GatheredIds(UnitIds):
    """A batch of texts is cut where its bytes say so, its distinct units are looked up, and their ids, which are kept in
    one array, are gathered for all texts at once.
    """

    def forget(self) -> None:
        self.units: dict[str, int] = {}
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def encode(self, texts):
        def chunks():
            some, held = [], 0
            for text in texts:
                some.append(text)
                held += len(text or "")
                if held >= CHUNK:
                    yield some
                    some, held = [], 0
            yield some

        for some in chunks():
            for ids, lengths in self.batches(pa.array(some, pa.string())):
                raw, ends = ids.tobytes(), [0, *np.cumsum(lengths).tolist()]
                yield from (raw[4 * a : 4 * b] for a, b in zip(ends, ends[1:]))

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of some texts in a row, number of ids of each), for one batch of texts after the other."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < len(texts):
            last = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BATCH)) + 1
            yield self._batch(pc.fill_null(texts.slice(first, last - first).cast(pa.string()), ""))
            first = last

    def learn(self, units: list[str]) -> None:
        """Remembers distinct units."""
        raise NotImplementedError

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts in a row, number of ids of each)."""
        raise NotImplementedError

    def _added(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold the string of an added token."""
        added = np.zeros(len(texts), bool)
        for content in self.added:
            added |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        return added

    def _full(self) -> bool:
        return len(self.units) > LIMIT or len(self.ids) > 8 * LIMIT

    def _wholes(self, texts: pa.Array, which: np.ndarray) -> np.ndarray:
        """Numbers of some texts' ids.  They aren't remembered by their text, only for this batch."""
        made = [np.frombuffer(self.whole(texts[k].as_py()), "<u4") for k in which.tolist()]
        return self._keep(np.concatenate(made), np.array([len(x) for x in made]))

    def _gathered(self, numbered: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered units, and how many lie between the edges."""
        n = self.lengths[numbered]
        after = np.concatenate(([0], np.cumsum(n)))
        places = np.repeat(self.starts[numbered] - after[:-1], n)
        places += np.arange(after[-1])
        return self.ids[places], np.diff(after[edges])

    def _known(self, units: list[str]) -> np.ndarray:
        """Numbers of units."""
        found = np.array(list(map(self.units.get, units, repeat(-1))), np.int64)
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new = [units[k] for k in unknown.tolist()]
            self.learn(list(dict.fromkeys(new)))
            found[unknown] = list(map(self.units.__getitem__, new))
        return found

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers for sequences of the given lengths, that come in a row."""
        first, starts = len(self.starts), len(self.ids) + np.cumsum(lengths) - lengths
        self.starts, self.lengths = np.concatenate((self.starts, starts)), np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids))
        return np.arange(first, len(self.starts))


class ByteLevelIds(GatheredIds):
    """Byte-level vocabulary: a unit is a word with the one space before it, a row of marks after a letter with what
    follows up to the next cut, or a run of white space."""

    newline: int | None = None

    def __init__(self, path: str) -> None:
        super().__init__(path)
        from tokenizers import Tokenizer, models, pre_tokenizers

        #: The merges alone, for words that need no cut, with the id that stands between them.
        self.merges, self.between, own, model = None, -1, self.library.pre_tokenizer, self.library.model
        searched = isinstance(own, pre_tokenizers.ByteLevel) and own.use_regex and not own.add_prefix_space and self.library.normalizer is None
        if searched and isinstance(model, models.BPE) and not any(
            (model.dropout, model.unk_token, model.continuing_subword_prefix, model.end_of_word_suffix, model.ignore_merges)
        ):
            # Without another entry that has the mark no merge reaches over it.
            vocabulary = self.library.get_vocab()
            if [x for x in vocabulary if _BETWEEN in x] == [_BETWEEN] and vocabulary.keys() >= set(_ALPHABET):
                self.merges, self.between = Tokenizer(model), vocabulary[_BETWEEN]

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self._full():
            self.forget()
        # Texts with other white space or added tokens stand aside; their runs come last and then go to their place.
        added = self._added(texts)
        aside = added | pc.match_substring_regex(texts, _ODD_TEXT).to_numpy(zero_copy_only=False)
        runs, numbers = [], np.zeros(len(texts), np.int64)
        for k in np.flatnonzero(aside & ~added).tolist():
            found = _RUNS.findall(texts[k].as_py())
            runs += found
            numbers[k] = len(found)
        data, ends = _strings(pc.if_else(pa.array(aside), "", texts) if aside.any() else texts)
        cuts = self._cuts(data, ends, True)
        units = _between_cuts(data, cuts)
        if runs:
            odd, run_ends = _strings(pa.array(runs, pa.string()))
            odd_cuts = self._cuts(odd, run_ends, False)
            numbers = np.diff(np.searchsorted(odd_cuts, run_ends[np.cumsum(numbers)]), prepend=0)
            units = pa.concat_arrays([units, _between_cuts(odd, odd_cuts)])
        coded = units.dictionary_encode()
        numbered = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        edges = np.searchsorted(cuts[:-1], ends)
        if aside.any():
            ordinary, odd = np.split(numbered, [len(cuts) - 1])
            whole = np.flatnonzero(added)
            if len(whole):
                odd = np.insert(odd, (np.cumsum(numbers) - numbers)[whole], self._wholes(texts, whole))
                numbers[whole] = 1
            numbered = np.insert(ordinary, np.repeat(edges[:-1], numbers), odd)
            edges = edges + np.concatenate(([0], np.cumsum(numbers)))
        return self._gathered(numbered, edges)

    @staticmethod
    def _cuts(data: np.ndarray, ends: np.ndarray, spaces: bool) -> np.ndarray:
        """Where units begin, and the end of the data: at the given places, at marks after a letter, and if asked at
        spaces, newlines and behind newlines."""
        cut = np.zeros(len(data) + 1, bool)
        if spaces:
            newline = data == 10
            cut[:-1] = (data == 32) | newline
            cut[1:] |= newline
        cut[ends] = True
        cut[_marks_after_letters(data)] = True
        return np.flatnonzero(cut)

    def learn(self, units: list[str]) -> None:
        """Units that end in a visible character are encoded together with something between them that has one id of its
        own there, which no such unit has: a newline, or for Latin words, that go to the merges at once, another byte."""
        if self.newline is None:
            ids = self.library.encode("\n", add_special_tokens=False).ids
            self.newline = ids[0] if len(ids) == 1 else -1

        def joined(some: list[str]):
            lines = ("\n".join(some[k : k + JOINED]).encode() for k in range(0, len(some), JOINED))
            return self.merges.encode_batch_fast([codecs.charmap_decode(x, "strict", _ALPHABET)[0] for x in lines], add_special_tokens=False)

        def lines(some: list[str]):
            return self.library.encode_batch_fast(["\n".join(some)], add_special_tokens=False)

        latin, plain, rest = [], [], []
        for unit in units:
            if self.merges is not None and _PLAIN.fullmatch(unit):
                latin.append(unit)
            elif self.newline >= 0 and unit[-1:] not in _WHITES and "\0" not in unit:
                plain.append(unit)
            else:
                rest.append(unit)
        alone = [found.ids for found in self.library.encode_batch_fast(rest, add_special_tokens=False)] if rest else []
        known = [(np.array([*chain.from_iterable(alone)], "<u4"), np.array([len(x) for x in alone], np.int64))]
        known += [self._between(latin, joined, self.between), self._between(plain, lines, self.newline)]
        numbers = self._keep(*map(np.concatenate, zip(*known)))
        self.units.update(zip(chain(rest, latin, plain), numbers.tolist()))

    def _between(self, units: list[str], together, mark: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in a row, number of each) from encodings of many units with a mark's id between them."""
        found, lengths = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for k in range(0, len(units), LINES):
            some = units[k : k + LINES]
            ids = np.array([*chain.from_iterable((*x.ids, mark) for x in together(some))], "<u4")
            ends = np.flatnonzero(ids == mark)
            if len(ends) != len(some):
                raise ValueError("the mark between units isn't one of its own in this vocabulary")
            found.append(ids[ids != mark])
            lengths.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(found), np.concatenate(lengths)


class WordIds(GatheredIds):
    """Word vocabulary: white space is dropped, so a unit is a word, or its part from a mark after a letter on; ASCII
    units are in lower case."""

    def _batch(self, texts):
        if self._full():
            self.forget()
        added = self._added(texts)
        plain = pc.if_else(pa.array(added), "", texts) if added.any() else texts
        if pc.any(pc.match_substring_regex(plain, _ODD_OTHER.pattern)).as_py():
            plain = pc.replace_substring_regex(plain, _ODD_OTHER.pattern, " ")
        data, ends = _strings(plain)
        cut, white = np.zeros(len(data) + 1, bool), _IS_WHITE[data]
        cut[:-1] = white
        cut[1:] |= white
        cut[ends] = True
        cut[_marks_after_letters(data)] = True
        cuts = np.flatnonzero(cut)
        words = ~white[cuts[:-1]]
        edges = np.concatenate(([0], np.cumsum(words)))[np.searchsorted(cuts[:-1], ends)]
        coded = _between_cuts(data, cuts).filter(pa.array(words)).dictionary_encode()
        units = coded.dictionary
        units = pc.if_else(pc.string_is_ascii(units), pc.ascii_lower(units), units)
        numbered = self._known(units.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        whole = np.flatnonzero(added)
        if len(whole):
            numbered = np.insert(numbered, edges[whole], self._wholes(texts, whole))
            edges = edges + np.concatenate(([0], np.cumsum(added)))
        return self._gathered(numbered, edges)

    def learn(self, units):
        ids, lengths = [], []
        for k in range(0, len(units), LINES):
            found = [x.ids for x in self.library.encode_batch_fast(units[k : k + LINES], add_special_tokens=False)]
            ids.append(np.array([*chain.from_iterable(found)], "<u4"))
            lengths.append(np.array([len(x) for x in found], np.int64))
        self.units.update(zip(units, self._keep(np.concatenate(ids), np.concatenate(lengths)).tolist()))


_MADE: dict[tuple[type, str], UnitIds] = {}


def unit_ids(kind: type[UnitIds], path: str) -> UnitIds:
    """One encoder per worker process and file."""
    if (kind, path) not in _MADE:
        _MADE[kind, path] = kind(path)
    own = _MADE[kind, path]
    common.remembers(f"units {kind.__name__} {path}", own.forget)
    return own
