"""URL rules looked up in Bloom filter cascades.

A rule is a host with a path: it fits the host and all its subdomains where the url's path starts with its own.
So the keys of a url are the ends of its host at dots, each joined with the starts of its path that are as long as
some rule's path.  The first filter of a cascade encodes the listed keys; the second one the keys of the corpus
that pass the first by chance; the third the listed keys that pass the second by chance, and so on until a filter
passes nothing by chance.  A key of the corpus is listed exactly if the first filter that it fails is an even one,
counted from one, so a task answers from a few bits of memory and no row is joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from daystrata.llm import common

#: Listed keys in one pair of cascades; more of them are dealt by hash, and each part is one pass over the urls.
PART_KEYS = 4_000_000
#: Keys a task remembers while it looks for chance passes.
_SEEN = 100_000
#: Bits a filter has at least, so that short lists need few levels.
LEAST_BITS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = "host string, path string, action string"


class Filter:
    """A Bloom filter; a level has hashes of its own."""

    def __init__(self, n: int, chance: float, level: int) -> None:
        self.level = level
        self.hashes = max(1, round(math.log2(1 / chance)))
        self.bits = max(LEAST_BITS, math.ceil(n * self.hashes / math.log(2)))
        self.words = np.zeros(-(-self.bits // 64), np.uint64)

    def places(self, keys: list[str]) -> np.ndarray:
        both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k.encode(), seed=self.level) for k in keys]), "<u8").reshape(-1, 2)
        turn = np.arange(self.hashes, dtype=np.uint64)
        return (both[:, :1] + turn * (both[:, 1:] | np.uint64(1))) % np.uint64(self.bits)

    def marks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, bits set in them) of some keys."""
        places = np.unique(self.places(keys).ravel())
        words, first = np.unique(places >> np.uint64(6), return_index=True)
        bits = np.uint64(1) << (places & np.uint64(63))
        return words, np.bitwise_or.reduceat(bits, first) if len(first) else bits

    def passes(self, keys: list[str]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        places = self.places(keys)
        return ((self.words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).astype(bool).all(axis=1)


class Cascade:
    """Filters in order; none means that nothing is listed."""

    def __init__(self, filters: list[Filter]) -> None:
        self.filters = filters

    def listed(self, keys: list[str]) -> np.ndarray:
        found, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for number, one in enumerate(self.filters):
            if not len(left):
                break
            fits = one.passes([keys[k] for k in left])
            # Who fails an even filter is in the set of the one before; who passes all is in the set of the last.
            found[left[~fits]] = number % 2 == 1
            left = left[fits]
        found[left] = len(self.filters) % 2 == 1
        return found


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.  Path: from there up to
    ``?``, ``#`` or the end.  Both empty for a null url and one without ``://``."""
    parts = [F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit("")) for k in (1, 2)]
    return F.translate(parts[0], UPPER, LOWER), parts[1]


def url_keys(host: str, path: str, lengths: list[int]) -> Iterator[tuple[str, int]]:
    """(key, length of its host) of every rule that could fit: ends of the host at dots, starts of the path."""
    starts = [path[:n] for n in lengths if n <= len(path)]
    at = 0
    while True:
        for start in starts:
            yield host[at:] + start, len(host) - at
        at = host.find(".", at) + 1
        if not at:
            return


def _mapped_keys(df: DataFrame, function) -> DataFrame:
    """Keys for which ``function(list of keys)`` is true; a task gives a key again only after many others."""
    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            new = list(dict.fromkeys(k for k in function(batch) if k not in seen))
            if len(seen) > _SEEN:
                seen.clear()
            seen.update(new)
            yield pa.RecordBatch.from_pydict({"key": pa.array(new, pa.string())})

    return common.map_batches(df, run, "key string")


def _filter(keys: DataFrame, n: int, chance: float, level: int) -> Filter:
    """A filter of ``n`` keys, its bits set where the keys are and joined word by word."""
    made = Filter(n, chance, level)

    def mark(batches):
        for batch in batches:
            words, bits = made.marks(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_pydict({"word": pa.array(words.astype(np.int64)), "bits": pa.array(bits.view(np.int64))})

    words = common.map_batches(keys.select("key"), mark, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = Filter(n, chance, level)
    filled.words[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return filled


def _passing(keys: DataFrame, one: Filter) -> DataFrame:
    def fits(batch):
        own = batch.column(0).to_pylist()
        return [k for k, fit in zip(own, one.passes(own)) if fit]

    return common.stored(_mapped_keys(keys.select("key"), fits), "passing")


def cascade(listed: DataFrame, parts: DataFrame, rows: int, lengths: list[int]) -> Cascade:
    """The filters that tell ``listed`` (key; stored, distinct) from all other keys of ``parts`` (host, path).

    The filter of the listed keys lets about as many other keys pass as there are listed ones; every later filter
    lets one in two pass.  Only keys that pass are shuffled, once each from a task, and the bits of a filter are
    bounded by ``PART_KEYS``.
    """
    n = listed.count()
    if not n:
        return Cascade([])
    filters = [_filter(listed, n, min(0.5, max(n / (4.0 * max(rows, 1)), 2.0**-50)), 0)]
    first = filters[0]

    def fits(batch):
        own = list(dict.fromkeys(k for h, p in zip(*(c.to_pylist() for c in batch.columns)) for k, _ in url_keys(h, p, lengths)))
        return [k for k, fit in zip(own, first.passes(own)) if fit]

    chance = _mapped_keys(parts.select("host", "path"), fits).distinct().join(listed, "key", "left_anti")
    # The set to encode next, and the one it has to be told from.
    inner, outer = common.stored(chance, "chance"), listed
    while n := inner.count():
        filters.append(_filter(inner, n, 0.5, len(filters)))
        inner, outer = _passing(outer, filters[-1]), inner
    return Cascade(filters)


def judge(urls: DataFrame, rules: DataFrame, part_keys: int = PART_KEYS, unlisted: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``urls`` (page_id, url).

    ``rules`` has host, path and action (allow or block); hosts count in lower case, nulls as empty.  Of the rules
    that fit a url the longest text wins, of equal ones that with the longer host; a rule given with both actions
    blocks.  A url without rule isn't listed: its rule is null and its verdict ``unlisted``.  A null url and one
    without ``://`` have an empty host and path; null and repeated page_ids are rows like others; other columns are
    ignored; an empty table gives no rows, and without rules nothing is listed.

    To the driver and every task come the filters of at most ``part_keys`` listed keys at a time, and the distinct
    lengths of rule paths.  A longer list is dealt by hash; each part is one more pass over the urls.
    """
    host, path = host_and_path("url")
    parts = common.columns(urls, page_id="bigint", url="string").select("page_id", host.alias("host"), path.alias("path"))
    named = common.columns(rules, host="string", path="string", action="string").fillna("", ["host", "path"]).withColumn("host", F.translate("host", UPPER, LOWER))
    listed = common.stored(named.groupBy(F.concat("host", "path").alias("key"), F.length("path").alias("n")).agg(
        F.max((F.col("action") == "block").cast("int")).alias("blocks")), "rules")
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())
    rows, passes = parts.count(), max(1, -(-listed.count() // part_keys))
    done = parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(0).alias("host_size"), F.lit(False).alias("blocks"))
    schema = done.schema
    for k in range(passes):
        own = common.stored(listed.filter(F.pmod(F.xxhash64("key"), F.lit(passes)) == k).select("key", "blocks").distinct(), "listed")
        both = tuple(cascade(common.stored(own.filter(F.col("blocks") == b).select("key"), "keys"), parts, rows, lengths) for b in (1, 0))
        shared = urls.sparkSession.sparkContext.broadcast(both)

        def look(batches, shared=shared):
            blocked, allowed = shared.value
            for batch in batches:
                ids, hosts, paths, rule, sizes, blocks = (c.to_pylist() for c in batch.columns)
                found = [list(url_keys(h, p, lengths)) for h, p in zip(hosts, paths)]
                keys = list({key for own in found for key, _ in own})
                block = {key for key, hit in zip(keys, blocked.listed(keys)) if hit}
                fit = block | {key for key, hit in zip(keys, allowed.listed(keys)) if hit}
                for row, own in enumerate(found):
                    for key, size in own:
                        if key in fit and (rule[row] is None or (len(key), size) > (len(rule[row]), sizes[row])):
                            rule[row], sizes[row], blocks[row] = key, size, key in block
                arrays = [batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(sizes, pa.int32()), pa.array(blocks, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

        done = common.map_batches(done, look, schema)
        if k + 1 < passes:
            done = common.stored(done, "judged")
    verdict = F.when(F.col("rule").isNull(), F.lit(unlisted)).when(F.col("blocks"), F.lit("block")).otherwise(F.lit("allow"))
    return done.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
