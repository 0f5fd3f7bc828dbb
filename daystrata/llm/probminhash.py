"""Near-duplicates by probability Jaccard of weighted word shingles.

Each shingle is a Poisson process whose rate is its share of the document's shingles; its arrivals fall into
random slots, and a slot keeps the shingle that arrives first.  Two documents agree in a slot with the
probability Jaccard similarity of their weights.  Generation stops once no shingle can still arrive before
the latest filled slot.  Slots form bands; documents that share a band are compared exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from daystrata.llm import common, links

WORDS = 5
BANDS, ROWS = 24, 6
THRESHOLD = 0.8
#: A pair of one band is compared exactly when its slots agree at least this often; four standard errors
#: of 144 slots below the threshold.
ESTIMATE = 0.66
#: Rows of a block when the rest of a large bucket is compared in blocks.
BLOCK = 512
#: Words whose hashes a worker remembers, about 40 MB.
_WORD_LIMIT = 300_000
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each result bit depends on every input bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the windows of five words; a shorter text with a word has one window."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - WORDS + 1)
    h = np.full(n, len(w) if len(w) < WORDS else 0, np.uint64)
    for k in range(min(WORDS, len(w))):
        h = h * _U(0x9E3779B97F4A7C15) + w[k : k + n]
    found, counts = np.unique(mixed(h), return_counts=True)
    return found, counts.astype(float)


def sketch(hashes: np.ndarray, weights: np.ndarray, slots: int) -> np.ndarray:
    """The hash of the first shingle to arrive in every slot."""
    first, kept = np.full(slots, np.inf), np.zeros(slots, np.uint64)
    rate = weights / weights.sum()
    clock, step = np.zeros(len(hashes)), 0
    while len(hashes):
        # So many arrivals of each shingle at once that small documents need few rounds.
        each = max(1, -(-slots * 6 // len(hashes))) if step == 0 else max(1, -(-64 // len(hashes)))
        turn = np.arange(step, step + each, dtype=np.uint64)
        draw = mixed(hashes[:, None] + (turn + _U(1)) * _U(0x9E3779B97F4A7C15))
        gap = -np.log(((draw >> _U(11)).astype(float) + 1.0) * 2.0**-53) / rate[:, None]
        time = clock[:, None] + np.cumsum(gap, axis=1)
        slot = (mixed(draw) % _U(slots)).astype(np.int64)
        reach = first.max()
        flat = np.flatnonzero(time.ravel() < reach)
        order = flat[np.argsort(-time.ravel()[flat], kind="stable")]
        # Written from late to early, so the earliest arrival of a slot stays.
        new, owner = np.full(slots, np.inf), np.zeros(slots, np.int64)
        new[slot.ravel()[order]] = time.ravel()[order]
        owner[slot.ravel()[order]] = order // each
        better = new < first
        first[better], kept[better] = new[better], hashes[owner[better]]
        go = time[:, -1] < first.max()
        hashes, rate, clock, step = hashes[go], rate[go], time[go, -1], step + each
    return kept


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact: over common shingles d, the sum of 1 / sum over e of max(a(e)/a(d), b(e)/b(d))."""
    common_, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common_):
        return 0.0
    wa, wb = a[1] / a[1].sum(), b[1] / b[1].sum()
    xa, xb = wa[at], wb[bt]
    # By the ratio a/b of an element, either its a or its b counts: two running sums over the sorted ratios.
    order = np.argsort(xa / xb, kind="stable")
    xa, xb, ratio = xa[order], xb[order], (xa / xb)[order]
    only_a, only_b = wa.sum() - xa.sum(), wb.sum() - xb.sum()
    first, last = np.searchsorted(ratio, ratio, "left"), len(ratio)
    b_below = np.concatenate(([0.0], np.cumsum(xb)))[first] + only_b
    a_above = xa.sum() - np.concatenate(([0.0], np.cumsum(xa)))[first] + only_a
    return float(np.sum(1.0 / (a_above / xa + b_below / xb)))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, bands, slots) of documents with a word; one scan, no text is moved."""
    powers = _U(0x9E3779B97F4A7C15) ** np.arange(1, ROWS + 1, dtype=np.uint64)

    def make(batches):
        common.remembers("words", _HASHES.clear)
        for batch in batches:
            ids, hashes, bands, slots = [], [], [], []
            seen: dict[bytes, tuple] = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                key = hashlib.md5(text.encode(), usedforsecurity=False).digest()
                if key not in seen:
                    found, counts = shingles(text)
                    if not len(found):
                        continue
                    kept = sketch(found, counts, BANDS * ROWS)
                    seen[key] = mixed((kept.reshape(BANDS, ROWS) * powers).sum(axis=1)).view(np.int64).tolist(), kept.astype("<u2").tobytes()
                ids.append(doc_id)
                hashes.append(key)
                bands.append(seen[key][0])
                slots.append(seen[key][1])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "text_hash": pa.array(hashes, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64())),
                "slots": pa.array(slots, pa.binary()),
            })

    rows = common.columns(docs, doc_id="bigint", text="string").filter("doc_id is not null and text is not null")
    return common.map_batches(rows, make, "doc_id bigint, text_hash binary, bands array<bigint>, slots binary")


def _own_text() -> Column:
    """The text that stands for a doc_id: of several the one with the least digest, as for its sketch."""
    return F.min(F.struct(F.unhex(F.md5("text")), "text"))["text"].alias("text")


def verified(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold.

    Only texts that stand in a pair are moved.  Texts of ``b`` go to their pairs first; a hub ``a`` with many
    pairs is split by the skew join, which is why a pair keeps its text instead of joining a group.
    """
    needed = common.stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "needed")
    # Sent to every task only up to a checked number of rows; else a shuffle join.
    few = needed.count() <= 500_000
    texts = common.columns(docs, doc_id="bigint", text="string").join(F.broadcast(needed) if few else needed, "doc_id", "left_semi")
    texts = common.stored(texts.groupBy("doc_id").agg(_own_text()), "texts")
    right = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    full = right.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def check(batches):
        name, left = None, None
        for batch in batches:
            keep = []
            for k, (a, ta, tb) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3))):
                if a != name:
                    name, left = a, shingles(ta.as_py())
                keep.append(probability_jaccard(left, shingles(tb.as_py())) >= threshold)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return common.map_batches(full, check, "a bigint, b bigint")


def _rest(buckets: DataFrame, reps: DataFrame, found: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different classes so far.

    The members of such a bucket are dealt into blocks, and every two blocks meet in a task of their own.  A pair is
    looked at in the first band that both share, if their slots agree often enough.  A first pass finds by slots alone
    which members have such a partner; only their texts then go to the second, which compares pairs exactly from the
    likeliest on and skips those that are in one class by then.  So a task gives fewer links than it has members.
    """
    of = found.select(F.col("id").alias("rep_id"), "class_id")
    members = buckets.select("band", "value", "rep_id").join(of, "rep_id", "left").withColumn("class_id", F.coalesce("class_id", "rep_id"))
    open_ = members.groupBy("band", "value").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).filter("low <> high")
    rows = members.join(open_.select("band", "value"), ["band", "value"]).join(reps.select("rep_id", "slots"), "rep_id")

    def met(rows: DataFrame) -> DataFrame:
        blocks = rows.groupBy("band", "value").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        dealt = rows.join(blocks, ["band", "value"]).withColumn("block", F.expr("cast(pmod(xxhash64(rep_id), blocks) as int)"))
        dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
        return dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).groupBy("band", "value", "i", "j")

    def near(rows: pd.DataFrame):
        """(left, right, agreement) numbers of the pairs to look at."""
        slots = np.frombuffer(b"".join(rows["slots"]), "<u2").reshape(len(rows), BANDS, ROWS)
        groups, block, band = rows["class_id"].to_numpy(), rows["block"].to_numpy(), int(rows["band"].iloc[0])
        left, right = np.flatnonzero(block == rows["i"].iloc[0]), np.flatnonzero(block == rows["j"].iloc[0])
        for k in left:
            other = right[(groups[right] != groups[k]) & ((right > k) | (block[right] != block[k]))]
            same = slots[other] == slots[k]
            share = same.mean(axis=(1, 2))
            other, same, share = other[share >= ESTIMATE], same[share >= ESTIMATE], share[share >= ESTIMATE]
            # Slots are kept in 16 bits; a chance agreement moves a pair to a band where it may not meet, so the
            # bands before count only with certainty enough: all six slots.
            first = same[:, :band].all(axis=2).any(axis=1) if band else np.zeros(len(other), bool)
            for r, x in zip(other[~first], share[~first]):
                yield k, r, x

    def flag(rows: pd.DataFrame) -> pd.DataFrame:
        hit = sorted({n for k, r, _ in near(rows) for n in (k, r)}) if rows["class_id"].nunique() > 1 else []
        return rows.iloc[hit][["band", "value", "rep_id"]]

    flagged = common.stored(met(rows).applyInPandas(flag, "band int, value bigint, rep_id bigint").distinct(), "flagged")
    needed = common.stored(flagged.select(F.col("rep_id").alias("doc_id")).distinct(), "needed")
    few = needed.count() <= 500_000
    texts = common.columns(docs, doc_id="bigint", text="string").join(F.broadcast(needed) if few else needed, "doc_id", "left_semi")
    texts = common.stored(texts.groupBy(F.col("doc_id").alias("rep_id")).agg(_own_text()), "texts")
    full = rows.join(flagged, ["band", "value", "rep_id"]).join(texts, "rep_id")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = sorted(near(rows), key=lambda x: -x[2]) if rows["class_id"].nunique() > 1 else []
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        ids, groups, texts, read, linked = rows["rep_id"].to_numpy(), rows["class_id"].to_numpy(), rows["text"].to_numpy(), {}, []
        for k, r, _ in pairs:
            a, b = root(groups[k]), root(groups[r])
            if a != b:
                for n in (k, r):
                    if n not in read:
                        read[n] = shingles(texts[n])
                if probability_jaccard(read[k], read[r]) >= threshold:
                    parent[max(a, b)] = min(a, b)
                    linked.append((ids[k], ids[r]))
        return pd.DataFrame(linked, columns=["a", "b"]).astype("int64")

    return met(full).applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, copy_of, class_id, kept) for every row of ``docs``.

    ``copy_of`` is the least doc_id with the same text, ``class_id`` the least one reached by links; a document is
    kept when it is its own class.  Documents of the same text are one node, and rows with one doc_id are one
    document: all its texts link exact copies, the one with the least digest is compared with others.  A bucket is first compared with its most central member; where that leaves several classes in it, all its
    members of different classes meet in blocks.  So no bucket is cut, and pairs are only left out inside a class.
    Null and wordless texts and null ids are alone in their class (null ids have a null class and are kept); other
    columns are ignored; an empty table gives no rows.
    """
    ship_rows = common.columns(docs, doc_id="bigint", text="string")
    made = common.stored(sketches(docs), "sketches")
    least = made.groupBy("text_hash").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
    least = common.stored(least, "texts-seen")
    # Texts with over a thousandth of all rows: fewer than a thousand of them, so they can be sent to every task.
    total = made.count()
    hot = F.broadcast(least.filter(F.col("copies") * 1000 > total).select("text_hash", "rep_id"))
    narrow = made.select("doc_id", "text_hash")
    copies = narrow.join(hot, "text_hash").unionByName(
        narrow.join(hot, "text_hash", "left_anti").join(least.filter(F.col("copies") * 1000 <= total).select("text_hash", "rep_id"), "text_hash"))
    copies = common.stored(copies.groupBy("doc_id").agg(F.min("rep_id").alias("copy_of")), "copies")
    own = made.join(least.select(F.col("rep_id").alias("doc_id")).distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text_hash", "bands", "slots")).alias("own"))
    reps = common.stored(own.select(F.col("doc_id").alias("rep_id"), "own.bands", "own.slots"), "representatives")
    rows = reps.select("rep_id", F.posexplode("bands").alias("band", "value"))
    # The member that shares most buckets over all bands is the likeliest centre of its near copies, so it is the hub.
    shared = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = common.stored(rows.join(shared, ["band", "value"]), "crowded")
    central = crowded.groupBy("rep_id").agg(F.sum(F.col("n") - 1).alias("mates"))
    weighed = crowded.join(central, "rep_id")
    hubs = weighed.groupBy("band", "value").agg(F.max(F.struct("mates", (-F.col("rep_id")).alias("id"))).alias("top"))
    buckets = common.stored(crowded.join(hubs, ["band", "value"]).select("band", "value", "rep_id", (-F.col("top.id")).alias("hub")), "buckets")
    stars = common.stored(buckets.filter("hub <> rep_id").select(F.col("hub").alias("a"), F.col("rep_id").alias("b")).distinct(), "stars")
    linked = common.stored(verified(stars, docs, threshold), "linked")
    sure = copies.filter("doc_id <> copy_of").select(F.col("copy_of").alias("a"), F.col("doc_id").alias("b"))
    found = common.stored(links.classes(linked), "classes")
    linked = linked.unionByName(common.stored(_rest(buckets, reps, found, docs, threshold), "rest"))
    # Rows with one doc_id and several texts can join texts, so copies take part in the last round.
    found = links.classes(linked.unionByName(sure))
    return ship_rows.select("doc_id").join(copies, "doc_id", "left").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"), F.coalesce("class_id", "copy_of", "doc_id").alias("class_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
