"""Language identification with one interpolated Kneser-Ney character model per language.

A word is read as its letters between a start and an end mark, so its probability needs no neighbour and a
word met before costs one look-up.  A model is a sorted array of hashed character strings of one to five
letters with the interpolated probability of each, and one of contexts with their weight for the shorter
context.  The language with the lowest cross-entropy per letter wins; it is rejected when that is above what
calibration documents of the language show.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daystrata.llm import common
from daystrata.llm.probminhash import mixed

ORDER = 5
DISCOUNT = 0.75
#: Bound of the fit: documents per language in expectation, chosen by a hash of id and text.  One in five of them
#: calibrates, the others train.
FIT_DOCS = 1500
#: Letters an unseen one is one of.
ALPHABET = 2000
START, END = "\x02", "\x03"
UNKNOWN = "und"
# Word characters; numbers that aren't decimal are among them and are taken out one by one.
_WORD = re.compile(r"[^\W\d_]+")
_NUMBERS = re.compile("[" + "".join(chr(c) for c in range(0x80, 0x110000) if not chr(c).isalpha() and _WORD.match(chr(c))) + "]")


def letters(text: str) -> list[str]:
    """Stretches of letters."""
    return _WORD.findall(text if text.isascii() else _NUMBERS.sub(" ", text))


#: Bytes of the remembered costs of a worker; a token takes eight for each language, and about 150 for its text.
_MEMORY_BYTES = 64_000_000
_U = np.uint64


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _hash(texts) -> np.ndarray:
    """64-bit hashes of equally long strings."""
    texts = list(texts)
    if not texts:
        return np.zeros(0, np.uint64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), -1).astype(np.uint64)
    return _rolled(points.T)


def _rolled(columns) -> np.ndarray:
    h = np.full(columns[0].shape, len(columns), np.uint64)
    for c in columns:
        h = mixed(h * _U(0x9E3779B97F4A7C15) + c)
    return h


class Model:
    """Sorted hashes with log probabilities, and sorted context hashes with log weights."""

    def __init__(self, counts: Counter) -> None:
        """``counts`` of all strings of ORDER characters, and of shorter ones that begin with the start mark."""
        # Of the longest strings and of starts raw counts; of the others how many characters precede them.
        use: list[dict[str, float]] = [defaultdict(float) for _ in range(ORDER + 1)]
        for gram, n in counts.items():
            use[len(gram)][gram] += n
        for n in range(ORDER, 1, -1):
            for gram in use[n]:
                if gram[1:2] != START:
                    use[n - 1][gram[1:]] += 1.0
        keys, logs, contexts, weights = [], [], [], []
        floor = 1.0 / ALPHABET
        shorter: dict[str, float] = {}
        for n in range(1, ORDER + 1):
            total, kinds = defaultdict(float), defaultdict(int)
            table = {g: c for g, c in use[n].items() if g != START}
            for gram, c in table.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            weight = {h: DISCOUNT * kinds[h] / total[h] for h in total}
            here = {g: max(c - DISCOUNT, 0.0) / total[g[:-1]] + weight[g[:-1]] * (shorter.get(g[1:], floor) if n > 1 else floor) for g, c in table.items()}
            keys.append(_hash(here))
            logs.append(np.log(np.fromiter(here.values(), float, len(here))))
            contexts.append(_hash(weight) if n > 1 else np.full(len(weight), 0, np.uint64))
            weights.append(np.log(np.fromiter(weight.values(), float, len(weight))))
            shorter = here
        self.keys, self.logs = _sorted(keys, logs)
        self.contexts, self.weights = _sorted(contexts, weights)

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Minus the log probability of each word with its end mark."""
        return self.costs(*marked_points(words))

    def costs(self, points: np.ndarray, place: np.ndarray, owner: np.ndarray, n_words: int) -> np.ndarray:
        log, open_ = np.zeros(len(points)), place > 0
        for n in range(ORDER, 0, -1):
            at = np.flatnonzero(open_ & (place >= n - 1))
            if len(at):
                columns = [points[at - k] for k in range(n - 1, -1, -1)]
                row, hit = _look(self.keys, _rolled(columns))
                log[at[hit]] += self.logs[row[hit]]
                open_[at[hit]] = False
                missed = at[~hit]
                # The weight of the context, where the context itself is known.
                known = _rolled([c[~hit] for c in columns[:-1]]) if n > 1 else np.zeros(len(missed), np.uint64)
                row, hit = _look(self.contexts, known)
                log[missed[hit]] += self.weights[row[hit]]
        log[open_] += np.log(1.0 / ALPHABET)
        return -np.bincount(owner, log, n_words)


def _sorted(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, v = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(k, kind="stable")
    return k[order], v[order].astype(np.float32)


def _look(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    row = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return row, table[row] == wanted


def marked_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Code points of all marked words in a row, each one's place in its word, and its word."""
    points = np.frombuffer("".join([START + w + END for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    return points, np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths), owner, len(words)


class Identifier:
    """All languages' models, and for each the mean and spread of the cross-entropy of its calibration documents."""

    def __init__(self, models: dict[str, Model]) -> None:
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.mean, self.spread = np.full(len(models), np.inf), np.zeros(len(models))
        self.index: dict[str, int] = {}
        self.cost = np.zeros((1024, len(models) + 1))

    @property
    def room(self) -> int:
        """Tokens that may be remembered."""
        return _MEMORY_BYTES // (8 * self.cost.shape[1] + 150)

    def forget(self) -> None:
        self.index.clear()
        self.cost = np.zeros((1024, self.cost.shape[1]))

    def learn(self, tokens: set[str]) -> None:
        """Costs of new tokens by language and their number of characters, each of their words counted."""
        if len(self.index) + len(tokens) > self.room:
            self.index.clear()
        words = [(t, w) for t in tokens for w in letters(t)]
        start, total = len(self.index), len(self.index) + len(tokens)
        if total > len(self.cost):
            self.cost = np.concatenate((self.cost, np.zeros((max(total, len(self.cost)), self.cost.shape[1]))))
        self.cost[start:total] = 0
        self.index.update(zip(tokens, range(start, total)))
        if words:
            read = marked_points([w for _, w in words])
            owner = np.fromiter((self.index[t] for t, _ in words), np.int64, len(words)) - start
            for k, model in enumerate(self.models):
                self.cost[start:total, k] = np.bincount(owner, model.costs(*read), len(tokens))
            self.cost[start:total, -1] = np.bincount(owner, np.fromiter((len(w) + 1 for _, w in words), float, len(words)), len(tokens))

    def sums(self, texts: list[str]) -> np.ndarray:
        """Cost of each text by language, and in the last column its letters and word ends."""
        rows = np.zeros((len(texts), len(self.langs) + 1))
        step = 256
        for first in range(0, len(texts), step):
            split = [t.lower().split() for t in texts[first : first + step]]
            new = set().union(*split).difference(self.index)
            if len(self.index) + len(new) > self.room:
                new = set().union(*split)
                self.index.clear()
            if new:
                self.learn(new)
            for k, tokens in enumerate(split):
                if tokens:
                    rows[first + k] = self.cost[np.fromiter(map(self.index.__getitem__, tokens), np.int64, len(tokens))].sum(axis=0)
        return rows

    def calibrate(self, langs: list[str], sums: np.ndarray) -> None:
        for k, lang in enumerate(self.langs):
            own = np.array([x == lang for x in langs]) & (sums[:, -1] > 0)
            if own.any():
                rate, n = sums[own, k] / sums[own, -1], sums[own, -1]
                self.mean[k] = np.average(rate, weights=n)
                self.spread[k] = np.sqrt(np.mean((rate - self.mean[k]) ** 2 * n))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float], list[bool]]:
        """Language, score, cross-entropy and acceptance of each text."""
        sums = self.sums([t or "" for t in texts])
        out: tuple[list, list, list, list] = ([], [], [], [])
        for row in sums:
            n = row[-1]
            if not n or not self.langs:
                values = (UNKNOWN, 0.0, None, False)
            else:
                rates = row[:-1] / n
                best = int(np.argmin(rates))
                score = 1.0 / np.exp(-(rates - rates[best]) * min(n, 200.0)).sum()
                limit = 1.25 * self.mean[best] + 8 * self.spread[best] / np.sqrt(n)
                values = (self.langs[best], float(score), float(rates[best]), bool(rates[best] <= limit))
            for column, value in zip(out, values):
                column.append(value)
        return out


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Identifier:
    """Models from text and lang of documents that aren't held out.

    String counts are made where the documents are and summed in Spark; the sums of a bounded number of
    documents come to the driver.  Of a language with fewer documents all are used.
    """
    labelled = common.columns(docs, doc_id="bigint", text="string", lang="string").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    found = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not found:
        return Identifier({})
    share = F.create_map(*[x for lang, n in found.items() for x in (F.lit(lang), F.lit(min(1.0, fit_docs / n)))])
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit("fit")), F.lit(1_000_000)) / 1_000_000
    fold = (F.pmod(F.xxhash64("doc_id", "text", F.lit("fold")), F.lit(5)) == 0).alias("calibrates")
    sample = common.stored(labelled.filter(drawn < share[F.col("lang")]).select("lang", "text", fold), "fit-sample")

    def count(batches):
        sums: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[lang].update(letters(text.as_py().lower()))
        for lang, words in sums.items():
            grams: Counter = Counter()
            for word, n in words.items():
                marked = START + word + END
                for k in range(2, min(ORDER, len(marked) + 1)):
                    grams[marked[:k]] += n
                for i in range(len(marked) - ORDER + 1):
                    grams[marked[i : i + ORDER]] += n
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": list(grams), "n": pa.array(list(grams.values()), pa.int64())})

    # A language whose only documents calibrate is trained on them as well.
    trains = {r["lang"] for r in sample.filter("not calibrates").select("lang").distinct().collect()}
    training = sample.filter(~F.col("calibrates") | ~F.col("lang").isin(list(trains)))
    sums = common.map_batches(training.select("lang", "text"), count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = {lang: Counter() for lang in found}
    for batch in sums.toArrow().to_batches():
        for lang, gram, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[lang][gram] += n
    identifier = Identifier({lang: Model(c) for lang, c in counts.items() if c})
    shared = sample.sparkSession.sparkContext.broadcast(identifier)
    width = len(identifier.langs) + 1

    def measure(batches):
        for batch in batches:
            rows = shared.value.sums(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"lang": batch.column(0), "sums": pa.array(rows.tolist(), pa.list_(pa.float64()))})

    checks = {r["lang"] for r in sample.filter("calibrates").select("lang").distinct().collect()}
    held = sample.filter(F.col("calibrates") | ~F.col("lang").isin(list(checks)))
    rows = common.map_batches(held.select("lang", "text"), measure, "lang string, sums array<double>").collect()
    identifier.calibrate([r["lang"] for r in rows], np.array([r["sums"] for r in rows]).reshape(-1, width))
    return identifier


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, cross_entropy, accepted) of every whole text.

    ``und`` with score 0 for a null text or one without a letter, and for all when nothing could be learned; these
    are not accepted.  Equal costs go to the first language by name.  Null ids count as not held out; repeated rows
    get equal answers; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(identifier)

    def predict(batches):
        common.remembers("languages", shared.value.forget)
        for batch in batches:
            lang, score, rate, fine = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64()), pa.array(fine, pa.bool_())],
                                             ["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "accepted"])

    rows = common.columns(docs, doc_id="bigint", text="string").select("doc_id", held_out().alias("held_out"), "text")
    return common.map_batches(rows, predict, "doc_id bigint, held_out boolean, lang_pred string, score double, cross_entropy double, accepted boolean")


def accepted(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """The rows of ``docs`` whose whole text is accepted, with all their columns.

    Each row is judged by its own text, whatever its id; so null and repeated ids need no join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    text = docs.columns.index("text")

    def keep(batches):
        common.remembers("languages", shared.value.forget)
        for batch in batches:
            yield batch.filter(pa.array(shared.value.predict(batch.column(text).to_pylist())[3], pa.bool_()))

    return common.map_batches(docs, keep, docs.schema)
