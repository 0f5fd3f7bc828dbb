"""Near-duplicate vectors by navigable small-world graphs, one graph per shard of a label.

Every vector asks every graph of its label.  The width of the search beam doubles until an audit of fixed
query rows, compared with the whole shard, finds their nearest rows and no link missing, and for queries whose
beam is full of links.  Hits are verified by cosine in double precision, and links are contracted to classes.
"""

from __future__ import annotations

import io
import logging
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from daystrata.llm import common, links

_LOG = logging.getLogger(__name__)
#: Vectors of a graph at most, about; bounds a task's memory.
SHARD_ROWS = 20_000
#: Queries that a task answers together.
QUERY_ROWS = 4096
NEIGHBOURS = 12
BUILD_BEAM = 48
FIRST_BEAM = 32
#: Beyond this beam, or one that no longer pays, a query is compared with the whole shard, the widest beam there is.
LAST_BEAM = 256
#: A beam pays while so many rows for each of its places are fewer than the shard has.
PLACE_ROWS = 16
#: A step of a search opens one waiting row for so many places of the beam, at least four.
OPENED_PLACES = 16
#: Queries of a call that are audited, and at least this share of them.
AUDITED, AUDITED_SHARE = 64, 1 / 64
#: The audit looks for so many nearest rows of a query, links or not, and this share of them must be found.
NEAREST, AUDIT_RECALL = 10, 0.99


def _unique_rows(ids: np.ndarray) -> np.ndarray:
    """Repeated ids of a row become -1; rows are sorted."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


class Graph:
    """Hierarchical graph over unit vectors; built and searched for many vectors at once."""

    def __init__(self, vectors: np.ndarray, keys: np.ndarray | None = None) -> None:
        self.v = vectors
        #: Queries that were compared with all rows, as no beam was wide enough.
        self.compared = 0
        n = len(vectors)
        # The level of a vector follows from its key, so a repeated task builds the same graph.
        keys = np.arange(n) if keys is None else keys
        self.level = np.minimum((-np.log(_uniform(keys)) / np.log(NEIGHBOURS)).astype(int), 6)
        order = np.argsort(-self.level, kind="stable")
        top = int(self.level.max()) if n else 0
        self.entry = int(order[0]) if n else -1
        self.near = [np.full((n, NEIGHBOURS * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]
        # Higher levels first: they are whole before lower ones use them as the way in.
        for level in range(top, -1, -1):
            members = order[self.level[order] >= level]
            self._build(level, members)

    def _build(self, level: int, members: np.ndarray) -> None:
        done, size = 1, 1
        while done < len(members):
            new = members[done : done + min(size, 1024)]
            block = self.v[new]
            beam = self.search(block, BUILD_BEAM, level, limit=members[:done] if done < 64 else None)
            inside = block @ block.T
            np.fill_diagonal(inside, -np.inf)
            k = min(BUILD_BEAM // 2, len(new) - 1)
            if k > 0:
                peers = new[np.argpartition(-inside, k - 1, axis=1)[:, :k]]
                beam = np.concatenate((beam, peers), axis=1)
            chosen = self._diverse(new, _unique_rows(beam), NEIGHBOURS)
            self.near[level][new, :NEIGHBOURS] = chosen
            self._back(level, new, chosen)
            done += len(new)
            size = done

    def _diverse(self, rows: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
        """For each row the nearest candidates that are closer to it than to any chosen before; then the nearest."""
        kept = np.full((len(rows), most), -1, np.int32)
        for first in range(0, len(rows), 512):
            own, c = rows[first : first + 512], candidates[first : first + 512]
            near = np.einsum("bkd,bd->bk", self.v[c], self.v[own])
            near[(c < 0) | (c == own[:, None])] = -np.inf
            order = np.argsort(-near, axis=1, kind="stable")[:, : 3 * most]
            c, near = np.take_along_axis(c, order, 1), np.take_along_axis(near, order, 1)
            between = np.einsum("bkd,bjd->bkj", self.v[c], self.v[c])
            chosen, fine = np.zeros(c.shape, bool), near > -np.inf
            worst = np.full(c.shape, -np.inf)
            for k in range(c.shape[1]):
                take = fine[:, k] & (near[:, k] >= worst[:, k]) & (chosen.sum(axis=1) < most)
                chosen[:, k] = take
                worst = np.where(take[:, None], np.maximum(worst, between[:, k]), worst)
            rank = np.where(chosen, 0, np.where(fine, 1, 2)) * c.shape[1] + np.arange(c.shape[1])
            pick = np.argsort(rank, axis=1)[:, :most]
            found = np.where(np.take_along_axis(fine, pick, 1), np.take_along_axis(c, pick, 1), -1)
            kept[first : first + 512, : found.shape[1]] = found
        return kept

    def _back(self, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
        """Links back to the new vectors; a full list is chosen anew from old and new."""
        width = self.near[level].shape[1]
        target, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        rows, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        # Of very many new links to one vector the nearest are candidates.
        most = 3 * width
        if count.max() > most:
            near = np.einsum("bd,bd->b", self.v[target], self.v[source])
            order = np.lexsort((-near, target))
            target, source = target[order], source[order]
        fresh = np.full((len(rows), min(int(count.max()), most)), -1, np.int32)
        keep = place < most
        fresh[np.repeat(np.arange(len(rows)), count)[keep], place[keep]] = source[keep]
        both = _unique_rows(np.concatenate((self.near[level][rows], fresh), axis=1))
        full = (both >= 0).sum(axis=1) > width
        packed = -np.sort(-both, axis=1)[:, :width]
        if full.any():
            packed[full] = self._diverse(rows[full], both[full], width)
        self.near[level][rows] = packed

    def _start(self, queries: np.ndarray, level: int) -> np.ndarray:
        """Greedy descent from the top to just above ``level``."""
        at = np.full(len(queries), self.entry)
        for k in range(len(self.near) - 1, level, -1):
            best = np.einsum("bd,bd->b", self.v[at], queries)
            while True:
                around = self.near[k][at]
                near = np.einsum("bkd,bd->bk", self.v[around], queries)
                near[around < 0] = -np.inf
                pick = near.argmax(axis=1)
                value = near[np.arange(len(at)), pick]
                better = value > best
                if not better.any():
                    break
                at = np.where(better, around[np.arange(len(at)), pick], at)
                best = np.where(better, value, best)
        return at

    def search(self, queries: np.ndarray, width: int, level: int = 0, limit: np.ndarray | None = None, own: np.ndarray | None = None) -> np.ndarray:
        """(queries, width) nearest rows found, nearest first, -1 where fewer.  ``own`` is each query's row in this
        graph, a second way in, or -1."""
        if limit is not None:
            near = queries @ self.v[limit].T
            return limit[np.argsort(-near, axis=1, kind="stable")[:, :width]]
        step = max(16, min(1024, 24_000_000 // max(1, len(self.v))))
        own = np.full(len(queries), -1) if own is None else own
        parts = [self._search(queries[k : k + step], width, level, own[k : k + step]) for k in range(0, len(queries), step)]
        return np.concatenate(parts) if parts else np.zeros((0, width), np.int64)

    def _search(self, queries: np.ndarray, width: int, level: int, own: np.ndarray) -> np.ndarray:
        b, near_of, open_many = len(queries), self.near[level], max(4, width // OPENED_PLACES)
        rows = np.arange(b)
        ids = np.full((b, width), -1, np.int64)
        near = np.full((b, width), -np.inf, np.float32)
        done = np.ones((b, width), bool)
        start = self._start(queries, level)
        ids[:, 0], near[:, 0], done[:, 0] = start, np.einsum("bd,bd->b", self.v[start], queries), False
        seen = np.zeros((b, len(self.v) + 1), bool)
        seen[rows, start] = True
        second = np.flatnonzero((own >= 0) & (own != start))
        ids[second, 1], done[second, 1] = own[second], False
        near[second, 1] = np.einsum("bd,bd->b", self.v[own[second]], queries[second])
        seen[second, own[second]] = True
        live = rows
        while len(live):
            # The nearest few of each beam that weren't opened; beams are sorted after the first step.
            waiting = ~done[live]
            turn = waiting & (np.cumsum(waiting, axis=1) <= open_many)
            live, turn = live[turn.any(axis=1)], turn[turn.any(axis=1)]
            if not len(live):
                break
            at = np.argsort(~turn, axis=1, kind="stable")[:, :open_many]
            opened = np.take_along_axis(ids[live], at, 1)
            valid = np.take_along_axis(turn, at, 1)
            state = done[live]
            state |= turn
            around = np.where(valid[:, :, None], near_of[opened], -1).reshape(len(live), -1)
            around[seen[live[:, None], around]] = -1
            around = _unique_rows(around)
            around = around[:, (around >= 0).any(axis=0)]
            seen[live[:, None], around] = True
            seen[:, -1] = False
            value = np.einsum("bkd,bd->bk", self.v[around], queries[live]).astype(np.float32)
            value[around < 0] = -np.inf
            all_ids = np.concatenate((ids[live], around), axis=1)
            all_near = np.concatenate((near[live], value), axis=1)
            all_done = np.concatenate((state, around < 0), axis=1)
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            ids[live], near[live], done[live] = (np.take_along_axis(x, order, 1) for x in (all_ids, all_near, all_done))
        return ids

    def to_bytes(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        np.savez(out, v=self.v, level=self.level, entry=self.entry, **{f"near{k}": x for k, x in enumerate(self.near)}, **more)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, image: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        stored = np.load(io.BytesIO(image))
        graph = cls.__new__(cls)
        graph.compared = 0
        graph.v, graph.level, graph.entry = stored["v"], stored["level"], int(stored["entry"])
        graph.near = [stored[f"near{k}"] for k in range(int(graph.level.max()) + 1)]
        return graph, stored


def _uniform(keys: np.ndarray) -> np.ndarray:
    from daystrata.llm.probminhash import mixed

    return ((mixed(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def nearest_recall(graph: Graph, queries: np.ndarray, own: np.ndarray) -> Callable[[int], float]:
    """Share of the ``NEAREST`` rows of each query, its own excluded, that a beam of a given width finds."""
    rows, most = np.flatnonzero(own >= 0), min(NEAREST, len(graph.v) - 1)
    last = np.zeros(len(queries), np.float32)
    for k in range(0, len(queries), 256):
        near = queries[k : k + 256] @ graph.v.T
        mine = rows[(rows >= k) & (rows < k + 256)]
        near[mine - k, own[mine]] = -np.inf
        last[k : k + 256] = np.partition(near, -most, axis=1)[:, -most] if most else np.inf

    def recall(width: int) -> float:
        beam = graph.search(queries, width, own=own)
        near = np.einsum("bkd,bd->bk", graph.v[beam], queries)
        near[(beam < 0) | (beam == own[:, None])] = -np.inf
        # Rows as near as the last of the nearest count alike; sums differ in the last digits.
        return float(np.minimum((near >= last[:, None] - 1e-6).sum(axis=1), most).mean() / most) if most and len(queries) else 1.0

    return recall


def audited_queries(ids: np.ndarray) -> np.ndarray:
    """Numbers of the queries to audit, by a hash that the levels of the graph don't depend on."""
    from daystrata.llm.probminhash import mixed

    return np.argsort(mixed(ids.astype(np.uint64) ^ np.uint64(0xD1B54A32D192ED03)), kind="stable")[: max(AUDITED, int(len(ids) * AUDITED_SHARE))]


def range_links(graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, audited: np.ndarray,
                own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Pairs (query, row) with cosine >= ``threshold`` in double precision, and the recall of the last audit.

    ``exact`` and ``queries`` are unit vectors in double precision, ``audited`` the numbers of audited queries, ``own``
    the row of each query in the graph, or -1.
    The beam is as wide as the audited queries need to find their nearest rows, own row excluded, of the whole graph.
    A query goes on with twice the beam while its beam ends in links, and all go on while the audit misses a link.
    Where the widest beam that pays isn't enough, queries are compared with the whole graph, which has a recall of 1.
    """
    own = np.full(len(queries), -1) if own is None else own
    slack, low = threshold - 1e-4, queries.astype(np.float32)

    def whole(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.zeros(0, int), np.zeros(0, int))]
        for k in range(0, len(some), 256):
            q, r = np.nonzero(low[some[k : k + 256]] @ graph.v.T >= slack)
            found.append((some[k : k + 256][q], r))
        return tuple(np.concatenate(x) for x in zip(*found))

    def verified(q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.zeros(len(q), bool)
        for k in range(0, len(q), 65536):
            part = slice(k, k + 65536)
            keep[part] = np.einsum("bd,bd->b", queries[q[part]], exact[r[part]]) >= threshold
        return q[keep], r[keep]

    def widest() -> bool:
        return width > LAST_BEAM or width * PLACE_ROWS >= len(graph.v)

    width, recall = FIRST_BEAM, nearest_recall(graph, low[audited], own[audited])
    found_share = 1.0
    while not widest() and (found_share := recall(width)) < AUDIT_RECALL:
        width *= 2
    truth = set(zip(*verified(*whole(audited))))
    pending, kept = np.arange(len(queries)), [(np.zeros(0, int), np.zeros(0, int))]
    while True:
        if widest():
            graph.compared += len(pending)
            # Queries answered by a beam before keep the recall of that beam.
            found_share = 1.0 if len(pending) == len(queries) else found_share
            kept.append(verified(*whole(pending)))
            found = tuple(np.concatenate(x) for x in zip(*kept))
            break
        beam = graph.search(low[pending], width, own=own[pending])
        near = np.einsum("bkd,bd->bk", graph.v[beam], low[pending])
        near[beam < 0] = -np.inf
        full = near.min(axis=1) >= slack
        q, k = np.nonzero((near >= slack) & ~full[:, None])
        now = verified(pending[q], beam[q, k])
        closed = set(pending[~full].tolist())
        mine = set(zip(*now))
        missing = [p for p in truth if p[0] in closed and p not in mine]
        if missing:
            width *= 2
            continue
        kept.append(now)
        pending = pending[full]
        if not len(pending):
            found = tuple(np.concatenate(x) for x in zip(*kept))
            break
        width *= 2
    return found[0], found[1], found_share


def near_vectors(embeddings: DataFrame, threshold: float = 0.98, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Linked are different vectors of one label with cosine >= ``threshold``.  A null label, and a vector that is null,
    empty, zero or holds a null or non-finite number, links with nothing; vectors of different length don't
    either.  Equal vectors are one node that counts for all its rows.  A null vec_id never links and has no
    component; rows that share a vec_id count as vectors each.  Other columns are ignored; an empty table gives no rows.
    """
    rows = common.columns(embeddings, vec_id="bigint", embedding="array<double>", label="string")
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    # Vectors of another length are another group; equal ones meet by the digest of their numbers.
    group = F.concat_ws("/", "label", F.size("embedding").cast("string"))
    valid = common.stored(rows.filter(good).select("vec_id", group.alias("label"), "embedding", F.md5(F.to_json(F.struct("label", "embedding"))).alias("digest")), "vectors")
    nodes = valid.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    sizes = common.stored(nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards")), "sizes")
    # Sent to every task only up to a checked number of labels.
    if sizes.count() <= 100_000:
        sizes = F.broadcast(sizes)
    placed = nodes.join(sizes, "label").withColumn("shard", F.expr("cast(pmod(xxhash64(node), shards) as int)"))
    placed = common.stored(placed.select("digest", "node", "copies", "label", "embedding", "shard", "shards", F.expr(f"cast(floor(pmod(xxhash64(node, 1), shards * {shard_rows}) / {QUERY_ROWS}) as int)").alias("chunk")), "nodes")
    common.ship(placed.sparkSession)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "digest"])
        exact = unit(np.array(rows["embedding"].tolist(), np.float64))
        graph = Graph(exact.astype(np.float32), rows["node"].to_numpy())
        image = graph.to_bytes(exact=exact, node=rows["node"].to_numpy(), copies=rows["copies"].to_numpy())
        return pd.DataFrame({"label": rows["label"].iloc[:1], "shard": rows["shard"].iloc[:1], "image": [image]})

    graphs = common.stored(placed.groupBy("label", "shard").applyInPandas(build, "label string, shard int, image binary"), "graphs")
    asked = placed.select("label", F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"), "chunk", "node", "embedding")
    chunks = common.stored(asked.select("label", "shard", "chunk").distinct(), "chunks")
    calls = graphs.join(chunks, ["label", "shard"]).select("label", "shard", "chunk", "image")

    def answer(queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64").assign(recall=1.0, compared=0)
        if not len(queries) or not len(graphs):
            return empty
        graph, stored = Graph.from_bytes(graphs["image"].iloc[0])
        names, copies, asks = stored["node"], stored["copies"], queries["node"].to_numpy()
        vectors = unit(np.array(queries["embedding"].tolist(), np.float64))
        row = np.minimum(np.searchsorted(names, asks), len(names) - 1)
        own = np.where(names[row] == asks, row, -1)
        q, r, recall = range_links(graph, stored["exact"], vectors, threshold, audited_queries(asks), own)
        other = names[r] != asks[q]
        q, r = q[other], r[other]
        count = np.bincount(q, copies[r], len(asks)).astype("int64")
        # Links of the call contracted here, so that at most one edge for each vector leaves it.
        ids, back = np.unique(np.concatenate((asks[q], names[r])), return_inverse=True)
        a, b, root = back[: len(q)], back[len(q) :], np.arange(len(ids))
        while len(q):
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({
            "node": np.concatenate((asks, ids)), "links": np.concatenate((count, np.zeros(len(ids), "int64"))),
            "root": np.concatenate((asks, ids[root] if len(ids) else ids)),
        }).astype("int64").assign(recall=recall, compared=np.where(np.arange(len(asks) + len(ids)) == 0, graph.compared, 0))

    keys = ["label", "shard", "chunk"]
    found = asked.groupBy(*keys).cogroup(calls.groupBy(*keys)).applyInPandas(answer, "node bigint, links bigint, root bigint, recall double, compared bigint")
    found = common.stored(found, "answers")
    row = found.agg(F.min("recall").alias("least"), F.avg("recall").alias("mean"), F.sum("compared").alias("compared")).first()
    if row["least"] is not None:
        _LOG.info("audited recall of the %d nearest vectors: %.4f at least, %.4f on average; %d queries compared with a whole shard", NEAREST, row["least"], row["mean"], row["compared"])
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = valid.select("vec_id", "digest").join(placed.select("digest", "node", "copies"), "digest")
    named = common.stored(named, "named")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(named.select(F.col("vec_id").alias("a"), F.col("node").alias("b")))
    known = named.join(linked, "node").groupBy("vec_id").agg(F.max(F.col("links") + F.col("copies") - 1).alias("n_links"))
    parts = links.classes(edges).withColumnRenamed("id", "vec_id")
    return rows.select("vec_id").join(known, "vec_id", "left").join(parts, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("class_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
