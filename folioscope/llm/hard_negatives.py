"""Hard negatives by branch and bound over ball trees of quantised vectors.

A component x becomes the integer weight floor(256 * x), and a row's score is its inner product with the anchor. An anchor's positives
are its best rows of the same label; for each of them the best rows of other labels are wanted whose score lies between
``lower`` and ``upper`` percent of the positive's (both included).

A task indexes its vectors in pieces of at most PIECE rows. A label of more than LEAF rows in a piece has a ball tree of its own, the
others share one. A ball of centre c and radius r bounds every inner product with q on both sides, by q.c - |q| r and q.c + |q| r.
The frontier of a tree goes down level by level for a batch of anchors; a node stays for an anchor if its label can fit,
its balls' bounds meet one of the anchor's score windows, and the upper one isn't strictly beneath the current kth score there (ties can still
win by a smaller vec_id). Leaves that stay are scored by falling upper bounds and asked again before.
The positives' search is the same with an open window and the other rule for labels.

Scores are exact in 64 bits (exact.py); bounds are doubles, widened by more than their rounding. Both searches run in two passes: over
1 / FIRST of the rows, whose merged kth scores are proven floors, and over the rest, whose tasks report nothing beneath. Anchors go to
the tasks as a broadcast of at most ``block_bytes``, else block by block; vectors are never shuffled. Shards are
merged by a ranking with a limit on both sides of the shuffle.

Rows with a null vec_id, label or vector, or any null or non-finite component take no part. A row is no candidate for its own vec_id, and of
rows equal in vec_id, label and vector one counts. Labels are whole numbers, or else compared by a 64-bit hash. Vectors of different lengths are compared on their
common dimensions. Weights and scores are cut to the range of 64 bits. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from folioscope.llm.exact import HIGH, LOW, products
from folioscope.llm.maxscore import BLOCK_BYTES, CELLS, FIRST, padded, usable, weight_lists
from folioscope.storage import bounded_batches, land, release

PIECE, LEAF, BATCH, HELD = 8192, 64, 64, 256


class Forest:
    """Ball trees over some rows: one for every label of more than LEAF rows, one for all others."""

    def __init__(self, labels: np.ndarray, weights: np.ndarray):
        self.points = weights.astype(np.float64)
        values, at, n = np.unique(labels, return_inverse=True, return_counts=True)
        self.order, self.spans, self.kids, self.label = np.empty(len(labels), np.int64), [], [], []
        self.centres, self.radii, self.roots = [], [], []
        small, start = n[at] <= LEAF, 0
        parts = [(np.flatnonzero(at == i), values[i]) for i in np.flatnonzero(n > LEAF)] + [(np.flatnonzero(small), None)]
        for rows, label in parts:
            if len(rows):
                self.roots.append(self._grow(rows, start, label))
                start += len(rows)
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.sizes = np.sqrt((self.centres**2).sum(1))
        self.mixed = np.array([x is None for x in self.label])
        self.label = np.array([0 if x is None else x for x in self.label], np.int64)

    def _grow(self, rows: np.ndarray, start: int, label) -> int:
        """Adds the tree of ``rows``, which take the places from ``start`` on, and returns its root."""
        todo, root = [(rows, start, None)], len(self.spans)
        while todo:
            rows, start, parent = todo.pop()
            node, points = len(self.spans), self.points[rows]
            centre = points.mean(0)
            far = ((points - centre) ** 2).sum(1)
            self.spans.append((start, start + len(rows))), self.kids.append([]), self.label.append(label)
            self.centres.append(centre), self.radii.append(np.sqrt(far.max()) * (1 + 1e-12))
            if parent is not None:
                self.kids[parent].append(node)
            if len(rows) <= LEAF or not far.max():
                self.order[start : start + len(rows)] = rows
                continue
            a = points[far.argmax()]
            b = points[((points - a) ** 2).sum(1).argmax()]
            half = len(rows) // 2
            split = np.argpartition(points @ (b - a), half)
            todo += [(rows[split[:half]], start, node), (rows[split[half:]], start + half, node)]
        return root

    def bounds(self, queries: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible inner product of every query with each node's rows."""
        size = np.sqrt((queries**2).sum(1))[:, None]
        middle, width = queries @ self.centres[nodes].T, size * self.radii[nodes]
        width = width + 1e-9 * (size * self.sizes[nodes] + width) + 1e-3
        return np.minimum(middle - width, float(HIGH)), np.maximum(middle + width, float(LOW))


class Search:
    """The best ``k`` rows of each anchor's score windows among the pieces shown so far.

    ``lo`` and ``hi``: anchors x windows, both included; an empty window has lo > hi. ``same``: rows of the anchor's label, or of others.
    """

    def __init__(self, ids, labels, vectors: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, floors: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.vectors, self.k, self.same = ids, labels, vectors, k, same
        self.lo, self.hi, self.floors = lo, hi, floors.copy()
        self.best = tuple(np.empty(0, np.int64) for _ in range(4))
        self.held, self.n_held = [], 0
        #: Rows scored, and those there were, over all anchors.
        self.scored = self.all = 0

    def show(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], keys: np.ndarray) -> None:
        width = max(1, max(map(len, vectors), default=1))
        weights = padded(vectors, width)
        forest = Forest(labels, weights)
        ids, labels, keys, weights = ids[forest.order], labels[forest.order], keys[forest.order], weights[forest.order]
        self.all += len(ids) * len(self.ids)
        for a in range(0, len(self.ids), BATCH):
            mine = np.arange(a, min(a + BATCH, len(self.ids)))
            q = padded([self.vectors[i] for i in mine], width)
            for top, node, alive in self._leaves(forest, mine, q.astype(np.float64)):
                least = self._least(mine)
                live = alive & (top[:, None] >= least - np.abs(least) * 1e-9)
                some = np.flatnonzero(live.any(1))
                if len(some):
                    rows = slice(*forest.spans[node])
                    self._score(mine[some], q[some], live[some], ids[rows], labels[rows], keys[rows], weights[rows])
        self._trim()

    def _least(self, mine: np.ndarray) -> np.ndarray:
        return np.maximum(self.lo[mine], self.floors[mine]).astype(np.float64)

    def _leaves(self, forest: Forest, mine: np.ndarray, q: np.ndarray):
        """Leaves that some window needs, best first: upper bounds by anchor, node, and which windows need it."""
        nodes, alive, found = np.array(forest.roots), np.ones((len(mine), self.lo.shape[1], len(forest.roots)), bool), []
        alive &= (self.lo[mine] <= self.hi[mine])[:, :, None]
        least, most = self._least(mine)[:, :, None], self.hi[mine].astype(np.float64)[:, :, None]
        least, most = least - np.abs(least) * 1e-9, most + np.abs(most) * 1e-9
        while len(nodes):
            low, high = forest.bounds(q, nodes)
            equal = forest.label[nodes][None, :] == self.labels[mine][:, None]
            fits = forest.mixed[nodes][None, :] | (equal if self.same else ~equal)
            alive = alive & fits[:, None, :] & (high[:, None, :] >= least) & (low[:, None, :] <= most)
            kids, source = [], []
            for at in np.flatnonzero(alive.any((0, 1))).tolist():
                below = forest.kids[nodes[at]]
                if below:
                    kids += below
                    source += [at] * len(below)
                else:
                    found.append((high[:, at], nodes[at], alive[:, :, at]))
            nodes, alive = np.array(kids, np.int64), alive[:, :, source]
        return sorted(found, key=lambda x: -x[0][x[2].any(1)].max())

    def _score(self, mine, q, live, ids, labels, keys, weights) -> None:
        scores = products(q, weights)
        self.scored += scores.size
        equal = labels[None, :] == self.labels[mine][:, None]
        fits = (equal if self.same else ~equal) & (ids[None, :] != self.ids[mine][:, None])
        least = np.maximum(self.lo[mine], self.floors[mine])
        ok = fits[:, None, :] & live[:, :, None] & (scores[:, None, :] >= least[:, :, None]) & (scores[:, None, :] <= self.hi[mine][:, :, None])
        anchor, window, row = np.nonzero(ok)
        if len(row):
            self.held.append((mine[anchor] * self.lo.shape[1] + window, ids[row], scores[anchor, row], keys[row]))
            self.n_held += len(row)
            if self.n_held >= max(HELD, 2 * self.k * self.lo.size):
                self._trim()

    def _trim(self) -> None:
        """Keeps the best rows of each window and raises the floors."""
        slot, ids, scores, keys = (np.concatenate(x) for x in zip(self.best, *self.held))
        self.held, self.n_held = [], 0
        at = np.lexsort((keys, ids, ~scores, slot))
        slot, ids, scores, keys = slot[at], ids[at], scores[at], keys[at]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        slot, ids, scores, keys = slot[new], ids[new], scores[new], keys[new]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = rank == self.k - 1
        flat = self.floors.reshape(-1)
        flat[slot[last]] = np.maximum(flat[slot[last]], scores[last])
        keep = rank < self.k
        self.best = slot[keep], ids[keep], scores[keep], keys[keep]


def _searched(anchors, windows, k: int, same: bool):
    """Rows (vec_id, label, weights, key) to (slot, vec_id, score, key) of each window's best."""

    def run(batches):
        search = Search(*anchors.value, *windows.value, k, same)
        held, ids, labels, keys, width = [], [], [], [], 0

        def show():
            search.show(np.array(ids, np.int64), np.array(labels, np.int64), held, np.array(keys, np.int64))

        for batch in batches:
            for i, label, w, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), weight_lists(batch.column(2)), batch.column(3).to_pylist()):
                if held and (len(held) >= PIECE or (len(held) + 1) * max(width, len(w)) > CELLS):
                    show()
                    held, ids, labels, keys, width = [], [], [], [], 0
                held.append(w), ids.append(i), labels.append(label), keys.append(key)
                width = max(width, len(w))
        if held:
            show()
        for a in range(0, len(search.best[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in search.best], ["slot", "vec_id", "score", "key"])

    return run


def _best(rows: DataFrame, anchors, lo: np.ndarray, hi: np.ndarray, k: int, same: bool) -> DataFrame:
    """slot, vec_id, score, rank: the best ``k`` rows of every window, landed."""
    spark = rows.sparkSession
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id", "key")
    floors, found = np.full(lo.shape, LOW, np.int64), None
    for first in (True, False):
        windows = spark.sparkContext.broadcast((lo, hi, floors))
        part = rows.where(F.col("first") if first else ~F.col("first")).select("vec_id", "label", "weights", "key")
        best = part.mapInArrow(_searched(anchors, windows, k, same), "slot long, vec_id long, score long, key long")
        best = best if found is None else best.unionByName(found.drop("rank"))
        best = land(best.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        if found is not None:
            release(found)
        found = best
        if first:
            held = found.where(F.col("rank") == k).select("slot", "score").toArrow()
            floors.reshape(-1)[held["slot"].to_numpy()] = held["score"].to_numpy()
    return found


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score, of rows (vec_id, label, embedding)."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    whole = isinstance(vectors.schema["label"].dataType, IntegralType)
    label = F.col("label").cast("long") if whole else F.xxhash64(F.col("label"))
    rows = usable(vectors.where("label is not null"), label.alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    rows = rows.withColumn("key", F.xxhash64("label", "weights"))
    rows = land(rows.withColumn("first", F.pmod(F.xxhash64("vec_id", "key"), F.lit(FIRST)) == 0), "vectors")
    asked = land(rows.where("asked").select("vec_id", "label", "weights").distinct(), "anchors")
    size = asked.agg(F.coalesce(F.sum(8 * F.size("weights") + 32 + 40 * positives), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    found, used = None, []
    for block in range(blocks):
        held = (asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id", "label", "weights"), F.lit(blocks)) == block)).toArrow()
        ids, labels = (held[c].to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        anchors = spark.sparkContext.broadcast((ids, labels, [np.array(w, np.int64) for w in held["weights"].to_pylist()]))
        shape = len(ids), positives
        open_window = np.full((len(ids), 1), LOW, np.int64), np.full((len(ids), 1), HIGH, np.int64)
        best = _best(rows, anchors, *open_window, positives, True)
        own = best.select("slot", "vec_id", "score", "rank").toArrow()  # at most ``positives`` rows per anchor of the block
        release(best)
        lo, hi, other, score = np.full(shape, 1, np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for slot, i, s, rank in zip(*(own[c].to_pylist() for c in ("slot", "vec_id", "score", "rank"))):
            lo[slot, rank - 1], hi[slot, rank - 1] = max(LOW, -(-lower * s // 100)), min(HIGH, upper * s // 100)
            other[slot, rank - 1], score[slot, rank - 1] = i, s
        best = _best(rows, anchors, lo, hi, negatives, False)
        used.append(best)
        names = pa.table({"slot": np.arange(lo.size), "anchor_id": np.repeat(ids, positives), "positive_id": other.reshape(-1), "positive_score": score.reshape(-1)})
        names = spark.createDataFrame(names, "slot long, anchor_id long, positive_id long, positive_score long")
        best = best.join(names, "slot").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        found = best if found is None else found.unionByName(best)
    release(asked, rows)
    return found
