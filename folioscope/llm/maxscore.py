"""Exact top-k inner products by MaxScore over inverted indexes of quantised vectors.

A component x becomes the integer weight floor(256 * x). Terms are signed dimensions: a vector stands in the
postings of (d, +) or (d, -) with its weight. Of a query's terms those of its own signs raise a score, by at most
|query weight| * the largest weight of the postings; the opposite ones only lower it.

Every task indexes its vectors in pieces of at most STEP rows (and CELLS weights) and keeps each query's best k rows from piece to piece,
so that the k-th score is a floor for the next. In a piece a query's raising terms are ordered by their bounds.
Those of smallest bounds whose sum stays below the floor are non-essential: a vector in none of the other, essential,
postings can't reach it. Essential postings are traversed, each once for all queries that need it, adding up
scores; non-essential terms and lowering ones are probed by falling bounds, in groups, for those vectors only whose score so far
plus the bounds of what is left is still competitive. While a query has no floor all its terms are essential, so
the first SEED rows of a task are scored whole. Tasks go over 1 / FIRST of the vectors first; the merged k-th scores of these are
proven floors with which all other tasks begin, so these report only what can still be among the best. Ties count as competitive, so the smaller vec_id wins. The shards'
(tasks') lists are merged by a ranking whose limit Spark applies on both sides of the shuffle.

Vectors are neither shuffled nor copied. Queries go to the tasks as a broadcast if their weights take at most
``block_bytes``, else block by block, passes over the landed vectors and one landed result per block. A task holds one
piece, the queries of a block and k rows for each.

Vectors that are null or hold null or non-finite components take no part, as queries or candidates, nor do rows with
null vec_id; other columns don't matter. Vectors of different lengths, also very long ones, are compared on their common dimensions
(missing weights are 0). A row is no candidate for its own vec_id, and one of equal (vec_id, weights) is kept. Scores are
exact in 64 bits: partial sums and bounds are kept in integers where they can't leave 63 bits, by |query weight| times the largest |weight| of
each dimension, added up; beyond that, in Python's integers. Only a weight or a score that itself lies outside 64 bits is cut to their
range. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.exact import HIGH, LOW, products, reach
from folioscope.storage import bounded_batches, land, release

STEP, CELLS, BATCH, GROUP, SEED = 2048, 1 << 21, 64, 8, 256
#: The share of rows whose results are floors for the others.
FIRST = 16
BLOCK_BYTES = 32 << 20
#: Stands for a floor that isn't known.
NONE = np.int64(LOW)


def padded(rows: list[np.ndarray], width: int, kind=np.int64) -> np.ndarray:
    """Rows of at most ``width`` weights as a matrix."""
    out = np.zeros((len(rows), width), kind)
    for i, w in enumerate(rows):
        out[i, : len(w)] = w[:width]
    return out


class Piece:
    """An inverted index of some vectors: for each signed dimension its postings, by row."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        #: Largest weight of the postings of (d, +), and least of those of (d, -).
        self.raised, self.lowered = np.maximum(weights.max(0), 0), np.minimum(weights.min(0), 0)
        self.postings = {}
        for sign in (1, -1):
            dims, rows = np.nonzero((weights * sign > 0).T)
            ends = np.searchsorted(dims, np.arange(weights.shape[1] + 1))
            self.postings[sign] = ends, rows, weights[rows, dims]

    def list_of(self, d: int, sign: int) -> tuple[np.ndarray, np.ndarray]:
        ends, rows, w = self.postings[sign]
        part = slice(ends[d], ends[d + 1])
        return rows[part], w[part]


class Search:
    """The best ``k`` candidates of each query among the pieces shown so far."""

    def __init__(self, ids: np.ndarray, weights: list[np.ndarray], floors: np.ndarray, k: int):
        order = np.argsort([len(w) for w in weights], kind="stable")  # batches of like lengths
        self.ids, self.queries, self.k = ids[order], [weights[i] for i in order], k
        self.floors = floors[order]
        #: By a batch's first query: places of queries, ids, scores and keys.
        self.best = {a: tuple(np.empty(0, np.int64) for _ in range(4)) for a in range(0, len(ids), BATCH)}
        #: Postings traversed, and those there were, over all queries.
        self.traversed = self.all_postings = 0

    def show(self, ids: np.ndarray, vectors: list[np.ndarray], keys: np.ndarray) -> None:
        """Takes in candidates: their ids, weights and 64-bit keys, by which equal rows are one."""
        at = np.lexsort((keys, ids))
        first = at[np.concatenate([[True], (np.diff(ids[at]) != 0) | (np.diff(keys[at]) != 0)])]
        ids, keys, vectors = ids[first], keys[first], [vectors[i] for i in first]
        width = max(map(len, vectors), default=0)
        if not width:
            vectors, width = [np.zeros(1, np.int64)] * len(vectors), 1
        weights = padded(vectors, width)
        seed = SEED if (self.floors == NONE).any() else 0
        for part, whole in ((slice(0, seed), True), (slice(seed, None), False)):
            if len(ids[part]):
                piece = Piece(weights[part])
                for a in range(0, len(self.queries), BATCH):
                    self._batch(piece, ids[part], keys[part], a, min(a + BATCH, len(self.queries)), whole)

    def _batch(self, piece: Piece, ids: np.ndarray, keys: np.ndarray, a: int, b: int, whole: bool) -> None:
        width = piece.weights.shape[1]
        q = padded(self.queries[a:b], width)
        if whole:
            pairs = np.nonzero(ids[:, None] != self.ids[None, a:b])
            self._keep(a, pairs[1], ids[pairs[0]], products(q, piece.weights).T[pairs], keys[pairs[0]])
            return
        # 32 bits hold the sums traversed, 63 all others, or else Python's integers do
        most = np.maximum(piece.raised.astype(float), -piece.lowered.astype(float))
        top = reach(q, most).max(initial=0)
        kind, wide = (np.int32, np.int64) if top < 2**30 else (np.int64, np.int64) if top < 2**62 else (object, object)
        weights, floors = piece.weights, self.floors[a:b].astype(wide)
        if wide is object:
            q, weights = q.astype(object), weights.astype(object)
        elif kind is np.int32:
            q = q.astype(np.int32)
        bound = np.maximum(q.astype(wide) * piece.raised, q.astype(wide) * piece.lowered)
        order = np.argsort(bound, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(bound, order, 1), axis=1)
        essential = np.zeros(q.shape, bool)
        np.put_along_axis(essential, order, sums >= floors[:, None], 1)
        essential &= bound > 0
        score = np.zeros((len(ids), b - a), kind)
        for sign in (1, -1):
            needed = essential & (q * sign > 0)
            for d in np.flatnonzero(needed.any(0)).tolist():
                rows, w = piece.list_of(d, sign)
                w = w.astype(kind)
                own = needed[:, d]
                n = int(own.sum())
                self.traversed += n * len(rows)
                if 4 * n >= b - a:
                    score[rows] += w[:, None] * np.where(own, q[:, d], 0)[None, :]
                else:
                    own = np.flatnonzero(own)
                    score[rows[:, None], own] += w[:, None] * q[own, d][None, :]
        self.all_postings += sum(len(rows) for _, rows, _ in piece.postings.values()) * (b - a)
        left = np.where(essential, 0, bound).sum(1)
        row, col = np.nonzero((score + left >= floors) & (ids[:, None] != self.ids[None, a:b]))
        found = score[row, col].astype(wide)
        # what remains: non-essential terms by falling bounds, then the lowering side of essential ones
        order = np.argsort(np.where(essential, -1, bound), axis=1, kind="stable")[:, ::-1]
        rest = np.take_along_axis(np.where(essential, 0, bound), order, 1)
        rest = np.concatenate([np.cumsum(rest[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1), wide)], 1)
        for at in range(0, width, GROUP):
            dims = order[:, at : at + GROUP][col]
            product = weights[row[:, None], dims].astype(wide) * q[col[:, None], dims]
            found = found + np.where(essential[col[:, None], dims], np.minimum(product, 0), product).sum(1)
            alive = found + rest[col, min(at + GROUP, width)] >= floors[col]
            row, col, found = row[alive], col[alive], found[alive]
        self._keep(a, col, ids[row], found, keys[row])

    def _keep(self, a: int, col: np.ndarray, ids: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Adds candidates of the batch from ``a`` on to the best rows and raises the floors."""
        if scores.dtype == object:
            scores = np.clip(scores, LOW, HIGH)
        own = [np.concatenate(x) for x in zip(self.best[a], (col + a, ids, scores.astype(np.int64), keys))]
        at = np.lexsort((own[3], own[1], ~own[2], own[0]))
        own = [x[at] for x in own]
        rank = np.arange(len(at)) - np.searchsorted(own[0], own[0])
        last = rank == self.k - 1
        self.floors[own[0][last]] = np.maximum(self.floors[own[0][last]], own[2][last])
        self.best[a] = tuple(x[rank < self.k] for x in own)

    def rows(self) -> tuple[np.ndarray, ...]:
        """query_id, vec_id, score and key of the best."""
        at, *rest = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*self.best.values())) if self.best else (np.empty(0, np.int64),) * 4
        return self.ids[at], *rest


def weight_lists(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *column.value_lengths().to_pylist()])
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def _search(queries, k: int):
    def run(batches):
        search = Search(*queries.value, k)
        held, ids, keys, width = [], [], [], 0
        for batch in batches:
            for i, w, key in zip(batch.column(0).to_pylist(), weight_lists(batch.column(1)), batch.column(2).to_pylist()):
                if held and (len(held) >= STEP or (len(held) + 1) * max(width, len(w)) > CELLS):
                    search.show(np.array(ids, np.int64), held, np.array(keys, np.int64))
                    held, ids, keys, width = [], [], [], 0
                held.append(w), ids.append(i), keys.append(key)
                width = max(width, len(w))
        if held:
            search.show(np.array(ids, np.int64), held, np.array(keys, np.int64))
        out = search.rows()
        for a in range(0, len(out[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 100_000]) for x in out], ["query_id", "vec_id", "score", "key"])

    return run


def usable(vectors: DataFrame, *columns: Column) -> DataFrame:
    """vec_id, weights (integers) and ``columns`` of rows whose vec_id and vector are whole and finite."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(broken, F.lit(False)))
    weights = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), weights.alias("weights"), *columns)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best of all other vectors for every query row."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = usable(vectors, F.coalesce(is_query, F.lit(False)).alias("asked")).withColumn("key", F.xxhash64("weights"))
    rows = land(rows.withColumn("first", F.pmod(F.xxhash64("vec_id", "key"), F.lit(FIRST)) == 0), "vectors")
    asked = land(rows.where("asked").select("vec_id", "weights").distinct(), "queries")
    size = asked.agg(F.coalesce(F.sum(8 * F.size("weights") + 32), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "key")
    found = None
    for block in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        held = part.toArrow()
        ids, weights = held["vec_id"].to_numpy(), [np.array(w, np.int64) for w in held["weights"].to_pylist()]
        floors, best = np.full(len(ids), NONE), None
        for first in (True, False):
            queries = spark.sparkContext.broadcast((ids, weights, floors))
            some = rows.where(F.col("first") if first else ~F.col("first")).select("vec_id", "weights", "key")
            some = some.mapInArrow(_search(queries, k), "query_id long, vec_id long, score long, key long")
            some = some if best is None else some.unionByName(best.drop("rank"))
            some = land(some.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
            if best is not None:
                release(best)
            best = some
            if first:
                # vectors that share a query's vec_id share its list, and so its floor
                proven = dict(best.where(F.col("rank") == k).select("query_id", "score").toLocalIterator())
                floors = np.array([proven.get(i, NONE) for i in ids.tolist()], np.int64)
        found = best if found is None else found.unionByName(best)
    if blocks > 1:
        found = found.select("query_id", "vec_id", "score", "key").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    release(asked, rows)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
