"""Benchmark decontamination by winnowing.

Both sides are words (runs of digits, ASCII letters and non-ASCII characters; A-Z lower-cased). Of every
SPAN - GRAM + 1 successive GRAM-word hashes the least is kept as a fingerprint, on both sides by the same rule,
so every shared span of at least SPAN words shares a fingerprint. Fingerprints of documents are joined with
those of the benchmark, and each hit is extended to the left and right as far as the words agree; a run of at
least SPAN words is marked. An item of 1 to SPAN - 1 words is one window as a whole and found by the hash of all
its words, which is looked up at every place of a document.

The benchmark's index goes to the executors in blocks of at most ``block_words`` words (16 bytes each: a hash and an item), one
broadcast a block; a document passes through all blocks in one task and carries its hits along. So the
broadcast stays bounded for any benchmark, and no document's text is shuffled.

A null text or one without words has no windows and no hits. Items that repeat an item_id are one item in
``items``; null item_ids are left out of it, though their words are marked. Rows of documents are independent: repeated
rows, ties and other columns don't matter. Empty tables: no documents give no rows, no items give no hits.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.carried import parted
from folioscope.llm.words import WordHashes, alnum_words, grams
from folioscope.storage import bounded_batches, frugal, land

SPAN, GRAM = 10, 5


def fingerprints(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of every ``window`` successive ones (ties: all); all, if there are fewer."""
    if len(h) <= window:
        return np.arange(len(h)) if len(h) < window else np.flatnonzero(h == h.min())
    least = h[: len(h) - window + 1].copy()
    for i in range(1, window):
        np.minimum(least, h[i : i + len(least)], out=least)
    most = np.zeros(len(h), np.uint64)
    for i in range(window):
        np.maximum(most[i : i + len(least)], least, out=most[i : i + len(least)])
    return np.flatnonzero(h == most)


class Index:
    """Fingerprints of a block of benchmark items, and their windows of SPAN words, each once with the list of items that hold it."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        hashes, keys, windows, owners, self.names = WordHashes(), [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
        short: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            w = hashes.of(alnum_words(text))
            if not len(w):
                continue
            k = len(self.names)
            self.names.append(name)
            if len(w) < SPAN:
                short[len(w)][int(grams(w, len(w))[0])].add(k)
                continue
            g, own = grams(w, GRAM), np.unique(grams(w, SPAN))
            keys.append(g[fingerprints(g, SPAN - GRAM + 1)]), windows.append(own), owners.append(np.full(len(own), k))
        self.short = {n: (np.sort(np.array(list(x), np.uint64)), {h: np.array(sorted(v)) for h, v in x.items()}) for n, x in short.items()}
        self.keys = np.unique(np.concatenate(keys))
        windows, owners = np.concatenate(windows), np.concatenate(owners)
        order = np.argsort(windows, kind="stable")
        self.windows, starts = np.unique(windows[order], return_index=True)
        #: Windows that the same items hold share a list.
        self.lists, self.list_of = [], np.empty(len(self.windows), np.int64)
        seen: dict[bytes, int] = {}
        for i, own in enumerate(np.split(owners[order], starts[1:]) if len(starts) else []):
            k = seen.setdefault(own.tobytes(), len(self.lists))
            if k == len(self.lists):
                self.lists.append(own)
            self.list_of[i] = k

    def hits(self, w: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of a document's words inside occurrences of windows, and the items that occur.

        A fingerprint that both sides have is extended to every window of SPAN words around it; a window counts if it is one of the
        benchmark's, however many items hold it, and its items are added once.
        """
        spans, found = [], [np.empty(0, np.int64)]
        for n, (keys, known) in self.short.items():
            g = grams(w, n)
            at = np.flatnonzero(_member(keys, g)) if len(g) else np.empty(0, np.int64)
            spans += [(p, p + n) for p in at.tolist()]
            found += [known[h] for h in np.unique(g[at]).tolist()]
        g = grams(w, GRAM)
        if len(w) >= SPAN and len(self.keys):
            at = fingerprints(g, SPAN - GRAM + 1)
            at = at[_member(self.keys, g[at])]
            if len(at):
                starts = np.unique((at[:, None] - np.arange(SPAN - GRAM + 1)).reshape(-1))
                starts = starts[(starts >= 0) & (starts <= len(w) - SPAN)]
                h = grams(w, SPAN)[starts]
                own = _member(self.windows, h)
                spans += [(p, p + SPAN) for p in starts[own].tolist()]
                lists = np.unique(self.list_of[np.searchsorted(self.windows, np.unique(h[own]))])
                found += [self.lists[k] for k in lists.tolist()]
        return spans, set(np.unique(np.concatenate(found)).tolist())


def _member(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return keys[at] == x


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_CARRIED = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
_FOUND = "found struct<n_words: long, starts: array<long>, ends: array<long>, items: array<string>>"


def _mark(index, first: bool):
    """Adds the hits in one block of the benchmark to the last column, which ``first`` creates."""

    def run(batches):
        hashes, block = WordHashes(), index.value
        for batch in batches:
            out = []
            was = [None] * len(batch) if first else batch.column(len(batch.columns) - 1).to_pylist()
            for text, x in zip(batch.column(0).to_pylist(), was):
                w = hashes.of(alnum_words(text))
                spans, found = block.hits(w)
                names = {block.names[k] for k in found} - {None}
                if x:
                    spans += zip(x["starts"], x["ends"])
                    names |= set(x["items"])
                spans = merged(spans)
                out.append({"n_words": len(w), "starts": [a for a, _ in spans], "ends": [b for _, b in spans], "items": sorted(names)})
            columns = batch.columns if first else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, _CARRIED)], [*batch.schema.names[: len(columns)], "found"])

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, block_words: int = 2_000_000) -> DataFrame:
    """For every row of ``documents``: ``row``, its columns, and ``found``: n_words, spans (starts, ends) of hit words, items."""
    spark = documents.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[1] // (2 * block_words)))  # a word takes two characters at least, with its blank
    out, row = parted(documents)
    schema = T.StructType([*out.schema.fields, *T.StructType.fromDDL(_FOUND).fields])
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in part.distinct().collect()]))
        out = out.mapInArrow(frugal(_mark(index, k == 0)), schema)
        if k % 4 == 3 and k + 1 < blocks:
            out = land(out, "hits")
    return out.select(row.alias("row"), "found")
