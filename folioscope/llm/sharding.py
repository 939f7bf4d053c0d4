"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to N - 1: by hash bucket of doc_id, the text's checksum and size, and within a bucket by these three.
The number is permuted by a keyed Feistel network over the least even number of bits
that holds N; values from N on walk on through the network until they fall below N (cycle walking), so the
walk is a permutation of 0 to N - 1. With position p, the shard is p mod shards and the slot p div shards: anyone can
compute both from the row's number, N and the key, shard sizes differ by one at most (the law ``rows``), and
slots have no gap.

Rows equal in all three are interchangeable; they are counted in a partial aggregate, numbered as one, and made rows
again in pieces of PIECE that are dealt anew, so that neither a doc_id nor equal rows are one task's work. The counted keys are
written once, without texts, so that numbers stay the same if executors are lost. Buckets hold some ROWS_A_BUCKET keys. Where each begins is a prefix sum
on two levels: in Spark within GROUP buckets, and over the groups, of which there are N / (ROWS_A_BUCKET * GROUP), on the driver.

A null text has no bytes and checksum 0. Null doc_ids are a key like others; repeated rows are each
placed, other columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.words import mix
from folioscope.storage import land

ROWS_A_BUCKET, GROUP, PIECE, ROUNDS = 50_000, 1_000, 10_000, 6


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The permutation of 0 to n - 1 at ``x``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out, walk = x.astype(np.uint64), np.arange(len(x))
    while len(walk):
        left, right = out[walk] >> shift, out[walk] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walk] = (left << shift) | right
        walk = walk[out[walk] >= n]
    return out.astype(np.int64)


def shards(documents: DataFrame, count: int = 40, key: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, row_number, position, shard and slot of every row of ``documents``."""
    spark = documents.sparkSession
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    rows = documents.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keys = land(rows.groupBy("doc_id", "text_crc32", "size").agg(F.count(F.lit(1)).alias("n")), "keys")
    total, n = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(64, -(-total // ROWS_A_BUCKET))
    keys = keys.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).cast("int"))
    counts = land(keys.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn("group", F.expr(f"bucket div {GROUP}").cast("int")), "buckets")
    before, first = 0, []
    for g, k in sorted(tuple(r) for r in counts.groupBy("group").agg(F.sum("n")).collect()):
        first.append((g, before))
        before += k
    within = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = spark.createDataFrame(first, "group int, first long")
    starts = counts.withColumn("k", F.coalesce(F.sum("n").over(within), F.lit(0))).join(groups, "group").select("bucket", (F.col("first") + F.col("k")).alias("start"))
    order = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    ranked = keys.withColumn("k", F.coalesce(F.sum("n").over(order), F.lit(0))).join(starts, "bucket")
    ranked = ranked.select("doc_id", "text_crc32", "size", (F.col("start") + F.col("k")).alias("a"), (F.col("start") + F.col("k") + F.col("n") - 1).alias("z"))
    pieces = ranked.where(F.col("z") - F.col("a") >= PIECE).withColumn("a", F.explode(F.sequence("a", "z", F.lit(PIECE).cast("long"))))
    pieces = pieces.withColumn("z", F.least("z", F.col("a") + PIECE - 1)).repartition("a")
    whole = ranked.where(F.col("z") - F.col("a") < PIECE).unionByName(pieces)
    numbered = whole.select("doc_id", "text_crc32", "size", F.explode(F.sequence("a", "z")).alias("row_number"))

    @F.pandas_udf("long")
    def position(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in numbers:
            yield pd.Series(permuted(x.to_numpy(), n, key))

    placed = numbered.withColumn("position", position("row_number"))
    return placed.select("doc_id", "size", "text_crc32", "row_number", "position", (F.col("position") % count).cast("int").alias("shard"), F.expr(f"position div {count}").alias("slot"))
