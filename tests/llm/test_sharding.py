from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from folioscope.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    got = sharding.permuted(np.arange(n), n, 7)
    assert sorted(got.tolist()) == list(range(n))
    if n >= 64:
        assert (got != np.arange(n)).mean() > 0.9 and (got != sharding.permuted(np.arange(n), n, 8)).any()


def slow_permutation(n, key):
    """The same network in plain integers, from its definition: round keys, halves exchanged, values of n and more walked on."""
    def mixed(h):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = (h ^ (h >> shift)) * factor % 2**64
        return h

    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = [mixed((r * 0x9E3779B97F4A7C15 + key) % 2**64) for r in range(1, sharding.ROUNDS + 1)]

    def once(x):
        left, right = x >> half, x % 2**half
        for k in keys:
            left, right = right, left ^ (mixed((right + k) % 2**64) % 2**half)
        return (left << half) | right

    out = []
    for x in range(n):
        x = once(x)
        while x >= n:
            x = once(x)
        out.append(x)
    return out


@pytest.mark.parametrize(("n", "key"), [(1, 7), (5, 7), (100, 7), (1000, 12345)])
def test_permutation_equals_plain_integers(n, key):
    assert sharding.permuted(np.arange(n), n, key).tolist() == slow_permutation(n, key)


def test_equal_rows_and_ids_are_dealt_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 16)
    rows = [(None, None)] * 300 + [(7, f"t{k}") for k in range(200)] + [(8, "same")] * 40 + [(k, "x") for k in range(100, 160)]
    placed = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    law(placed, 7, 600)
    assert Counter((r.doc_id, r.text_crc32) for r in placed) == Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(r.row_number for r in placed) == list(range(600))


def law(rows, count, n):
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == n and max(sizes.values()) - min(sizes[s] for s in range(count)) <= 1
    for s in range(count):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_query(spark):
    from oracle import SF

    from folioscope.llm import queries

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_feistel"](spark, SF).collect()
    law(rows, 40, len(texts))
    again = {r.doc_id: (r.shard, r.slot) for r in queries.QUERIES["op6_feistel"](spark, SF).collect()}
    for r in rows:
        t = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 16, zlib.crc32(t), "rows", None)
        assert again[r.doc_id] == (r.shard, r.slot)


def test_odd_documents(odd_documents):
    rows = sharding.shards(odd_documents, 3).collect()
    law(rows, 3, odd_documents.count())
    assert next(r for r in rows if r.doc_id == 0).size == 16
    assert all(r.position == int(sharding.permuted(np.array([r.row_number]), len(rows), 7)[0]) for r in rows)
    assert sharding.shards(odd_documents.where("false")).count() == 0


def test_numbers_have_no_gap_whatever_the_buckets(spark, monkeypatch):
    rows = [(i % 70, f"text {i % 90}") for i in range(800)] + [(None, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for bucket, group in ((50_000, 1_000), (7, 3), (1, 1)):
        monkeypatch.setattr(sharding, "ROWS_A_BUCKET", bucket)
        monkeypatch.setattr(sharding, "GROUP", group)
        got = sharding.shards(docs, count=7).collect()
        assert sorted(r.row_number for r in got) == sorted(r.position for r in got) == list(range(805))
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
