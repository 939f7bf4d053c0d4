from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from folioscope.llm import lookups


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_every_chunk_finds_its_keys(spark, most):
    rng = random.Random(most)
    texts = [None, "", *[" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 9))) for _ in range(60)]]
    rows = spark.createDataFrame(list(zip(texts, range(62))), "text string, rest int").repartition(3)
    table = spark.createDataFrame([(c, ord(c)) for c in "abcdexyz"], "key string, value int")
    keys_of = lambda t: set((t or "").split())
    chunks = lookups.chunked(rows, keys_of, most)
    held = chunks.collect()
    assert sorted((r.text, r.rest) for r in held if r.text is not None) == sorted(x for x in zip(texts, range(62)) if x[0] is not None)
    by = {}
    for r in held:
        by.setdefault((r.part, r.chunk), []).append(keys_of(r.text))
    assert all(len(set().union(*own)) <= most or max(map(len, own)) == len(set().union(*own)) for own in by.values())
    folder = lookups.found(chunks, keys_of, "key", table)
    for (part, chunk), own in by.items():
        got = lookups.loaded(folder, part, chunk)
        assert {(k, v) for k, v in zip(got["key"].to_pylist(), got["value"].to_pylist())} == {(k, ord(k)) for k in set().union(*own) & set("abcdexyz")} if got else not set().union(*own) & set("abcde")


def test_no_rows(spark):
    rows = spark.createDataFrame([], "text string, rest int")
    chunks = lookups.chunked(rows, lambda t: {t}, 5)
    folder = lookups.found(chunks, lambda t: {t}, "key", spark.createDataFrame([("a", 1)], "key string, value int"))
    assert chunks.count() == 0 and lookups.loaded(folder, 0, 0) is None
    assert chunks.where(F.col("part") == 0).count() == 0
