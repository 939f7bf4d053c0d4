from __future__ import annotations

import numpy as np
import pytest
from oracle import SF, assert_same
from pyspark.sql import functions as F

from folioscope.llm import hard_negatives, queries


def brute(rows, asked, positives=5, negatives=3, lower=50, upper=95):
    """By all pairs in Python's integers; rows of (vec_id, weights, label)."""
    rows = sorted({(i, tuple(w), label) for i, w, label in rows})
    cut = lambda s: max(-(2**63), min(2**63 - 1, s))
    out = []
    for a, q, label in rows:
        if not asked(a):
            continue
        scored = sorted((-cut(sum(x * y for x, y in zip(q, w))), i, g) for i, w, g in rows if i != a)
        own = [(-s, i) for s, i, g in scored if g == label][:positives]
        for p, i in own:
            fits = [(-s, j) for s, j, g in scored if g != label and 50 * p * lower <= 50 * 100 * -s <= 50 * upper * p][:negatives]
            out += [(a, i, r, j, p, s) for r, (s, j) in enumerate(fits, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, [x / 256 for x in w], label, "c") for i, w, label in rows], "vec_id long, embedding array<double>, label int, slot string")


def mined(df, asked, **kw):
    found = hard_negatives.mine(df, asked, **kw)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect())


@pytest.mark.parametrize("kind", ["dense", "ties", "skew", "many labels", "mixed lengths", "huge"])
def test_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PIECE", 150)
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    monkeypatch.setattr(hard_negatives, "HELD", 16)
    rng = np.random.default_rng(8)
    n = 400
    w = rng.integers(-300, 300, (n, 6)) + 90
    label = rng.integers(0, 4, n)
    if kind == "ties":
        w = rng.integers(0, 3, (n, 4))
    if kind == "skew":
        label = np.where(rng.random(n) < 0.9, 0, label)
    if kind == "many labels":
        label = rng.integers(0, 150, n)
    if kind == "huge":
        w = rng.integers(0, 2**31, (n, 6))
    rows = [(i, x[: 1 + i % 6] if kind == "mixed lengths" else x, g) for i, (x, g) in enumerate(zip(w.tolist(), label.tolist()))]
    for block_bytes in (1 << 20, 400):
        assert mined(frame(spark, rows), F.col("vec_id") % 40 == 0, block_bytes=block_bytes) == brute(rows, lambda i: i % 40 == 0)


def test_nodes_outside_the_windows_are_not_scored():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * 900
    weights = np.floor(np.repeat(centres, 200, 0) + rng.normal(size=(8000, 16)) * 20).astype(np.int64)
    labels, ids = np.repeat(np.arange(40) % 8, 200), np.arange(8000)
    anchors = ids[::400]
    vectors = [weights[i] for i in anchors]
    full = np.full((len(anchors), 1), hard_negatives.LOW, np.int64)
    for same, lo, hi in ((True, full, -full - 1), (False, np.full((len(anchors), 2), 10**6), np.full((len(anchors), 2), 3 * 10**6))):
        search = hard_negatives.Search(anchors, labels[anchors], vectors, lo, hi, np.full(lo.shape, hard_negatives.LOW), 3, same)
        search.show(ids, labels, list(weights), ids)
        assert 0 < search.scored < 0.3 * search.all
        got = set(zip(*(x.tolist() for x in search.best[:3])))
        for a, (i, v) in enumerate(zip(anchors, vectors)):
            s = weights @ v
            fits = sorted((-int(s[j]), j) for j in ids if j != i and (labels[j] == labels[i]) == same and lo[a, 0] <= s[j] <= hi[a, 0])[:3]
            assert {(a * lo.shape[1] + p, j, -x) for x, j in fits for p in range(lo.shape[1])} == {x for x in got if x[0] // lo.shape[1] == a}


def test_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.9], 2), (2, [0.9, 0.9], 2), (3, [0.5, 0.5], 2), (4, [0.49, 0.5], 2)]
    rows += [(5, None, 1), (6, [1.0, None], 2), (7, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (9, [0.9, 0.9], None), (None, [0.9, 0.9], 2), (10, [], 2), (11, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = mined(df, F.col("vec_id") == 0)
    # positives of 0: 1 (score 131072) and 11 (score 0, whose window holds 0 only: row 10)
    assert got == [(0, 1, 1, 2, 131072, 117760), (0, 1, 2, 3, 131072, 65536), (0, 11, 1, 10, 0, 0)]
    assert mined(df.where("false"), F.lit(True)) == []
    assert mined(df, F.lit(False)) == []
    named = df.withColumn("label", F.concat(F.lit("l"), F.col("label").cast("string")))
    assert mined(named, F.col("vec_id") == 0) == got


def test_query_agrees_with_sql(spark):
    assert_same(queries.QUERIES["op12_hard_negatives"](spark, SF), queries.ORACLE_SQL["op12_hard_negatives"])
