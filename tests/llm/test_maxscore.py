from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import maxscore


def brute(rows, asked, k):
    width = max((len(v) for _, v in rows), default=0)
    w = np.zeros((len(rows), width), np.int64)
    for i, (_, v) in enumerate(rows):
        w[i, : len(v)] = np.floor(256 * np.array(v, np.float32).astype(float))
    out = set()
    for i, (q, _) in enumerate(rows):
        if asked(q):
            best = sorted((-int(w[i] @ w[j]), c) for j, (c, _) in enumerate(rows) if c != q)[:k]
            out |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "mixed"])
def test_equals_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(maxscore, "STEP", 64)
    monkeypatch.setattr(maxscore, "SEED", 16)
    monkeypatch.setattr(maxscore, "BATCH", 4)
    rng = np.random.default_rng(13)
    v = rng.normal(size=(500, 24)).astype(np.float32)
    if kind == "sparse":
        v *= rng.random(v.shape) < 0.15
    if kind == "ties":
        v = np.round(v)
    rows = [(i, r.tolist()[: 24 if kind != "mixed" else 1 + i % 24]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for block_bytes in (1 << 20, 1000):
        got = {tuple(r) for r in maxscore.top_k(df, F.col("vec_id") % 50 == 0, 5, block_bytes).collect()}
        assert got == brute(rows, lambda q: q % 50 == 0, 5)


def shown(v, asked, k=5, step=128):
    ids = np.arange(len(v))
    search = maxscore.Search(ids[asked], [v[i] for i in ids[asked]], np.full(int(asked.sum()), maxscore.NONE), k)
    for a in range(0, len(v), step):
        search.show(ids[a : a + step], list(v[a : a + step]), ids[a : a + step])
    return search


def test_non_essential_postings_are_not_traversed():
    rng = np.random.default_rng(14)
    v = rng.integers(1, 9, (4000, 200)) * (rng.random((4000, 200)) < 0.03)
    v[:, :5] *= 40  # rare weights that matter
    search = shown(v, np.arange(4000) % 50 == 0)
    assert 0 < search.traversed < 0.03 * search.all_postings
    got = set(zip(*(x.tolist() for x in search.rows()[:3])))
    for q in range(0, 4000, 50):
        best = sorted((-int(v[q] @ v[j]), j) for j in range(4000) if j != q)[:5]
        assert {(q, j, -s) for s, j in best} <= got


def test_scores_above_2_to_the_53_are_exact(spark):
    big = 134_217_729 / 256  # the square of the weight exceeds 2**53
    rows = [(0, [big, big, 1 / 256])] + [(i, [big, big, i / 256]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    w = int(256 * big)
    assert got == [(0, r + 1, 39 - r, 2 * w * w + 39 - r) for r in range(5)]


def test_huge_weights_and_long_vectors_and_other_columns(spark):
    rows = [(0, [1e30, 1.0], 1, "x"), (1, [1e30, -1.0], 2, "y"), (2, [-1e30], 3, "z"), (3, [1.0] * 50_000, 4, "w"), (4, [2.0], 5, "v")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key long, weights string")
    got = [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert [r[2] for r in got] == [1, 3, 4, 2] and got[0][3] == 2**63 - 1 and got[3][3] == -(2**63)
    got = {tuple(r) for r in maxscore.top_k(df.where("vec_id > 2"), F.lit(True), 5).collect()}
    assert got == {(3, 1, 4, 512 * 256), (4, 1, 3, 512 * 256)}


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [3.0, -1.0]), (5, [3.0, -1.0]), (None, [1.0, 1.0]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert got == [(0, 1, 5, 65536), (0, 2, 6, 0)]
    assert maxscore.top_k(df.where("false"), F.col("vec_id") == 0).count() == 0
    assert maxscore.top_k(df.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_weights_whose_bound_leaves_64_bits_though_scores_do_not(spark):
    """The bound of |weight| * |weight| * width is beyond 2**62, the scores differ by one and fit."""
    big = 2**30 + 1
    n, width = 700, 64
    rows = [(0, [big / 256] + [1 / 256] * 63)] + [(i, [big / 256] + [0.0] * 62 + [(i % 40) / 256]) for i in range(1, n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert width * big * big > 2**62
    scores = sorted((-(big * big + i % 40), i) for i in range(1, n))[:5]
    assert got == [(0, r, i, -s) for r, (s, i) in enumerate(scores, 1)]


@pytest.mark.parametrize("power", [20, 29, 30, 31, 33])
def test_equals_integers_of_any_size(spark, power, monkeypatch):
    monkeypatch.setattr(maxscore, "SEED", 8)
    monkeypatch.setattr(maxscore, "STEP", 64)
    rng = np.random.default_rng(power)
    weights = rng.integers(-(2**power), 2**power, (300, 8)).tolist()
    rows = [(i, [x / 256 for x in w]) for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in maxscore.top_k(df, F.col("vec_id") % 50 == 0, 4).collect()}
    wanted = set()
    for q in range(0, 300, 50):
        score = [sum(a * b for a, b in zip(weights[q], w)) for w in weights]
        best = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for i, s in enumerate(score) if i != q)[:4]
        wanted |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert got == wanted


def test_exact_products():
    from folioscope.llm import exact

    rng = np.random.default_rng(3)
    for power in (4, 25, 27, 29, 31, 40, 62):
        q, w = (rng.integers(-(2**power), 2**power, (9, 5)) for _ in "qw")
        true = [[max(exact.LOW, min(exact.HIGH, sum(a * b for a, b in zip(x, y)))) for y in w.tolist()] for x in q.tolist()]
        assert exact.products(q, w).tolist() == true


def test_tasks_report_only_what_reaches_the_floors_of_the_first(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(4000, 8))
    search = maxscore.Search(np.array([0]), [np.floor(256 * v[0]).astype(np.int64)], np.array([10**9]), 5)
    search.show(np.arange(4000), list(np.floor(256 * v).astype(np.int64)), np.arange(4000))
    assert len(search.rows()[0]) == 0
