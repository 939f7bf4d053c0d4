from __future__ import annotations

import random

import numpy as np
import pytest

from folioscope.llm import minhash
from folioscope.llm.components import components
from folioscope.llm.words import WordHashes


def brute(docs, size):
    hashes = WordHashes()
    sets = {i: set(minhash.shingles(hashes, t, size).tolist()) for i, t in docs}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize(("size", "paired"), [(2, 2), (5, 64)])
def test_groups_equal_brute_force(spark, monkeypatch, size, paired):
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "ASKED", 8 * paired)
    monkeypatch.setattr(minhash, "OTHERS", 10 * paired)
    monkeypatch.setattr(minhash, "HUB", paired)
    rng = random.Random(6)
    docs = []
    for _ in range(60):
        docs.append(" ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 2, 3, 8, 40]))))
    base = [f"b{rng.randrange(500)}" for _ in range(150)]
    docs += [edited(rng, base, rng.randrange(0, 30)) for _ in range(140)]  # a centre and copies on both sides of the threshold
    chain = list(base[:100])
    for _ in range(25):  # each like the one before, not like the first
        chain = edited(rng, chain, 4).split()
        docs.append(" ".join(chain))
    docs += [docs[70]] * 30 + [docs[3].upper(), "", None, "  ", docs[75] + " "]
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size).collect()}
    assert got == brute(rows, size)


def test_no_link_escapes_the_prefix_filter(spark):
    rng = random.Random(9)
    sets = []
    for _ in range(40):
        base = [rng.randrange(10**6) for _ in range(rng.choice([3, 9, 30, 60, 200, 400]))]
        for _ in range(12):  # around the similarity, of differing sizes
            x = [y if rng.random() > rng.choice([0, 0.05, 0.1, 0.12]) else rng.randrange(10**6) for y in base]
            sets.append(sorted({*x, *[rng.randrange(10**6) for _ in range(rng.choice([0, 0, 1, len(base) // 8]))]}))
    for percent in (80, 60):
        rows = [(i, i % 400, s) for i, s in enumerate(sets)]
        prefix = minhash.prefixes(spark.createDataFrame(rows, "id long, c long, set array<long>"), percent)
        met = {tuple(r) for r in minhash.meetings(prefix, percent).collect()}
        linked = set()
        for i, _, x in rows:
            for j, _, y in rows[i + 1 :]:
                both = len({*x} & {*y})
                if 100 * both >= percent * (len(x) + len(y) - both) and i % 400 != j % 400:
                    linked.add((i, j))
        assert len(linked) > 100 and linked <= met


def test_templated_texts_below_the_similarity_cost_linear_work(spark):
    rng = random.Random(10)
    template, rows, compared = [f"t{k}" for k in range(300)], {}, {}
    for n in (500, 1000, 2000, 4000):
        docs = []
        for i in range(n):  # two of them have a similarity of about 0.77
            words = list(template)
            for k in range(0, 300, 15):
                words[k] = f"u{i}x{k}"
            docs.append((i, " ".join(words)))
        hashes = WordHashes()
        sets = [(i, i, minhash.shingles(hashes, t, 2).view(np.int64).tolist()) for i, t in docs]
        a, b = ({*sets[k][2]} for k in (0, 1))
        assert 0.74 < len(a & b) / len(a | b) < 0.79
        prefix = minhash.prefixes(spark.createDataFrame(sets, "id long, c long, set array<long>"), 80)
        rows[n], compared[n] = prefix.count(), minhash.meetings(prefix, 80).count()
    assert rows[4000] <= 100 + rows[500] * 8**1.1 and compared[4000] <= 10 + compared[500] * 8**1.1
    groups = minhash.near_duplicates(spark.createDataFrame(docs[:600], "doc_id long, text string"), 2)
    assert groups.where("not kept").count() == 0


def test_odd_documents(odd_documents):
    rows = minhash.near_duplicates(odd_documents, 2).collect()
    assert len(rows) == odd_documents.count()
    of = {r.doc_id: r for r in rows}
    assert of[None].component_id is None and of[None].kept
    assert of[0].n_shingles == 0 and of[0].kept and of[1].component_id == 1
    assert of[7].component_id == 6 and not of[7].kept and of[3].kept
    assert minhash.near_duplicates(odd_documents.where("false")).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1400)] + [(1, 2), (2, 3), (3, 1), (9, 9)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {i: 100 for i in range(100, 161)} | {i: 5 for i in range(1000, 1400)} | {5: 5, 1: 1, 2: 1, 3: 1}
    assert got == wanted


def test_bits_estimate_the_similarity():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2**63, 2000, np.uint64)
    y = np.concatenate([x[:1778], rng.integers(0, 2**63, 222, np.uint64)])  # similarity 0.8
    a, b = minhash.minima(x), minhash.minima(y)
    assert abs((a == b).mean() - 0.8) < 0.12
    same = minhash.BANDS * minhash.ROWS - sum(int(v).bit_count() for v in (minhash.bits(a) ^ minhash.bits(b)).view(np.uint64))
    assert same >= minhash._least_equal_bits(80)


def test_query_agrees_with_sql(spark):
    from oracle import assert_same

    from folioscope.llm import queries

    for name in ("op7_minhash", "op9_winnowing", "op2_maxscore", "op4_warc", "op10_chat"):
        assert_same(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), queries.ORACLE_SQL[name])


def test_linked_pairs_are_missed_below_1e_6():
    from math import comb

    n, least = minhash.BANDS * minhash.ROWS, minhash._least_equal_bits(80)
    by_bits = sum(comb(n, k) * 0.9**k * 0.1 ** (n - k) for k in range(least))
    assert by_bits < 1e-7 and by_bits + (1 - 0.8**minhash.ROWS) ** minhash.BANDS < 1e-6
