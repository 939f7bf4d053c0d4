from __future__ import annotations

import random

from folioscope.llm import decontaminate
from folioscope.llm.words import WordHashes, alnum_words


def brute(words, items):
    hit, found = set(), set()
    for name, text in items:
        w = alnum_words(text)
        n = min(decontaminate.SPAN, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(name)
    return hit, found


def cases(rng, n):
    for _ in range(n):
        letters = "abcd"[: rng.randint(1, 4)]
        items = [(str(i), " ".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 5, 7, 9, 10, 11, 14, 25])))) for i in range(4)]
        doc = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
        for _ in range(2):
            x = rng.choice(items)[1].split()
            a, p = rng.randint(0, len(x)), rng.randint(0, len(doc))
            doc[p:p] = x[a : a + rng.randint(5, 20)]
        yield " ".join(doc), items


def test_hits_equal_brute_force():
    for doc, items in cases(random.Random(9), 1500):
        index, words = decontaminate.Index(items), alnum_words(doc)
        spans, found = index.hits(WordHashes().of(words))
        got = {i for a, b in decontaminate.merged(spans) for i in range(a, b)}
        assert (got, {index.names[k] for k in found}) == brute(words, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    rng = random.Random(10)
    docs = [d for d, _ in cases(rng, 40)]
    items = [(i, x[1]) for _, c in cases(rng, 6) for i, x in enumerate(c)]
    items = [(k, t) for k, (_, t) in enumerate(items)]
    documents = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = {r.row.doc_id: r.found for r in decontaminate.contamination(documents, benchmark).collect()}
    many = {r.row.doc_id: r.found for r in decontaminate.contamination(documents, benchmark, block_words=60).collect()}
    assert one == many
    for i, d in enumerate(docs):
        hit, found = brute(alnum_words(d), [(str(k), t) for k, t in items])
        assert {p for a, b in zip(one[i].starts, one[i].ends) for p in range(a, b)} == hit and set(one[i]["items"]) == found


def test_odd_documents(spark, odd_documents):
    benchmark = spark.createDataFrame([(1, "word " * 12), (1, "x"), (None, "same text here"), (2, None), (3, "")], "item_id long, text string")
    rows = decontaminate.contamination(odd_documents, benchmark).collect()
    assert len(rows) == odd_documents.count() and rows[0].row.__fields__ == odd_documents.columns
    of = {r.row.doc_id: r.found for r in rows}
    assert of[0].n_words == 0 and of[0].starts == [] and of[8].ends == [30_000] and of[8]["items"] == ["1"]
    assert of[6].starts == [0] and of[6]["items"] == []
    empty = benchmark.where("false")
    assert all(not r.found.starts for r in decontaminate.contamination(odd_documents, empty).collect())
    assert decontaminate.contamination(odd_documents.where("false"), benchmark).count() == 0


def test_a_preamble_that_all_items_share_costs_as_much_as_one():
    import time

    import numpy as np

    from folioscope.llm.words import WordHashes, alnum_words

    preamble = " ".join(f"w{i}" for i in range(12))
    text = " ".join(f"{preamble} own {i}" for i in range(20))
    took = {}
    for n in (1000, 16_000):
        index = decontaminate.Index([(f"i{k}", f"{preamble} item {k} says this") for k in range(n)])
        w = WordHashes().of(alnum_words(text))
        assert len(index.lists) < n + 10
        start = time.perf_counter()
        spans, found = index.hits(w)
        took[n] = time.perf_counter() - start
        assert len(found) == n and decontaminate.merged(spans) == [(14 * i, 14 * i + 12) for i in range(20)]
    assert took[16_000] < 0.2
    assert isinstance(index.list_of, np.ndarray)
