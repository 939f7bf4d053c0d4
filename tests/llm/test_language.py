from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from folioscope.llm import language


def test_probabilities_sum_to_one():
    texts = {"a": "the cat sat on the mat and the rat", "b": "der hund und die katze und das pferd"}
    counts = {}
    for lang, t in texts.items():
        keys, n = np.unique(language.gram_keys(language.padded(language.characters(t))), return_counts=True)
        counts[lang] = keys, n, 0.5
    model = language.Model(counts)
    symbols = np.unique(np.concatenate([k & np.uint64(0xFFFF) for k, _, _ in counts.values()]))
    for context in ("the", "und", "zzz", "  c"):
        c = np.uint64(sum(ord(x) << 16 * (2 - i) for i, x in enumerate(context)) << 16)
        unseen = np.array([0x4E2D], np.uint64)
        p = model.probabilities(language.ORDER, c | np.concatenate([symbols, unseen]))
        assert p.sum(0) == pytest.approx([1, 1])


class SlowModels:
    """Interpolated Kneser-Ney by the book, over strings and dictionaries, for each language."""

    def __init__(self, texts):
        self.counts, symbols = {}, set()
        for lang, text in texts:
            t = self.normal(text)
            symbols |= set(t) if t else set()
            self.counts.setdefault(lang, [None, None, None, None, Counter()])[4].update(t[i : i + 4] for i in range(len(t) - 3))
        for c in self.counts.values():
            for n in (3, 2, 1):
                c[n] = Counter(g[1:] for g in c[n + 1])
        self.uniform = 1 / (len({s for c in self.counts.values() for s in c[1]}) + 1)

    @staticmethod
    def normal(text):
        t = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
        return f"   {t} " if t else ""

    def probability(self, lang, gram):
        n = len(gram)
        if not n:
            return self.uniform
        c = self.counts[lang][n]
        once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
        d = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
        after = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        lower = self.probability(lang, gram[1:])
        if not after:
            return lower
        return max(c[gram] - d, 0) / sum(after) + min(1, d * len(after) / sum(after)) * lower

    def bits(self, lang, text):
        t = self.normal(text)
        return -sum(math.log2(self.probability(lang, t[i : i + 4])) for i in range(len(t) - 3))


@pytest.mark.parametrize("most", [language.MOST, 400])
def test_predictions_equal_brute_force(spark, most):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang is not null").orderBy("doc_id").limit(60).collect()
    learned = [(r.lang, " ".join((r.text or "").split()[:12])) for r in docs]
    slow = SlowModels(learned)
    found = language.learn(spark.createDataFrame(learned, "lang string, text string"), most=most, chunk=90)
    assert (found.entries is None) == (most == language.MOST) and found.langs == sorted(slow.counts) and len(found.langs) > 2
    texts = [" ".join((r.text or "").split()[12:18]) for r in docs[:25]] + ["中文", "zq-xj", "l'été"]
    rows = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), found).collect()
    for r in rows:
        t = texts[r.row.doc_id]
        if not slow.normal(t):
            assert r.lang_pred == "und"
            continue
        bits = {k: slow.bits(k, t) / (len(slow.normal(t)) - 3) for k in found.langs}
        assert r.bits == pytest.approx(min(bits.values())) and bits[r.lang_pred] == pytest.approx(r.bits)


def test_query_accuracy(spark):
    from folioscope.llm import queries

    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op8_kneser_ney"](spark, sf).collect()}
    held = [(rows[d.doc_id], d.lang) for d in spark.read.parquet(f"{sf}/documents.parquet").collect() if rows[d.doc_id].held_out]
    assert len(held) > 150 and sum(r.lang_pred == lang for r, lang in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_rejection_and_odd_documents(spark, odd_documents):
    learned = spark.createDataFrame([("en", "the cat sat on the mat with another cat " * 5), ("fr", "le chat est sur la table avec un autre chat " * 5), ("fr", None), ("en", "123")] * 4, "lang string, text string")
    found = language.learn(learned)
    assert found.predict("the other cat sat")[0] == "en" and found.predict("le chat est la")[0] == "fr"
    assert not found.predict("the other cat sat on the mat")[3] and found.predict("zqxj wvkq " * 40)[3]
    assert found.predict("12 !")[:2] == ("und", 0.0) and found.predict(None)[3]
    out = language.identify(odd_documents, found)
    assert out.select("row.*").columns == odd_documents.columns
    rows = out.collect()
    assert len(rows) == odd_documents.count()
    assert {r.row.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2}
    assert language.identify(odd_documents.where("false"), found).count() == 0
    none = language.learn(learned.where("false"))
    assert none.predict("the cat") == ("und", 0.0, None, True)
    # the same as a table
    table = language.learn(learned, most=20)
    assert table.entries is not None and table.predict("the cat sat on the mat")[0] == "en" and table.predict(None)[3]
    by = lambda rows: {(r.row.doc_id, r.row.text): (r.lang_pred, pytest.approx(r.score), r.rejected) for r in rows}
    assert by(language.identify(odd_documents, table).collect()) == by(rows)
    assert language.identify(odd_documents.where("false"), table).count() == 0


LEARNED = [("en", "the cat sat on the mat with another cat and many other words"), ("fr", "le chat est sur la table avec un autre chat été noël"), ("zh", "中文字符很多 中文 漢字 文字")]


@pytest.mark.parametrize("chunk", [5, 200_000])
def test_the_table_is_the_model(spark, chunk):
    learned = spark.createDataFrame(LEARNED, "lang string, text string")
    whole, table = language.learn(learned), language.learn(learned, most=15, chunk=chunk)
    assert whole.entries is None and table.model is None
    # an entry for each language that has the gram or context, and no other
    keys = {lang: language.needed(text) for lang, text in LEARNED}
    held = {r.key: r.langs for r in table.entries.collect()}
    assert {lang: {k for k, langs in held.items() if i in langs} for i, lang in enumerate(table.langs)} == keys
    texts = ["the cat", "le chat noël", "unseen zqx words", "中文 mat", "x" * 50, "", None] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    found = [{r.row.doc_id: r for r in language.identify(rows, x).collect()} for x in (whole, table)]
    for k, text in enumerate(texts):
        one, many = found[0][k], found[1][k]
        assert (one.lang_pred, one.rejected) == (many.lang_pred, many.rejected)
        assert one.score == pytest.approx(many.score) and one.bits == (None if one.bits is None else pytest.approx(many.bits))
        if k < 7:
            assert whole.predict(text)[2] == (None if one.bits is None else pytest.approx(one.bits)) == table.predict(text)[2]


def test_passes_over_texts_do_not_grow_with_the_model(spark):
    learned = spark.createDataFrame(LEARNED * 5, "lang string, text string")
    rows = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    passes = []
    for most in (200, 20, 1):
        df = language.identify(rows, language.learn(learned, most=most))
        passes.append(df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
    assert set(passes) == {1}


def test_calibration_covers_rare_languages(spark):
    many = [("en", f"the cat number {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyzabcd'[k // 100 % 10]}{'efghijklmn'[k // 1000]} sat on the mat") for k in range(6000)]
    rare = [("zh", f"中文字符很多{x}") for x in "甲乙丙"]
    found = language.learn(spark.createDataFrame(many + rare, "lang string, text string"))
    assert set(found.means) == {"en", "zh"}
    bits = {k: [found.predict(t)[2] * len(language.characters(t)) for lang, t in many + rare if lang == k] for k in found.means}
    sizes = {k: sum(len(language.characters(t)) for lang, t in many + rare if lang == k) for k in found.means}
    assert found.means == pytest.approx({k: sum(v) / sizes[k] for k, v in bits.items()})
    lang, _, _, rejected = found.predict("漢龍鳳麟龜" * 20 + "中")
    assert lang == "zh" and rejected
    assert not found.predict(rare[0][1])[3]
