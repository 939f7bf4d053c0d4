from __future__ import annotations

import math
import zlib

import corpus_pipeline
from test_decontaminate import brute as contamination
from test_minhash import brute as groups
from test_language import SlowModels
from test_pii import slow_spans

from folioscope.llm import language
from folioscope.llm.words import alnum_words
from folioscope.storage import land

SF = "/root/testdata/sf0.001"


def test_stages(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        df = land(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in df.collect()}
        assert set(after) <= set(before)
        if name != "encoding":
            assert df.columns == docs.columns
        if name == "language_id":
            assert len(after) >= 0.97 * len(before)
        if name == "near_duplicates":
            wanted = groups([(i, r.text) for i, r in before.items()], 5)
            assert set(after) == {i for i, (_, c) in wanted.items() if c == i}
        if name == "decontamination":
            assert set(after) == {i for i, r in before.items() if not contamination(alnum_words(r.text), benchmark)[0]}
        if name == "personal_data":
            assert set(after) == set(before)
            for i, r in after.items():
                assert not slow_spans(r.text) and r.n_chars == len(r.text)
        if name == "encoding":
            assert all(r.n_tokens == len(tokenizer.encode(before[i].text, add_special_tokens=False).ids) for i, r in after.items())
        docs, before = df, after


def test_null_texts_go_and_extra_columns_stay(spark, odd_documents):
    first = corpus_pipeline.STAGES[0][1](spark, odd_documents, SF)
    assert first.columns == odd_documents.columns and first.where("text is null").count() == 0
    second = corpus_pipeline.STAGES[1][1](spark, odd_documents, SF)
    assert second.where("doc_id = 7").count() == 0 and second.columns == odd_documents.columns


def test_near_duplicates_goes_by_rows(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    rows = [(1, a), (1, a), (None, a), (5, a), (5, b), (None, None), (None, None), (None, "c d e f g h"), (None, "c d e f g h")]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    wanted = [(1, a), (5, b), (None, None), (None, None), (None, "c d e f g h")]
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, wanted))


def test_every_stage_takes_odd_documents_and_empty_tables(spark, odd_documents):
    for name, stage in corpus_pipeline.STAGES:
        some = stage(spark, odd_documents, SF).collect()
        none = stage(spark, odd_documents.where("false"), SF)
        assert none.count() == 0
        if name != "encoding":
            assert none.columns == odd_documents.columns
        if name in ("decontamination", "personal_data", "encoding"):
            assert len(some) == odd_documents.count()
        if name == "personal_data":
            assert sorted(map(repr, map(tuple, some))) == sorted(map(repr, map(tuple, odd_documents.collect())))


def test_rejection_equals_a_slow_model(spark):
    learned = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(80).collect()]
    rows = [(r.doc_id, " ".join((r.text or "").split()[:10]), r.lang) for r in learned]
    rows += [(10_000 + k, "zqxj wvkq xxqz " * 6 + "kjq " * k, None) for k in range(4)] + [(20_000, None, "en"), (20_001, "12 !", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = [(lang, t) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % 4 != 2]
    slow = SlowModels(own)
    size = lambda t: len(slow.normal(t)) - 2
    texts = sorted({(lang, t) for lang, t in own if slow.normal(t)})
    bits = {(lang, t): slow.bits(lang, t) / (size(t) - 1) for lang, t in texts}
    means = {k: sum(b * size(t) for (lang, t), b in bits.items() if lang == k) / sum(size(t) for lang, t in texts if lang == k) for k in {lang for lang, _ in texts}}
    excess = sorted((b - means[lang]) * size(t) ** 0.5 for (lang, t), b in bits.items())
    q = max(0.0, excess[math.ceil(language.QUANTILE * len(excess)) - 1])
    wanted = set()
    for i, t, _ in rows:
        if not slow.normal(t):
            continue
        least, lang = min((slow.bits(k, t) / (size(t) - 1), k) for k in means)
        if least - means[lang] <= language.SLACK + q / size(t) ** 0.5:
            wanted.add(i)
    got = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    assert got == wanted and 60 < len(got) < len(rows) - 3
