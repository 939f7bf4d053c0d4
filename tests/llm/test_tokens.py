from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest_texts import PIECES

from folioscope.llm import bpe, fragments, token_counts


def random_text(rng, most):
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, most)))


def test_fragments_encode_as_the_library(tokenizer_path, tokenizer):
    rng, encoder = random.Random(1), fragments.Encoder(tokenizer_path, most=500)
    texts = [random_text(rng, 14) for _ in range(3000)]
    got = encoder.encode_many([t.encode() for t in texts])
    for t, ids in zip(texts, got):
        wanted = tokenizer.encode(t, add_special_tokens=False).ids
        assert bpe.id_list(ids) == wanted, t
        assert encoder.decode(ids) == tokenizer.decode(wanted, skip_special_tokens=False) == t


def test_cuts_are_certain(tokenizer_path):
    tokens = fragments.token_bytes(tokenizer_path)
    table = fragments.cut_table(tokens)
    for t in tokens:
        assert fragments.bounds(t, table) in ([0, len(t)], [0])
    assert fragments.bounds("the quick fox".encode(), table) == [0, 3, 9, 13]


@pytest.mark.parametrize("plain", [True, False])
def test_resynchronised_counts(tokenizer_path, tokenizer, plain):
    rng, encoder = random.Random(2), token_counts.Encoder(tokenizer_path, most=300)
    assert encoder.plain
    encoder.plain = plain  # the library's own offsets otherwise
    counter = token_counts.Resynchroniser(encoder, chunk=200, overlap=40)
    for _ in range(150):
        t = random_text(rng, 300) + "x" * rng.choice([0, 0, 900]) + random_text(rng, 100)
        assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids)
    assert counter.splices > 100 and counter.widenings > 50


def test_every_character_is_read_as_the_library_reads_it(tokenizer_path, tokenizer):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    random.Random(3).shuffle(points)
    counter = token_counts.Resynchroniser(token_counts.Encoder(tokenizer_path))
    for t in ("".join(points[:20_000]), " ".join(points[20_000:40_000]), "'".join(points[40_000:50_000])):
        assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids)


def test_a_long_word_is_read_in_growing_chunks(tokenizer_path, tokenizer):
    counter = token_counts.Resynchroniser(token_counts.Encoder(tokenizer_path))
    read = []
    counter._read, inner = lambda text, a, b: (read.append(b - a), inner(text, a, b))[1], counter._read
    t = "some words, " * 300 + "x" * 100_000 + " and more" * 300
    assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids)
    assert sum(read) < 6 * len(t)


def test_the_query_splices(tokenizer_path, tokenizer, spark):
    from oracle import SF

    counter = token_counts.Resynchroniser(token_counts.Encoder(tokenizer_path))
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    long = sum(len(t) > token_counts.CHUNK for t in texts)
    for t in texts:
        assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids)
    assert long > 50 and counter.splices >= long


@pytest.mark.parametrize("chunk", [100, 2048])
def test_odd_documents(chunk, odd_documents, tokenizer_path, tokenizer):
    rows = {(r.doc_id, r.text) for r in odd_documents.collect()}
    wanted = sorted((repr(i), len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in [(r.doc_id, r.text) for r in odd_documents.collect()])
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(odd_documents, tokenizer_path, chunk=chunk).collect())
    assert got == wanted and len(rows) < len(got)
    for r in bpe.decode(bpe.encode(odd_documents, tokenizer_path), tokenizer_path).collect():
        assert (r.doc_id, r.decoded) in {(i, t or "") for i, t in rows}
    none = odd_documents.where("false")
    assert token_counts.token_counts(none, tokenizer_path).count() == bpe.encode(none, tokenizer_path).count() == 0


@pytest.mark.parametrize("name", ["op3_token_counts", "op5_bpe"])
def test_queries(spark, tokenizer, name):
    from oracle import SF

    from folioscope.llm import queries

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        if name == "op5_bpe":
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        else:
            assert (r.n_bytes, r.over_limit) == (len(texts[r.doc_id].encode()), len(ids) > 512)
