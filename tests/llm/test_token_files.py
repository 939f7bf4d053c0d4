from __future__ import annotations

import random
import zlib
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pytest
from conftest_texts import PIECES
from tokenizers import Tokenizer

from folioscope.llm import queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def read(spark, folder, kind="long"):
    return sorted(((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_token_files(spark, folder, kind).collect()), key=lambda x: x[0])


def test_units_encode_as_the_library(library):
    rng = random.Random(4)
    pieces = [*PIECES, "ÉTÉ", "é", " ́", "İ", "ΣΑΣ", "don't", " 's", " ", " ", "　", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\r\n", "\t", "​", "<|endoftext|>", "<|startoftext|>x", "ＡＢ", "2019", "½", "한국", "…", "_", "😀"]
    encoder = token_files.Encoder(PATH, "<u2", most=50)
    assert encoder.cut
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 20))) for _ in range(4000)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_every_character_between_words(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b {c}d" for c in points[a : a + 5000]) for a in range(0, 70_000, 5000)]
    encoder = token_files.Encoder(PATH, "<u2")
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_files_are_encoded_whole(tokenizer_path, tokenizer):
    encoder = token_files.Encoder(tokenizer_path, "<u2")
    assert not encoder.cut
    assert np.frombuffer(encoder.encode("two  words"), "<u2").tolist() == tokenizer.encode("two  words").ids


@pytest.mark.parametrize("file_bytes", [300, 1 << 27])
def test_files_hold_all_documents_in_order(spark, library, odd_documents, file_bytes):
    folder = token_files.write_token_files(odd_documents.repartition(5), PATH, file_bytes=file_bytes)
    got = read(spark, folder)
    wanted = [(r.doc_id, ids_of(library, r.text)) for r in odd_documents.collect()]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((i, ids) for _, i, ids in got), key=key) == sorted(wanted, key=key)
    assert [i for _, i, _ in got] == sorted((i for i, _ in wanted), key=lambda i: (i is not None, i or 0))
    assert [s for s, _, _ in got] == np.cumsum([0, *[len(ids) for _, _, ids in got]])[:-1].tolist()
    rows = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()
    assert (len(rows) > 1) == (file_bytes < 1000) and {r.id_bytes for r in rows} == {2}
    # the flat files alone, in order of parts, are all ids
    flat = b"".join(open(f"{urlparse(folder).path}/{r.name}.bin", "rb").read() for r in rows)
    assert np.frombuffer(flat, "<u2").tolist() == [x for _, _, ids in got for x in ids]
    file = token_files.TokenFile(folder, rows[0].name, rows[0].n_docs, rows[0].n_ids, 2)
    assert file.ids(0).tolist() == got[0][2] and file.ids(0, rows[0].n_docs).size == rows[0].n_ids


def test_a_doc_id_that_repeats_is_in_several_parts(spark, library):
    docs = spark.createDataFrame([(7, f"text {i % 3}") for i in range(400)], "doc_id long, text string")
    folder = token_files.write_token_files(docs, PATH, file_bytes=400)
    assert spark.read.parquet(f"{folder}/manifest").count() > 3
    assert sorted(ids for _, _, ids in read(spark, folder)) == sorted(ids_of(library, f"text {i % 3}") for i in range(400))


def test_other_ids_and_wide_integers(spark, monkeypatch):
    docs = spark.createDataFrame([("b", "two"), ("a", "one"), (None, None)], "doc_id string, text string")
    folder = token_files.write_token_files(docs, PATH, end_id=70_000)
    assert [(i, ids[-1]) for _, i, ids in read(spark, folder, "string")] == [(None, 70_000), ("a", 70_000), ("b", 70_000)]
    assert read(spark, token_files.write_token_files(docs.where("false"), PATH), "string") == []


def test_broken_files_are_refused(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    folder = token_files.write_token_files(docs, PATH)
    (row,) = spark.read.parquet(f"{folder}/manifest").collect()
    path = f"{urlparse(folder).path}/{row.name}"
    whole = open(f"{path}.idx", "rb").read()
    for end, broken in ((".idx", whole[:-8]), (".idx", b"x" + whole[1:]), (".idx", whole[:24] + whole[32:] + whole[24:32]), (".bin", b"abc")):
        old = open(path + end, "rb").read()
        open(path + end, "wb").write(broken)
        with pytest.raises(ValueError):
            token_files.TokenFile(folder, row.name, row.n_docs, row.n_ids, 2)
        open(path + end, "wb").write(old)
    assert token_files.TokenFile(folder, row.name, row.n_docs, row.n_ids, 2).ids(0)[-1] == 1


def test_query(spark, library):
    from oracle import SF

    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op13_token_files"](spark, SF).collect())
    start = 0
    assert len(got) == len(texts)
    for (i, t), row in zip(texts, got):
        ids = ids_of(library, t)
        assert row == (start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
