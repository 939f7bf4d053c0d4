"""Byte-pair encoding by forced boundaries, and decoding.

Every text is cut at all certain boundaries (fragments.py), each fragment encoded by itself, and the ids are
concatenated. Ids are those of the tokenizers library with add_special_tokens=False: special strings inside a
text become special tokens. Decoding joins the bytes of the ids, special tokens included.

A null text is encoded as the empty text: no ids. Rows are independent: repeated rows and doc_ids, ties and
other columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.fragments import Encoder, joined, token_bytes
from folioscope.storage import bounded_batches, frugal


def _encoded(path: str):
    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            ids = encoder.encode_many([(t or "").encode("utf-8") for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def _decoded(path: str):
    def run(batches):
        tokens = token_bytes(path)
        for batch in batches:
            texts = [joined(tokens, i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return run


def encode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids of every row: binary, little-endian unsigned 32-bit integers."""
    bounded_batches(documents.sparkSession)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(_encoded(tokenizer)), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Adds the decoded text to rows of (doc_id, ids) as ``encode`` returns them."""
    bounded_batches(encoded.sparkSession)
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(frugal(_decoded(tokenizer)), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def _recoded(path: str):
    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            ids = encoder.encode_many([(t or "").encode("utf-8") for t in batch.column(1).to_pylist()])
            texts = [encoder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return run


def recode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """What ``decode`` makes of what ``encode`` returns, by one Python worker instead of two."""
    bounded_batches(documents.sparkSession)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(frugal(_recoded(tokenizer)), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def id_list(ids: bytes) -> list[int]:
    """Ids of the binary form as Python integers."""
    return np.frombuffer(ids, "<u4").tolist()
