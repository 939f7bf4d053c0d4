"""Token ids as flat binary files with 64-bit document offsets, for training readers that map them into memory.

Documents are dealt by ranges of doc_id and sorted; every partition encodes its own and streams one set of files:

* ``part-N-*.bin``: the ids of its documents, one after the other, as little-endian unsigned integers of 16 bits, or of 32 where the
  vocabulary needs them; nothing else.
* ``part-N-*.idx``: MAGIC, the bytes of an id and the number of documents (both unsigned 64-bit), then the documents' offsets
  in ids within the part, one more than documents, as unsigned 64-bit integers.
* ``part-N-*.docs``: an Arrow file with the doc_ids.

A part's base, the ids of all parts before it, comes from prefix sums over the parts' counts and stands in the table ``manifest`` (one
row per part), so a document's global offset is base + offset, without a second pass over ids. Only counts go through the driver: one
row per FILE_BYTES of text. The manifest names the files: every attempt of a task writes files of its own, and those of an attempt
that was lost are named nowhere. Files are written and read through Arrow's file systems in the folder that the cluster
shares, mapped into memory where that is a mounted path, and read by ranges elsewhere.

Files of the form ``cuts_at_blanks`` tells (white space is dropped, and no rule crosses it) are read by their published pattern: texts, or their
units between ASCII blanks, of ASCII and the letters U+00C0-00FF alone are lower-cased and cut into pre-tokens here, other units go
through the library whole. Every distinct pre-token is encoded by the library's model and kept in a cache of bounded size, which tasks of a
worker share. With files of another form texts are encoded whole. Ids are those of the tokenizers library with add_special_tokens=False and the end id.

A null text is empty: its document is the end id alone. Documents are in ascending order of doc_id, null first; repeated doc_ids are in order
of a hash of their texts, and rows equal in both are interchangeable, so no doc_id is bound to one part. An empty table gives no
part, and reading it no row. Other columns don't matter.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.fragments import byte_of_char
from folioscope.storage import bounded_batches, land, new_folder, release

MAGIC = b"FOLIOIDS"
#: Bytes of text per file, and the least for which a file more is made to keep all cores busy; bytes of a batch read back.
FILE_BYTES, LEAST_BYTES, READ_BYTES = 256 << 20, 8 << 20, 4 << 20
#: A pre-tokenizer pattern none of whose matches holds white space or depends on it (fixed value of such files).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_at_blanks(spec: dict) -> bool:
    """Whether texts can be cut at white space: it is dropped, and no rule of the tokenizer file crosses it."""
    normal = (spec["normalizer"] or {}).get("normalizers", [])
    blanks = [n for n in normal if n["type"] == "Replace"]
    if any(n["type"] not in ("NFC", "Lowercase", "Replace") for n in normal) or any((n["pattern"], n["content"]) != ({"Regex": r"\s+"}, " ") for n in blanks):
        return False
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    if [s["type"] for s in split] != ["Split", "ByteLevel"] or split[1]["add_prefix_space"] or split[1]["use_regex"]:
        return False
    if (split[0]["pattern"], split[0]["behavior"], split[0]["invert"]) != ({"Regex": WORDS}, "Removed", True):
        return False
    added = spec["added_tokens"]
    plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return plain and not any(t["content"].split() != [t["content"]] for t in added) and spec["post_processor"] is None


#: Letters beyond ASCII that are read here, in lower case, and texts of which all characters are.
_LATIN = "\u00df-\u00f6\u00f8-\u00ff"
_KNOWN = re.compile(f"[\\t-\\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
#: The pattern WORDS over these characters; its alternatives exclude each other but for the contractions, which come first.
_PIECES = re.compile(f"[a-z{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\\sa-z0-9{_LATIN}]+").findall


class Encoder(dict):
    """Ids of texts, as bytes of ``kind``; itself the cache of pieces, in two generations of at most ``most`` each.

    A piece is a pre-token, or after a NUL a unit that the library has to read.
    """

    LONGEST = 64

    def __init__(self, path: str, kind: str, most: int = 250_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.cut, self.code, self.most, self.older = cuts_at_blanks(spec), {2: "H", 4: "I"}[np.dtype(kind).itemsize], most, {}
        self.model, self.letters = self.tokenizer.model.tokenize, {b: c for c, b in byte_of_char().items()}
        added = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(added) or "(?!)").search

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def by_library(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            if piece[0] == "\0":
                ids = self.by_library(piece[1:])
            else:
                word = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.letters)
                ids = self.packed([t.id for t in self.model(word)])
        if len(piece) <= self.LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def pieces(self, text: str) -> list[str]:
        if _KNOWN(text) and not self.special(text):
            return _PIECES(text.lower())
        out = []
        for unit in text.encode("utf-8").split():
            unit = unit.decode("utf-8")
            out += _PIECES(unit.lower()) if _KNOWN(unit) and not self.special(unit) else ["\0" + unit]
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text))) if self.cut else self.by_library(text)


@lru_cache(maxsize=2)
def encoder(path: str, kind: str) -> Encoder:
    """The encoder of this worker, which its tasks share."""
    return Encoder(path, kind)


def id_kind(path: str, end_id: int) -> str:
    """Unsigned integers of 16 bits if all ids fit, else of 32."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    return "<u2" if max([*vocab.values(), end_id]) < 1 << 16 else "<u4"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _written(folder: str, tokenizer: str, kind: str, end_id: int):
    """Sorted rows (part, doc_id, text) of one part to files, and one row about them."""

    def run(batches):
        encode, end, size = encoder(tokenizer, kind).encode, np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize
        out, offsets = None, [0]
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, path = _store(folder)
                store.create_dir(path, recursive=True)
                part = batch.column(0)[0].as_py()
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                out, ids = store.open_output_stream(f"{path}/{name}.bin"), store.open_output_stream(f"{path}/{name}.docs")
                docs = pa.ipc.new_file(ids, pa.schema([batch.schema.field(1)]))
            docs.write_batch(batch.select([1]))
            for text in batch.column(2).to_pylist():
                data = encode(text or "") + end
                out.write(data)
                offsets.append(offsets[-1] + len(data) // size)
        if out is None:
            return
        out.close(), docs.close(), ids.close()
        with store.open_output_stream(f"{path}/{name}.idx") as f:
            f.write(MAGIC + np.array([size, len(offsets) - 1], "<u8").tobytes() + np.array(offsets, "<u8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "n_docs": [len(offsets) - 1], "n_ids": [offsets[-1]]})

    return run


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Writes the ids of (doc_id, text), each document's followed by ``end_id``, and returns the folder.

    ``tokenizer`` is the path of a file of the tokenizers library, the same on all machines; ``folder`` is a URI that driver and executors
    share. A file has the ids of about ``file_bytes`` of text.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    folder = folder or f"{new_folder(spark)}/tokens"
    kind = id_kind(tokenizer, end_id)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-total // file_bytes), min(4 * spark.sparkContext.defaultParallelism, count, total // LEAST_BYTES))
    order = ["doc_id", "tie", "row"]
    dealt = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    found = land(dealt.mapInArrow(_written(folder, tokenizer, kind, end_id), "part int, name string, n_docs long, n_ids long"), "parts")
    held = found.orderBy("part").toArrow()
    for name, of in (("first_doc", "n_docs"), ("base", "n_ids")):
        n = held[of].to_numpy()
        held = held.append_column(name, pa.array(np.cumsum(n) - n, pa.int64()))
    held = held.append_column("id_bytes", pa.array([np.dtype(kind).itemsize] * len(held), pa.int32()))
    spark.createDataFrame(held, SCHEMA).coalesce(1).write.parquet(f"{folder}/manifest")
    release(found)
    return folder


SCHEMA = "part int, name string, n_docs long, n_ids long, first_doc long, base long, id_bytes int"


class TokenFile:
    """One part, checked against its manifest row: offsets and ids, mapped into memory where it has a local path."""

    def __init__(self, folder: str, name: str, n_docs: int, n_ids: int, id_bytes: int):
        store, path = _store(folder)
        local = isinstance(store, pafs.LocalFileSystem)
        opened = (lambda end: pa.memory_map(f"{path}/{name}{end}")) if local else (lambda end: store.open_input_file(f"{path}/{name}{end}"))
        self.bin, index = opened(".bin"), opened(".idx")
        head = index.read_buffer(24)
        if bytes(head[:8]) != MAGIC or np.frombuffer(head[8:], "<u8").tolist() != [id_bytes, n_docs] or index.size() != 24 + 8 * (n_docs + 1):
            raise ValueError(f"{name}.idx is broken or of another form")
        self.offsets = np.frombuffer(index.read_buffer(8 * (n_docs + 1)), "<u8")
        if self.bin.size() != n_ids * id_bytes or self.offsets[0] or int(self.offsets[-1]) != n_ids or (self.offsets[1:] < self.offsets[:-1]).any():
            raise ValueError(f"{name}.bin doesn't fit its offsets")
        self.kind, self.docs = f"<u{id_bytes}", lambda: pa.ipc.open_file(opened(".docs")).read_all().column(0).combine_chunks()

    def ids(self, k: int, n: int = 1) -> np.ndarray:
        """The ids of ``n`` documents from the ``k``-th of the part on, a view of the file where it is mapped."""
        a, z, size = int(self.offsets[k]), int(self.offsets[k + n]), int(self.kind[2])
        self.bin.seek(a * size)
        return np.frombuffer(self.bin.read_buffer((z - a) * size), self.kind)


def _read(folder: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(folder, row["name"], row["n_docs"], row["n_ids"], row["id_bytes"])
                docs, k = file.docs(), 0
                if len(docs) != row["n_docs"]:
                    raise ValueError(f"{row['name']}.docs doesn't fit its offsets")
                while k < row["n_docs"]:
                    # at least one document, and as many as READ_BYTES hold
                    last = int(np.searchsorted(file.offsets, file.offsets[k] + np.uint64(READ_BYTES // 4), "right")) - 1
                    n = max(1, min(last, row["n_docs"]) - k)
                    flat = file.ids(k, n).astype("<u4")
                    ends = (file.offsets[k : k + n + 1] - file.offsets[k]).astype(np.int64) * 4
                    data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])
                    start = pa.array(row["base"] + file.offsets[k : k + n].astype(np.int64), pa.int64())
                    yield pa.RecordBatch.from_arrays([docs[k : k + n], start, data.cast(pa.binary())], ["doc_id", "start", "ids"])
                    k += n

    return run


def read_token_files(spark: SparkSession, folder: str, doc_id: str = "long") -> DataFrame:
    """doc_id (of the given type), start (ids of all documents before) and ids (little-endian unsigned 32-bit) of every document."""
    manifest = spark.read.schema(SCHEMA).parquet(f"{folder}/manifest")
    parts = max(1, manifest.count())
    dealt = manifest.repartitionByRange(parts, "part")
    return dealt.mapInArrow(_read(folder), f"doc_id {doc_id}, start long, ids binary")
