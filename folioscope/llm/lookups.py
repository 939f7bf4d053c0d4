"""Tables too large for a broadcast, looked up by tasks for their own texts; no text is shuffled.

Rows are landed in chunks, runs of rows of one task whose texts have at most ``most`` distinct keys together (a text with more is a chunk by itself).
The distinct keys of every chunk are joined with the table, and what is found is written to the shared folder by the
landed task that the chunk belongs to. A last pass over the landed rows loads what its chunk needs. So a task holds a chunk's
share of the table, and the number of passes doesn't depend on the table's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.storage import land, new_folder


def chunked(rows: DataFrame, keys_of: Callable[[str | None], set], most: int) -> DataFrame:
    """Lands rows, whose first column is their text, with ``part`` and ``chunk``."""

    def run(batches):
        part, chunk, seen = TaskContext.get().partitionId(), 0, set()
        for batch in batches:
            chunks = []
            for text in batch.column(0).to_pylist():
                keys = keys_of(text)
                seen |= keys
                if len(seen) > most and len(seen) > len(keys):
                    chunk, seen = chunk + 1, set(keys)
                chunks.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(chunks, pa.int64())], [*batch.schema.names, "part", "chunk"])

    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("chunk", T.LongType())])
    return land(rows.mapInArrow(run, schema), "chunks")


def found(chunks: DataFrame, keys_of: Callable[[str | None], set], key: str, table: DataFrame) -> str:
    """Joins the keys of every chunk with ``table`` on its column ``key``; returns the folder of what was found."""
    kind = table.schema[key].dataType.simpleString()

    def run(batches):
        at, seen = None, set()

        def done() -> Iterable[pa.RecordBatch]:
            keys = list(seen)
            for a in range(0, len(keys), 100_000):
                some = pa.array(keys[a : a + 100_000], pa.string() if kind == "string" else pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(some), pa.int32()), pa.array([at[1]] * len(some), pa.int64()), some], ["part", "chunk", key])

        for batch in batches:
            for text, part, chunk in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, chunk) != at:
                    if at:
                        yield from done()
                    at, seen = (part, chunk), set()
                seen |= keys_of(text)
        if at:
            yield from done()

    keys = chunks.select(F.col(chunks.columns[0]), "part", "chunk").mapInArrow(run, f"part int, chunk long, {key} {kind}").distinct()
    folder = f"{new_folder(chunks.sparkSession)}/found"
    keys.join(table, key).repartition("part").sortWithinPartitions("part", "chunk").write.partitionBy("part").parquet(folder)
    return folder


def loaded(folder: str, part: int, chunk: int) -> pa.Table | None:
    """What was found for a chunk; None where nothing was."""
    store, path = pafs.FileSystem.from_uri(folder)
    path = f"{path}/part={part}"
    if store.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    return pads.dataset(path, filesystem=store, format="parquet", exclude_invalid_files=False).to_table(filter=pads.field("chunk") == chunk)


def by_chunk(folder: str, make: Callable[[pa.Table | None], object]):
    """A function of (part, chunk) that makes something of what was found, once as long as the chunk stays the same."""
    held = [None, None]

    def of(part: int, chunk: int):
        if held[0] != (part, chunk):
            held[0], held[1] = (part, chunk), make(loaded(folder, part, chunk))
        return held[1]

    return of
