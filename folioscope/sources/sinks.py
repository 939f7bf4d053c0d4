"""Outputs: the results document, the grep report and draw lists."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def results_json(parts: dict[str, DataFrame], most: int = 1_000_000) -> DataFrame:
    """One row with one JSON document: each part's rows as an array under its name, sorted.

    It is for results, which are small; they become one value, so a part of more than ``most`` rows is refused.
    """
    out = None
    for k, (name, rows) in enumerate(parts.items()):
        if rows.limit(most + 1).count() > most:
            raise ValueError(f"{name} has more than {most} rows, too many for one document")
        held = F.to_json(F.sort_array(F.collect_list(F.struct(*rows.columns))), {"ignoreNullFields": "false"})
        one = rows.agg(F.concat(F.to_json(F.array(F.lit(name))).substr(F.lit(2), F.lit(len(json.dumps(name, ensure_ascii=False)))), F.lit(":"), held).alias("json")).select(F.lit(k).alias("k"), "json")
        out = one if out is None else out.unionByName(one)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "json"))), lambda x: x["json"]), ",")
    return out.agg(F.concat(F.lit("{"), joined, F.lit("}")).alias("json"))


def report_line(box: Column, text: Column) -> Column:
    """``[x0, y0, x1, y1]  text`` with four decimals; null without a box."""
    line = F.concat(F.lit("["), F.concat_ws(", ", *[F.format_string("%.4f", box[i]) for i in range(4)]), F.lit("]  "), text)
    return F.when(box.isNotNull(), line)


def draw_list(boxes: DataFrame, colour: str, width: int) -> DataFrame:
    """What to draw over a page: rectangles with colour, line width and number, in the given order.

    Lines without a box are left out; a box beyond the page is drawn all the same.
    """
    return boxes.where("box is not null").select("doc_id", "page", "box", F.lit(colour).alias("colour"), F.lit(width).alias("width"), (F.col("pos") + 1).alias("label"))


def _written(root: str):
    def run(batches):
        store, path = pafs.FileSystem.from_uri(root)
        for batch in batches:
            size = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{path}/{name}"
                folder, _, file = target.rpartition("/")
                store.create_dir(folder, recursive=True)
                # an attempt that is lost leaves a hidden file at most; readers pass over these
                hidden, data = f"{folder}/.{uuid.uuid4().hex}", (content or "").encode("utf-8")
                with store.open_output_stream(hidden) as f:
                    f.write(data)
                store.move(hidden, target)
                size.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64())], ["path", "n_bytes"])

    return run


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Writes rows (path, content) as UTF-8 files under ``root``, a URI that driver and executors share; returns path and n_bytes, lazily.

    Each row is one file, written by the task that holds it; a repeated path is written again. Evaluate the result once. A null content is an empty file.
    """
    rows = files.select(F.col("path").cast("string").alias("path"), F.col("content").cast("string").alias("content"))
    return rows.mapInArrow(_written(root), "path string, n_bytes long")
