"""Page sizes of PDF files, as a viewer shows the pages: the crop box, turned.

Only the object structure is read: objects by their ``obj`` marks, a later one of a number replacing an earlier (as incremental updates do),
objects in compressed object streams, the page tree from the catalogue, and the boxes and rotation that pages inherit. Contents aren't
rendered. Files are rows of Spark's ``binaryFile`` source, each read in one task; a file that is no PDF, is encrypted or has no page tree
raises ValueError with its path.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OBJECT = re.compile(rb"(?<![0-9])([0-9]+)\s+[0-9]+\s+obj\b(.*?)\bendobj\b", re.S)
_REFERENCE = rb"([0-9]+)\s+[0-9]+\s+R\b"
_NUMBER = rb"[-+]?[0-9]*\.?[0-9]+"
_BOX = rb"\[\s*(" + _NUMBER + rb")\s+(" + _NUMBER + rb")\s+(" + _NUMBER + rb")\s+(" + _NUMBER + rb")\s*\]"
#: What a page has where nothing says otherwise: US Letter, fixed by common use.
DEFAULT = (0.0, 0.0, 612.0, 792.0)


def objects(data: bytes) -> dict[int, bytes]:
    """Bodies of a file's objects by number."""
    out = {}
    for m in _OBJECT.finditer(data):
        number, body = int(m[1]), m[2]
        head, found, stream = body.partition(b"stream")
        if found and re.search(rb"/Type\s*/ObjStm\b", head):
            out.update(_packed(head, stream, out))
        else:
            out[number] = head
    return out


def _packed(head: bytes, stream: bytes, known: dict[int, bytes]) -> dict[int, bytes]:
    """Objects of a compressed object stream."""
    if not re.search(rb"/Filter\s*\[?\s*/FlateDecode\b", head):
        raise ValueError("an object stream of another filter")
    text = zlib.decompressobj().decompress(stream.removeprefix(b"\r").removeprefix(b"\n"))
    n, first = (int(re.search(rb"/" + k + rb"\s+([0-9]+)", head)[1]) for k in (b"N", b"First"))
    places = [int(x) for x in text[:first].split()[: 2 * n]]
    ends = [*places[3::2], len(text) - first]
    return {number: text[first + a : first + z] for number, a, z in zip(places[::2], places[1::2], ends)}


def _value(body: bytes, name: bytes, all_: dict[int, bytes]) -> bytes | None:
    """What follows a name in a dictionary, a reference resolved."""
    if not (m := re.search(rb"/" + name + rb"(?![A-Za-z])\s*(.*)", body, re.S)):
        return None
    reference = re.match(_REFERENCE, m[1])
    return all_.get(int(reference[1])) if reference else m[1]


def sizes(data: bytes) -> Iterator[tuple[float, float]]:
    """(width, height) in points of every page in order."""
    if not data.startswith(b"%PDF-"):
        raise ValueError("no PDF file")
    all_ = objects(data)
    if re.search(rb"/Encrypt\s+" + _REFERENCE, data):
        raise ValueError("an encrypted file")
    catalogues = [x for x in all_.values() if re.search(rb"/Type\s*/Catalog\b", x)]
    root = re.search(rb"/Pages\s+" + _REFERENCE, catalogues[-1]) if catalogues else None
    if not root:
        raise ValueError("no page tree")
    todo, seen = [(int(root[1]), {})], set()
    while todo:
        number, above = todo.pop()
        body = all_.get(number)
        if body is None or number in seen:
            raise ValueError("a broken page tree")
        seen.add(number)
        own = dict(above)
        for name in (b"MediaBox", b"CropBox"):
            if (value := _value(body, name, all_)) and (m := re.match(rb"\s*" + _BOX, value)):
                own[name] = tuple(map(float, m.groups()))
        if (value := _value(body, b"Rotate", all_)) and (m := re.match(rb"\s*(-?[0-9]+)", value)):
            own[b"Rotate"] = int(m[1])
        if (kids := _value(body, b"Kids", all_)) is not None:
            listed = re.match(rb"\s*\[(.*?)\]", kids, re.S)
            todo += [(int(k), own) for k in reversed(re.findall(_REFERENCE, listed[1]))] if listed else []
            continue
        media = own.get(b"MediaBox", DEFAULT)
        box = own.get(b"CropBox", media)
        # a crop box counts as far as it lies in the media box
        low = [max(min(box[k], box[k + 2]), min(media[k], media[k + 2])) for k in (0, 1)]
        high = [min(max(box[k], box[k + 2]), max(media[k], media[k + 2])) for k in (0, 1)]
        w, h = (high[0] - low[0], high[1] - low[1]) if high[0] > low[0] and high[1] > low[1] else (abs(media[2] - media[0]), abs(media[3] - media[1]))
        yield (h, w) if own.get(b"Rotate", 0) % 180 else (w, h)


def _read(batches):
    for batch in batches:
        rows = []
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                rows += [(path, page, w, h) for page, (w, h) in enumerate(sizes(data), 1)]
            except (ValueError, zlib.error, TypeError) as e:
                raise ValueError(f"{path}: {e}") from e
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.float64(), pa.float64()))], ["path", "page", "w_pt", "h_pt"])


def page_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, page, w_pt, h_pt) of the PDF files at a path or glob; doc_id is what follows the last ``_`` of the file's name."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    read = files.mapInArrow(_read, "path string, page int, w_pt double, h_pt double")
    return read.select(F.regexp_extract("path", r"([^/_]+)\.pdf$", 1).alias("doc_id"), "page", "w_pt", "h_pt")
