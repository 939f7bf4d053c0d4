"""WARC archives in Zstandard frames: one frame per record, the dictionary in a leading skippable frame.

Writing: a page is one record with its HTML as HTTP payload. Of the pages with equal payloads of LEAST bytes or
more, the one with the smallest page_id is a response, the others are revisits of it, without a payload. Every task writes
archives of some ARCHIVE payload bytes; a dictionary is trained on each archive's first TRAINED payload bytes
(a bounded sample, of that archive alone) and stands, itself compressed, in a skippable frame of the magic number
0x184D2A5D at the start of the file. Archives too small to train on have none.

Reading, also of archives from elsewhere: the dictionary is loaded from that frame if there is one, other skippable frames are passed over,
frames are found by their block headers, each is decoded by itself, to FRAME bytes at most, and must hold exactly one record: its
version line, required headers and length are checked, and its block and payload digests where they are of a known kind (md5, sha1,
sha256 or sha512, in hexadecimal or base 32). Anything wrong raises ValueError with the archive's name. ``read_records`` returns records
of every type; ``read_archives`` responses and revisits alone, as pages. Lengths are those of the WARC header; only a revisit, which has no payload,
takes its payload's from the HTTP head, and null where that doesn't tell. A page_id is read off record ids of the form written here and is null
for others. A response's payload_digest is computed; a revisit's is its header's, bare if it is SHA-256.

Archives are binary rows, so that Spark commits them to any store; ``binaryFile`` gives rows of the same form
from files. A null html is an empty payload, a null url ``about:blank``. Pages that repeat the smallest page_id of
their payload are responses all. A null page_id is smaller than none: such a page is a response only if no other of its
payload has an id. A record's id is made of the page_id, so pages that repeat one have equal record ids, and null ones ``<urn:page:>``. Empty tables
give no archives. Other columns don't matter.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.storage import BROADCAST_BYTES, bounded_batches, land

LEAST, ARCHIVE, TRAINED, DICTIONARY = 100, 8 << 20, 1 << 20, 32 << 10
#: Bytes that one frame may decode to, and of its window.
FRAME, FRAME_WINDOW = 1 << 30, 1 << 27
DATE = "2025-01-01T00:00:00Z"
#: Fixed values of the formats: magic numbers of the dictionary's frame, of dictionaries and of frames, and the profile of revisits.
SKIPPABLE, DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xEC30A437, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; ``refers_to`` is the page_id of the response that it revisits, or None."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The archive of some records."""
    sample, held = [], 0
    for r in records:
        if held >= TRAINED:
            break
        sample.append(r)
        held += len(r)
    trained = None
    if len(sample) >= 16 and held >= 64 << 10:
        try:
            trained = zstandard.train_dictionary(min(DICTIONARY, held // 8), sample)
        except zstandard.ZstdError:  # the sample has too little in common
            trained = None
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True, write_content_size=True)
    parts = []
    if trained:
        stored = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
        parts.append(struct.pack("<II", SKIPPABLE, len(stored)) + stored)
    return b"".join([*parts, *map(packer.compress, records)])


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, by its header and block headers."""
    if at + 6 > len(data) or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError(f"no frame at byte {at}")
    descriptor = data[at + 4]
    single = descriptor >> 5 & 1
    at += 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + ((single, 2, 4, 8)[descriptor >> 6])
    while True:
        if at + 3 > len(data):
            raise ValueError("a frame is cut off")
        header = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
        if header & 1:
            break
    at += 4 * (descriptor >> 2 & 1)
    if at > len(data):
        raise ValueError("a frame is cut off")
    return at


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record that must be all of ``raw``."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name:
            raise ValueError(f"a broken header: {line[:80]}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"a record without {name}")
    if not re.fullmatch("[0-9]+", headers["content-length"]) or int(headers["content-length"]) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"a record of another length than its Content-Length, {headers['content-length'][:20]}")
    return headers, rest[:-4]


def _skippable(data: bytes, at: int) -> int:
    """Where the skippable frame at ``at`` ends."""
    if len(data) < at + 8 or len(data) < (end := at + 8 + struct.unpack_from("<I", data, at + 4)[0]):
        raise ValueError("a skippable frame is cut off")
    return end


def records(data: bytes, most: int = FRAME):
    """(headers, block) of every record of an archive, each of at most ``most`` bytes."""
    at, trained = 0, None
    if data[:4] == struct.pack("<I", SKIPPABLE):
        at = _skippable(data, 0)
        stored = data[8:at]
        if stored[:4] == struct.pack("<I", FRAME_MAGIC):
            stored = _decoded(zstandard.ZstdDecompressor(max_window_size=FRAME_WINDOW), stored, most)
        if stored[:4] != struct.pack("<I", DICT_MAGIC):
            raise ValueError("no dictionary in the leading frame")
        trained = zstandard.ZstdCompressionDict(stored)
    reader = zstandard.ZstdDecompressor(dict_data=trained, max_window_size=FRAME_WINDOW)
    while at < len(data):
        if len(data) >= at + 4 and struct.unpack_from("<I", data, at)[0] & 0xFFFFFFF0 == SKIPPABLE & 0xFFFFFFF0:
            at = _skippable(data, at)
            continue
        end = frame_end(data, at)
        yield parsed(_decoded(reader, data[at:end], most))
        at = end


def _decoded(reader: zstandard.ZstdDecompressor, frame: bytes, most: int) -> bytes:
    with reader.stream_reader(frame) as f:
        out = f.read(most + 1)
    if len(out) > most:
        raise ValueError(f"a frame of more than {most} bytes")
    return out


def verified(label: str, stated: str, data: bytes) -> None:
    """Raises if ``data`` hasn't the digest ``algorithm:value``; other algorithms and forms can't be checked and pass."""
    name, _, value = stated.partition(":")
    name = name.lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return
    true = hashlib.new(name, data).digest()
    try:
        said = bytes.fromhex(value) if len(value) == 2 * len(true) else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        raise ValueError(f"a digest of another form: {stated[:80]}") from None
    if said != true:
        raise ValueError(f"the {label} isn't what its digest says")


def entry(headers: dict[str, str], block: bytes) -> tuple:
    """(record_id, type, url, date, content_type, payload_bytes, payload_digest, refers_to, payload) of a record of any type, checked.

    The payload of HTTP messages is what follows their head, of other records the block; a revisit's is null.
    """
    kind, content = headers["warc-type"].lower(), headers.get("content-type", "")
    payload, head = block, b""
    if kind in ("response", "request", "revisit") and content.lower().replace(" ", "").startswith("application/http"):
        head, found, payload = block.partition(b"\r\n\r\n")
        if not found and kind == "response":
            raise ValueError(f"{headers['warc-record-id']} holds no HTTP message")
    if stated := headers.get("warc-block-digest"):
        verified(f"block of {headers['warc-record-id']}", stated, block)
    digest = headers.get("warc-payload-digest")
    if kind == "revisit":
        if payload:
            raise ValueError(f"{headers['warc-record-id']} is no proper revisit")
        length = re.search(rb"(?i)\r\ncontent-length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", head)
        size, payload = int(length[1]) if length else None, None
    else:
        if digest:
            verified(f"payload of {headers['warc-record-id']}", digest, payload)
        size, digest = len(payload), f"sha256:{hashlib.sha256(payload).hexdigest()}"
    target = headers.get("warc-target-uri", "").strip("<>") or None
    return headers["warc-record-id"], kind, target, headers["warc-date"], content or None, size, digest, headers.get("warc-refers-to"), payload


def _page(value: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?[0-9]+)>", value or "")
    return int(m[1]) if m else None


def page(headers: dict[str, str], block: bytes) -> tuple | None:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a response or revisit, None of other records."""
    record_id, kind, url, _, _, size, digest, refers_to, payload = entry(headers, block)
    if kind not in ("response", "revisit"):
        return None
    digest = digest[7:].lower() if (digest or "").startswith("sha256:") and len(digest) == 71 else digest
    return _page(record_id), url, size, digest, kind, _page(refers_to), payload


def _write(batches):
    held, size = [], 0

    def done():
        return pa.RecordBatch.from_arrays([pa.array([f"{uuid.uuid4().hex}.warc.zst"]), pa.array([archive(held)], pa.binary())], ["path", "content"])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            held.append(record(*row))
            size += len(held[-1])
            if size >= ARCHIVE:
                yield done()
                held, size = [], 0
    if held:
        yield done()


_PAGE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


_RECORD = "path string, record_id string, type string, url string, date string, content_type string, payload_bytes long, payload_digest string, refers_to string"


def _read(of, ddl: str, with_payload: bool):
    """Rows (path, content) to the rows that ``of`` makes of each record, None for none; ``ddl`` names their columns, a payload last."""
    names = [x.split()[0] for x in ddl.split(", ")]
    types = [pa.int64() if x.endswith(" long") else pa.string() for x in ddl.split(", ")]
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0

                def some():
                    columns = list(zip(*rows)) if rows else [[]] * len(names)
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

                try:
                    for headers, block in records(data):
                        row = of(path, headers, block)
                        if row is None:
                            continue
                        rows.append(row if with_payload else row[:-1])
                        held += len(block) if with_payload else 0
                        if len(rows) >= 500 or held >= ARCHIVE:
                            yield some()
                            rows, held = [], 0
                except (ValueError, zstandard.ZstdError) as e:
                    raise ValueError(f"{path}: {e}") from e
                yield some()

    return run


def write_archives(pages: DataFrame) -> DataFrame:
    """(path, content) of archives that hold every row of ``pages``, written to the shared folder."""
    spark = pages.sparkSession
    bounded_batches(spark)
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    sized = rows.where(F.octet_length("payload") >= LEAST).select("page_id", "digest")
    firsts = sized.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).where("n > 1").select("digest", "first")
    firsts = land(firsts, "firsts")
    small = 128 * firsts.count() <= BROADCAST_BYTES // 2
    rows = rows.join(F.broadcast(firsts) if small else firsts, "digest", "left")
    own = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", F.when(~own, F.col("first")).alias("refers_to"))
    return land(rows.mapInArrow(_write, "path string, content binary"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The pages of archives, responses and revisits: rows of (path, content), from ``write_archives`` or Spark's ``binaryFile`` source."""
    bounded_batches(archives.sparkSession)
    read = _read(lambda path, headers, block: page(headers, block), _PAGE, with_payload)
    return archives.select("path", "content").mapInArrow(read, _PAGE + (", payload binary" if with_payload else ""))


def read_records(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of archives, of every type: path, record_id, type, url, date, content_type, payload_bytes, payload_digest, refers_to."""
    bounded_batches(archives.sparkSession)
    read = _read(lambda path, headers, block: (path, *entry(headers, block)), _RECORD, with_payload)
    return archives.select("path", "content").mapInArrow(read, _RECORD + (", payload binary" if with_payload else ""))
