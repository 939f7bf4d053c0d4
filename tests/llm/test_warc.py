from __future__ import annotations

import base64
import hashlib
import struct

import pytest
import zstandard

from folioscope.llm import warc


def some_records(n, size=400):
    out = []
    for i in range(n):
        payload = (f"<html><body>page {i} " + "shared words of all pages " * (size // 26)).encode()
        out.append(warc.record(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None))
    return out


def test_archives_with_and_without_dictionary():
    for n, dictionary in ((3, False), (400, True)):
        data = warc.archive(some_records(n))
        assert (data[:4] == struct.pack("<I", warc.SKIPPABLE)) is dictionary
        pages = [warc.page(h, b) for h, b in warc.records(data)]
        assert [p[0] for p in pages] == list(range(n)) and all(p[4] == "response" for p in pages)
        frames, at = 0, struct.unpack_from("<I", data, 4)[0] + 8 if dictionary else 0
        while at < len(data):
            at = warc.frame_end(data, at)
            frames += 1
        assert frames == n


def test_a_plain_dictionary_is_read():
    plain = some_records(400)
    trained = zstandard.train_dictionary(4096, plain)
    packer = zstandard.ZstdCompressor(dict_data=trained)
    raw = trained.as_bytes()
    data = struct.pack("<II", warc.SKIPPABLE, len(raw)) + raw + b"".join(map(packer.compress, plain))
    assert len(list(warc.records(data))) == 400


@pytest.mark.parametrize("broken", ["cut", "length", "two", "digest", "head", "magic"])
def test_broken_archives_are_refused(broken):
    payload = b"p" * 120
    good = warc.record(1, "http://x", payload, hashlib.sha256(payload).hexdigest(), None)
    data = warc.archive([good])
    pack = zstandard.ZstdCompressor().compress
    data = {
        "cut": data[:-3],
        "length": pack(good.replace(b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 9")),
        "two": pack(good + good),
        "digest": pack(good.replace(b"pppp", b"qqqq")),
        "head": pack(good.replace(b"WARC-Date", b"WARC-Dote")),
        "magic": b"\0" * 8 + data,
    }[broken]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        [warc.page(h, b) for h, b in warc.records(data)]


def test_pages(spark, tmp_path):
    long, short = "é<p>" * 40, "tiny"
    rows = [(5, "http://a b\r\n/é", long, 1), (2, None, long, 1), (2, "again", long, 1), (9, "u", long, 1), (3, "u", short, 1), (4, "u", short, 1), (6, "u", None, 1), (7, "u", "", 1), (None, "u", long, 1), (8, "u", "z" * 100, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    archives = warc.write_archives(pages)
    got = sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(archives).collect())))
    wanted = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and html == long and i != 2
        wanted.append(repr((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 2 if again else None)))
    assert got == sorted(wanted)
    # as files, through Spark's own reader
    for k, r in enumerate(archives.collect()):
        (tmp_path / f"{k}.warc.zst").write_bytes(r.content)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    texts = [r.payload for r in warc.read_archives(files, with_payload=True).collect()]
    assert len(texts) == len(rows) and sum(t is None for t in texts) == 3
    assert warc.read_archives(warc.write_archives(pages.where("false"))).count() == 0


def foreign(kind, block, **headers):
    """A record as other writers have it."""
    names = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{kind}-{len(block)}>", "WARC-Date": "2020-02-02T00:00:00Z", **{k.replace("_", "-"): v for k, v in headers.items()}}
    head = "".join(f"{k}: {v}\r\n" for k, v in names.items())
    return f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


BODY = b"<p>hello</p>" * 20
HTTP = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + BODY
MESSAGE = "application/http; msgtype=response"
FOREIGN = [
    foreign("warcinfo", b"software: other/1.0\r\n", Content_Type="application/warc-fields"),
    foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", Content_Type="application/http; msgtype=request", WARC_Target_URI="http://x/"),
    foreign("response", HTTP, Content_Type=MESSAGE, WARC_Target_URI="<http://x/>", WARC_Payload_Digest=sha1(BODY), WARC_Block_Digest=sha1(HTTP)),
    foreign("response", HTTP + b"2", Content_Type=MESSAGE, WARC_Target_URI="http://x/2"),
    foreign("metadata", b"a: b", Content_Type="application/warc-fields", WARC_Block_Digest="md5:" + hashlib.md5(b"a: b").hexdigest(), WARC_Payload_Digest="blake3:zz"),
    foreign("revisit", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n", Content_Type=MESSAGE, WARC_Payload_Digest=sha1(BODY), WARC_Refers_To="<urn:uuid:response>"),
    foreign("revisit", b"", Content_Type=MESSAGE, WARC_Payload_Digest="sha256:" + "A" * 64),
    foreign("resource", BODY, Content_Type="text/html"),
]


def test_archives_from_elsewhere(spark, tmp_path):
    pack = zstandard.ZstdCompressor(write_content_size=False).compress
    other = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    (tmp_path / "a.warc.zst").write_bytes(other + b"".join(map(pack, FOREIGN[:3])) + other + b"".join(map(pack, FOREIGN[3:])))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    got = {(r.type, r.payload_bytes, r.payload_digest, r.url, r.refers_to, r.payload) for r in warc.read_records(files, with_payload=True).collect()}
    sha = lambda x: "sha256:" + hashlib.sha256(x).hexdigest()
    assert got == {
        ("warcinfo", 21, sha(b"software: other/1.0\r\n"), None, None, b"software: other/1.0\r\n"),
        ("request", 0, sha(b""), "http://x/", None, b""),
        ("response", len(BODY), sha(BODY), "http://x/", None, BODY),
        ("response", len(BODY) + 1, sha(BODY + b"2"), "http://x/2", None, BODY + b"2"),
        ("metadata", 4, sha(b"a: b"), None, None, b"a: b"),
        ("revisit", None, sha1(BODY), None, "<urn:uuid:response>", None),
        ("revisit", None, "sha256:" + "A" * 64, None, None, None),
        ("resource", len(BODY), sha(BODY), None, None, BODY),
    }
    pages = [tuple(r) for r in warc.read_archives(files).collect()]
    assert sorted(p[4] for p in pages) == ["response", "response", "revisit", "revisit"] and all(p[0] is None and p[5] is None for p in pages)
    assert ("a" * 64) in {p[3] for p in pages}


@pytest.mark.parametrize("label", ["payload", "block", "form"])
def test_wrong_digests_are_refused(label):
    headers = {"payload": {"WARC_Payload_Digest": sha1(b"x")}, "block": {"WARC_Block_Digest": "sha256:" + "0" * 64}, "form": {"WARC_Payload_Digest": "sha1:abc"}}[label]
    data = zstandard.ZstdCompressor().compress(foreign("response", HTTP, Content_Type=MESSAGE, **headers))
    with pytest.raises(ValueError, match="digest"):
        [warc.entry(h, b) for h, b in warc.records(data)]


@pytest.mark.parametrize("sized", [True, False])
def test_a_frame_that_decodes_to_too_much_is_refused(sized):
    data = zstandard.ZstdCompressor(write_content_size=sized).compress(foreign("resource", b"\0" * 1_000_000))
    assert len(list(warc.records(data, most=2_000_000))) == 1
    with pytest.raises(ValueError, match="more than 1000 bytes"):
        list(warc.records(data, most=1000))


def test_record_ids_of_repeated_and_null_pages(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "b"), (None, "u", "c")], "page_id long, url string, html string")
    found = warc.read_records(warc.write_archives(pages)).collect()
    assert sorted(r.record_id for r in found) == ["<urn:page:1>", "<urn:page:1>", "<urn:page:>"]
