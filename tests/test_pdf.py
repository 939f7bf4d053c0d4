from __future__ import annotations

import zlib

import pytest

from folioscope.sources import pdf


def document(*bodies, trailer=b"trailer << /Root 1 0 R >>"):
    return b"%PDF-1.7\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, b) for k, b in bodies) + trailer


CATALOGUE = (1, b"<< /Type /Catalog /Pages 2 0 R >>")


def test_boxes_are_inherited_turned_and_cropped():
    data = document(
        CATALOGUE,
        (2, b"<< /Type /Pages /Kids [3 0 R 4 0 R 9 0 R] /Count 5 /MediaBox [0 0 595.5 842] >>"),
        (3, b"<< /Type /Page /Parent 2 0 R /Contents 7 0 R >>"),
        (4, b"<< /Type /Pages /Parent 2 0 R /Rotate 90 /Kids [5 0 R\n6 0 R 8 0 R] >>"),
        (5, b"<< /Type /Page /CropBox [10 10 110 210] >>"),
        (6, b"<< /Type /Page /Rotate 180 /MediaBox 10 0 R >>"),
        (7, b"<< /Length 30 >>\nstream\n/MediaBox [0 0 1 1] 9 0 obj\nendstream"),
        (8, b"<< /Type /Page /Rotate -90 /CropBox [-50 700 5000 900] >>"),
        (9, b"<< /Type /Page /CropBox [900 900 950 950] >>"),
        (10, b"[100 700 0 0]"),
    )
    assert list(pdf.sizes(data)) == [(595.5, 842), (200, 100), (100, 700), (142, 595.5), (595.5, 842)]


def test_later_objects_replace_earlier_ones_and_streams_are_unpacked():
    body = b"<< /Type /Pages /Kids [3 0 R] /MediaBox [0 0 10 20] >>"
    packed = b"2 0 3 %d " % len(body)
    text = packed + body + b" << /Type /Page >>"
    stream = zlib.compress(text)
    head = b"<< /Type /ObjStm /N 2 /First %d /Filter /FlateDecode /Length %d >>\nstream\r\n" % (len(packed), len(stream))
    data = document(CATALOGUE, (2, b"<< /Type /Pages /Kids [] >>"), (7, head + stream + b"\nendstream"))
    assert list(pdf.sizes(data)) == [(10, 20)]
    assert list(pdf.sizes(data + b"\n3 0 obj << /Type /Page /MediaBox [0 0 5 6] >> endobj")) == [(5, 6)]
    assert list(pdf.sizes(document(CATALOGUE, (2, b"<< /Type /Pages /Kids [3 0 R] >>"), (3, b"<< /Type /Page >>")))) == [(612, 792)]


@pytest.mark.parametrize("data", [b"", b"hello", b"%PDF-1.4", document(CATALOGUE), document(CATALOGUE, (2, b"<< /Kids [2 0 R] >>")), document(CATALOGUE, (2, b"<< /Kids [] >>"), trailer=b"trailer << /Encrypt 5 0 R >>")])
def test_what_is_no_readable_file_is_refused(data):
    with pytest.raises(ValueError):
        list(pdf.sizes(data))


def test_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"acte_2020-01-0{k + 1}_{k}ab.pdf").write_bytes(document(CATALOGUE, (2, b"<< /Kids [3 0 R 3 0 R] /MediaBox [0 0 %d 20] >>" % (k + 1)), (3, b"<< /Type /Page >>")).replace(b"3 0 R 3 0 R", b"3 0 R"))
    assert sorted(map(tuple, pdf.page_sizes(spark, str(tmp_path)).collect())) == [(f"{k}ab", 1, k + 1.0, 20.0) for k in range(3)]
    (tmp_path / "broken_x.pdf").write_bytes(b"nothing")
    with pytest.raises(Exception, match="broken_x.pdf"):
        pdf.page_sizes(spark, str(tmp_path)).collect()
