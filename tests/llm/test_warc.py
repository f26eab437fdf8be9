import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from departure_risk.llm import warc
from llm.conftest import table

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if same and len(payload) >= 100 else None
        revisit = first is not None and page != first
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def read(rows):
    return sorted((tuple(r)[:5] for r in warc.read_archives(rows).collect()), key=repr)


LONG = "<p>" + "ünï " * 60


def pages():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<html><body>page {i % 40} " + "text and more " * (i % 9) + "</body></html>") for i in range(300)]
    rows += [(1000, None, None), (1001, "x", ""), (1002, "a\r\nWARC-Type: evil", LONG), (999, "y", LONG), (999, "y", LONG), (None, "n", LONG),
             (2000, "z", "WARC/1.1\r\n\r\n" * 50), (2001, "big", "0123456789" * 200_000), (2002, "big", "0123456789" * 200_000), (2003, "s", "s" * 99), (2004, "s", "s" * 99)]
    return rows


def test_records_come_back_with_revisits_of_the_smallest_page(spark):
    rows = pages()
    written = warc.write_archives(table(spark, rows, SCHEMA).repartition(4))
    assert read(written) == expected(rows)
    assert written.agg(F.sum("records")).first()[0] == len(rows)


def test_a_payload_shared_by_most_pages(spark):
    rows = [(i, "u", LONG if i % 3 else f"<p>own {i}" + "x" * 100) for i in range(900, 0, -1)]
    assert read(warc.write_archives(table(spark, rows, SCHEMA).repartition(3))) == expected(rows)


def test_files_start_with_their_dictionary(spark):
    written = warc.write_archives(table(spark, pages(), SCHEMA).coalesce(1))
    uri = written.first().uri
    data = open(uri.removeprefix("file:"), "rb").read()
    magic, length = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and length > 0
    headers = [h for h, _ in warc.read_records(uri, step=777)]
    assert len(headers) == len(pages())
    assert {h["WARC-Type"] for h in headers} == {"response", "revisit"}
    by_id = {h["WARC-Record-ID"] for h in headers if h["WARC-Type"] == "response"}
    assert all(h["WARC-Refers-To"] in by_id and h["WARC-Profile"] == warc.REVISIT for h in headers if h["WARC-Type"] == "revisit")
    assert all("evil" not in h["WARC-Type"] for h in headers)
    # each record is a frame of its own that the dictionary alone opens
    first = zstandard.ZstdDecompressor(dict_data=warc._dictionary(data[8:8 + length])).decompressobj().decompress(data[8 + length:])
    assert first.startswith(b"WARC/1.1\r\n")


def test_a_cut_file_is_an_error(spark, tmp_path):
    uri = warc.write_archives(table(spark, pages(), SCHEMA).coalesce(1)).first().uri
    data = open(uri.removeprefix("file:"), "rb").read()
    (tmp_path / "cut.warc.zst").write_bytes(data[:-5])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(str(tmp_path / "cut.warc.zst")))


@pytest.mark.parametrize("rows", [[], [(5, "u", "tiny")]])
def test_tables_too_small_to_train_on(spark, rows):
    assert read(warc.write_archives(table(spark, rows, SCHEMA))) == expected(rows)
