"""WARC archives compressed record by record with a Zstandard dictionary.

`write_archives` trains one dictionary on a bounded sample of the records, then writes files that start with the
dictionary in a skippable frame (magic 0x184D2A5D), followed by one Zstandard frame per WARC record. Of equal payloads
of at least `smallest` bytes, the one with the smallest page id is stored as a response; the others become revisits
that refer to it. `read_archives` reads the files back, record by record, and checks every stored payload's digest.

Defined cases: a null payload counts as empty; a null url has no WARC-Target-URI; a null page id comes last in the order
of ids, so such a page is a revisit only of a page that has an id; rows that repeat a page id keep a record each, and
rows that repeat the smallest id of a payload are all responses; other columns are ignored; an empty table gives no file
and no row. A table too small to train on uses the sample itself as a raw dictionary.
"""

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from departure_risk.llm import files
from departure_risk.session import written_once

SKIPPABLE = 0x184D2A5D
FULL_DICTIONARY = b"\x37\xa4\x30\xec"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A digest's rows are dealt out over so many keys before the join with its first page.
SALTS = 16
#: At most SAMPLED records, and of each at most SAMPLED_CHARS from a place given by its id, train the dictionary.
SAMPLED, SAMPLED_CHARS, DICTIONARY_BYTES = 600, 8192, 1 << 16
ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16])}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """A WARC record: a revisit where `first`, the page it refers to, is given."""
    revisit = first is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page-Id: {first}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:  # too few or too short
        return b"".join(records)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    full = data.startswith(FULL_DICTIONARY)
    return zstandard.ZstdCompressionDict(data, zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT)


def hashed_pages(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).cast("long").alias("bytes"))


def first_pages(hashed: DataFrame, smallest: int) -> DataFrame:
    """digest and first (smallest page id) of payloads that occur more than once."""
    return hashed.where(F.col("bytes") >= smallest).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")


def _sample(hashed: DataFrame, sampled: int) -> list[bytes]:
    """Records to train on: ids first, so only the sample's payloads are read."""
    by_hash = F.xxhash64("page_id")
    ids = [r[0] for r in hashed.select("page_id").where("page_id is not null").orderBy(by_hash, "page_id").limit(sampled).collect()]
    text = F.col("payload").cast("string")
    start = F.pmod(F.xxhash64("page_id", F.lit(1)), F.greatest(F.length(text) - SAMPLED_CHARS, F.lit(0)) + 1)
    rows = hashed.where(F.col("page_id").isin(ids)).orderBy(by_hash, "page_id").limit(sampled).select(
        "page_id", "url", F.substring(text, (start + 1).cast("int"), F.lit(SAMPLED_CHARS)).alias("part"), "digest").collect()
    return [record(r.page_id, r.url, r.part.encode(), r.digest, None, "1970-01-01T00:00:00Z") for r in rows]


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   smallest: int = 100, date: str = "1970-01-01T00:00:00Z", level: int = 3,
                   sampled: int = SAMPLED) -> DataFrame:
    """Write the archives; one row per file: file, uri, records, bytes. `date` is the WARC-Date of all records.

    The first pages of repeated payloads are found on digests alone. They meet the pages by a salted join, so that a
    payload shared by a third of all pages is spread over many tasks; where they are few, Spark broadcasts them.
    """
    folder = files.new_folder(pages.sparkSession, "archives")
    hashed = hashed_pages(pages, id_col, url_col, payload_col)
    dictionary = train_dictionary(_sample(hashed, sampled))
    firsts = written_once(first_pages(hashed, smallest), "first-pages").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    placed = salted.join(firsts, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    shape = pa.schema([("file", pa.int64()), ("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        uri, count, size = f"{folder}/{number:06d}.warc.zst", 0, 8 + len(dictionary)
        press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary))
        with files.written(uri) as stream:
            stream.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
            for batch in (b for again in ([first], batches) for b in again):
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    frame = press.compress(record(*row, date))
                    stream.write(frame)
                    count, size = count + 1, size + len(frame)
        yield pa.RecordBatch.from_pydict({"file": [number], "uri": [uri], "records": [count], "bytes": [size]}, shape)

    ordered = placed.sortWithinPartitions(F.col("page_id").asc_nulls_last(), "url", "digest")
    return written_once(ordered.mapInArrow(archive, "file long, uri string, records long, bytes long"), "archive-files")


def read_records(uri: str, step: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, one frame at a time."""
    with files.opened(uri) as source:
        magic, length = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE:
            raise ValueError("the archive does not start with its dictionary")
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(source.read(length)))
        waiting = b""
        while waiting := waiting or source.read(step):
            frame, parts = unpack.decompressobj(), []
            while not frame.eof:
                if not waiting and not (waiting := source.read(step)):
                    raise ValueError("the archive ends within a record")
                parts.append(frame.decompress(waiting))
                waiting = frame.unused_data if frame.eof else b""
            data = b"".join(parts)
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
                raise ValueError("not a WARC record")
            yield headers, rest[:size]


def read_archives(written: DataFrame) -> DataFrame:
    """One row per record, from the files: page_id, payload_bytes, payload_digest, record_type, refers_to, file."""
    shape = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.int64())])

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def rows(uri: str, file: int) -> Iterator[tuple]:
        for headers, block in read_records(uri):
            http, _, payload = block.partition(b"\r\n\r\n")
            kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
            size = int(http.rpartition(b"Content-Length: ")[2])
            if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
            yield number(headers.get("X-Page-Id")), size, digest, kind, number(headers.get("X-Refers-To-Page-Id")), file

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                found = []
                for row in rows(entry["uri"], entry["file"]):
                    found.append(row)
                    if len(found) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), shape)], schema=shape)
                        found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), shape)], schema=shape)

    return written.select("file", "uri").repartition(max(1, min(written.count(), 10_000))).mapInArrow(decode, ROW)
