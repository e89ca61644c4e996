"""WARC archives, written together with an index and read through it.

Every record is a gzip member of its own. The index holds file, offset, length,
URL and digest per record, so that selected records are read by byte ranges:
sorted by file and offset, neighbouring ranges are coalesced into one read.

Files have a name of their own per attempt and only the index, written by
Spark's committer, makes them visible: a task that is repeated after the loss of
an executor leaves a file that nothing refers to.

Of records with equal payloads of at least ``least`` bytes, the one with the
smallest page id is the response, the others revisit it; smaller ones are all
responses. Defined cases: a NULL payload is empty; a NULL URL leaves its header
out; a NULL page id is never the smallest unless all are NULL, and then all such
records are responses; rows that repeat page id and payload count as the same
response; an empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm.common import partitions, table, text_of
from lendscape.session import keep, new_path

# Fixed values
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100
FILE_BYTES = 1 << 30
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
INDEX = "page_id long, url string, digest string, record_type string, refers_to long, payload_bytes long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, digest string, payload_bytes long, payload binary"


def _address(url: str) -> str:
    """A line end, which no valid URL holds, would end the header; all else stays as it is."""
    return url.replace("\r", "%0D").replace("\n", "%0A")


def _record(page_id, url, digest, refers_to, refers_url, payload: bytes, date: str) -> bytes:
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _address(url))
        if url != _address(url):
            head.append("X-Url: " + quote(url, safe=""))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-Id: {refers_to}", f"WARC-Refers-To-Date: {date}"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + _address(refers_url))
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; raises where lengths or digest don't fit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    size = int(headers["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length doesn't match its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("the payload doesn't match its digest")
    url = headers.get("WARC-Target-URI")
    number = lambda k: int(headers[k]) if k in headers else None
    return {
        "page_id": number("X-Page-Id"),
        "url": unquote(headers["X-Url"]) if "X-Url" in headers else url,
        "record_type": headers["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "digest": digest,
        "payload_bytes": int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"]),
        "payload": None if revisit else payload,
    }


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least: int = LEAST_BYTES, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write ``pages`` to WARC files under ``folder``; returns the written index."""
    body = text_of(F.col(payload))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body"),
        F.sha2(body.cast("binary"), 256).alias("digest"),
    )
    large = rows.where(F.octet_length("body") >= least)
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count(F.lit(1)).alias("n"))
    shared = keep(shared.where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first", "first_url"), "shared-payloads")
    tagged = rows.join(shared, "digest", "left").select(
        "page_id", "url", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"), "first_url",
        F.col("body").cast("binary").alias("body"),
    )
    store = f"{folder}/archives"
    names = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(store)
        files.create_dir(root, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                index = []
                for page, link, digest, refers, refers_link, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    member = packer.compress(_record(page, link, digest, refers, refers_link, data, date)) + packer.flush()
                    out.write(member)
                    index.append(
                        {"page_id": page, "url": link, "digest": digest, "record_type": "response" if refers is None else "revisit",
                         "refers_to": refers, "payload_bytes": len(data), "file": name, "offset": offset, "length": len(member)}
                    )
                    offset += len(member)
                yield _batch(index, names)
        finally:
            if out is not None:
                out.close()

    tagged.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def ranges(rows: Iterable[tuple[str, int, int]], gap: int = GAP_BYTES, most: int = RANGE_BYTES) -> Iterator[tuple[str, int, int, list]]:
    """Coalesce sorted ``(file, offset, length)`` into reads ``(file, start, end, members)``.

    Ranges at most ``gap`` bytes apart join while a read stays within ``most``
    bytes; a single larger record is a read of its own.
    """
    name, start, end, members = None, 0, 0, []
    for file, offset, length in rows:
        if members and (file != name or offset - end > gap or offset + length - start > most):
            yield name, start, end, members
            members = []
        if not members:
            name, start, end = file, offset, offset + length
        end = max(end, offset + length)
        members.append((offset, length))
    if members:
        yield name, start, end, members


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` (or any selection of it) names, parsed; rows that repeat give repeated records."""
    store = f"{folder}/archives"
    names = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(store)
        wanted = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        last, source = None, None
        for name, start, end, members in ranges(wanted):
            if name != last:
                if source is not None:
                    source.close()
                last, source = name, files.open_input_file(f"{root}/{name}")
            source.seek(start)
            data = source.read(end - start)
            yield _batch([parse_record(zlib.decompress(data[o - start : o - start + n], 31)) for o, n in members], names)
        if source is not None:
            source.close()

    spots = index.select("file", "offset", "length")
    spots = spots.repartitionByRange(partitions(index.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    return spots.mapInArrow(read, RECORD)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    records = read_records(index, folder)
    # A revisit holds no payload; its headers tell what the payload was.
    return records.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "digest").alias("payload_digest"),
        "record_type", "refers_to",
    )


OP7_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
