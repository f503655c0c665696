"""Web archives with an index that is written first and read by byte ranges.

Writing: each task appends compressed records to an archive of its own in the shared folder and
returns one index row per record (file, offset, length, URL, digest). The index is stored as a
table; only files that it names count, so a task that is run twice leaves at most an archive that
nothing refers to. Of the records with equal payloads of at least ``min_bytes`` bytes the one with
the smallest page id is a response, the others are revisits that refer to it.

Reading: the selected index rows are spread by file and stretch of the file, sorted by offset,
neighbouring byte ranges are joined up to ``MAX_READ`` bytes, and each joined range is read at once.
Payloads of responses are hashed again and must agree with their header.

Digests are grouped with partial sums and only ids and digests are joined on the digest, which
adaptive execution can split; the pages themselves move once, by page id. The shared folder must be
one that Arrow's file systems can open (``file:``, ``hdfs:``, object stores).

A null html is an empty payload; a null URL or page id leaves its header out and comes back as
null; rows that repeat both id and payload have the same role; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.llm.common import utf8
from corpusml.storage import materialize, scratch_path

MAX_READ = 8 << 20
MAX_GAP = 64 << 10
MAX_ARCHIVE = 1 << 30
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64())])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record with its HTTP block; a revisit keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, of its HTTP block, and the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no archive record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def with_roles(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``(page_id, url, payload, refers_to)``; ``refers_to`` is null for responses."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", utf8("html").alias("payload"))
    small = rows.select("page_id", F.sha2("payload", 256).alias("key"), F.length("payload").alias("size")).filter(F.col("size") >= min_bytes)
    firsts = small.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("key", "first")
    again = small.join(firsts, "key").filter("page_id != first").select("page_id", "key", "first").distinct()
    revisits = again.select(F.col("page_id").alias("_id"), F.col("key").alias("_key"), F.col("first").alias("refers_to"))
    same = (F.col("page_id") == F.col("_id")) & (F.sha2("payload", 256) == F.col("_key"))
    return rows.join(revisits, same, "left").select("page_id", "url", "payload", "refers_to")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all pages ``(page_id, url, html)`` below ``folder``; returns the stored index."""

    def run(parts):
        disk, root = fs.FileSystem.from_uri(folder)
        disk.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        for part in parts:
            rows = []
            for page_id, url, payload, refers_to in zip(*(part.column(c).to_pylist() for c in range(4))):
                if out is None or at > MAX_ARCHIVE:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = disk.open_output_stream(f"{root}/{name}", compression=None)
                digest = base32_sha1(payload)
                raw = gzip.compress(record(page_id, url, payload, digest, refers_to, date), 4, mtime=0)
                out.write(raw)
                rows.append((name, at, len(raw), url, digest, page_id))
                at += len(raw)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), INDEX)], schema=INDEX)
        if out is not None:
            out.close()

    index = with_roles(pages, min_bytes).mapInArrow(run, "file string, offset long, length long, url string, digest string, page_id long")
    return materialize(index, "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)`` of the selected index rows."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def rows_of(raw: bytes, wanted: list[tuple[int, int]], first: int):
        for offset, length in wanted:
            fields, http, payload = parse(gzip.decompress(raw[offset - first : offset - first + length]))
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            kind = fields["WARC-Type"]
            if kind == "response" and base32_sha1(payload) != digest:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
            yield (number(fields.get("X-Page-Id")), fields.get("WARC-Target-URI"), int(http["Content-Length"]), digest, kind,
                   number(fields.get("X-Refers-To-Page-Id")), payload if kind == "response" else None)

    def run(parts):
        disk, root = fs.FileSystem.from_uri(folder)
        opened, source = None, None
        wanted: list[tuple[int, int]] = []

        def flush():
            if not wanted:
                return None
            first, end = wanted[0][0], max(o + n for o, n in wanted)
            source.seek(first)
            rows = list(rows_of(source.read(end - first), wanted, first))
            wanted.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for part in parts:
            for name, offset, length in zip(*(part.column(c).to_pylist() for c in range(3))):
                last = wanted[-1] if wanted else None
                if name != opened or last and (offset - sum(last) > MAX_GAP or offset + length - wanted[0][0] > MAX_READ):
                    if (batch := flush()) is not None:
                        yield batch
                if name != opened:
                    if source is not None:
                        source.close()
                    opened, source = name, disk.open_input_file(f"{root}/{name}")
                wanted.append((offset, length))
        if (batch := flush()) is not None:
            yield batch
        if source is not None:
            source.close()

    places = index.select("file", "offset", "length", F.floor(F.col("offset") / (4 * MAX_READ)).alias("_stretch"))
    near = places.repartition("file", "_stretch").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return near.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages into archives and read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, min_bytes)
    return read_records(index, folder).drop("payload")


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
  SELECT page_id, body, octet_length(encode(body)) AS n,
         array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: '{_B32}'[(CAST('0x' || h[5 * g + 1 : 5 * g + 5] AS BIGINT) >> s) % 32 + 1]), '')), '') AS digest
  FROM p),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM coded)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts"""
