"""Web archives without repeated payloads.

The headers of all captures, a page id, a payload digest and a length, are shuffled by
digest; of equal payloads one capture stays the response and the others become revisit
records that refer to it. Archives are then written with fresh headers, one gzip member
per record, and an index of the members' places. Reading joins revisits to their
responses again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import store
from shelfrank.llm.spark_io import named, narrow_side, written

LEAST_BYTES = 0
READ_BYTES = 8 << 20
# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Name space of the record ids, which follow from page id and payload.
RECORDS = uuid.UUID("0f4a9d3e-5a0c-4f0e-9a67-2b1c6f1f7d10")

_MANIFEST = "archive string, index string, records long, bytes long"
_CAPTURE = (
    "page_id long, url string, record_id string, record_type string, refers_to_record string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def payload_key(html: Column) -> Column:
    """SHA-1 of the payload in hexadecimal digits; null counts as empty."""
    return F.sha1(F.coalesce(html, F.lit("")).cast("binary"))


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORDS, f'{page_id} {digest}')}>"


def resolved(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Revisits among (page_id, key, bytes): (page_id, key, refers_to), each once.

    Of equal payloads of at least `least_bytes` bytes that with the largest page id is the
    response. One row per digest and task enters the shuffle, so a payload that a third of
    all pages share is no load; the join on it is split by adaptive execution.
    """
    large = headers.where(F.col("bytes") >= least_bytes)
    groups = large.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    pairs = large.join(groups.where("n > 1 and refers_to is not null").drop("n"), "key")
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return pairs.where(other).select("page_id", "key", "refers_to").distinct()


def _header(fields: list[tuple[str, str]]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    digest = base32_digest(payload)
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # A line break or another control character would end the header.
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        fields.insert(3, ("WARC-Target-URI", clean))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
    return _header(fields) + block + b"\r\n\r\n"


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Every attempt writes files of its own; only those of the manifest count.
        name = f"{folder}/pages-{uuid.uuid4().hex}"
        archive = index = None
        place = records = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if archive is None:
                    archive, index = store.create(f"{name}.warc.gz"), store.create(f"{name}.idx")
                page_id, url, html, refers_to = row
                member = gzip.compress(
                    _record(page_id, url, (html or "").encode(), refers_to, date), 6, mtime=0
                )
                archive.write(member)
                index.write(struct.pack("<Q", place))
                place, records = place + len(member), records + 1
        if archive is not None:
            archive.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": [f"{name}.warc.gz"], "index": [f"{name}.idx"],
                    "records": [records], "bytes": [place],
                }
            )

    return run


def write_archives(
    pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", least_bytes: int = LEAST_BYTES, date: str | None = None,
) -> DataFrame:
    """Write a record per row, repeated payloads as revisits; returns the manifest.

    The payload is the HTML in UTF-8, empty for null. A row without an id is a revisit if
    its payload has a response with an id, else a response. Rows that repeat an id and a
    payload are of the same kind. Control characters in a URL are percent-encoded. An empty
    table writes no archive. Files of attempts that failed are not in the manifest.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    spark = pages.sparkSession
    rows = named(pages, {"page_id": id_column, "url": url_column, "html": html_column})
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("bytes")
    headers = rows.select("page_id", payload_key(F.col("html")).alias("key"), size)
    revisits = written(resolved(headers, least_bytes), "revisits")
    revisits = revisits.select(F.col("page_id").alias("own"), F.col("key").alias("own_key"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("own")) & (F.col("key") == F.col("own_key"))
    marked = (
        rows.withColumn("key", payload_key(F.col("html")))
        .join(narrow_side(revisits), same, "left")
        .select("page_id", "url", "html", "refers_to")
    )
    marked.mapInArrow(_write(folder, date), _MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; raises on damage."""
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) < length or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_digest(block)}":
        raise ValueError("a record's block is damaged")
    return fields, block


def _read(payloads: bool):
    def capture(member: bytes) -> dict:
        fields, block = _parsed(member)
        kind = fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
        if payload is not None and base32_digest(payload) != digest:
            raise ValueError("a payload does not have its digest")
        page_id = fields.get("X-Page-Id")
        return {
            "page_id": None if page_id is None else int(page_id),
            "url": fields.get("WARC-Target-URI"),
            "record_id": fields["WARC-Record-ID"],
            "record_type": kind,
            "refers_to_record": fields.get("WARC-Refers-To"),
            "payload_digest": digest,
            "payload_bytes": None if payload is None else len(payload),
            "payload": payload if payloads else None,
        }

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()),
            ("record_type", pa.string()), ("refers_to_record", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, high = row["low"], row["high"]
                index = store.read_range(row["index"], 8 * low, 8 * (high - low + 1))
                places = np.frombuffer(index, dtype="<u8").tolist()
                if high == row["records"]:
                    places.append(row["bytes"])
                data = store.read_range(row["archive"], places[0], places[-1] - places[0])
                captures = [
                    capture(data[a - places[0] : b - places[0]])
                    for a, b in zip(places[:-1], places[1:], strict=True)
                ]
                for first in range(0, len(captures), 500):
                    yield pa.RecordBatch.from_pylist(captures[first : first + 500], schema=schema)

    return run


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records as they stand in the archives, in runs of about READ_BYTES per read."""
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    runs = (
        files.withColumn("parts", F.ceil(F.col("bytes") / READ_BYTES))
        .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
        .withColumn("low", F.expr("part * records div parts"))
        .withColumn("high", F.expr("(part + 1) * records div parts"))
        .where("high > low")
    )
    return runs.repartition(F.xxhash64("archive", "part")).mapInArrow(_read(payloads), _CAPTURE)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with `refers_to`, the page a revisit stands for, and that page's payload size.

    Headers only: a hot response is joined to its revisits without its payload.
    """
    columns = ("page_id", "url", "record_type", "payload_digest")
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'")
    originals = responses.groupBy(F.col("record_id").alias("refers_to_record")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes")
    )
    joined = revisits.select(*columns, "refers_to_record").join(originals, "refers_to_record", "left")
    plain = responses.select(*columns, "payload_bytes", F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(joined.select(*columns, "payload_bytes", "refers_to"))
