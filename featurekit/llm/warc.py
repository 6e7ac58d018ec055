"""WARC: a converter for legacy ARC archives.

ARC files start with a version block that names the fields of the header lines; version 1 has five fields,
version 2 ten.  Every record is such a line, as many bytes as its last field declares, and a line end.  The
reader follows the declared lengths, so payloads may hold anything.  The converter gives each record the
equivalent WARC header: an identifier made from URL, date and digest, the ISO date, the type, SHA-256 payload
digests, and a ``warcinfo`` record per archive.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest ``page_id`` (NULL
last; then file and offset) is the response, the others are revisits without the payload.

Archives are written by Spark's text writer, whose line separator is the end of a record, gzip-compressed, to
the session's shared checkpoint folder, and read as binary files; a task holds the files of one read split.
Payloads are read twice (digests, then records) and shuffled only if the list of revisits is too large to
broadcast.  NULL html is an empty payload, NULL urls are ``unknown:``; repeated rows are records of their own.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurekit.llm.common import durable, ensure_checkpoint_dir, maybe_broadcast, table

REVISIT_BYTES = 100
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FLUSH = 4 << 20


def archive_folder(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


# --- legacy archives -------------------------------------------------------------------------------------

def _version_block(version: int) -> str:
    text = f"{version} 0 featurekit\n{FIELDS[version]}\n"
    head = {1: "filedesc://pages.arc 0.0.0.0 20240101000000 text/plain",
            2: "filedesc://pages.arc 0.0.0.0 20240101000000 text/plain 200 - - 0 pages.arc"}[version]
    return f"{head} {len(text)}\n{text}\n"


def write_arc(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html) as ARC files, one per partition; versions 1 and 2 take turns."""
    html = F.coalesce("html", F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    url = F.regexp_replace(F.coalesce("url", F.lit("unknown:")), r"\s", "%20")
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "), page,
                     F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html)
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(31536000))),
                         "yyyyMMddHHmmss")
    size = F.octet_length(block).cast("string")
    start = F.concat(F.when(F.length(url) > 0, url).otherwise(F.lit("unknown:")), F.lit(" 0.0.0.0 "), date, F.lit(" text/html"))
    second = F.spark_partition_id() % 2 == 1
    head = F.when(second, F.concat(start, F.lit(" 200 - - 0 pages.arc "), size)).otherwise(F.concat(start, F.lit(" "), size))
    opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    version = F.when(second, F.lit(_version_block(2))).otherwise(F.lit(_version_block(1)))
    record = F.concat(F.when(opens, version).otherwise(F.lit("")), head, F.lit("\n"), block)
    pages.select(record.alias("value")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _arc_records(content: bytes) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, version, fields, block) of each record, the version blocks left out."""
    f, version, names = gzip.GzipFile(fileobj=io.BytesIO(content)), 0, []
    offset = 0
    while line := f.readline():
        if not line.strip():
            offset += len(line)
            continue
        values = line.decode("utf-8", "replace").split()
        size = int(values[-1])                       # the declared length is the last field of both versions
        block = f.read(size)
        if len(block) < size:
            raise ValueError(f"an ARC record at {offset} declares {size} bytes, {len(block)} follow")
        if values[0].startswith("filedesc:"):
            first, fields = block.decode().split("\n")[:2]
            version, names = int(first.split()[0]), fields.split()
            if FIELDS.get(version) != fields:
                raise ValueError(f"unknown ARC version block: {first!r}")
        else:
            if len(values) != len(names):
                raise ValueError(f"an ARC {version} header line has {len(names)} fields: {line[:200]!r}")
            yield offset, version, dict(zip(names, values, strict=True)), block
        offset += len(line) + size


def _http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, the header's bytes and the payload of an HTTP response; all payload if it isn't one."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}, head + b"\r\n\r\n", body


ARC_SCHEMA = ("file string, offset long, version int, url string, date string, content_type string, page_id long,"
              " head binary, payload_bytes long, digest string")


def _read_arc(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ARC_SCHEMA.split(", ")] + ["payload"] * payloads
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(),
                 pa.string()] + [pa.binary()] * payloads
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        rows, held = [], 0
        for b in batches:
            for i in range(b.num_rows):
                file = b.column(0)[i].as_py()
                for offset, version, x, block in _arc_records(b.column(1)[i].as_py()):
                    fields, head, body = _http(block)
                    page = fields.get("x-page-id", "-")
                    rows.append((file, offset, version, x["URL"], x["Archive-date"], x["Content-type"], None if page == "-" else int(page),
                                 head, len(body), hashlib.sha256(body).hexdigest(), *[body] * payloads))
                    held += len(head) + len(body) * payloads
                    if held > _FLUSH:
                        yield pack(rows)
                        rows, held = [], 0
        if rows:
            yield pack(rows)
    return read


def _files(spark: SparkSession, path: str) -> DataFrame:
    name = F.regexp_extract("path", "[^/]+$", 0)
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(name.alias("file"), "content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    return _files(spark, path).mapInArrow(_read_arc(payloads), ARC_SCHEMA + ", payload binary" * payloads)


# --- conversion ------------------------------------------------------------------------------------------

def record_id() -> Column:
    """An identifier from what the ARC record says, so converting again gives the same one."""
    h = F.sha2(F.concat_ws("\n", "url", "date", "digest", "file", F.col("offset").cast("string")), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Convert the ARC files under ``arc`` to WARC files under ``warc``."""
    facts = durable(read_arc(spark, arc, payloads=False).where(F.col("payload_bytes") >= REVISIT_BYTES)
                    .select("digest", "page_id", "file", "offset", record_id().alias("id")))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset", "id")
    first = (facts.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"))
    revisits = durable(facts.join(first, "digest")
                       .where((F.col("file") != F.col("first.file")) | (F.col("offset") != F.col("first.offset")))
                       .select("file", "offset", F.col("first.id").alias("refers_to"), F.col("first.page_id").alias("refers_page")))
    records = (read_arc(spark, arc).withColumn("id", record_id())
               .join(maybe_broadcast(revisits, 200), ["file", "offset"], "left"))
    text = lambda c: F.col(c).cast("string")
    again = F.col("refers_to").isNotNull()
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    iso = F.date_format(F.to_timestamp("date", "yyyyMMddHHmmss"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    size = F.octet_length("head") + F.when(again, 0).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", F.col("id")), field("WARC-Date", iso), field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", F.col("refers_to")),
                               field("X-Refers-To-Page", F.coalesce(F.col("refers_page").cast("string"), F.lit("-"))))).otherwise(F.lit("")),
        field("Content-Type", F.when(F.octet_length("head") > 0, F.lit("application/http; msgtype=response")).otherwise(F.col("content_type"))),
        field("Content-Length", size.cast("string")), F.lit("\r\n"))
    info_block = "software: featurekit\r\nformat: WARC File Format 1.1\r\n"
    info = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: "), F.regexp_replace("id", "^<urn:uuid:.{4}", "<urn:uuid:0000"),
                    F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\n"
                          f"Content-Length: {len(info_block)}\r\n\r\n{info_block}\r\n\r\n"))
    opens = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    value = F.concat(F.when(opens, info).otherwise(F.lit("")), header, text("head"), F.when(again, F.lit("")).otherwise(text("payload")))
    records.select(value.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc)


# --- reading WARC files ----------------------------------------------------------------------------------

WARC_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string,"
               " url string, date string")


def _read_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in WARC_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    number = lambda x: None if x in (None, "-") else int(x)
    for b in batches:
        for i in range(b.num_rows):
            f, rows = gzip.GzipFile(fileobj=io.BytesIO(b.column(1)[i].as_py())), []
            while line := f.readline():
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/1."):
                    raise ValueError(f"not a WARC record: {line[:80]!r}")
                x = {}
                while (line := f.readline().decode("utf-8", "replace").rstrip("\r\n")):
                    k, _, v = line.partition(": ")
                    x[k.lower()] = v
                block = f.read(int(x["content-length"]))
                if x["warc-type"] not in ("response", "revisit"):
                    continue
                fields, _, body = _http(block)
                digest = x["warc-payload-digest"].removeprefix("sha256:")
                if x["warc-type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"{x['warc-record-id']}: the payload doesn't have the digest {digest}")
                size = len(body) if x["warc-type"] == "response" else number(fields["content-length"])
                rows.append((number(fields.get("x-page-id")), size, digest, x["warc-type"], number(x.get("x-refers-to-page")),
                             x["warc-record-id"], x["warc-target-uri"], x["warc-date"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record; payload digests of responses are checked against the payload."""
    return _files(spark, path).mapInArrow(_read_warc, WARC_SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as ARC archives, convert them to WARC, and read those back: one row per page."""
    spark = pages.sparkSession
    arc, warc = archive_folder(spark, "arc"), archive_folder(spark, "warc")
    write_arc(pages.select("page_id", "url", "html"), arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))
