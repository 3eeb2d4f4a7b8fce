"""WARC archives: writing, reading, and transaction assembly.

Writing is SQL alone: each page becomes a request, a response or revisit, and a
metadata record, concatenated as bytes and written by the text sink with the
records' closing line breaks as separator, so that a file is a valid WARC file
(compressed as a whole by gzip). ``pages_per_file`` bounds an archive.

Of captures with an equal payload of at least ``REVISIT_BYTES`` bytes, that
with the largest page id is a response and the others are revisits of it.

Reading parses the archives record by record, by their Content-Length. Assembly
joins requests and metadata to the response or revisit that their
WARC-Concurrent-To names and gives one nested row a capture.

Defined cases: a null payload is empty, a null url is ``urn:null``; line breaks
in a url are dropped; a null page id is always a response; rows that agree in
id and payload are one capture; of several requests (or metadata records)
of a capture the one with the smallest record id is shown and all are counted;
requests without a capture give no row; columns beyond the three named ones
aren't archived; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, scratch

REVISIT_BYTES = 1000
_SALTS = 32
_BREAK = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(kind: str, page: str = "__id") -> Column:
    """A record id made of the page id and digest, so that a retried task writes the same."""
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(F.col(page).cast("string"), F.lit("")), F.col("__digest")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(date: str, kind: Column | str, record_id: Column, content_type: str, length: Column, *more: Column) -> Column:
    """A record's header block as bytes; ``more`` are whole header lines or null."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("__url")),
        *more,
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(_BREAK, *lines), F.lit(_BREAK * 2)).cast("binary")


def _decided(pages: DataFrame) -> DataFrame:
    """Pages with digest, record type and the referred page; the hot digests are salted."""
    df = pages.withColumn("__digest", F.sha1("__payload")).withColumn("__bytes", F.octet_length("__payload").cast("long"))
    large = df.where((F.col("__bytes") >= REVISIT_BYTES) & F.col("__id").isNotNull())
    twice = large.groupBy("__digest").agg(F.max("__id").alias("__first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("__digest", "__first")
    salted = twice.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    df = df.withColumn("__salt", F.pmod(F.xxhash64("__id"), F.lit(_SALTS)).cast("int"))
    joined = df.join(salted.hint("merge"), ["__digest", "__salt"], "left")
    return joined.withColumn("__refers", F.when(F.col("__id") != F.col("__first"), F.col("__first")))


def write_archive(pages: DataFrame, path: str, date: str = "2026-01-01T00:00:00Z", pages_per_file: int = 2000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write ``pages`` as gzipped WARC files below ``path``."""
    url = F.coalesce(F.regexp_replace(F.col(url_col).cast("string"), "[\\r\\n]+", ""), F.lit("urn:null"))
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    df = _decided(pages.select(F.col(id_col).alias("__id"), url.alias("__url"), payload.alias("__payload")))
    page = F.coalesce(F.col("__id").cast("string"), F.lit(""))
    df = df.withColumn("__capture", _record_id("capture"))
    revisit = F.col("__refers").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}Content-Length: "), F.col("__bytes").cast("string"), F.lit(_BREAK * 2)).cast("binary")
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("__payload")))
    df = df.withColumn("__body", body)
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), F.col("__capture"))
    ask = F.concat(F.lit("GET "), F.col("__url"), F.lit(f" HTTP/1.1{_BREAK}Accept: text/html{_BREAK * 2}")).cast("binary")
    fields = F.concat(F.lit("page-id: "), page, F.lit(_BREAK), F.when(revisit, F.concat(F.lit("refers-to-page: "), F.col("__refers").cast("string"), F.lit(_BREAK))).otherwise(F.lit(""))).cast("binary")
    record = F.concat(
        _header(date, "request", _record_id("request"), "application/http; msgtype=request", F.octet_length(ask), concurrent),
        ask,
        F.lit(_BREAK * 2).cast("binary"),
        _header(
            date,
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            F.col("__capture"),
            "application/http; msgtype=response",
            F.octet_length("__body"),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("__digest")),
            F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
            F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id("capture", "__refers"))),
        ),
        F.col("__body"),
        F.lit(_BREAK * 2).cast("binary"),
        _header(date, "metadata", _record_id("metadata"), "application/warc-fields", F.octet_length(fields), concurrent),
        fields,
    )
    out = df.select(record.cast("string").alias("value"))
    out.write.option("lineSep", _BREAK * 2).option("compression", "gzip").option("maxRecordsPerFile", pages_per_file).text(path)


RECORD = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to string, refers_to string, http_status int, "
    "payload_digest string, given_digest string, payload_bytes long, fields map<string,string>, payload binary"
)


def _unzip(content: bytes) -> bytes:
    """All members of a gzip file, or the content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


def _head(block: bytes) -> tuple[bytes, dict[str, str]]:
    first, *lines = block.split(b"\r\n")
    pairs = (line.partition(b":") for line in lines if line)
    return first, {k.strip().lower().decode(): v.strip().decode(errors="replace") for k, _, v in pairs}


def _records(data: bytes, with_payload: bool) -> Iterator[dict]:
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.index(b"\r\n\r\n", at)
        _, head = _head(data[at:end])
        begin = end + 4
        at = begin + int(head["content-length"])
        block = data[begin:at]
        row = {
            "record_id": head["warc-record-id"],
            "record_type": head["warc-type"],
            "target_uri": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "concurrent_to": head.get("warc-concurrent-to"),
            "refers_to": head.get("warc-refers-to"),
            "given_digest": head.get("warc-payload-digest"),
        }
        if row["record_type"] in ("response", "revisit"):
            split = block.index(b"\r\n\r\n")
            status, http = _head(block[:split])
            payload = block[split + 4 :]
            row["http_status"] = int(status.split()[1])
            if row["record_type"] == "response":
                row |= {"payload_digest": hashlib.sha1(payload).hexdigest(), "payload_bytes": len(payload), "payload": payload if with_payload else None}
            else:  # a revisit holds the digest and length of the payload it doesn't repeat
                row |= {"payload_digest": (row["given_digest"] or "").rpartition(":")[2] or None, "payload_bytes": int(http["content-length"]) if "content-length" in http else None}
        elif row["record_type"] == "metadata":
            row["fields"] = list(_head(b"\r\n" + block)[1].items())
        yield row


_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("http_status", pa.int32()),
     ("payload_digest", pa.string()), ("given_digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
)


def _parse(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                for row in _records(_unzip(content.as_py()), with_payload):
                    rows.append(row)
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row of ``RECORD`` for each record of the WARC files at ``path``.

    Responses carry the digest and length of the payload as read. An archive
    is one row of Spark's binary source, so it must be under 2 GB.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    with_one = files.mapInArrow(_parse(with_payload), RECORD)
    return with_one


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: the response or revisit, its request and its metadata."""
    main = records.where(F.col("record_type").isin("response", "revisit")).dropDuplicates(["record_id"])

    def beside(kind: str, *columns: str) -> DataFrame:
        own = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
        shown = F.min_by(F.struct("record_id", "target_uri", "date", *columns), "record_id").alias(kind)
        # equal record ids are one record
        return own.dropDuplicates(["record_id"]).groupBy(F.col("concurrent_to").alias("record_id")).agg(shown, F.count(F.lit(1)).alias(f"n_{kind}"))

    nested = main.select("record_id", "target_uri", "record_type", F.struct("record_id", "date", "http_status", "payload_digest", "given_digest", "payload_bytes", "refers_to", "payload").alias("capture"))
    out = nested.join(beside("request"), "record_id", "left").join(beside("metadata", "fields"), "record_id", "left")
    return out.select(F.col("record_id").alias("capture_id"), "target_uri", "record_type", "capture", "request", "metadata", F.coalesce("n_request", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` to the shared folder, read the archives back, and assemble them (without payloads)."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archive(pages, path, **columns)
    return assemble(materialise(read_archive(spark, path, with_payload=False), "warc-records"))
