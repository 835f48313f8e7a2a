"""WARC archives: write, read and resolve revisits (records whose payload another record has).

The writer is Spark's text sink: a record is one string, and the line separator is the blank
line pair that ends a WARC record, so the part files are archives.  They are gzipped as a whole.
The reader takes whole archives (``binaryFile``); ``max_records`` bounds them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.llm.common import base32_of_hex, materialise, salted_min

CRLF = "\r\n"
# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
DECISION = ("kind", "to_id", "to_page", "to_uri", "to_date")

RECORD_SCHEMA = ("file string, offset long, record_type string, record_id string, page_id string, target_uri string, "
                 "date string, refers_to_id string, refers_to_page string, payload_bytes long, payload_digest string, "
                 "intact boolean, payload binary")


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for null.  Line breaks in the value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _write(records: DataFrame, path: str, max_records: int) -> None:
    (records.select("record").write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", max_records).text(path))


def _record(kind: Column, fields: list[Column], http: Column, payload: Column) -> Column:
    """header block, blank line, HTTP head, payload; the sink adds the record end."""
    length = F.octet_length(http) + F.octet_length(payload)
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit(CRLF), *fields,
                    _line("Content-Type", F.lit("application/http; msgtype=response")),
                    F.lit("Content-Length: "), length.cast("string"), F.lit(RECORD_END))
    return F.concat(head, http, payload)


def write_responses(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                    payload_col: str = "html", date: str = "2020-01-01T00:00:00Z", max_records: int = 2_000) -> None:
    """One ``response`` record per row.  A null payload is empty; a null url or id leaves its header out."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(F.sha1(payload.cast("binary"))))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(payload).cast("string"), F.lit(RECORD_END))
    fields = [_line("WARC-Record-ID", _uuid(F.col(id_col), F.col(url_col), digest)),
              _line("WARC-Target-URI", F.col(url_col)), _line("WARC-Date", F.lit(date)),
              _line("X-Page-ID", F.col(id_col)), _line("WARC-Payload-Digest", digest)]
    _write(pages.select(_record(F.lit("response"), fields, http, payload).alias("record")), path, max_records)


def _parse(blob: bytes) -> Iterator[tuple[int, dict[str, str], bytes, bytes]]:
    """(offset, headers, HTTP head, payload) of each record, found by its Content-Length alone."""
    if blob[:2] == b"\x1f\x8b":
        blob = gzip.decompress(blob)
    at = blob.find(b"WARC/")
    while at >= 0:
        end = blob.index(b"\r\n\r\n", at)
        lines = blob[at:end].decode("utf-8", "replace").split(CRLF)[1:]
        fields = dict(x.split(": ", 1) for x in lines if ": " in x)
        stop = end + 4 + int(fields["Content-Length"])
        head, _, payload = blob[end + 4:stop].partition(b"\r\n\r\n")
        yield at, fields, head, payload
        at = blob.find(b"WARC/", stop)


def _records(file: str, blob: bytes, with_payload: bool) -> list[tuple]:
    """Rows of ``RECORD_SCHEMA`` of one archive."""
    rows = []
    for at, f, head, payload in _parse(blob):
        said = f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
        if f["WARC-Type"] == "response":
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            size, digest = int(dict(x.split(": ", 1) for x in head.decode().split(CRLF)[1:])["Content-Length"]), said
        rows.append((file, at, f["WARC-Type"], f.get("WARC-Record-ID"), f.get("X-Page-ID"), f.get("WARC-Target-URI"),
                     f.get("WARC-Date"), f.get("WARC-Refers-To"), f.get("X-Refers-To-Page-ID"), size, digest,
                     digest == said, payload if with_payload else None))
    return rows


def _columns(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record (``RECORD_SCHEMA``).  A response's length and digest are those of the bytes
    read, and ``intact`` says that its header agrees; a revisit's come from its headers."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, blob in zip(batch["path"], batch["content"], strict=True):
                if rows := _records(file, blob, with_payload):
                    yield pd.DataFrame(rows, columns=_columns(RECORD_SCHEMA))

    return _files(spark, path).mapInPandas(parse, RECORD_SCHEMA)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide for each record header (columns of ``read_archives``) whether it is the response or a revisit.

    Headers alone are shuffled by payload digest.  Of equal payloads of at least ``min_bytes``
    the smallest page id (nulls last; then target URI, file and offset) is the response.
    Adds ``kind`` and, for revisits, ``to_id``, ``to_page``, ``to_uri`` and ``to_date``.
    """
    h = headers.select(F.col("page_id").cast("long").isNull().alias("no_id"), F.col("page_id").cast("long").alias("id"),
                       "file", "offset", "record_id", "target_uri", "date", "payload_digest", "payload_bytes")
    h = h.withColumn("group", F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest"))
                     .otherwise(F.concat_ws(":", "file", "offset"))).withColumn("at", F.concat_ws(":", "file", "offset"))
    h = salted_min(h, "group", ["no_id", "id", "target_uri", "file", "offset", "record_id", "date"], "at")
    own = (F.col("first.file") == F.col("file")) & (F.col("first.offset") == F.col("offset"))
    to = {"to_id": "record_id", "to_page": "id", "to_uri": "target_uri", "to_date": "date"}
    return h.select("file", "offset", F.when(own, "response").otherwise("revisit").alias("kind"),
                    *[F.when(~own, F.col(f"first.{c}")).alias(k) for k, c in to.items()])


def write_deduplicated(spark: SparkSession, raw: str, decisions: DataFrame, path: str, max_records: int = 2_000) -> None:
    """Rewrite the archives of ``raw`` so that revisits carry fresh headers and no payload; responses stay whole.

    The decisions of one archive (bounded by its ``max_records``) are joined to the archive as it
    is stored, so compressed files are moved, not payloads.
    """
    per_file = decisions.groupBy("file").agg(F.collect_list(F.struct("offset", *DECISION)).alias("decided"))
    schema = f"{RECORD_SCHEMA}, kind string, to_id string, to_page long, to_uri string, to_date string"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, blob, decided in zip(batch["path"], batch["content"], batch["decided"], strict=True):
                by_offset = {d["offset"]: [d[c] for c in DECISION] for d in decided}
                if rows := [(*r, *by_offset[r[1]]) for r in _records(file, blob, True)]:
                    yield pd.DataFrame(rows, columns=_columns(schema)).astype({"to_page": "Int64"})

    files = _files(spark, raw)
    r = files.join(per_file, files["path"] == per_file["file"]).select("path", "content", "decided").mapInPandas(parse, schema)
    revisit = F.col("kind") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    fields = [_line("WARC-Record-ID", F.when(revisit, _uuid(F.col("record_id"), F.col("to_id"), F.col("file"), F.col("offset")))
                    .otherwise(F.col("record_id"))),
              _line("WARC-Target-URI", F.col("target_uri")), _line("WARC-Date", F.col("date")), _line("X-Page-ID", F.col("page_id")),
              _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
              _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _line("WARC-Refers-To", F.col("to_id")),
              _line("WARC-Refers-To-Target-URI", F.col("to_uri")), _line("WARC-Refers-To-Date", F.col("to_date")),
              _line("X-Refers-To-Page-ID", F.col("to_page"))]
    _write(r.select(_record(F.col("kind"), fields, http, payload).alias("record")), path, max_records)


def archive(pages: DataFrame, folder: str, min_bytes: int = 0, **write) -> DataFrame:
    """Write ``pages`` as archives, resolve revisits, write the deduplicated archives, and read those.

    ``folder`` must be shared storage; it gets ``raw`` and ``dedup``.  Returns one row per
    page: page_id, payload_bytes, payload_digest, record_type, refers_to, intact, target_uri.
    Null html is an empty payload; repeated rows with one page id: one is the response, the others
    revisit it; an empty table gives no rows; other columns of ``pages`` are ignored.
    """
    spark = pages.sparkSession
    raw, dedup = f"{folder}/raw", f"{folder}/dedup"
    write_responses(pages, raw, **write)
    decisions = materialise(resolve_revisits(read_archives(spark, raw), min_bytes), "warc-decisions")
    write_deduplicated(spark, raw, decisions, dedup)
    return read_archives(spark, dedup).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_page").cast("long").alias("refers_to"), "intact", "target_uri")
