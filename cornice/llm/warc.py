"""WARC archives: writing captures, reading them back, assembling transactions.

Each capture is a request, a response or revisit, and a metadata record; the
latter two kinds name the response's record in WARC-Concurrent-To.  Records are
UTF-8 text whose end mark, two line ends, is the writer's line separator, so
Spark's own committed text sink writes valid files to any store.  Reading takes
whole files (kept small by the writer) and splits them by Content-Length.
Assembly joins the three kinds through the concurrent-to identifiers into one
nested row per capture.

Defined cases: a null payload is empty; a null url is left out of its headers,
and blanks and control characters of a url are percent-encoded in them;
records with equal payloads of at least `least` bytes revisit the one with the
largest page_id, and rows that repeat that page_id are responses too; with only
null page_ids all are responses.  Repeated rows each have a capture of their own.
A revisit names its response's record in WARC-Refers-To, and the metadata of its
capture the response's page_id.  Other columns are ignored; an empty table gives
no captures.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import materialize, new_path

END = "\r\n\r\n"
LEAST_BYTES = 1000
#: Captures in one file; the reader holds a file in memory.
FILE_CAPTURES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _urn(kind: str, page_id: str = "page_id", place: str = "_place") -> Column:
    """A record identifier made of the kind, the page and the row's place in the table."""
    h = F.md5(F.concat_ws("|", F.lit(kind), F.col(page_id).cast("string"), "_sha1", F.col(place).cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _base32(sha1: Column) -> Column:
    """The customary form of a SHA-1 in headers: base32 of 160 bits, five at a time."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(sha1, i, 10), 16, 2), 40, "0") for i in (1, 11, 21, 31)])
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.concat(*[F.substring(F.lit(letters), F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)])


def _headers(kind: str, identifier: Column, length: Column, *more: tuple[str, Column]) -> Column:
    """Lines of a record's head; a null value leaves its line out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), identifier), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in more]
    lines.append(F.concat(F.lit("Content-Length: "), length.cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END))


def plan_revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """pages (page_id, url, html) with _sha1, _bytes, _place, and the _winner's page_id and place if it revisits one.

    Only digests that occur more than once are joined back; they are counted
    with partial sums, and Spark splits a hot digest's rows in the join.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), F.sha1(body).alias("_sha1"), F.length(body).cast("long").alias("_bytes"), F.monotonically_increasing_id().alias("_place"))
    top = F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", (-F.col("_place")).alias("_at")))).alias("_t")
    groups = pages.where(F.col("_bytes") >= least).groupBy("_sha1").agg(F.count("*").alias("n"), top).where("n > 1 and _t is not null")
    groups = materialize(groups.select(F.col("_sha1").alias("_g"), F.col("_t.page_id").alias("_top"), (-F.col("_t._at")).alias("_top_place")), "warc-digests")
    joined = pages.join(groups, (F.col("_sha1") == F.col("_g")) & (F.col("_bytes") >= least), "left")
    revisits = F.col("_top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_top"))
    return joined.select("page_id", "url", "html", "_sha1", "_bytes", "_place", F.when(revisits, F.col("_top")).alias("_winner"), F.when(revisits, F.col("_top_place")).alias("_winner_place"))


def _uri(url: Column) -> Column:
    """A url whose blanks and control characters, which would end a header or a request line, are percent-encoded."""
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write the captures of pages (page_id, url, html) as gzipped WARC files under path."""
    rows = plan_revisits(pages, least)
    uri = F.when(F.col("url").rlike(r"[\x00-\x20\x7F]"), _uri(F.col("url"))).otherwise(F.col("url"))
    target = ("WARC-Target-URI", uri)
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), _base32(F.col("_sha1"))))
    close = ("WARC-Concurrent-To", _urn("response"))
    host = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    asked = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit(END))
    about = F.concat_ws("\r\n", F.concat(F.lit("page_id: "), F.col("page_id").cast("string")), F.concat(F.lit("payload_bytes: "), F.col("_bytes").cast("string")), F.concat(F.lit("refers_to_page: "), F.col("_winner").cast("string")), F.lit(""))
    http, fields = ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Type", F.lit("application/warc-fields"))
    request = F.concat(_headers("request", _urn("request"), F.octet_length(asked), target, close, ("Content-Type", F.lit("application/http; msgtype=request"))), asked)
    response = F.concat(_headers("response", _urn("response"), F.octet_length(head) + F.col("_bytes"), target, digest, http), head, F.col("html"))
    refers = ("WARC-Refers-To", _urn("response", "_winner", "_winner_place"))
    revisit = F.concat(_headers("revisit", _urn("response"), F.octet_length(head), target, digest, ("WARC-Profile", F.lit(PROFILE)), refers, http), head)
    metadata = F.concat(_headers("metadata", _urn("metadata"), F.octet_length(about), target, close, fields), about)
    main = F.when(F.col("_winner").isNull(), response).otherwise(revisit)
    # The three records of a capture follow each other in one file.
    text = F.concat_ws(END, request, main, metadata).alias("value")
    rows.select(text).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_CAPTURES).text(path)


RECORDS = "kind string, record_id string, concurrent_to string, target_uri string, payload_sha1 string, payload_bytes long, refers_to string, fields map<string,string>, payload binary"
_RECORD_TYPES = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of an archive file."""
    at = 0
    while data.startswith(b"WARC/", at):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = end + 4
        at = begin + int(headers["content-length"])
        yield headers, data[begin:at]
        at += 4


def _parse(with_payload: bool):
    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers["warc-type"]
        sha1, size, payload, fields = None, None, None, {}
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            named = headers.get("warc-payload-digest", "")
            sha1 = base64.b32decode(named.removeprefix("sha1:")).hex() if named else None
            if kind == "response":
                if sha1 != hashlib.sha1(body).hexdigest():
                    raise ValueError(f"payload of {headers['warc-record-id']} doesn't have its digest")
                size, payload = len(body), body if with_payload else None
            else:
                size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
        elif kind == "metadata":
            fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
        refers = headers.get("warc-refers-to")
        return kind, headers["warc-record-id"], headers.get("warc-concurrent-to"), headers.get("warc-target-uri"), sha1, size, refers, list(fields.items()), payload

    names = [x.split(" ")[0] for x in RECORDS.replace("map<string,string>", "map").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                data = batch.column(0)[i].as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = []
                for headers, block in parse_records(data):
                    rows.append(row(headers, block))
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD_TYPES, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD_TYPES, strict=True)], names)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record.  Payloads' digests are verified; with_payload False leaves their bytes out.

    A task holds the compressed files of its split and one file's content.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, url, main, request, metadata (structs)."""
    main = records.where(F.col("kind").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), F.col("target_uri").alias("url"), F.struct("kind", "payload_sha1", "payload_bytes", "refers_to", "payload").alias("main"))
    request = records.where("kind = 'request'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target_uri").alias("request"))
    metadata = records.where("kind = 'metadata'").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "fields").alias("metadata"))
    return main.join(request, "capture_id", "left").join(metadata, "capture_id", "left")


def archive_and_assemble(pages: DataFrame, least: int = LEAST_BYTES, with_payload: bool = False) -> DataFrame:
    """Write pages to archives in the shared folder, read those back and assemble their captures."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages.select("page_id", "url", "html"), path, least)
    return assemble(materialize(read_archives(spark, path, with_payload), "warc-records"))


#: DuckDB SQL for the query's columns over pages.
WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000) END AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id = top THEN NULL ELSE top::BIGINT END AS refers_to
FROM g
"""
