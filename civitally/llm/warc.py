"""Legacy ARC archives to WARC: parse version-specific headers, synthesise what WARC asks for.

An ARC row holds one whole archive: a version block and records whose header lines have
five (version 1) or ten (version 2) fields, each followed by a body of the declared length.
Conversion gives each record a stable identifier, an ISO timestamp, a type and digests.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.session import cut_lineage, delete_at_end, shared_dir

from .registry import query, table

#: Bytes of records in an archive, at least, before the next one is begun (one record may be larger).
ARCHIVE_BYTES = 8 << 20
CRAWLED = "20000101000000"
# Field lists of the two ARC versions and the WARC revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ARC = "name string, version int, content binary"
_RECORD = ("page_id long, record_id string, url string, ip string, warc_date string, mime string, "
           "payload_bytes long, payload_digest string, head binary, payload binary")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _arc_line(version: int, url: str, mime: str, status: str, at: int, name: str, length: int) -> bytes:
    fields = [url, "0.0.0.0", CRAWLED, mime]
    if version == 2:
        fields += [status, "-", "-", str(at), name]
    return (" ".join([*fields, str(length)]) + "\n").encode()


def to_arc(pages: DataFrame, version: int, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Whole ARC archives (name, version, content) of ``pages``; a null html is an empty payload.

    White space in urls is written as %20, a null url as ``-``. The page's id goes into the
    stored HTTP header, unless it is null.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = bytearray()
        for batch in batches:
            for page_id, url, html in batch.itertuples(index=False):
                name = f"v{version}.arc"
                if not out:
                    block = f"{version} 0 crawl\n{ARC_FIELDS[version]}\n\n".encode()
                    out += _arc_line(version, f"filedesc://{name}", "text/plain", "200", 0, name, len(block)) + block
                url = "%20".join(url.split()) if url and url.strip() else "-"
                mark = f"X-Page-Id: {page_id}\r\n" if page_id else ""
                html = html or b""
                head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}"
                        f"Content-Length: {len(html)}\r\n\r\n").encode()
                out += _arc_line(version, url, "text/html", "200", len(out), name, len(head) + len(html))
                out += head + html + b"\n"
                if len(out) >= archive_bytes:
                    yield pd.DataFrame({"name": [name], "version": [version], "content": [bytes(out)]})
                    out.clear()
        if out:
            yield pd.DataFrame({"name": [name], "version": [version], "content": [bytes(out)]})

    return pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.col("html").cast("binary").alias("html")).mapInPandas(write, _ARC)


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of every record after the version block, by declared lengths."""
    at, names = 0, None
    while at < len(content):
        stop = content.index(b"\n", at)
        line = content[at:stop].decode()
        if names is None:
            length = int(line.rsplit(" ", 1)[1])
            block = content[stop + 1:stop + 1 + length].decode().split("\n")
            version = int(block[0].split(" ", 1)[0])
            names, at = ARC_FIELDS[version].split(), stop + 1 + length
            if block[1].split() != names:
                raise ValueError(f"the field list is not that of version {version}")
            continue
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"no ARC header line: {line[:80]}")
        length = int(values[-1])
        body = content[stop + 1:stop + 1 + length]
        if len(body) != length:
            raise ValueError("the archive ends inside a record")
        yield dict(zip(names, values)), body
        at = stop + 1 + length + 1


def _http(body: bytes) -> tuple[bytes, bytes]:
    end = body.index(b"\r\n\r\n") + 4
    return body[:end], body[end:]


def _field(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode()
    return None


def convert(archives: DataFrame) -> DataFrame:
    """One row per ARC record with what its WARC record needs; ids depend on the content alone."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _RECORD.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                out = []
                for fields, body in parse_arc(content):
                    head, payload = _http(body)
                    page_id, sha = _field(head, b"x-page-id"), digest(payload)
                    d = fields["Archive-date"]
                    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    record_id = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{fields['URL']} {d} {page_id} {sha}')}"
                    out.append((None if page_id is None else int(page_id), record_id, fields["URL"],
                                fields["IP-address"], date, fields["Content-type"], len(payload), sha, head, payload))
                yield pd.DataFrame(out, columns=columns, dtype=object).astype({"page_id": "Int64"})

    return archives.select("content").mapInPandas(read, _RECORD)


def with_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with the response a record revisits (``of``), null for responses.

    Of records with equal payloads of at least ``min_bytes`` the one with the largest page_id
    is the response (null ids last; equal ids are all responses). Only payloads met more than
    once are joined, so single ones need no shuffle where that table is small.
    """
    shared = records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.count("*").alias("n"), F.max(F.struct("page_id", "record_id", "url", "warc_date")).alias("of"))
    shared = cut_lineage(shared.where("n > 1").drop("n"))
    joined = records.join(shared, "payload_digest", "left")
    revisits = ~F.col("page_id").eqNullSafe(F.col("of.page_id")) & (F.col("payload_bytes") >= min_bytes)
    return joined.withColumn("of", F.when(revisits, F.col("of")))


def write_warc(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip") -> None:
    """WARC files under ``folder``; a file holds about ``archive_bytes`` (unpacked) and one record at least."""

    def block(r) -> str:
        revisit = r.of is not None
        body = r.head if revisit else r.head + r.payload
        lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{r.record_id}>",
                 f"WARC-Date: {r.warc_date}", f"WARC-Target-URI: {r.url}", f"WARC-IP-Address: {r.ip}",
                 f"WARC-Payload-Digest: sha1:{r.payload_digest}", f"WARC-Block-Digest: sha1:{digest(body)}"]
        if revisit:
            lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{r.of['record_id']}>",
                      f"WARC-Refers-To-Target-URI: {r.of['url']}", f"WARC-Refers-To-Date: {r.of['warc_date']}"]
            if r.of["page_id"]:
                lines.append(f"X-Refers-To-Page-Id: {r.of['page_id']}")
        lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}", "", ""]
        return "\r\n".join(lines) + body.decode()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                held.append(block(r))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pd.DataFrame({"value": ["\r\n\r\n".join(held)]})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"value": ["\r\n\r\n".join(held)]})

    # As text, because pandas turns whole numbers beside nulls into floats.
    of = F.col("of").withField("page_id", F.col("of.page_id").cast("string"))
    needed = ["record_id", "url", "ip", "warc_date", "payload_digest", "head", "payload"]
    packed = records.select(*needed, of.alias("of")).mapInPandas(pack, "value string")
    # The end of a WARC record is two line ends, which the text writer puts after every value.
    packed.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).option(
        "compression", compression).text(folder)


def parse_warc(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of every record, by declared lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        head = content[at:end]
        if not head.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record at {at}")
        length = int(_field(head, b"content-length"))
        if content[end + length:end + length + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} has another length than declared")
        yield head, content[end:end + length]
        at = end + length + 4


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id and url of every record."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                out = []
                packed = content[:2] == b"\x1f\x8b"
                for head, block in parse_warc(gzip.decompress(content) if packed else content):
                    http, payload = _http(block)
                    kind, sha = _field(head, b"warc-type"), _field(head, b"warc-payload-digest").removeprefix("sha1:")
                    if kind == "response" and digest(payload) != sha:
                        raise ValueError("a payload does not have its digest")
                    ids = [_field(http, b"x-page-id"), _field(head, b"x-refers-to-page-id")]
                    page_id, refers_to = (None if x is None else int(x) for x in ids)
                    out.append((page_id, int(_field(http, b"content-length")), sha, kind, refers_to,
                                _field(head, b"warc-record-id").strip("<>"), _field(head, b"warc-target-uri")))
                yield pd.DataFrame(out, columns=["page_id", "payload_bytes", "payload_digest", "record_type",
                                                 "refers_to", "record_id", "url"], dtype=object).astype(
                    {"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    return files.select("content").mapInPandas(read, (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, url string"))


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Pages through ARC archives of both versions to WARC files. Repeated rows are records of their own."""
    odd = F.pmod(F.xxhash64("page_id"), F.lit(2)) == 1
    archives = to_arc(pages.where(odd), 1).unionByName(to_arc(pages.where(~odd), 2))
    write_warc(with_revisits(convert(archives), min_bytes), folder)


_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, encode(h) AS b, sha1(h) AS s FROM p),
bits AS (SELECT page_id, octet_length(b) AS n, s, max(page_id) OVER (PARTITION BY s) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     CAST((CAST('0x' || substr(s, 1 + (i // 4) * 5, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1), '' ORDER BY i)
   FROM (SELECT unnest(range(0, 32)) AS i)) AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM bits
"""


@query(_SQL)
def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the WARC files it was written to."""
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archive_pages(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, delete_at_end(spark, folder)).drop("record_id", "url")
