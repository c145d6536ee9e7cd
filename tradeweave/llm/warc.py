"""WARC archives with revisit records: equal payloads are stored once.

1. Every page's payload digest is taken; the narrow headers (digest, length, page id) are summed by payload, which
   names the original of each payload: the largest page id.
2. Pages meet their original's id by digest, get fresh record headers and are written: originals and small pages as
   `response`, the rest as `revisit` records that hold HTTP headers only and refer to the original's record.
3. The archives are read back record by record; revisit records are joined to the responses they refer to, from
   whose payload their length and digest are taken.

A record ends with CRLF CRLF, so Spark's text writer frames records by its line separator and any file system that
Spark can write will do. Files are gzip as a whole.

Defined results: a null payload is an empty one; payloads below the limit are always responses; rows that repeat the
largest page id with the same payload are all responses; a null page id counts as the smallest; the digest of a
record is that of its full payload. Other columns than page id, url and payload are not archived.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm.text import apart, spread_join
from tradeweave.session import forget_at_exit, shared_dir, stage

CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # archives of the same pages are equal byte by byte


def with_originals(pages: DataFrame, page_id: str, payload: str, min_bytes: int) -> DataFrame:
    """`_digest`, `_bytes` of each payload and `_original`, the largest page id with that payload (null if too small).

    Only headers are summed, with partial sums before the shuffle: one payload may hold most pages.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    hashed = pages.withColumn("_digest", F.sha1(body)).withColumn("_bytes", F.octet_length(body).cast("long"))
    headers = hashed.filter(F.col("_bytes") >= min_bytes).groupBy("_digest", "_bytes").agg(
        F.max(page_id).alias("_original"), F.count(F.lit(1)).alias("_pages")).filter(F.col("_pages") > 1)
    return hashed.join(headers.drop("_pages"), ["_digest", "_bytes"], "left")


def _record_id(digest: Column, page: Column) -> Column:
    """A UUID from page id and payload digest: the same record gets the same id in every run."""
    h = F.md5(F.concat_ws("|", page.cast("string"), digest))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
            min_bytes: int = 1000) -> DataFrame:
    """One column `value`: a whole WARC record without its closing CRLF CRLF, for each page."""
    inner, at = apart(pages)
    page, link, body = at[page_id], F.col(at[url]), F.coalesce(F.col(at[payload]), F.lit(""))
    placed = with_originals(inner, page, at[payload], min_bytes)
    key = F.col(page)
    revisit = F.coalesce(~key.eqNullSafe(F.col("_original")) & F.col("_original").isNotNull(), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("_bytes").cast("string"), F.lit(END))
    block_bytes = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("_bytes"))
    target = F.coalesce(F.nullif(F.regexp_replace(link, r"[\x00-\x20\x7f]+", "%20"), F.lit("")), F.lit("urn:none"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    none = F.lit("")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("_digest"), key)), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", target), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", _record_id(F.col("_digest"), F.col("_original")))))
        .otherwise(none),
        F.when(key.isNotNull(), line("Page-ID", key.cast("string"))).otherwise(none),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block_bytes.cast("string")), F.lit(CRLF))
    return placed.select(F.concat(head, http, F.when(revisit, none).otherwise(body)).alias("value"))


def write_archives(pages: DataFrame, path: str, **columns) -> None:
    """Write the deduplicated archives of `pages` into the new folder `path`."""
    records(pages, **columns).write.option("lineSep", END).option("compression", "gzip").text(path)


_HEADER = re.compile(rb"^([^:\r\n]+): *([^\r\n]*)", re.M)


def parse_archive(data: bytes) -> Iterator[dict]:
    """Records of one archive, by the Content-Length of each: payloads may hold any bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _HEADER.findall(data[at:end])}
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        start, length = end + 4, int(head["content-length"])
        block = data[start:start + length]
        if len(block) < length or data[start + length:start + length + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut off")
        yield head | {"payload": block[block.index(b"\r\n\r\n") + 4:]}
        at = start + length + 4


def unpacked(content: bytes) -> bytes:
    """The content of all gzip members of a file: archives may be gzip as a whole or record by record."""
    members, data = [], content
    while data.strip(b"\0"):  # zeros may fill up a file
        member = zlib.decompressobj(47)
        members.append(member.decompress(data) + member.flush())
        if not member.eof:
            raise ValueError("a gzip member is cut off")
        data = member.unused_data
    return b"".join(members)


_ROW = "record_id string, page_id string, record_type string, refers_to_id string, url string, header_digest string, "
_ROW += "payload_bytes long, payload_digest string, payload string"


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in `path`; length and digest are taken from the payload that was read."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                found, size = [], 0
                for r in parse_archive(unpacked(bytes(content))):
                    body = r["payload"]
                    found.append((r["warc-record-id"], r.get("page-id"), r["warc-type"], r.get("warc-refers-to"),
                                  r.get("warc-target-uri"), r["warc-payload-digest"].partition(":")[2], len(body),
                                  hashlib.sha1(body).hexdigest(),
                                  body.decode("utf-8") if payloads and r["warc-type"] == "response" else None))
                    size += len(body) if payloads else 0
                    if len(found) >= 10_000 or size >= 16_000_000:
                        yield pd.DataFrame(found, columns=names)
                        found, size = [], 0
                if found:
                    yield pd.DataFrame(found, columns=names)

    names = [part.split()[0] for part in _ROW.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(rows, _ROW)


def resolve_revisits(rows: DataFrame, payloads: bool = False) -> DataFrame:
    """Records with their full payload's length, digest and text: those of a revisit come from its original.

    Only revisits are joined, with the responses they refer to. Without payloads the records are narrow: they are staged,
    and originals of very many revisits are broadcast.
    """
    own = ["payload_bytes", "payload_digest", "payload"]
    rows = rows if payloads else stage(rows)
    revisits, others = rows.filter("record_type = 'revisit'"), rows.filter("record_type <> 'revisit'")
    held = revisits.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("held"))
    originals = others.filter("record_type = 'response'").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), *own).join(held, "refers_to_id")
    found = revisits.drop(*own)
    found = found.join(originals, "refers_to_id", "left") if payloads else spread_join(found, stage(originals), "refers_to_id")
    columns = ["record_id", "page_id", "record_type", "refers_to_id", "refers_to", "url", "header_digest", *own]
    return others.withColumn("refers_to", F.lit(None).cast("string")).select(*columns).unionByName(found.select(*columns))


def archive_and_read(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                     min_bytes: int = 1000, path: str | None = None, payloads: bool = False) -> DataFrame:
    """Write the archives to `path` (a new folder in the shared one if none is given) and read them back, resolved."""
    spark = pages.sparkSession
    if path is None:
        path = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
        forget_at_exit(spark, path)
    write_archives(pages, path, page_id=page_id, url=url, payload=payload, min_bytes=min_bytes)
    return resolve_revisits(read_records(spark, path, payloads), payloads)
