"""WARC archives without repeated payloads: revisit records refer to one original response.

Only headers are grouped by payload digest: of the records with equal payloads of ``LEAST_BYTES`` or more the one with the largest
``page_id`` is the original, the rest become revisit records. The originals of digests that occur more than once
then meet the pages by digest and a salt, so that a payload which many pages share is dealt over many tasks. Each record
gets fresh headers; a revisit has the original's record id and no payload. Spark's text writer puts the
records into gzip files, with the record's end as line separator, and its committer makes that safe when executors are lost.

A null page is an empty payload. Pages below the bound are responses, equal or not. Of rows that repeat a ``page_id`` with
the same payload all are responses if that is the largest ``page_id``, else all are revisits. Null ``page_id`` counts as
smallest. Long pages are written whole, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpscope.llm.common import new_path

LEAST_BYTES = 1000
SALTS = 16
RECORDS_PER_FILE = 4000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n\r\n"
_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*\r?$", re.M)


def resolve(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The pages with payload, its size and digest, and ``original``: the page that has the same payload, if not this one."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    own = own.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha1("payload"))
    headers = own.filter(F.col("n") >= least_bytes).groupBy("digest")
    shared = headers.agg(F.max("page_id").alias("original"), F.count("*").alias("times")).filter("times > 1")
    shared = shared.select("digest", "original", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = own.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    own = own.join(shared, ["digest", "salt"], "left").drop("salt")
    other = (F.col("n") >= least_bytes) & (F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("original"))
    return own.withColumn("original", F.when(other, F.col("original")))


def _record_id(page):
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), F.col("digest"), F.lit(">"))


def records(resolved: DataFrame) -> DataFrame:
    """One string for each record, without the two line ends that close it."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    revisit = F.col("original").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    refers = F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("original")), F.lit("\r\n"))
    return resolved.select(
        F.concat(
            F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
            F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id")),
            F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url,
            F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
            F.when(revisit, refers).otherwise(F.lit("")),
            F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(END),
            block,
        ).alias("value")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> None:
    out = records(resolve(pages, least_bytes)).write.option("lineSep", END).option("compression", "gzip")
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers and block of each record of a gzip file, which may have many members."""
    buffer, inflate = b"", zlib.decompressobj(31)

    def more() -> bytes:
        nonlocal data, inflate
        out = b""
        while data and not out:
            out = inflate.decompress(data, 1 << 20)
            data = inflate.unconsumed_tail
            if inflate.eof:
                data, inflate = inflate.unused_data, zlib.decompressobj(31)
        return out

    def need(n: int) -> bool:
        nonlocal buffer
        parts, have = [buffer], len(buffer)
        while have < n and (new := more()):
            parts.append(new)
            have += len(new)
        buffer = b"".join(parts)
        return have >= n

    at = 0
    while True:
        while (stop := buffer.find(b"\r\n\r\n", at)) < 0:
            if not need(len(buffer) + 1):
                return
        head = {k.lower(): v for k, v in _FIELD.findall(buffer[at:stop])}
        first = stop + 4
        last = first + int(head[b"content-length"])
        if not need(last + 4):
            raise ValueError("an archive ends within a record")
        yield head, buffer[first:last]
        at = last + 4
        if at > 1 << 22:
            buffer, at = buffer[at:], 0


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record, from its headers; a response's payload is checked against its digest."""
    from hashlib import sha1

    def page(name: bytes) -> int | None:
        number = name.strip(b"<>").split(b":")[2]
        return int(number) if number else None

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows: list[tuple] = []
                for head, block in parse(batch.column("content")[k].as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(dict(_FIELD.findall(http))[b"Content-Length"])
                    kind, digest = head[b"warc-type"].decode(), head[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
                    if kind == "response" and (len(payload), sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"a payload differs from its headers: {head[b'warc-record-id']!r}")
                    refers = page(head[b"warc-refers-to"]) if kind == "revisit" else None
                    rows.append((page(head[b"warc-record-id"]), head.get(b"warc-target-uri", b"").decode(), size, digest, kind, refers))
                if rows:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch(columns, names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back."""
    folder = new_path(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
