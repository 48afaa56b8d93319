"""WARC archives: written by Spark tasks into the shared folder, read back record by record.

Every record is one gzip member. The reader is sequential: it inflates a file piece by piece with zlib, frames a record's
block by its Content-Length, checks the block's and the payload's digests, and never holds more than one record. Files are
rolled at `file_bytes`, so that a table makes many files and each is one reader's work.

Of records with the same payload of at least `revisit_bytes` bytes the one with the smallest page_id is a response, the
others are revisits: headers only, that name the response and the payload's digest and length. Payloads are equal if their
SHA-256 is. A null html is an empty payload; a null page_id is never referred to unless no other record has the payload,
and then its record stands for itself; of rows that share the smallest page_id one is the response, chosen by url. An
empty table makes no file and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, small_side, stored, work_dir

FILE_BYTES = 64 << 20
REVISIT_BYTES = 100
CHUNK = 1 << 16
#: Written in every record, so that archives of the same pages are the same bytes.
DATE = "2024-01-01T00:00:00Z"
RECORD_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean"


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("Content-Length", str(len(block)))])
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = (url or "").encode("ascii", "backslashreplace").decode().replace("\r", "").replace("\n", "").strip() or "about:blank"
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Target-URI", uri), ("WARC-Date", DATE), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        headers.insert(1, ("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    return member(headers, http if revisit else http + payload)


def read_records(source: BinaryIO, chunk: int = CHUNK) -> Iterator[Record]:
    """The records of one archive, in order. Raises ValueError where the framing is broken or a digest differs."""
    left = b""
    while True:
        data = left or source.read(chunk)
        if not data:
            return
        z, got, length, headers, start = zlib.decompressobj(31), bytearray(), None, {}, 0
        while not z.eof:
            got += z.decompress(data)
            if length is None and (end := got.find(b"\r\n\r\n")) >= 0:
                first, *lines = got[:end].decode().split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError(f"no WARC version line: {first[:40]!r}")
                headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
                length, start = int(headers["content-length"]), end + 4
            if not z.eof:
                data = source.read(chunk)
                if not data:
                    raise ValueError("the archive ends within a record")
        left = z.unused_data
        if length is None or len(got) != start + length + 4 or got[start + length :] != b"\r\n\r\n":
            raise ValueError("a record's length differs from its Content-Length")
        block = bytes(got[start : start + length])
        if headers.get("warc-block-digest", "").removeprefix("sha256:") not in ("", hashlib.sha256(block).hexdigest()):
            raise ValueError("a block's digest differs")
        yield Record(headers, block)


def _page(uri: str | None) -> int | None:
    return int(uri.strip("<>").rpartition(":")[2]) if uri else None


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def planned(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, refers_to, revisit. The payloads stay where they lie while the digests that occur more than once are few enough for a broadcast; else they are shuffled by digest."""
    df = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    df = df.withColumn("digest", F.sha2("payload", 256))
    groups = df.filter(F.octet_length("payload") >= revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("original"), F.count("*").alias("copies"), F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("least"))
    groups = groups.filter("copies > 1 AND original IS NOT NULL").select("digest", "original", F.col("least.url").alias("original_url"))
    df = df.join(small_side(stored(groups)), "digest", "left")
    same = F.coalesce((F.col("page_id") == F.col("original")) & F.col("url").eqNullSafe(F.col("original_url")), F.lit(False))
    df = df.withColumn("revisit", F.col("original").isNotNull() & ~same)
    # rows that repeat the response's page_id and url are equal: one of them stays, the others revisit it
    first = df.filter(F.col("original").isNotNull() & ~F.col("revisit")).groupBy("page_id", "url", "digest", "original").agg(F.any_value("payload").alias("payload"), F.count("*").alias("n"))
    first = first.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("revisit", F.col("row") > 1)
    rest = df.filter(F.col("original").isNull() | F.col("revisit"))
    out = ["page_id", "url", "payload", "digest", F.when(F.col("revisit"), F.col("original")).alias("refers_to"), "revisit"]
    return rest.select(*out).unionByName(first.select(*out))


def write_archives(plan: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the planned records; (path, records, bytes) of the files of the tasks that count. A task that is run again writes other files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        out = None

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            for page, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = page_record(page, url, payload, digest, refers_to, revisit)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    small_batches(plan.sparkSession)
    return stored(plan.select("page_id", "url", "payload", "digest", "refers_to", "revisit").mapInArrow(run, "path string, records long, bytes long"))


def read_archives(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """A row per record of the archives that `files` (path below the folder) names; intact: the payload has the digest that its record states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with fs.open_input_stream(f"{root}/{path}", compression=None) as source:
                    for r in read_records(source):
                        h = r.headers
                        http, _, payload = r.block.partition(b"\r\n\r\n")
                        length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        stated = h["warc-payload-digest"].removeprefix("sha256:")
                        revisit = h["warc-type"] == "revisit"
                        intact = not payload if revisit else len(payload) == length and hashlib.sha256(payload).hexdigest() == stated
                        if not intact:
                            raise ValueError(f"{path}: a payload differs from its record")
                        rows.append((_page(h.get("warc-record-id")), h["warc-target-uri"], h["warc-type"], length, stated, _page(h.get("warc-refers-to")), True))
                        if len(rows) >= 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    n = files.count()
    return files.select("path").repartition(max(1, n)).mapInArrow(run, RECORD_SCHEMA) if n else spark.createDataFrame([], RECORD_SCHEMA)


def round_trip(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the pages' archives below the shared folder and returns what reading them gives."""
    spark = pages.sparkSession
    folder = f"{work_dir(spark)}/warc"
    files = write_archives(planned(pages, revisit_bytes), folder, file_bytes)
    return read_archives(spark, files, folder)


#: round_trip over the table pages.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""
