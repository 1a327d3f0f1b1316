"""Web archives and containers: a WARC data source, reads of byte ranges, fetching, and readers of rows."""

from __future__ import annotations

import gzip
import io
import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, StructField, StructType

SCHEMA = "warc_filename string, warc_record_offset bigint, warc_record_length bigint, record_type string, url string, date string, content_mime_type string, content_mime_detected string, content_truncated string, body binary"
# Record types that hold content, and the body size at which a crawler cut
CONTENT = ("response", "conversion", "resource")
CUT_AT = 1_048_576


def headers(block: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields of a header block, names in lower case."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    return lines[0], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if ":" in x)}


def detected(body: bytes) -> str | None:
    """Media type by the first bytes."""
    for magic, mime in ((b"%PDF", "application/pdf"), (b"PK\x03\x04", "application/zip"), (b"\x89PNG", "image/png"), (b"\xff\xd8", "image/jpeg"), (b"<!DOCTYPE html", "text/html"), (b"<html", "text/html")):
        if body[: len(magic)].lower() == magic.lower():
            return mime
    return None


def record(data: bytes, name: str, offset: int, length: int) -> dict | None:
    """A content record as a row; None for other types and for what is no record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, h = headers(head)
    if not first.startswith("WARC/") or h.get("warc-type") not in CONTENT:
        return None
    n = h.get("content-length", "")
    body = rest[: int(n)] if n.isdigit() else rest
    mime = h.get("content-type")
    if h["warc-type"] == "response":
        http, _, body = body.partition(b"\r\n\r\n")
        mime = headers(http)[1].get("content-type")
    mime = mime.split(";")[0].strip().lower() if mime else None
    cut = h.get("warc-truncated") or ("length" if len(body) >= CUT_AT else None)
    return {"warc_filename": name, "warc_record_offset": offset, "warc_record_length": length, "record_type": h["warc-type"], "url": h.get("warc-target-uri"), "date": h.get("warc-date"), "content_mime_type": mime, "content_mime_detected": h.get("warc-identified-payload-type") or detected(body), "content_truncated": cut, "body": body}


def members(f) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each gzip member of a file, or of each record of a plain one."""
    import zlib

    start = f.read(2)
    f.seek(0)
    if start != b"\x1f\x8b":
        data, at = f.read(), 0
        while (at := data.find(b"WARC/1.", at)) >= 0:
            head = data.find(b"\r\n\r\n", at)
            if head < 0:
                return
            n = headers(data[at:head])[1].get("content-length", "0")
            end = head + 4 + (int(n) if n.isdigit() else 0)
            yield at, end - at, data[at:end]
            at = end
        return
    offset, pending = 0, b""
    while True:
        d, out, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            chunk = pending or f.read(1 << 16)
            pending = b""
            if not chunk:
                return
            try:
                out.append(d.decompress(chunk))
            except zlib.error:
                return
            used += len(chunk)
        pending = d.unused_data
        used -= len(pending)
        yield offset, used, b"".join(out)
        offset += used


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[_Part]:
        if os.path.isdir(self.path):
            names = sorted(os.path.join(self.path, n) for n in os.listdir(self.path) if ".warc" in n)
        else:
            names = [self.path]
        return [_Part(n) for n in names]

    def read(self, part: _Part):
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        with open(part.path, "rb") as f:
            for offset, length, data in members(f):
                if row := record(data, part.path, offset, length):
                    yield tuple(row[n] for n in names)


class WarcSource(DataSource):
    """spark.dataSource.register(WarcSource); spark.read.format("warc").load(path): one partition for each file."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").load(path)


def attach_payload(index: DataFrame, root: str = "", container: str = "gzip") -> DataFrame:
    """Adds `media_bytes`, read by (warc_filename, warc_record_offset, warc_record_length); null where it can't be read.

    gzip members of WARC files, zstd frames of a container, or plain ranges. The rows are read where they are.
    """
    import pyarrow as pa

    schema = StructType([*index.schema.fields, StructField("media_bytes", BinaryType())])
    names = index.columns

    def fetch(path: str, offset: int, length: int) -> bytes | None:
        try:
            with open(os.path.join(root, path), "rb") as f:
                f.seek(offset)
                raw = f.read(length)
            if container == "gzip":
                row = record(gzip.decompress(raw), path, offset, length)
                return row and row["body"]
            if container == "zstd":
                import zstandard

                return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
            return raw
        except Exception:
            return None

    def run(batches):
        for b in batches:
            c = {n: b.column(i).to_pylist() for i, n in enumerate(names)}
            got = [fetch(*x) if None not in x else None for x in zip(c["warc_filename"], c["warc_record_offset"], c["warc_record_length"])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], names=[*names, "media_bytes"])

    return index.mapInArrow(run, schema)


def fetch_urls(urls: DataFrame, get: Callable[[str], bytes], column: str = "url", workers: int = 15, retries: int = 3) -> DataFrame:
    """Adds `media_bytes` by `get`, called from a pool of threads in each task; null after the retries."""
    import pyarrow as pa

    schema = StructType([*urls.schema.fields, StructField("media_bytes", BinaryType())])
    at = urls.columns.index(column)

    def once(u):
        for _ in range(retries if u is not None else 0):
            try:
                return get(u)
            except Exception:
                continue
        return None

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(pool.map(once, b.column(at).to_pylist())), pa.binary())], names=[*b.schema.names, "media_bytes"])

    return urls.mapInArrow(run, schema)


def chained(*parts: DataFrame) -> DataFrame:
    """Rows of several readers one after another; columns that one lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: str, limit: int | None = None, glob: str | None = None) -> DataFrame:
    r = spark.read.schema(schema)
    df = (r.option("pathGlobFilter", glob) if glob else r).json(path)
    return df.limit(limit) if limit else df


def within_limits(files: DataFrame, most_bytes: int | None = None, most_pages: int | None = None) -> DataFrame:
    """Adds `reject_reason` too_large or too_many_pages, by columns size and pages."""
    big = F.lit(False) if most_bytes is None else F.col("size") > most_bytes
    long = F.lit(False) if most_pages is None else F.col("pages") > most_pages
    return files.withColumn("reject_reason", F.when(big, "too_large").when(long, "too_many_pages"))
