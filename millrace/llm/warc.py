"""WARC archives of pages, and a normaliser for archives that were compressed as one gzip stream.

Crawlers may leave an archive as a single gzip stream, from which no record can be read alone.  `crawl` writes such
files, `normalise` inflates each one once from start to end, rewrites every record as a gzip member of its own, and
writes a sidecar index with the place of each member; `read` goes by the index and inflates members one by one.

Files go through pyarrow's file systems, so they may lie in any shared store.  A task writes to names nobody else
uses, and only names in the rows it returns are read afterwards: a task that is run again leaves a stray file at
worst, which goes with the folder.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import finish, raw, settle
from millrace.plans.staging import Folder, fresh_dir

FILE_BYTES = 16_000_000
FILE_RECORDS = 10_000
MIN_DEDUP_BYTES = 100
LEVEL = 1
_CHUNK = 1 << 18
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, which `archive_pages` gives with its scheme."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def record(kind: str, page_id, url: str | None, digest: str, length: int, block: bytes, refers_to=None) -> bytes:
    """One WARC/1.1 record."""
    fields = [
        b"WARC/1.1", b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: <urn:page:%s>" % (b"-" if page_id is None else b"%d" % page_id),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Target-URI: " + " ".join((url or "-").split()).encode(),
        b"WARC-Payload-Digest: sha256:" + digest.encode(), b"X-Payload-Length: %d" % length,
        b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block),
    ]
    if refers_to is not None:
        fields.insert(4, b"WARC-Refers-To: <urn:page:%d>" % refers_to)
        fields.insert(5, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return b"\r\n".join(fields) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def inflated(source) -> Iterator[bytes]:
    """Chunks of a gzip stream of one or more members."""
    unzip = zlib.decompressobj(31)
    while data := source.read(_CHUNK):
        while data:
            yield unzip.decompress(data)
            data = unzip.unused_data
            if unzip.eof:
                unzip = zlib.decompressobj(31)
            else:
                break
    yield unzip.flush()


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, holding one record at a time.

    Raises ValueError if the stream ends inside a record.
    """
    buffer = bytearray()
    while True:
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            if (more := next(chunks, None)) is None:
                if buffer.strip():
                    raise ValueError("the archive ends inside a record header")
                return
            seen = max(0, len(buffer) - 3)
            buffer += more
            end = buffer.find(b"\r\n\r\n", seen)
        fields = parse(bytes(buffer[:end]))
        start, length = end + 4, int(fields["content-length"])
        while len(buffer) < start + length + 4:
            if (more := next(chunks, None)) is None:
                raise ValueError("the archive ends inside a record")
            buffer += more
        yield fields, bytes(buffer[start : start + length])
        del buffer[: start + length + 4]


def crawl(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as response records, each file one gzip stream, and return the manifest:
    file, seq, page_id, payload_bytes, payload_digest."""

    def write(batches):
        target, root = store(folder)
        target.create_dir(root, recursive=True)
        name = out = zipper = None
        rows, size = [], 0

        def close():
            nonlocal out, rows, size
            out.write(zipper.flush())
            out.close()
            done = pa.RecordBatch.from_pylist(rows, MANIFEST)
            out, rows, size = None, [], 0
            return done

        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            for page_id, url, payload in zip(ids, urls, raw(batch.column("html")), strict=True):
                payload = payload or b""
                if out is None:
                    name = f"crawl-{uuid.uuid4().hex}.warc.gz"
                    out, zipper = target.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(LEVEL, wbits=31)
                digest = hashlib.sha256(payload).hexdigest()
                out.write(zipper.compress(record("response", page_id, url, digest, len(payload), _HTTP + payload)))
                rows.append({"file": name, "seq": len(rows), "page_id": page_id, "payload_bytes": len(payload), "payload_digest": digest})
                size += len(payload)
                if size >= FILE_BYTES or len(rows) >= FILE_RECORDS:
                    yield close()
        if out is not None:
            yield close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(write, "file string, seq long, page_id long, payload_bytes long, payload_digest string")


MANIFEST = pa.schema([
    ("file", pa.string()), ("seq", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
])


def revisits(manifest: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Add `refers_to`: the smallest page_id with an equal payload, for the other records of that payload.

    Payloads under `min_bytes` never refer.  A null page_id refers to the smallest id, if the payload has one; rows
    that repeat the smallest id are all responses.
    """
    large = manifest.where(F.col("payload_bytes") >= min_bytes)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    first = first.where("_n > 1").drop("_n")
    rows = manifest.join(first, "payload_digest", "left")
    refers = F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.select(*manifest.columns, refers.alias("refers_to"))


def normalise(decided: DataFrame, folder: str) -> DataFrame:
    """Rewrite each one-stream file with a member per record; returns archive and its sidecar index.

    `decided` has file, seq and refers_to for every record; a record that refers becomes a revisit without payload.
    A file holds at most FILE_RECORDS records, which bounds a group.
    """

    def rewrite(rows: pd.DataFrame) -> pd.DataFrame:
        target, root = store(folder)
        name = rows["file"].iloc[0]
        refers = {int(s): int(r) for s, r in zip(rows["seq"], rows["refers_to"]) if r is not None and not pd.isna(r)}
        archive = f"members-{uuid.uuid4().hex}.warc.gz"
        places, offset = [], 0
        with target.open_input_stream(f"{root}/{name}", compression=None) as source, target.open_output_stream(
            f"{root}/{archive}", compression=None
        ) as out:
            for seq, (fields, block) in enumerate(records(inflated(source))):
                page_id, to = _page(fields["warc-record-id"]), refers.get(seq)
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                length = int(fields["x-payload-length"])
                kind = "response" if to is None else "revisit"
                zipper = zlib.compressobj(LEVEL, wbits=31)
                body = record(kind, page_id, fields["warc-target-uri"], digest, length, block if to is None else b"", to)
                member = zipper.compress(body) + zipper.flush()
                out.write(member)
                places.append((offset, len(member), page_id))
                offset += len(member)
        if len(places) != len(rows):
            raise ValueError(f"{name} has {len(places)} records, its manifest {len(rows)}")
        with target.open_output_stream(f"{root}/{archive}.idx", compression=None) as out:
            out.write("".join(json.dumps(p) + "\n" for p in places).encode())
        return pd.DataFrame({"archive": [archive], "records": [len(places)], "bytes": [offset]})

    slim = decided.select("file", "seq", F.col("refers_to").cast("string").alias("refers_to"))
    # The rows are few beside the files they stand for, so the number of tasks follows the files.
    files = decided.agg(F.approx_count_distinct("file")).first()[0]
    slim = slim.repartition(max(1, files), "file")
    return slim.groupBy("file").applyInPandas(rewrite, "archive string, records long, bytes long")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, found through the sidecar index and inflated alone: page_id, payload_bytes,
    payload_digest, record_type, refers_to, archive, offset.  Length and digest of a response come from its payload,
    those of a revisit from its header."""

    def run(batches):
        source, root = store(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with source.open_input_stream(f"{root}/{archive}.idx", compression=None) as sidecar:
                    places = [json.loads(line) for line in sidecar.read().splitlines()]
                out = []
                with source.open_input_file(f"{root}/{archive}") as file:
                    for offset, length, _ in places:
                        file.seek(offset)
                        fields, block = next(records(iter([zlib.decompress(file.read(length), 31)])))
                        kind = fields["warc-type"]
                        size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response":
                            payload = block[block.find(b"\r\n\r\n") + 4 :]
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        out.append({
                            "page_id": _page(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
                            "record_type": kind, "refers_to": _page(fields.get("warc-refers-to")), "archive": archive,
                            "offset": offset,
                        })
                yield pa.RecordBatch.from_pylist(out, RECORDS)

    return archives.select("archive").mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, "
        "offset long",
    )


RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()),
])


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages to one-stream archives, normalise them, and read the result back by its index.

    A null page is an empty payload, a null URL is written as `-`.  An empty table gives no archive and no row.  The
    one-stream files go once they are rewritten.
    """
    settle(spark)
    # With its scheme, so that driver and executors mean the same store.
    folder = Folder(spark, folder or fresh_dir(spark, "warc")).uri()
    crawled = f"{folder}/crawl"
    manifest = finish(crawl(pages, crawled), "manifest")
    archives = finish(normalise(finish(revisits(manifest), "revisits"), crawled), "archives")
    target, root = store(crawled)
    if target.get_file_info(root).type != pafs.FileType.NotFound:
        for info in target.get_file_info(pafs.FileSelector(root)):
            if info.base_name.startswith("crawl-"):
                target.delete_file(info.path)
    tasks = max(1, spark.sparkContext.defaultParallelism)
    return read(archives.repartition(tasks * 4), crawled)


ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest from p),
g as (select *, min(page_id) over (partition by payload_digest) as f from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id is distinct from f and f is not null then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id is distinct from f then f end as refers_to from g
"""
