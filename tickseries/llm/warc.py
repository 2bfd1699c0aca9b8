"""WARC archives: write records and an index first, then read selected records by coalesced byte ranges.

Of records with equal payloads one is a response and the others revisit it. Records are gzip members of their own, so a
byte range of the file is a valid archive. The writer returns offset, length, URL and digest of every record; the index is
a table in the shared folder. A reader selects rows of the index, sorts them by file and offset, joins
ranges that lie close together into one read of a bounded size, and parses what it read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickseries.llm.common import file_system, put_file, work_dir

RECORDS_PER_FILE = 20_000
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
READ_BYTES_PER_TASK = 256 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def payload_digest(payload: bytes) -> str:
    """Bare SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. Page ids travel in a header of their own, as record ids must be URIs."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Page-Id", "" if refers_to is None else str(refers_to)),
        ]
    header = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + header.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """A record as `record_bytes` wrote it. Raises if a digest does not fit what it covers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if payload_digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("a block does not fit its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and payload_digest(payload) != digest:
        raise ValueError("a payload does not fit its digest")
    number = lambda x: int(x) if x else None
    return {
        "page_id": number(fields["X-Page-Id"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": int(http.rpartition(b": ")[2]),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("X-Refers-To-Page-Id")),
        "payload": None if revisit else payload,
    }


def assign_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds digest, refers_to and revisit. Of rows with equal payloads of at least `least_bytes`, those with the largest page_id
    are responses and the others revisit it. Smaller payloads are all responses."""

    @F.pandas_udf("string")
    def digests(html: pd.Series) -> pd.Series:
        return html.map(lambda x: payload_digest((x or "").encode()))

    hashed = pages.select("page_id", "url", "html").withColumn("digest", digests("html"))
    long_enough = F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes
    last = hashed.where(long_enough).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # Only payloads that several rows have can be revisited; the other rows need not be looked up.
    shared = last.where(F.col("n") > 1).drop("n")
    revisit = long_enough & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return (
        hashed.join(shared, "digest", "left")
        .withColumn("revisit", revisit)
        .withColumn("refers_to", F.when(F.col("revisit"), F.col("last")))
        .drop("last")
    )


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) below `folder` and return the index, which is stored beside it.

    Each task writes one gzip archive at a time and begins another at `RECORDS_PER_FILE` records or `FILE_BYTES`; it holds no more than that
    and a record. A task that runs again replaces its files by the same records. A null html is an empty payload.
    """
    fs, path = file_system(folder)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, n = TaskContext.get().partitionId(), 0
        members, entries, offset = [], [], 0

        def close() -> pd.DataFrame:
            put_file(folder, f"part-{task:06d}-{n:05d}.warc.gz", members)
            return pd.DataFrame(entries, columns=[x.split()[0] for x in INDEX.split(", ")]).astype({"page_id": "Int64"})

        for batch in batches:
            for page_id, url, html, digest, refers_to, revisit in batch.itertuples(index=False):
                page_id, refers_to = (None if pd.isna(x) else int(x) for x in (page_id, refers_to))
                raw = record_bytes(page_id, url, (html or "").encode(), digest, refers_to, bool(revisit))
                members.append(gzip.compress(raw, 6, mtime=0))
                kind = "revisit" if revisit else "response"
                entries.append((f"part-{task:06d}-{n:05d}.warc.gz", offset, len(members[-1]), url, digest, page_id, kind))
                offset += len(members[-1])
                if len(members) >= RECORDS_PER_FILE or offset >= FILE_BYTES:
                    yield close()
                    n, members, entries, offset = n + 1, [], [], 0
        if members:
            yield close()

    rows = assign_revisits(pages, least_bytes).select("page_id", "url", "html", "digest", "refers_to", "revisit")
    index = rows.mapInPandas(write, INDEX)
    at = f"{folder.rstrip('/')}/index"
    index.write.parquet(at)
    return pages.sparkSession.read.schema(index.schema).parquet(at)


def read_warc(selected: DataFrame, folder: str, read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records that rows of the index name, by sorted byte ranges.

    Ranges of a file within `gap_bytes` of each other become one read, of at most about `read_bytes` unless one record is longer.
    Each read is a row of its own; the reads are dealt by the bytes to read, not by the size of the index, so
    they spread over the cluster whatever files they are in: a task per `READ_BYTES_PER_TASK`, and one per core at least.
    """
    spark = selected.sparkSession
    to_read = selected.agg(F.sum("length")).first()[0] or 0
    n_tasks = max(spark.sparkContext.defaultParallelism, math.ceil(to_read / READ_BYTES_PER_TASK))
    in_order = Window.partitionBy("file").orderBy("offset", "length")
    end = F.col("offset") + F.col("length")
    gap = F.col("offset") - F.lag(end).over(in_order)
    # A new read begins after a wide gap, and wherever the file passes a multiple of read_bytes.
    block = F.floor(F.col("offset") / read_bytes)
    fresh = gap.isNull() | (gap > gap_bytes) | (block != F.lag(block).over(in_order))
    reads = (
        selected.select("file", "offset", "length")
        .distinct()
        .withColumn("fresh", fresh.cast("int"))
        .withColumn("read", F.sum("fresh").over(in_order))
        .groupBy("file", "read")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("ranges"))
        .select("file", "read", F.col("ranges.offset").alias("offsets"), F.col("ranges.length").alias("lengths"))
        .repartition(n_tasks, "file", "read")
        .drop("read")
    )

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = file_system(folder)
        for batch in batches:
            for file, offsets, lengths in batch.itertuples(index=False):
                with fs.open_input_file(f"{path}/{file}") as archive:
                    start = int(offsets[0])
                    data = memoryview(archive.read_at(int(offsets[-1] + lengths[-1]) - start, start))
                found = [parse_record(zlib.decompress(data[o - start : o - start + n], 31)) for o, n in zip(map(int, offsets), map(int, lengths))]
                yield pd.DataFrame(found).astype({"page_id": "Int64", "refers_to": "Int64"})

    return reads.mapInPandas(fetch, _RECORD)


def warc_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages, read all archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Nulls: a null html is an empty payload, a null url an empty one; a null page_id is a response only where no row with
    its payload has an id. Rows that repeat the largest page_id of a payload are all responses. Empty tables
    give an empty result, and columns besides page_id, url and html are ignored.
    """
    folder = work_dir(pages.sparkSession, "warc")
    index = write_warc(pages, folder, least_bytes)
    return read_warc(index, folder).drop("payload", "url")
