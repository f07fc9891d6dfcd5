"""WARC archives: write with an index, read selected records back by coalesced byte ranges.

Writing: each task streams its pages into ``.warc.gz`` files of its own, every record a gzip member by itself, and returns
an index row per record (file, offset, length, url, digest). The index is a Parquet table beside the archives; an archive
file counts only if the index names it, so a lost or repeated task attempt does no harm. Which pages are revisits is
found first from digests alone; the table of repeated payloads holds one row per such payload and is joined by whatever
way its size on disk allows, so a payload that a third of the pages share is split by adaptive execution.

Reading: index rows are selected, dealt by file and stretch of offsets to as many readers as the bytes they name ask for,
sorted, and neighbours are fetched with one range read, which may also bridge a small gap.

Defined cases: null html is the empty payload; a null url is written as an empty URI and read back as null. Of equal
payloads of at least ``min_bytes`` bytes the record with the largest page id is the response; rows that repeat it whole are
responses too; a null id is never preferred, and if all ids of a payload are null all are responses. Other columns are
ignored. No pages give an empty index and no archive.
"""

from __future__ import annotations

import hashlib
import math
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm.common import as_text, slices, task_count

INDEX = "file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, record_type string"
RECORD = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
#: A file is closed when it has reached so many bytes.
FILE_BYTES = 64 << 20
#: A range read spans at most so many bytes, unless one record is longer, and bridges gaps up to ``GAP_BYTES``.
RANGE_BYTES, GAP_BYTES = 4 << 20, 64 << 10
#: Offsets of one file are dealt to readers in stretches of so many bytes, and a reader gets about ``READER_BYTES``.
STRETCH_BYTES, READER_BYTES = 4 << 20, 32 << 20
#: So many pages are held as Python values at once.
WRITE_ROWS = 256
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_storage(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file URI, in the forms that Spark and Hadoop write."""
    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").replace("//", "", 1) if uri.startswith("file://") else "file://" + uri[5:]
    elif uri.startswith("/"):
        uri = "file://" + uri
    return fs.FileSystem.from_uri(uri)


def _page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def format_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. The block is an HTTP response; of a revisit it is the head alone, which still tells the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        # control characters and blanks of the URL are escaped; "%" first, so that unquoting gives the same text back
        *([] if url is None else [f"WARC-Target-URI: {re.sub('[%\\x00-\\x20\\x7f-\\U0010ffff]', lambda m: urllib.parse.quote(m[0], safe=''), url)}"]),
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_page_uri(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of ``RECORD``; a response whose payload does not match its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": _page_id(fields["WARC-Record-ID"]), "url": None if url is None else urllib.parse.unquote(url),
        "payload": None if revisit else payload, "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": _page_id(fields["WARC-Refers-To"]) if revisit else None,
    }


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _writer(folder: str):
    schema = _arrow(INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, base = open_storage(folder)
        out, name, at = None, "", 0
        for batch in slices(batches, WRITE_ROWS):
            rows = []
            for row in batch.to_pylist():
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    storage.create_dir(base, recursive=True)
                    out = storage.open_output_stream(f"{base}/{name}", compression=None)
                payload = row["html"].encode()
                gzip = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = gzip.compress(format_record(row["page_id"], row["url"], payload, row["refers_to"], row["revisit"])) + gzip.flush()
                out.write(data)
                rows.append({
                    "file": f"{folder}/{name}", "offset": at, "length": len(data), "page_id": row["page_id"], "url": row["url"],
                    "payload_digest": hashlib.sha1(payload).hexdigest(), "record_type": "revisit" if row["revisit"] else "response"})
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(rows, schema)
        if out is not None:
            out.close()
    return write


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` below ``folder`` (shared storage) and return the index, which is kept as ``folder``/index."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), as_text(html_col).alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    repeated = rows.where(F.octet_length("html") >= min_bytes).groupBy(digest.alias("digest")).agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    repeated.where("n > 1 and refers_to is not null").select("digest", "refers_to").write.parquet(f"{folder}/repeated")
    repeated = spark.read.parquet(f"{folder}/repeated")
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= min_bytes, digest)).join(repeated, "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull(), F.lit(False))
    rows = rows.select("page_id", "url", "html", "refers_to", revisit.alias("revisit"))
    rows.mapInArrow(_writer(f"{folder}/archive"), INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def coalesce_ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first, last, offset, end) as (index of the first span, index after the last, ...) for sorted (offset, length)."""
    merged: list[list[int]] = []
    for i, (offset, length) in enumerate(spans):
        if merged:
            _, _, start, end = merged[-1]
            if offset <= end + GAP_BYTES and max(end, offset + length) - start <= RANGE_BYTES:
                merged[-1][1], merged[-1][3] = i + 1, max(end, offset + length)
                continue
        merged.append([i, i + 1, offset, offset + length])
    return [tuple(m) for m in merged]


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(RECORD)
    name, source = None, None
    for batch in batches:
        rows = sorted(zip(batch["file"].to_pylist(), batch["offset"].to_pylist(), batch["length"].to_pylist(), strict=True))
        first = 0
        while first < len(rows):
            last = first
            while last < len(rows) and rows[last][0] == rows[first][0]:
                last += 1
            if rows[first][0] != name:
                if source is not None:
                    source.close()
                name = rows[first][0]
                storage, path = open_storage(name)
                source = storage.open_input_file(path)
            spans = [r[1:] for r in rows[first:last]]
            for i, j, start, end in coalesce_ranges(spans):
                data = source.read_at(end - start, start)
                yield pa.RecordBatch.from_pylist(
                    [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in spans[i:j]], schema)
            first = last
    if source is not None:
        source.close()


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` (any selection of its rows) names."""
    spans = index.select("file", "offset", "length")
    # index rows are tiny beside what they name, so the number of readers goes by the bytes named, not by the rows' own size
    named = spans.agg(F.sum("length")).first()[0] or 0
    readers = max(task_count(index.sparkSession), math.ceil(named / READER_BYTES))
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    spans = spans.repartition(readers, "file", stretch).sortWithinPartitions("file", "offset")
    return spans.mapInArrow(_reader, RECORD)
