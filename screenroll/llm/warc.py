"""WARC archives of pages: written with an index, read back by coalesced byte ranges.

Every task writes gzip members (one record each) to files of its own in the shared folder and
returns one index row per record: file, offset, length, URL and digest. The index is stored as
Parquet before anything is read, so it names exactly the files of the attempts that succeeded;
files of lost attempts are never read. Reading takes any selection of index rows, sorts it by
file and offset over many tasks, and joins neighbouring ranges into one request.

Equal payloads are found by a partial aggregate on their digest; only the digests that repeat
are joined back (broadcast behind a check of their number, else by a shuffle that splits hot
digests), and no payload is shuffled in the broadcast case.

Defined results: a NULL payload counts as empty; rows with a NULL id are always response records
and are never referred to; equal rows with the largest id are all response records; a NULL URL
leaves the header out; an empty table gives an empty index and no files; columns other than id,
URL and payload are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import posixpath
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, slices, small_or_plain, stage

FILE_BYTES = 1 << 30
GAP_BYTES, RANGE_BYTES = 64 << 10, 8 << 20
#: Bytes of records that a task reads, on average.
READ_BYTES = 32 << 20
#: Payloads from this size on are stored once; of smaller ones every record has its own.
REVISIT_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, file string, offset long, length long, payload_digest string, "
         "record_type string")
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages (page_id, url, html) with the SHA-1 of their payload and the page they revisit, if any."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    repeats = stage(
        rows.where((F.octet_length("html") >= revisit_bytes) & F.col("page_id").isNotNull())
        .groupBy("sha").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1").drop("n"), "warc-repeats")
    marked = rows.join(small_or_plain(repeats, repeats.count(), 80), "sha", "left")
    return marked.withColumn("refers_to", F.when(F.col("kept") != F.col("page_id"), F.col("kept"))).drop("kept")


def _record(page_id, url, payload: bytes, sha: str, refers_to, date: str) -> tuple[bytes, str, str]:
    """One record as a gzip member, its digest and type."""
    digest = base64.b32encode(bytes.fromhex(sha)).decode()
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    text = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(text, 4, mtime=0), digest, kind


def write_archives(pages: DataFrame, root: str, date: str = "2000-01-01T00:00:00Z",
                   revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` under ``root`` and return the stored index."""

    def run(batches):
        store, top = pafs.FileSystem.from_uri(root)
        task, out, path, at = TaskContext.get(), None, "", 0
        try:
            for batch in slices(batches, 256):
                index = []
                for page_id, url, html, sha, refers_to in zip(
                        *(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "refers_to")),
                        strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        store.create_dir(top, recursive=True)
                        path = f"{top}/part-{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, at = store.open_output_stream(path, compression=None), 0
                    member, digest, kind = _record(page_id, url, html.encode(), sha, refers_to, date)
                    out.write(member)
                    index.append((page_id, url, posixpath.basename(path), at, len(member), digest, kind))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        zip(*index, strict=True),
                        [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()],
                        strict=True)],
                    ["page_id", "url", "file", "offset", "length", "payload_digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    planned = plan_records(pages, revisit_bytes)
    return stage(planned.mapInArrow(run, INDEX), "warc-index")


def _parse(member: bytes) -> tuple[dict[bytes, bytes], bytes, bytes]:
    """Headers, HTTP head and payload of a gzip member."""
    text = zlib.decompress(member, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    http, _, payload = rest[:int(fields[b"Content-Length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def _page(urn: bytes) -> int | None:
    number = urn.removeprefix(b"<urn:page:").removesuffix(b">")
    return None if number == b"None" else int(number)


def _ranges(rows: list[tuple]):
    """Groups of index rows (file, offset, length) to be read with one request each."""
    group: list[tuple] = []
    for row in rows:
        if group:
            file, start, end = group[0][0], group[0][1], group[-1][1] + group[-1][2]
            if row[0] != file or row[1] - end > GAP_BYTES or row[1] + row[2] - start > RANGE_BYTES:
                yield group
                group = []
        group.append(row)
    if group:
        yield group


def read_records(index: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows: id, size, digest, type, referred page, payload (html).

    Size and digest are those of the full payload; a response's are taken from the bytes read, and a
    digest other than the header's fails the job.
    """

    def run(batches):
        store, top = pafs.FileSystem.from_uri(root)
        for batch in slices(batches, 256):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            out = []
            for group in _ranges(rows):
                start, end = group[0][1], group[-1][1] + group[-1][2]
                with store.open_input_file(f"{top}/{group[0][0]}") as source:
                    data = source.read_at(end - start, start)
                for _, offset, length in group:
                    fields, http, payload = _parse(data[offset - start:offset - start + length])
                    kind, digest = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"][5:].decode()
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response":
                        size = len(payload)
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"damaged record at {group[0][0]}:{offset}")
                    refers = _page(fields[b"WARC-Refers-To"]) if kind == "revisit" else None
                    row = (_page(fields[b"WARC-Record-ID"]), size, digest, kind, refers)
                    out.append((*row, payload.decode() if kind == "response" else None) if payloads else row)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
            n = len(names) - (not payloads)
            columns = list(zip(*out, strict=True)) or [()] * n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds[:n], strict=True)], names[:n])

    located = index.select("file", "offset", "length")
    # The index is small beside its records, so tasks are counted by the bytes to read, not by those of the index.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, math.ceil(total / READ_BYTES))
    sorted_rows = located.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return sorted_rows.mapInArrow(run, RECORD + (", html string" if payloads else ""))


def report(pages: DataFrame) -> DataFrame:
    """Write the pages, read every record back, one row per page."""
    root = new_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, root), root, payloads=False)


def warc_sql(revisit_bytes: int = REVISIT_BYTES) -> str:
    """The same rows as a DuckDB statement."""
    return f"""
      with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
      m as (select *, max(page_id) over (partition by hex) as kept from p)
      select page_id, cast(strlen(html) as bigint) as payload_bytes,
        array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + cast(
          (cast('0x' || substr(hex, (i // 4) * 5 + 1, 5) as bigint) >> cast(15 - 5 * (i % 4) as int)) & 31 as int)]), '')
          as payload_digest,
        case when page_id is null or page_id = kept or strlen(html) < {revisit_bytes} then 'response'
          else 'revisit' end as record_type,
        case when page_id != kept and strlen(html) >= {revisit_bytes} then kept end as refers_to
      from m"""
