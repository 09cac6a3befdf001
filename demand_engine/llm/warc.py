"""WARC archives with an index: written once, read by byte ranges.

Every record is a gzip member of its own, and the index has a row per
record: file, offset, length, URL and digest. To read records, their index
rows are sorted by file and offset and dealt by byte volume; each task
joins neighbouring ranges into few reads.

Archives go to the shared folder through Arrow's file systems (local paths,
file, s3, gs, hdfs). A task writes files of names of its own and only a
finished task's index rows count, so a lost or repeated task leaves an
unnamed file and no wrong row.

Cases: a null payload is empty; payloads below ``min_revisit`` bytes are
always responses; rows that repeat the response's id and payload are
responses too; a null id is never referred to (payloads that only null ids
have are all responses); a null URL is written as urn:page; an empty table
gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import fresh_path, materialise

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a Hadoop-style path, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """The bytes of one response or revisit record. A revisit has the HTTP
    header of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse_record(data: bytes) -> dict:
    """Type, ids, URL, digest and payload of a record; raises where the
    payload's digest differs from the header's."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].partition(":")[2]
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    number = lambda x: int(fields[x]) if x in fields else None
    return {
        "page_id": number("page-id"), "record_type": kind, "refers_to": number("refers-to-page-id"), "payload_digest": digest,
        "payload_bytes": len(payload) if kind == "response" else int(_headers(http)["content-length"]), "payload": payload if kind == "response" else None,
    }


def revisits(pages: DataFrame, id_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """(its_id, its_digest, first): the pages that revisit an earlier one."""
    data = F.coalesce(pages[html_col], F.lit("")).cast("binary")
    facts = pages.select(pages[id_col].cast("long").alias("id"), F.sha2(data, 256).alias("digest"), F.length(data).alias("n"))
    facts = materialise(facts.where(F.col("n") >= min_revisit).select("id", "digest"), "digests")
    first = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    later = facts.join(first, "digest").where("id is null or id <> first")
    return later.select(F.col("id").alias("its_id"), F.col("digest").alias("its_digest"), "first").distinct()


def write_archives(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 100,
    file_bytes: int = 256 << 20, level: int = 4, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page; return the index (file, offset, length,
    page_id, url, digest, record_type, refers_to), itself a written table."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    data = F.coalesce(pages[html_col], F.lit("")).cast("binary")
    src = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), data.alias("payload"), F.sha2(data, 256).alias("digest"))
    later = revisits(pages, id_col, html_col, min_revisit)
    same = src["page_id"].eqNullSafe(later["its_id"]) & (src["digest"] == later["its_digest"])
    planned = src.join(later, same, "left").select("page_id", "url", "payload", "digest", F.col("first").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, at = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                    record = make_record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], date)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    packed = packer.compress(record) + packer.flush()
                    out.write(packed)
                    index.append((name, at, len(packed)))
                    at += len(packed)
                kind = pa.compute.if_else(pa.compute.is_null(batch.column("refers_to")), "response", "revisit")
                columns = [pa.array([x[i] for x in index], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in ("page_id", "url", "digest", "refers_to")), kind], ["file", "offset", "length", "page_id", "url", "digest", "refers_to", "record_type"])
        finally:
            if out is not None:
                out.close()

    written = planned.mapInArrow(run, "file string, offset long, length long, page_id long, url string, digest string, refers_to long, record_type string")
    return materialise(written.withColumn("file", F.concat(F.lit(f"{folder}/"), "file")), "index")


def coalesced(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[int]]]:
    """Sorted (file, offset, length) ranges joined where they are at most
    ``gap`` bytes apart and a read stays under ``most`` bytes."""
    now = None
    for i, (file, at, n) in enumerate(rows):
        if now and file == now[0] and at - now[2] <= gap and at + n - now[1] <= most:
            now[2] = max(now[2], at + n)
            now[3].append(i)
        else:
            if now:
                yield tuple(now)
            now = [file, at, at + n, [i]]
    if now:
        yield tuple(now)


def read_records(index: DataFrame, with_payload: bool = True, gap: int = 64 << 10, read_bytes: int = 8 << 20, task_bytes: int = 32 << 20) -> DataFrame:
    """The selected index rows with their records' contents."""
    total = index.agg(F.sum("length")).first()[0] or 0
    n = max(1, -(-total // task_bytes))
    dealt = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_payload
        opened: tuple = (None, None)
        try:
            for batch in batches:
                rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
                for file, start, end, members in coalesced(rows, gap, read_bytes):
                    if opened[0] != file:
                        if opened[1] is not None:
                            opened[1].close()
                        fs, path = file_system(file)
                        opened = (file, fs.open_input_file(path))
                    data = opened[1].read_at(end - start, start)
                    found = [parse_record(zlib.decompress(data[rows[i][1] - start : rows[i][1] - start + rows[i][2]], 31)) for i in members]
                    yield pa.RecordBatch.from_arrays([pa.array([r[x] for r in found], t) for x, t in zip(names, kinds, strict=True)], names)
        finally:
            if opened[1] is not None:
                opened[1].close()

    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string" + ", payload binary" * with_payload
    return dealt.mapInArrow(run, schema)
