"""Web archives (WARC 1.1) of pages, deduplicated by revisit records.

Only headers are compared: payload digests are shuffled, with partial sums first, and of each group of
equal payloads the page with the largest id is the original. Pages join the groups that have more
than one member (a hot group is a skewed join key, which Spark splits) and every partition writes
its pages as archive files: originals as responses with their payload, others as revisits with fresh
headers that refer to the original. Each record is its own gzip member. A file's name holds the
attempt that wrote it, and only files of successful attempts enter the manifest, so lost executors and
repeated tasks leave no record twice.

Reading streams every file in the manifest record by record and checks payloads against their digests.
Revisits are then joined with the responses they refer to.

Files are written and read through the file system that the path names.

Defined cases: a null payload is empty. Empty payloads are compared like others, as are all of at least
``min_bytes`` bytes; smaller ones are responses. A page with a null id is archived; it can be a
revisit, never an original, and a group with null ids only is all responses. Rows that repeat the
original's id and payload are responses too. A null URL is written as ``about:blank``; control and
space characters in URLs are percent-encoded. An empty table gives no files and no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from waybill.llm.tables import keep
from waybill.llm.words import row_chunks
from waybill.session import scratch_path

FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, records long"
_RECORDS = ("record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
            "refers_to_record string, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def with_digest(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, payload_bytes) of pages (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    # the digest in hexadecimal is the same number; it is written in base 32
    return rows.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})


def originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(payload_digest, original, original_url) of payloads that several pages have."""
    heads = with_digest(pages).drop("payload").filter(F.col("payload_bytes") >= min_bytes)
    return heads.groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("original"),
        F.max_by("url", F.struct("page_id", "url")).alias("original_url"),
    ).filter("copies > 1 and original is not null").drop("copies")


def _header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def record(row: dict, date: str) -> bytes:
    """One record of a page, with the group's ``original`` if other pages have the same payload."""
    payload, page = row["payload"], row["page_id"]
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode("ascii")
    revisit = row["original"] is not None and page != row["original"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page, digest)), ("WARC-Date", date), ("WARC-Target-URI", _uri(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Page-ID", page),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(row["original"], digest) if revisit else None),
        ("WARC-Refers-To-Target-URI", _uri(row["original_url"]) if revisit else None),
        ("WARC-Refers-To-Date", date if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _header(fields, http if revisit else http + payload)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below ``path``; the stored manifest (path, records) names the files."""
    # stored, so that the join is of two plain shuffles and a hot payload can be split
    groups = keep(originals(pages, min_bytes), "originals")
    rows = with_digest(pages)
    usable = F.when(F.col("payload_bytes") >= min_bytes, F.col("payload_digest"))
    joined = rows.withColumn("key", usable).join(groups.withColumnRenamed("payload_digest", "key"), "key", "left").drop("key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        task = TaskContext.get()
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        out, name, made, written, records = None, None, 0, 0, 0
        done: list[tuple[str, int]] = []
        for whole in batches:
            for batch in row_chunks(whole, "payload"):
                for row in batch.to_pylist():
                    if out is None:
                        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{made}.warc.gz"
                        out, written, records, made = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0, made + 1
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record(row, date)) + packer.flush()
                    out.write(member)
                    written, records = written + len(member), records + 1
                    if written >= FILE_BYTES:
                        out.close()
                        done.append((name, records))
                        out = None
        if out is not None:
            out.close()
            done.append((name, records))
        yield pa.RecordBatch.from_pydict(
            {"path": [f"{path}/{n}" for n, _ in done], "records": [r for _, r in done]},
            schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    columns = ["page_id", "url", "payload_digest", "original", "original_url", "payload"]
    return keep(joined.select(*columns).mapInArrow(write, _MANIFEST), "manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one after another."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 20)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the files in a manifest, payloads checked against their digests; about a task a file."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = [f.split()[0] for f in _RECORDS.split(",")]
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with system.open_input_stream(place, compression=None) as stream:
                    for member in _members(stream):
                        fields, block = parse(member)
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        revisit = fields["warc-type"] == "revisit"
                        if not revisit and base32_sha1(payload) != digest:
                            raise ValueError(f"digest differs in {path}: {fields['warc-record-id']}")
                        page = fields.get("warc-page-id")
                        rows.append((fields["warc-record-id"], fields["warc-type"], int(page) if page is not None else None,
                                     fields["warc-target-uri"], digest, None if revisit else len(payload), fields.get("warc-refers-to"),
                                     payload if payloads and not revisit else None))
                        held += len(payload)
                        if held > 8 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # with a number of partitions, as adaptive execution would put the few rows of a manifest into one task
    files = max(1, manifest.count())
    return manifest.select("path").repartition(files, "path").mapInArrow(read, _RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """Records with revisits completed from the responses they refer to: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to (the response's page_id), payload."""
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"), F.col("payload").alias("original_payload"))
    responses = keep(responses.dropDuplicates(["refers_to_record"]), "responses")  # stored, as hot ones are split then
    whole = records.join(responses, "refers_to_record", "left")
    return whole.select("page_id", "url", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest",
                        "record_type", "refers_to", F.coalesce("payload", "original_payload").alias("payload"))


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written as archives in the shared folder and read back, revisits resolved; no payloads."""
    manifest = write_archives(pages, scratch_path(pages.sparkSession, "warc"), min_bytes)
    return resolved(keep(read_archives(manifest, payloads=False), "records")).drop("payload")
