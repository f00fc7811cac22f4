"""WARC files: a deterministic sharded writer and a reader.

Records are range-sorted by their id.  Each range is written to gzip files, one member per record, that are closed once they
exceed ``roll_bytes`` compressed; headers, record ids and digests are made from the records alone, so a repeated task writes
the same files again.  A file is written under a temporary name, moved to its own, and counts once the manifest names it.

Of payloads that are equal and at least ``SHARED_BYTES`` long, the one with the smallest id is written; the others refer to it.
The search for them shuffles ids and digests; payloads are shuffled once, for the range sort.

Defined results: a null payload counts as empty; a null url becomes ``urn:page:<id>``; a null id comes first, stays null, and is
never the one that is referred to unless all ids are null; repeated rows refer to the first of them; other columns are ignored; an empty table
gives a folder with an empty manifest.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm.arrow import filesystem, put_file, small_batches
from paperloom.llm.common import new_folder

SHARED_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BAD_URL = re.compile(r"[\x00-\x20\x7f]")


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}:{copy}')}>"


def make_record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, revisit: bool, copy: int, date: str
) -> bytes:
    """One uncompressed record; ``payload`` is left out of revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = _BAD_URL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, path: str | None = None, roll_bytes: int = 1 << 26, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write page_id, url, html; returns the folder of the files and their manifest."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    narrow = rows.where(F.col("size") >= SHARED_BYTES).select("page_id", "digest")
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = narrow.join(firsts, "digest").where("NOT (page_id <=> first)").select("page_id", "digest", "first").distinct()
    # What a record refers to travels as a row of its own, sorted right before it, so the payloads are shuffled once.
    none = F.lit(None)
    notes = later.select("page_id", "digest", none.cast("string").alias("url"), F.lit(-1).cast("bigint").alias("size"), "first", none.cast("string").alias("html"))
    records = rows.select("page_id", "digest", "url", "size", none.cast("bigint").alias("first"), "html").unionByName(notes)
    ordered = records.repartitionByRange("page_id", "digest").sortWithinPartitions("page_id", "digest", F.col("size") >= 0, "url")

    def write(batches):
        part = TaskContext.get().partitionId()
        members, held, seq, done, before, copy, noted = [], 0, 0, [], None, 0, None

        def roll():
            nonlocal members, held, seq
            name = f"{path}/part-{part:06d}-{seq:06d}.warc.gz"
            put_file(name, members)
            done.append((name, len(members), held))
            members, held, seq = [], 0, seq + 1

        for batch in small_batches(batches, "html", 1 << 23):
            for page, digest, url, size, first, html in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if size < 0:
                    noted = (page, digest, first)
                    continue
                copy = copy + 1 if (page, digest) == before else 0
                before = (page, digest)
                is_revisit = noted is not None and noted[:2] == before
                first = noted[2] if is_revisit else None
                if copy and not is_revisit and size >= SHARED_BYTES:
                    is_revisit, first = True, page
                body = (html or "").encode()
                if hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"payload of page {page} changed on its way")
                record = make_record(page, url, body, size, digest, first, is_revisit, copy, date)
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = deflate.compress(record) + deflate.flush()
                members.append(member)
                held += len(member)
                if held >= roll_bytes:
                    roll()
        if members:
            roll()
        if done:
            names, records_, sizes = zip(*done)
            yield pa.RecordBatch.from_pydict({"file": names, "records": records_, "bytes": sizes})

    ordered.mapInArrow(write, "file string, records bigint, bytes bigint").write.parquet(f"{path}/manifest")
    return path


def parse_records(stream):
    """(headers, block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline().strip()) :
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if "sha256:" + hashlib.sha256(block).hexdigest() != head["warc-block-digest"]:
            raise ValueError(f"block digest of {head['warc-record-id']} differs")
        yield head, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the files that the manifest names.

    page_id, url, record_type, refers_to, payload (null in revisits), payload_bytes, payload_digest (bare hex, checked
    against the payload where there is one).
    """
    manifest = spark.read.schema("file string").parquet(f"{path}/manifest")
    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]

    def pack(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def read(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, place = filesystem(file)
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in parse_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        kind = head["warc-type"]
                        if kind == "response":
                            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                                raise ValueError(f"payload of {head['warc-record-id']} differs from its header")
                        else:
                            payload = None
                        page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
                        rows.append((page and int(page), head["warc-target-uri"], kind, refers and int(refers), payload, size, digest))
                        held += len(block)
                        if held > 1 << 22:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    tasks = max(1, spark.sparkContext.defaultParallelism, manifest.rdd.getNumPartitions())
    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string"
    return manifest.repartition(tasks, "file").mapInArrow(read, schema)
