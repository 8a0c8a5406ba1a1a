"""Operator 3: WARC archives with segmented records, written and reassembled.

Writing: each page becomes a response record (an HTTP message whose body is chunked) or, when an equal payload
of MIN_DUPLICATE bytes or more has a smaller page_id, a revisit record that names it.  Equal payloads are found
by SHA-256 and size with a pre-aggregated minimum.  A record longer than a segment is split: the first segment
stays in the task's archive, continuation records go to its continuation archive with the record's
``WARC-Segment-Origin-ID`` and their ``WARC-Segment-Number``, the last also with the total length.  Every record
is a gzip member of its own.  Archives are named for the attempt; the manifest that Spark commits says which count.

Reading: archives are parsed as streams.  Segments are dealt by origin id and sorted by segment number, so
one pass joins them; it checks that no number is missing or doubled, that the parts add up to the total length,
undoes the chunked framing and compares the payload's digest.  ``status`` is ``ok`` or says what is wrong.

Defined results: a null html is an empty payload; a null page_id is always a response and never referred to;
rows that repeat the smallest page_id of equal payloads are all responses; a null url writes no target;
a payload of any length is cut into segments; other columns are ignored; an empty table has no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from martkit.llm import files
from martkit.llm.common import materialise, partitions, scratch

MIN_DUPLICATE = 100
SEGMENT_BYTES = 16 << 10
ARCHIVE_BYTES = 256 << 20  # compressed size after which a task starts a new archive
CHUNK_BYTES = 4 << 10      # of the chunked transfer framing
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[k:k + size]), payload[k:k + size]) for k in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    """Undo chunked framing (chunk extensions and trailers are skipped); ValueError if it is damaged."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size < 0 or at + size > len(body):
            raise ValueError("chunk cut short")
        if size == 0:
            return b"".join(out)
        out.append(body[at:at + size])
        at += size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("chunk end missing")
        at += 2


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response block without its transfer framing."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no HTTP header")
    fields = dict(line.split(b":", 1) for line in head.split(b"\r\n")[1:] if b":" in line)
    coding = {k.strip().lower(): v.strip().lower() for k, v in fields.items()}.get(b"transfer-encoding", b"")
    return dechunk(body) if coding == b"chunked" else body


def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode("utf-8") + block + b"\r\n\r\n", 5, mtime=0)


def read_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of each record of a gzip-compressed archive."""
    src = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
    while True:
        line = src.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC version line")
        fields: dict[str, str] = {}
        while (line := src.readline()).strip():
            k, _, v = line.decode("utf-8").partition(":")
            fields[k.strip().lower()] = v.strip()
        block = src.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("record cut short")
        yield fields, block


def split_record(fields: list[tuple[str, str]], record_id: str, block: bytes,
                 segment: int) -> list[tuple[list[tuple[str, str]], bytes]]:
    """The record itself, or its first segment and the continuation records."""
    if len(block) <= segment:
        return [(fields, block)]
    parts = [block[k:k + segment] for k in range(0, len(block), segment)]
    out = [([*fields, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:segment:{n}>"), ("WARC-Date", DATE),
               ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append((own, part))
    return out


_MANIFEST = "uri string, records long, bytes long"


def _write(folder: str, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        done: list[tuple[str, int, int]] = []
        files_: dict[str, list] = {}  # kind: [uri, stream, records, bytes]

        def put(kind: str, data: bytes) -> None:
            f = files_.get(kind)
            if f is None:
                uri = files.new_name(folder, f"{kind}-{task:06d}", ".warc.gz")
                f = files_[kind] = [uri, files.create(uri), 0, 0]
            f[1].write(data)
            f[2] += 1
            f[3] += len(data)
            if f[3] >= ARCHIVE_BYTES:
                close(kind)

        def close(kind: str) -> None:
            uri, stream, records, size = files_.pop(kind)
            stream.close()
            done.append((uri, records, size))

        k = 0
        for b in batches:
            for page, url, payload, digest, first, alone in zip(
                    *(b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "alone")), strict=True):
                page, first, payload, digest = page.as_py(), first.as_py(), payload.as_py(), digest.as_py()
                k += 1
                # the one record that revisits name has the plain id, others get a place of their own
                record = f"urn:page:{page}" if alone.as_py() else f"urn:page:{page}:{task}:{k}"
                kind = "response" if first is None else "revisit"
                fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record}>"), ("WARC-Date", DATE),
                          ("Content-Type", "application/http;msgtype=response"),
                          ("WARC-Payload-Digest", f"sha256:{digest}")]
                if page is not None:
                    fields.append(("X-Page-Id", str(page)))
                if url.is_valid:
                    fields.append(("WARC-Target-URI", " ".join(url.as_py().split())))
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if kind == "response":
                    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
                else:
                    fields += [("WARC-Refers-To", f"<urn:page:{first}>"), ("WARC-Profile", PROFILE),
                               ("X-Payload-Length", str(len(payload)))]
                    block = head + b"\r\n"
                for n, (own, part) in enumerate(split_record(fields, record, block, segment)):
                    put("pages" if n == 0 else "continued", record_bytes(own, part))
        for kind in list(files_):
            close(kind)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()),
                                                strict=True)], names=["uri", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, segment: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages as WARC archives under ``folder``; returns the committed manifest (uri, records, bytes)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # per repeated payload its smallest page_id and in how many rows that stands
    per_page = rows.where((F.octet_length("payload") >= MIN_DUPLICATE) & F.col("page_id").isNotNull()).groupBy(
        "digest", "page_id").agg(F.count("*").alias("n"))
    first = per_page.groupBy("digest").agg(
        F.min(F.struct("page_id", "n")).alias("m"), F.sum("n").alias("rows")).where("rows > 1").select(
        F.col("digest").alias("of"), F.col("m.page_id").alias("first"), F.col("m.n").alias("times"))
    first = materialise(first, "warc-first")  # a bare scan: AQE can then split a hot digest's rows in the join
    joined = rows.join(first, (F.col("digest") == F.col("of")) & F.col("page_id").isNotNull(), "left")
    same = F.col("page_id") == F.col("first")
    records = joined.select("page_id", "url", "payload", "digest", F.when(~same, F.col("first")).alias("refers_to"),
                            F.coalesce(same & (F.col("times") == 1), F.lit(False)).alias("alone"))
    return materialise(records.mapInArrow(_write(folder, segment), _MANIFEST), "warc-manifest")


_PART = ("origin string, segment int, total long, page_id long, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, status string, block binary")
_RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "status string, segments int")


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    named = [x.split() for x in ddl.split(", ")]
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, named, strict=True)],
                                      names=[n for n, _ in named])


def payload_facts(block: bytes, digest: str | None) -> tuple[int | None, str | None, str]:
    """(bytes, sha256, status) of the payload in a complete response block."""
    try:
        payload = http_payload(block)
    except ValueError as e:
        return None, None, str(e)
    own = hashlib.sha256(payload).hexdigest()
    return len(payload), own, "ok" if digest in (None, own) else "digest differs"


def _page(urn: str | None) -> int | None:
    return int(urn.strip("<>").split(":")[2]) if urn else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for b in batches:
        for uri in b.column("uri").to_pylist():
            with files.open_stream(uri) as stream:
                for f, block in read_records(stream):
                    kind, digest = f["warc-type"], f.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    page = int(f["x-page-id"]) if "x-page-id" in f else None
                    own, number = f["warc-record-id"], f.get("warc-segment-number")
                    total = f.get("warc-segment-total-length")
                    if number is not None:
                        rows.append((f.get("warc-segment-origin-id", own), int(number), total and int(total), page,
                                     kind, _page(f.get("warc-refers-to")), None, digest, None, block))
                        size += len(block)
                    else:
                        facts = (int(f["x-payload-length"]), digest, "ok") if kind == "revisit" else payload_facts(
                            block, digest)
                        rows.append((own, 0, None, page, kind, _page(f.get("warc-refers-to")), *facts, None))
                    if len(rows) >= 2000 or size > 8 << 20:
                        yield _batch(rows, _PART)
                        rows, size = [], 0
    if rows:
        yield _batch(rows, _PART)


def join_segments(numbers: list[int], totals: list[int | None], blocks: list[bytes]) -> tuple[bytes, str]:
    """The whole block of segments sorted by number, and ``ok`` or what is wrong."""
    whole = b"".join(blocks)
    if numbers != list(range(1, len(numbers) + 1)):
        return whole, "segments missing or doubled"
    if totals[-1] is None or any(t is not None for t in totals[:-1]):
        return whole, "last segment missing"
    return whole, "ok" if len(whole) == totals[-1] else "total length differs"


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by (origin, segment); whole ones pass through."""
    held: list[dict] = []
    out: list[tuple] = []

    def finish() -> None:
        first = held[0]
        block, status = join_segments([r["segment"] for r in held], [r["total"] for r in held],
                                      [r["block"] for r in held])
        n, digest = None, None
        if status == "ok":
            n, digest, status = payload_facts(block, first["payload_digest"])
        out.append((first["page_id"], n, digest, first["record_type"], first["refers_to"], status, len(held)))
        held.clear()

    for b in batches:
        for k in range(b.num_rows):
            r = {n: b.column(i)[k].as_py() for i, n in enumerate(b.schema.names)}
            if held and held[0]["origin"] != r["origin"]:
                finish()
            if r["segment"]:
                held.append(r)
            else:
                out.append((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                            r["status"], 1))
        if out:
            yield _batch(out, _RECORD)
            out = []
    if held:
        finish()
    if out:
        yield _batch(out, _RECORD)


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read archives back: one row per record, segments reassembled, with the facts of its whole payload."""
    n = partitions(spark)
    parts = manifest.select("uri").repartition(n, "uri").mapInArrow(_parse, _PART)
    return parts.repartition(n, "origin").sortWithinPartitions("origin", "segment").mapInArrow(_reassemble, _RECORD)


def warc_roundtrip(pages: DataFrame, folder: str | None = None, segment: int = SEGMENT_BYTES) -> DataFrame:
    """Write the pages (to the shared scratch folder unless one is given) and read the archives back."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, folder or scratch(spark, "warc"), segment))
