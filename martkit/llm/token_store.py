"""Operator 1: token ids in independent zstandard frames with a trailing seek table.

A shard file holds, in ascending doc_id order,

* one zstandard frame per document: its ids, little-endian, 2 bytes each when the vocabulary has at most
  65,536 ids and 4 otherwise;
* one skippable frame with the document index: magic ``DOCI``, id width, number of documents, and each
  doc_id as a signed 64-bit integer (the minimum stands for a null doc_id);
* the seek table of the public seekable zstandard format: per frame its compressed size, its decompressed
  size and the low 32 bits of the XXH64 of its content, then the number of frames, a descriptor byte whose
  top bit says that checksums are there, and the magic number.

``TokenShard.read`` fetches the seek table from the end of the file and decompresses only the documents asked
for, checking each frame's checksum.  Shards are cut at quantiles of doc_id (only that column is read for
them), and the shuffle carries compressed frames, not texts.  A task names its file for its own attempt and
the manifest that Spark commits says which files count, so lost or repeated tasks leave no trace.

Defined results: a null or empty text has the end id only; null doc_ids come first; rows that repeat a doc_id
stay separate documents, ordered by length and checksum; a text of any length is encoded whole and is one frame; a doc_id of
-2**63 cannot be told from null and reads back as null; other columns are ignored; an empty table has no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martkit.llm import files
from martkit.llm.common import doc_text, materialise, partitions, scratch, slices
from martkit.llm.tokens import encoder

# Fixed values of the seekable zstandard format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

DOC_MAGIC = b"DOCI"
NULL_ID = -(1 << 63)
LEVEL = 3


class ShardWriter:
    """Appends frames to one shard and closes it with the document index and the seek table."""

    def __init__(self, uri: str, width: int):
        self.uri, self.width = uri, width
        self.out = files.create(uri)
        self.table = bytearray()
        self.doc_ids: list[int] = []

    def add(self, doc_id: int | None, frame: bytes, raw_size: int, checksum: int) -> None:
        self.out.write(frame)
        self.table += struct.pack("<III", len(frame), raw_size, checksum)
        self.doc_ids.append(NULL_ID if doc_id is None else doc_id)

    def close(self) -> None:
        body = DOC_MAGIC + struct.pack("<II", self.width, len(self.doc_ids)) + np.array(self.doc_ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        # the index is a frame of the file too, without content
        table = bytes(self.table) + struct.pack("<III", len(body) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        foot = struct.pack("<IBI", len(table) // 12, CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(foot)) + table + foot)
        self.out.close()


class TokenShard:
    """Random access to one shard file."""

    def __init__(self, uri: str):
        self.file = files.open_random(uri)
        size = self.file.size()
        self.file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{uri}: no seek table with checksums")
        self.file.seek(size - 9 - 12 * n - 8)
        head, length = struct.unpack("<II", self.file.read(8))
        if head != SKIPPABLE_SEEK or length != 12 * n + 9:
            raise ValueError(f"{uri}: damaged seek table")
        table = np.frombuffer(self.file.read(12 * n), dtype="<u4").reshape(n, 3)
        ends = np.cumsum(table[:, 0].astype(np.int64))
        self.offsets = np.concatenate([np.zeros(1, np.int64), ends[:-2]])[: n - 1]
        self.sizes, self.raw, self.sums = (table[:-1, k].astype(np.int64) for k in range(3))
        start = int(ends[-2]) if n > 1 else 0
        self.file.seek(start)
        body = self.file.read(int(table[-1, 0]))[8:]
        if body[:4] != DOC_MAGIC:
            raise ValueError(f"{uri}: no document index")
        self.width, docs = struct.unpack("<II", body[4:12])
        self.doc_ids = np.frombuffer(body[12:], dtype="<i8")
        if docs != n - 1 or len(self.doc_ids) != docs:
            raise ValueError(f"{uri}: index and seek table differ")
        self.lengths = self.raw // self.width
        self._zstd = zstandard.ZstdDecompressor()

    def _decode(self, k: int, frame: bytes) -> np.ndarray:
        raw = self._zstd.decompress(frame, max_output_size=int(self.raw[k])) if self.raw[k] else b""
        if len(raw) != self.raw[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"checksum of frame {k} does not hold")
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")

    def frame(self, k: int) -> np.ndarray:
        """Ids of the k-th document; reads and decompresses its frame alone."""
        self.file.seek(int(self.offsets[k]))
        return self._decode(k, self.file.read(int(self.sizes[k])))

    def read(self, doc_id: int) -> list[np.ndarray]:
        """Ids of every document with this doc_id."""
        lo, hi = np.searchsorted(self.doc_ids, doc_id, "left"), np.searchsorted(self.doc_ids, doc_id, "right")
        return [self.frame(k) for k in range(lo, hi)]

    def scan(self) -> Iterator[tuple[int, np.ndarray]]:
        """All documents in file order, in one sequential read."""
        self.file.seek(0)
        for k in range(len(self.doc_ids)):
            yield int(self.doc_ids[k]), self._decode(k, self.file.read(int(self.sizes[k])))

    def close(self) -> None:
        self.file.close()


def doc_id_bounds(docs: DataFrame, parts: int) -> list[float]:
    """At most ``parts - 1`` ascending cut points that spread doc_ids evenly (one number per shard)."""
    if parts < 2:
        return []
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).where("d IS NOT NULL").approxQuantile(
        "d", [i / parts for i in range(1, parts)], 0.1 / parts)
    return sorted(set(cuts))


_FRAME = "shard int, doc_id long, n_tokens long, raw_size long, checksum long, frame binary"


def _frames(path: str, end_id: int | None, bounds: list[float]):
    cuts = np.array(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width = 2 if max(enc.size - 1, end_id or 0) < 1 << 16 else 4
        zstd = zstandard.ZstdCompressor(level=LEVEL)
        tail = np.array([] if end_id is None else [end_id], dtype=f"<u{width}").tobytes()
        for b in slices(batches, "text"):
            ids, first = enc.encode(b.column("text"))
            ids = ids.astype(f"<u{width}")
            raws = [ids[first[i]:first[i + 1]].tobytes() + tail for i in range(b.num_rows)]
            doc = b.column("doc_id")
            known = doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            shard = np.searchsorted(cuts, known, side="right").astype(np.int32)
            shard[doc.is_null().to_numpy(zero_copy_only=False)] = 0
            yield pa.RecordBatch.from_arrays([
                pa.array(shard), doc, pa.array([len(r) // width for r in raws], pa.int64()),
                pa.array([len(r) for r in raws], pa.int64()),
                pa.array([xxhash.xxh64_intdigest(r) & 0xFFFFFFFF for r in raws], pa.int64()),
                pa.array([zstd.compress(r) for r in raws], pa.binary())],
                names=["shard", "doc_id", "n_tokens", "raw_size", "checksum", "frame"])

    return run


_MANIFEST = "shard int, uri string, n_docs long, n_tokens long, bytes long"


def _write(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, shard, tokens = None, -1, 0

        def done() -> pa.RecordBatch:
            size = sum(struct.unpack_from("<I", writer.table, k)[0] for k in range(0, len(writer.table), 12))
            writer.close()
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([writer.uri]), pa.array([len(writer.doc_ids)], pa.int64()),
                pa.array([tokens], pa.int64()), pa.array([size], pa.int64())],
                names=["shard", "uri", "n_docs", "n_tokens", "bytes"])

        for b in batches:
            for s, d, n, raw, sums, frame in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    if writer:
                        yield done()
                    shard, tokens = s, 0
                    writer = ShardWriter(files.new_name(folder, f"ids-{s:06d}", ".zst"), width)
                writer.add(d, frame, raw, sums)
                tokens += n
        if writer:
            yield done()

    return run


def write_token_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = None,
                       shards: int | None = None) -> DataFrame:
    """Encode every text and write the shard files under ``folder``; returns the committed manifest
    (shard, uri, n_docs, n_tokens, bytes), one row per file."""
    spark = docs.sparkSession
    docs = doc_text(docs)
    parts = shards or partitions(spark)
    bounds = doc_id_bounds(docs, parts)
    width = 2 if max(encoder(tokenizer_path).size - 1, end_id or 0) < 1 << 16 else 4
    frames = docs.mapInArrow(_frames(tokenizer_path, end_id, bounds), _FRAME)
    dealt = frames.repartition(parts, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens", "checksum")
    return materialise(dealt.mapInArrow(_write(folder, width), _MANIFEST), "token-manifest")


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, frame long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for shard, uri, base in zip(*(b.column(c).to_pylist() for c in ("shard", "uri", "base")), strict=True):
            file = TokenShard(uri)
            doc, n, crc = [], [], []
            for d, ids in file.scan():
                doc.append(None if d == NULL_ID else d)
                n.append(len(ids))
                crc.append(zlib.crc32(ids.tobytes()))
            file.close()
            n_ = np.array(n, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(base + np.cumsum(n_) - n_), pa.array(n_),
                pa.array(crc, pa.int64()), pa.array(np.full(len(n_), shard, dtype=np.int32)),
                pa.array(np.arange(len(n_), dtype=np.int64))],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "frame"])


def read_token_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read every shard of a manifest back: per document its place in the whole stream and its checksum."""
    based = manifest.withColumn(  # one row per file
        "base", F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    return based.fillna(0, "base").repartition(partitions(spark), "shard").mapInArrow(_read, _READ)


def token_store(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the shards (to the shared scratch folder unless one is given) and read them back."""
    spark = docs.sparkSession
    manifest = write_token_shards(docs, folder or scratch(spark, "token-shards"), tokenizer_path, end_id)
    return read_token_shards(spark, manifest)
