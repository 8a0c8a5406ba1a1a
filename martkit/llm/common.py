"""Shared helpers: scratch tables, Arrow batch slicing, white-space words and 64-bit text hashes."""

from __future__ import annotations

import ctypes
import hashlib
import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.session import checkpoint_dir

U64 = np.uint64
SLICE_BYTES = 1 << 19  # text handled at a time by the vectorised helpers

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back (cuts the lineage)."""
    path = scratch(df.sparkSession, tag)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (public domain constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


WORDS_KEPT = 1 << 19   # words whose hashes a worker keeps
WORD_BLOCK = 1 << 20   # bytes of a text split at a time
GROUP_BYTES = 4 << 20  # bytes of texts split at a time
_GAP = re.compile(rb"[\x20\x09-\x0D]")


class WordHashes(dict):
    """64-bit BLAKE2b hashes of words: nobody can plant words with equal ones.  A hit compares the word itself.

    The dict numbers the words; ``values`` has the hash of every number.
    """

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []
        self.known = np.zeros(0, U64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        number, first = self.numbered(texts)
        return self.known[number], first

    def numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of every word in ``known``, and of every text's first word (n+1)."""
        if len(self) > WORDS_KEPT:
            self.clear()
            self.known = np.zeros(0, U64)
        number, first = word_numbers(texts, self.__getitem__, np.int32)
        if self.new:
            digest = hashlib.blake2b
            more = np.frombuffer(b"".join([digest(w, digest_size=8).digest() for w in self.new]), "<u8")
            self.known, self.new = np.concatenate([self.known, more.astype(U64)]), []
        return number, first


_cache: dict[object, object] = {}  # what the operator at work keeps in this worker


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """What a worker keeps of ``key`` from task to task; a worker that goes on to another key gives up the one before."""
    if key not in _cache:
        drop_caches()
        _cache[key] = make()
    return _cache[key]


def drop_caches() -> None:
    """For tasks that keep nothing: what other operators kept in this worker goes."""
    if _cache:
        _cache.clear()
        give_back()


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets (null: no bytes)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offs, buf = col.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    if len(offs) == 0:
        offs = np.zeros(1, dtype=np.int64)
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, dtype=np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, per text, the index of its first word (n+1)."""
    word = ~_SEP[data]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = offs[(offs > 0) & (offs < len(data))]
    begin[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def blobs(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text (null: none)."""
    return col.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"").to_pylist()


def text_blocks(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into blocks of about WORD_BLOCK bytes."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + WORD_BLOCK) if len(text) > at + WORD_BLOCK else None
        end = gap.start() if gap else len(text)
        yield text[at:end] if gap or at else text
        at = end


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, block by block."""
    return (block.split() for block in text_blocks(text))


def word_numbers(texts: list[bytes], number: Callable[[bytes], int], dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """``number`` of every word of every text and, per text, the index of its first word (n+1).

    Words are split and told apart by Arrow, a group of texts at a time, so that ``number`` is asked once for each
    distinct word of a group, in the order of their first occurrences.
    """
    parts, sizes = [np.zeros(0, dtype)], [np.zeros(0, np.int64)]

    def split(group: list[bytes]) -> None:
        words = pa.compute.ascii_split_whitespace(pa.array(group, pa.large_binary()).view(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        code = coded.indices.to_numpy()
        n = words.value_lengths().to_numpy().astype(np.int64)
        if b"" in names:  # before the first gap or after the last
            at = names.index(b"")
            word = code != at
            n = np.diff(np.append(0, np.cumsum(word))[np.append(0, np.cumsum(n))])
            code = code[word]
            names[at:at + 1] = []
            code = code - (code > at)
        parts.append(np.fromiter(map(number, names), dtype, len(names))[code])
        sizes.append(n)

    group, size, pieces = [], 0, []  # pieces of every text
    for text in texts:
        k = 0
        for piece in text_blocks(text):
            group.append(piece)
            size += len(piece)
            k += 1
            if size >= GROUP_BYTES:
                split(group)
                group, size = [], 0
        pieces.append(k)
    if group:
        split(group)
    upto = np.append(0, np.cumsum(np.concatenate(sizes)))
    return np.concatenate(parts), upto[np.append(0, np.cumsum(np.array(pieces, np.int64)))]


def word_hashes(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every white-space word of every text and, per text, the index of its first word (n+1)."""
    texts = blobs(col)
    return worker_cache(WordHashes, WordHashes).of([t.lower() for t in texts] if lower else texts)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``limit`` bytes (one row at least)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(column))
        n = np.zeros(b.num_rows + 1, dtype=np.int64)
        np.cumsum(pa.compute.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False), out=n[1:])
        i = 0
        while i < b.num_rows:
            j = min(b.num_rows, max(i + 1, int(np.searchsorted(n, n[i] + limit, side="right")) - 1))
            yield b.slice(i, j - i)
            i = j
        del b, col
        give_back()


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None  # glibc has it


def give_back() -> None:
    """Freed memory goes back to the system: a worker would keep it through its later tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each (start, length), one after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - first, lengths)


def doc_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long, ``text`` as string and the named columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def range_part(value: Column, bounds: list[float]) -> Column:
    """Number of ascending ``bounds`` at or below ``value`` by binary search (null: 0)."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    cuts, top = F.array(*[F.lit(float(b)) for b in bounds]), len(bounds)
    v = value.cast("double")
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= top) & (F.get(cuts, at + s - 1) <= v), at + s).otherwise(at))


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, label): the smallest node that each node of an undirected graph reaches.

    ``edges`` has two long columns.  Every round takes the smallest label among neighbours, then the label of
    that label, so chains halve; groups are pre-aggregated before they shuffle, and each round is written.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    pairs = materialise(edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other").unionByName(
        edges.select(F.col(b).alias("node"), F.col(a).alias("other")).where("node <> other")).distinct(), tag)
    labels = materialise(pairs.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), tag)
    while True:
        known = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        near = pairs.join(known, "other").groupBy("node").agg(F.min("theirs").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"),
                                                F.least("label", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("there"))
        new = materialise(step.join(jump, "via").select("node", "was", F.least("via", "there").alias("label")), tag)
        labels = new.select("node", "label")
        if new.where("label < was").isEmpty():
            return labels
