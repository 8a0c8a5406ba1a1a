"""Operator 13: repeated lines go by probing sharded minimal perfect hashes.

A line's key is the line without white space at both ends, in lower case (A-Z); lines whose key has ``min_chars`` code
points and stands in ``min_docs`` documents are dropped from all documents but the one with the largest doc_id.

1. **Index.**  Every task reduces its documents to distinct line hashes (128 bits of BLAKE2b) with the number of
   documents and the largest doc_id, so a line that a third of all documents hold is one entry for each task, and
   sends them to shards by hash range as packed arrays.  A shard's task merges them, builds a minimal perfect hash over
   all distinct line hashes and writes one file: the hash, a 32-bit fingerprint and an 8-bit count for each slot (255
   stands for more), and the largest doc_id of the lines that reach ``min_docs``.
2. **Probe.**  Documents send their line hashes to the shards' arrays, not to other documents' lines.  A shard with
   more than its share of lines is probed by as many tasks as its share demands, each mapping only that shard's
   file, so neither a hot line nor the size of the whole index weighs on a task.  Answers are only the dropped lines.
3. **Rewrite.**  A document meets its own dropped hashes by doc_id (one row each) and its other lines are joined again.

The result is exact up to collisions of 128-bit hashes: every probed line is in the index, so its slot is its own;
the fingerprint only guards against files of another corpus and raises.

Defined results: a null or empty text is one empty line, kept; every row counts as a document, so rows that repeat a
doc_id count each, and all rows of the largest doc_id keep the line; rows with a null doc_id neither count nor lose
lines; within one document all copies of a line go or stay together; a text of any length is read whole; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm import files
from martkit.llm.common import U64, doc_text, materialise, partitions, scratch, slices
from martkit.llm.ngram_lm import map_arrays, write_arrays
from martkit.llm.perfect_hash import PerfectHash

SHARDS = 4              # shards for each shuffle partition; a task holds one at a time
HELD_LINES = 1 << 18    # distinct lines that a task holds before it merges or sends them
MOST = 255              # an 8-bit count of this much stands for more

_SPACE = b" \t\n\x0b\x0c\r"
_KEY = np.dtype([("high", "<u8"), ("low", "<u8")])


def line_hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    """Hash of every line's key; None if the key is shorter than ``min_chars`` code points."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip(_SPACE)
        n = len(key)
        if n < min_chars or (n < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
            out.append(None)
        else:
            out.append(hashlib.blake2b(key.lower(), digest_size=16).digest())
    return out


def _texts(b: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return b.column(b.schema.get_field_index(column)).cast(pa.large_string()).cast(pa.large_binary()).fill_null(
        b"").to_pylist()


def _lines(b: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, doc_ids) of the distinct keys of every document of a batch."""
    found, n = [], []
    for text in _texts(b):
        own = set(line_hashes(text, min_chars))
        own.discard(None)
        found += own
        n.append(len(own))
    ids = b.column(b.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(found), _KEY), np.repeat(ids, n)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys["high"] >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


def _merge(keys: np.ndarray, docs: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order with the sum of ``docs`` and the largest ``last``."""
    order = np.lexsort((keys["low"], keys["high"]))
    keys, docs, last = keys[order], docs[order], last[order]
    if not len(keys):
        return keys, docs, last
    new = np.append(True, keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(docs, at), np.maximum.reduceat(last, at)


_COUNTS = "shard int, n long, body binary"


def _count(shards: int, min_chars: int, held_lines: int):
    """Distinct lines of a task's documents, packed by shard: keys, documents, largest doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def send(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            keys, docs, last = part
            shard = _shard(keys, shards)  # ascends with the keys
            at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            ends = np.append(at[1:], len(keys))
            return pa.RecordBatch.from_arrays([
                pa.array(shard[at].astype(np.int32)), pa.array(ends - at),
                pa.array([keys[a:z].tobytes() + docs[a:z].tobytes() + last[a:z].tobytes()
                          for a, z in zip(at, ends, strict=True)], pa.binary())], names=["shard", "n", "body"])

        for b in slices(batches, "text"):
            keys, ids = _lines(b, min_chars)
            held.append((keys, np.ones(len(keys), np.int64), ids))
            size += len(keys)
            if size > held_lines:
                held = [_merge(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > held_lines // 2:
                    yield send(held[0])
                    held, size = [], 0
        if size:
            yield send(_merge(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return run


_INDEX = "shard int, uri string, lines long, held long"


def _write(folder: str, min_docs: int):
    """One file for each shard of a task's rows, sorted by shard."""
    def save(shard: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, docs, last = _merge(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        parts.clear()
        index = PerfectHash.build(keys["high"], keys["low"])
        slot = PerfectHash(**index).slots(keys["high"], keys["low"])
        arrays = {f"hash.{k}": v for k, v in index.items()}
        arrays["print"] = np.empty(len(keys), np.uint32)
        arrays["print"][slot] = keys["low"].astype(np.uint32)
        wide = np.empty(len(keys), np.int64)
        wide[slot] = docs
        arrays["count"] = np.minimum(wide, MOST).astype(np.uint8)
        many = np.empty(len(keys), np.int64)
        many[slot] = last
        arrays["many"] = np.flatnonzero(wide >= min_docs)
        arrays["last"] = many[arrays["many"]]
        uri = write_arrays(folder, f"lines-{shard:06d}", arrays, {"shard": shard})
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([uri]), pa.array([len(keys)]),
                                           pa.array([int(docs.sum())])], names=["shard", "uri", "lines", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = None, []
        for b in batches:
            for shard, n, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != own and parts:
                    yield save(own, parts)
                    parts = []
                own = shard
                rest = np.frombuffer(body, np.int64, offset=16 * n)
                parts.append((np.frombuffer(body, _KEY, count=n), rest[:n], rest[n:]))
        if parts:
            yield save(own, parts)

    return run


class LineIndex:
    """One mapped shard."""

    def __init__(self, uri: str):
        self.arrays, _ = map_arrays(uri)
        self.hash = PerfectHash(**{k: self.arrays[f"hash.{k}"] for k in PerfectHash.NAMES})

    def probe(self, keys: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """(whether a line stands in ``min_docs`` documents, the largest doc_id that holds it if so)."""
        slot = self.hash.slots(keys["high"], keys["low"])
        if len(slot) and (slot.min() < 0 or (self.arrays["print"][slot] != keys["low"].astype(np.uint32)).any()):
            raise ValueError("a line is not in the index of its corpus")
        often = self.arrays["count"][slot] >= min(min_docs, MOST)
        last = np.zeros(len(keys), np.int64)
        at = np.searchsorted(self.arrays["many"], slot[often])
        found = at < len(self.arrays["many"])
        found[found] = self.arrays["many"][at[found]] == slot[often][found]
        often[often] = found
        last[often] = self.arrays["last"][at[found]]
        return often, last


_PROBES = "shard int, salt int, n long, body binary"


def _ask(shards: int, min_chars: int, salts: list[int], held_lines: int):
    """Line hashes of a task's documents, packed by shard and dealt over the shard's tasks."""
    salts = np.array(salts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, turn = 0, TaskContext.get().partitionId()

        def send() -> pa.RecordBatch:
            keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            shard = _shard(keys, shards)
            order = np.lexsort((ids, shard))
            keys, ids, shard = keys[order], ids[order], shard[order]
            at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            ends = np.append(at[1:], len(keys))
            rows = []
            for a, z in zip(at.tolist(), ends.tolist(), strict=True):
                s = int(shard[a])
                # a share of more than one task is cut, so no task gets it whole
                cuts = np.linspace(a, z, int(min(salts[s], max(1, (z - a) // 64))) + 1).astype(int).tolist()
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((s, (turn + k) % int(salts[s]), hi - lo, keys[lo:hi].tobytes() + ids[lo:hi].tobytes()))
            return pa.RecordBatch.from_pylist([dict(zip(("shard", "salt", "n", "body"), r, strict=True)) for r in rows],
                                              schema=pa.schema([("shard", pa.int32()), ("salt", pa.int32()),
                                                                ("n", pa.int64()), ("body", pa.binary())]))

        for b in slices(batches, "text"):
            keys, ids = _lines(b, min_chars)
            if len(keys):
                held.append((keys, ids))
                size += len(keys)
            if size >= held_lines:
                yield send()
                size, turn = 0, turn + 1
        if size:
            yield send()

    return run


_DROPS = "doc_id long, drops binary"


def _answer(uris: dict[int, str], min_docs: int):
    """Hashes of the lines that each document loses, of rows sorted by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, index = None, None
        for b in slices(batches, "body"):
            for shard, _, n, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != own:
                    own, index = shard, LineIndex(uris[shard])
                keys = np.frombuffer(body, _KEY, count=n)
                ids = np.frombuffer(body, np.int64, offset=16 * n)
                often, last = index.probe(keys, min_docs)
                drop = often & (last != ids)
                keys, ids = keys[drop], ids[drop]
                if len(ids):  # ids ascend within a row
                    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
                    ends = np.append(at[1:], len(ids))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[at]), pa.array([keys[a:z].tobytes() for a, z in zip(at, ends, strict=True)],
                                                    pa.binary())], names=["doc_id", "drops"])

    return run


_KEPT = "doc_id long, n_lines long, n_dropped long, kept string"


def _rewrite(min_chars: int):
    """Documents without their dropped lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n_lines, n_dropped, kept = [], [], []
            for text, drops in zip(_texts(b), b.column(b.schema.get_field_index("drops")).to_pylist(), strict=True):
                gone = {d[i:i + 16] for d in drops or () for i in range(0, len(d), 16)}
                if gone:
                    lines = text.split(b"\n")
                    left = [x for x, h in zip(lines, line_hashes(text, min_chars), strict=True) if h not in gone]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                    kept.append(b"\n".join(left))
                else:
                    n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(0)
                    kept.append(text)
            yield pa.RecordBatch.from_arrays([
                b.column(b.schema.get_field_index("doc_id")), pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept"])

    return run


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, folder: str | None = None,
                        held_lines: int = HELD_LINES) -> DataFrame:
    """Per document: doc_id, n_lines (before), n_dropped and the kept text."""
    if not 1 <= min_docs <= MOST:
        raise ValueError(f"min_docs must lie in 1 to {MOST}")
    spark = docs.sparkSession
    n = partitions(spark)
    shards = SHARDS * n
    folder = folder or scratch(spark, "line-index")
    texts = doc_text(docs)
    known = texts.where("doc_id IS NOT NULL")
    counts = known.mapInArrow(_count(shards, min_chars, held_lines), _COUNTS)
    index = materialise(counts.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(
        _write(folder, min_docs), _INDEX), "line-shards").collect()  # one row for each shard
    uris = {r.shard: r.uri for r in index}
    share = max(1, sum(r.held for r in index) // max(1, len(index)))
    salts = [1] * shards
    for r in index:
        salts[r.shard] = -(-r.held // share)
    asked = known.mapInArrow(_ask(shards, min_chars, salts, held_lines), _PROBES)
    answers = asked.repartition(n, "shard", "salt").sortWithinPartitions("shard").mapInArrow(
        _answer(uris, min_docs), _DROPS)
    drops = materialise(answers.groupBy("doc_id").agg(F.collect_list("drops").alias("drops")), "line-drops")
    none = F.lit(None).cast("array<binary>").alias("drops")
    return known.join(drops, "doc_id", "left").select("doc_id", "text", "drops").unionByName(
        texts.where("doc_id IS NULL").select("doc_id", "text", none)).mapInArrow(_rewrite(min_chars), _KEPT)
