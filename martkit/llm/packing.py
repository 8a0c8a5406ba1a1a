"""Operator 4: best-fit decreasing packing with a segment tree over remaining capacities.

Documents become token ids plus an end id; only those longer than a sequence are cut, into full pieces and
one shorter rest.  Full pieces are sequences by themselves.  The others are dealt at random (a hash of the
row number) over groups of about GROUP_PIECES pieces, and each group is packed longest piece first: a segment
tree over the capacities 0..max finds the tightest open sequence that still has room in logarithmic time.
The number of groups follows the number of pieces, so a group's work and memory are bounded at any input
size; a group costs at most about one part-filled sequence more than packing all at once.

Defined results: a null or empty text is one piece holding the end id; null doc_ids are packed like others;
repeated rows are packed each; ties go to the sequence opened first; a text of any length is cut into whole pieces; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import doc_text, materialise, slices
from martkit.llm.tokens import encoder

GROUP_PIECES = 32_768


class BestFit:
    """Open bins by remaining capacity; ``place`` puts an item into the tightest bin that takes it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)  # a node is 1 while a bin below it is open
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by remaining capacity
        self.used: list[int] = []               # tokens in each bin

    def _mark(self, room: int, value: int) -> None:
        tree, i = self.tree, room + self.leaves
        tree[i] = value
        i >>= 1
        while i:
            new = tree[2 * i] | tree[2 * i + 1]
            if tree[i] == new:
                return
            tree[i] = new
            i >>= 1

    def _tightest(self, size: int) -> int:
        """Smallest remaining capacity >= size that has an open bin, or -1."""
        tree, i = self.tree, size + self.leaves
        if tree[i]:
            return size
        while i > 1:  # up to the first ancestor whose right neighbour has an open bin
            if not i & 1 and tree[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of an item of this size."""
        room = self._tightest(size)
        if room < 0:
            bin_, room = len(self.used), self.capacity
            self.used.append(0)
        else:
            bins = self.open[room]
            bin_ = bins.pop()
            if not bins:
                self._mark(room, 0)
        offset = self.used[bin_]
        self.used[bin_] += size
        left = room - size
        if left:
            self.open[left].append(bin_)
            if len(self.open[left]) == 1:
                self._mark(left, 1)
        return bin_, offset


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], dtype=np.uint32)
        for b in slices(batches, "text"):
            ids, first = enc.encode(b.column("text"))
            doc, piece, start, length, crc = [], [], [], [], []
            for i, d in enumerate(b.column("doc_id").to_pylist()):
                own = np.concatenate([ids[first[i]:first[i + 1]], end]).astype("<u4")
                for p, s in enumerate(range(0, len(own), capacity)):
                    part = own[s:s + capacity]
                    doc.append(d)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of at most ``capacity`` ids."""
    return doc_text(docs).mapInArrow(_pieces(tokenizer_path, end_id, capacity), _PIECES)


def pack(pieces: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1..capacity.

    ``pieces`` is read twice (count, then packing): pass a materialised frame.
    """
    small = pieces.where(F.col("length") < capacity)
    groups = max(1, math.ceil(small.count() / group_pieces))
    cols = pieces.columns
    # numbered by row, so rows that repeat a key, or have none, spread too
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())

    def pack_group(t: pa.Table) -> pa.Table:
        length = t.column("length").to_numpy()  # about group_pieces rows of a few integers
        fit = BestFit(capacity)
        order = np.lexsort((t.column("_row").to_numpy(), -length))
        seq, at = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for i, size in zip(order.tolist(), length[order].tolist(), strict=True):
            seq[i], at[i] = fit.place(size)
        group = t.column("_group").to_numpy().astype(np.int64)
        return t.select(cols).append_column("sequence_id", pa.array(((seq << 24) | group) * 2)).append_column(
            "offset", pa.array(at))

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    packed = numbered.where(F.col("length") < capacity).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int")
    ).groupBy("_group").applyInArrow(pack_group, f"{schema}, sequence_id long, offset long")
    # a full piece is a sequence by itself; odd numbers keep these apart from the packed ones
    alone = numbered.where(F.col("length") >= capacity).select(
        *cols, (F.col("_row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def best_fit_packing(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialise(token_pieces(docs, tokenizer_path, end_id, capacity), "pieces")
    return pack(pieces, capacity)
