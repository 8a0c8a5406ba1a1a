"""Operator 8: exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance d = 1 - |x and y| / |x or y| is a metric, and two documents link when d <= r.  Texts of a corpus
are mostly at distance 1 from one another and from any pivot, where triangle windows alone would copy every
document into every region; so pigeonhole cells first put together what can possibly link, and the pivots then
work inside such groups:

1. every text becomes its set of word n-grams (64-bit hashes); equal sets collapse to one representative;
2. a set's elements are dealt by hash over buckets, as many that linked sets must agree in at least ``need``
   whole buckets (``Cells``).  Sets that share fewer cells than that with all others link with nothing, and the
   commonest cells drop out (``shared_cells``).  A cell is a region around its leader: measured distances and the
   triangle inequality decide which of its sets belong to the leader's group and which stay for another leader
   (``candidate_groups``); a link never leaves a group;
3. inside a group ``voronoi`` picks pivots, links what lies within r of one, assigns every set to its nearest
   pivot's region and copies it into the regions whose pivot is at most 2r farther (triangle inequality: two
   linked sets meet in one of their regions), and joins the regions recursively; regions that are of one
   component already are done;
4. a group of more than GROUP_DOCS sets is joined by Spark in the same geometry (``_large_groups``): pivots are
   drawn from the sets that no pivot has linked yet, all sets of the group are measured against them in salted
   pieces, and of balls that stay apart the sets within 2r of the other's pivot are compared.

Only shared cells, representatives' texts and links move; no group is gathered whole beyond GROUP_DOCS sets, and no
pair is formed that is not measured for a link.  Links within a component that is already known to be connected are
not enumerated.

Defined results: null and white-space texts have an empty set and link with nothing (component_id is their own
doc_id); a text shorter than an n-gram is one n-gram; rows with a null doc_id get their n_shingles, a null
component_id and link nothing; rows that repeat a doc_id with one text are one document, and with different texts
are judged each by its own text; equal sets count as one and take the smallest doc_id; a text of any length is judged by all its
n-grams; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm.common import (U64, components, doc_text, give_back, materialise, mix64, partitions, ragged, slices,
                                word_hashes)

GROUP_DOCS = 4096        # sets of a group that one task joins
SALT_DOCS = 1024         # sets of a larger group measured together
PIVOTS = 64              # pivots of a larger group in its first round, doubled from round to round up to
MAX_PIVOTS = 1024
LEAF = 24                # sets of a region compared pair by pair
CELL_ROWS = 1 << 18      # cells held before they are sent on
SORT_CELLS = 1 << 18     # cells of a shard sorted together
NEAR = 0.8               # distance within which a cell's sets join its leader
MARGIN = 0.02            # room for measuring with 32-bit elements
ROUNDS = 6               # leaders that a cell gets

_K1, _K2 = U64(0xA24BAED4963EE407), U64(0x9FB21C651E98DF25)


def shingle_sets(col: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of every text's word n-grams and their offsets (n+1)."""
    h, first = word_hashes(col)
    n = np.diff(first)
    size = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), size)
    at = ragged(first[:-1], size)
    left = first[1:][doc] - at  # words from here to the end of the text
    key = mix64(h[at] * _K1 + U64(1)) if len(at) else np.zeros(0, U64)
    for k in range(1, words):
        inside = left > k
        key[inside] = mix64(key[inside] * _K2 + h[at[inside] + k] * _K1 + U64(k + 1))
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[keep], doc[keep]
    return key, np.searchsorted(doc, np.arange(len(n) + 1))


def set_prints(keys: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of every set."""
    out = []
    for salt in (U64(0x632BE59BD9B4E019), U64(0xE220A8397B1DCDAF)):
        run = np.zeros(len(keys) + 1, U64)
        np.cumsum(mix64(keys ^ salt), out=run[1:])
        out.append(mix64(run[offs[1:]] - run[offs[:-1]] + np.diff(offs).astype(U64) * salt))
    return out[0], out[1]


class Cells:
    """Pigeonhole cells of a similarity threshold num/den.

    Two sets with J >= t differ in at most (1-t)/(1+t) * (|x|+|y|) elements.  Sizes fall into classes so that
    linked sets lie in one class or in neighbouring ones; a class bounds the difference by its K.  Elements are
    dealt by hash over K + need + spare buckets, so linked sets agree in need + spare of them at least.  A set's
    cells are its non-empty buckets, for its own class and for the next; a set with more than ``spare`` empty
    buckets has cells for the empty ones too.  Linked sets therefore share at least ``need`` cells of one class.
    """

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the threshold must lie in (0, 1]")
        self.num, self.den = num, den
        low = [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1] + 1, low[-1] * den // num + 1))
        self.low = np.array(low, dtype=np.int64)
        top = self.low[1:] - 1
        self.k = (den - num) * 2 * top // (den + num)
        self.spare = np.where(self.k > 0, 3 + self.k // 24, 0)
        self.need = 1 + np.where(self.k > 0, self.k // 3, 0)
        self.buckets = self.k + self.need + self.spare
        # of the cells that linked sets share, so many are left when each set gives up its commonest ones
        self.kept = (self.need + 1) // 2

    def of(self, keys: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell hash, index of its set, size class) of all cells of many sets."""
        size = np.diff(offs)
        own = np.searchsorted(self.low, size, side="right") - 1
        doc = np.repeat(np.arange(len(size)), size)
        content = mix64(keys ^ _K2)
        parts = []
        for step in (0, 1):
            cls = own + step
            b = np.where(size > 0, self.buckets[cls], 0)
            base = np.cumsum(b) - b
            slot = base[doc] + (keys % b[doc].astype(U64)).astype(np.int64)
            total = np.zeros(int(b.sum()), U64)
            np.add.at(total, slot, content)
            filled = np.zeros(len(total), bool)
            filled[slot] = True
            owner = np.repeat(np.arange(len(size)), b)
            empty = b - np.bincount(owner[filled], minlength=len(size))
            keep = filled | (empty > self.spare[cls])[owner]
            number = (np.arange(len(total)) - base[owner]).astype(U64)
            cell = mix64(total + mix64((cls[owner].astype(U64) << U64(32)) + number + _K1))
            parts.append((cell[keep], owner[keep], cls[owner[keep]]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Threshold:
    """J >= num/den, J >= the bounds at distance 2r and the pruning rule, in whole numbers and safe floats."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.r = 1 - num / den

    def links(self, common: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        return (self.den * common >= self.num * (a + b - common)) & (common > 0)

    @staticmethod
    def distance(common: np.ndarray, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        return 1.0 - common / np.maximum(a + b - common, 1)


EPS = 1e-9  # room for rounding in triangle windows; links themselves are decided in whole numbers


class SetBag:
    """Sets over one dictionary of elements; counts common elements of one set with many."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, U64)
        names, code = np.unique(flat, return_inverse=True)
        self.code = code.astype(np.int64)
        self.offs = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.size)])
        self.mark = np.zeros(len(names), dtype=np.int32)

    def common(self, one: int, many: np.ndarray) -> np.ndarray:
        own = self.code[self.offs[one]:self.offs[one + 1]]
        self.mark[own] = 1
        hits = self.mark[self.code[ragged(self.offs[many], self.size[many])]]
        self.mark[own] = 0
        run = np.zeros(len(hits) + 1, np.int64)
        np.cumsum(hits, out=run[1:])
        ends = np.cumsum(self.size[many])
        return run[ends] - run[ends - self.size[many]]


class Union:
    """Union-find whose label is the smallest index."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def labels(self, members: np.ndarray) -> np.ndarray:
        return np.array([self.find(m) for m in members.tolist()], dtype=np.int64)


def voronoi(bag: SetBag, members: np.ndarray, t: Threshold, union: Union, depth: int = 0) -> None:
    """Join every link among ``members`` into ``union``: pivots, regions with windows, recursion."""
    if len(members) < 2 or len(set(union.labels(members).tolist())) == 1:
        return
    if len(members) <= LEAF:
        for k, m in enumerate(members[:-1].tolist()):
            rest = members[k + 1:]
            rest = rest[union.labels(rest) != union.find(m)]
            if len(rest):
                for other in rest[t.links(bag.common(m, rest), bag.size[m], bag.size[rest])].tolist():
                    union.join(m, other)
        return
    # pivots: spread over the components known so far, one of each first
    color = union.labels(members)
    _, firsts = np.unique(color, return_index=True)
    n = max(2, int(len(members) ** 0.5))
    spread = np.argsort(mix64(members.astype(U64) + U64(depth * 0x9E37)), kind="stable")
    pool = list(dict.fromkeys([*sorted(firsts.tolist(), key=lambda i: int(mix64(np.array([i + depth], U64))[0])),
                               *spread.tolist()]))
    pivots = members[pool[:n]]
    dist = np.empty((len(members), len(pivots)))
    for j, p in enumerate(pivots.tolist()):
        common = bag.common(p, members)
        dist[:, j] = t.distance(common, bag.size[p], bag.size[members])
        for other in members[t.links(common, bag.size[p], bag.size[members])].tolist():
            union.join(p, other)
    near = dist.min(axis=1)
    home = dist.argmin(axis=1)
    for j in range(len(pivots)):
        core = home == j
        # a window set can link with a set of this core only if it is within r of the core's reach
        window = (dist[:, j] <= near + 2 * t.r + EPS) & (dist[:, j] <= near[core].max(initial=0.0) + t.r + EPS)
        region = members[core | window]
        if len(region) < 0.75 * len(members):
            voronoi(bag, region, t, union, depth + 1)
        elif core.any():
            # the windows keep nearly everything: compare the core with the region, pruned by all pivots
            inside = np.flatnonzero(core | window)
            label = union.labels(members[inside])
            for i in np.flatnonzero(core[inside]).tolist():
                m = inside[i]
                other = np.flatnonzero(label != label[i])
                other = other[np.abs(dist[inside[other]] - dist[m]).max(axis=1, initial=0.0) <= t.r + EPS]
                if len(other):
                    rest = members[inside[other]]
                    found = other[t.links(bag.common(int(members[m]), rest), bag.size[members[m]], bag.size[rest])]
                    for x in found.tolist():
                        union.join(int(members[m]), int(members[inside[x]]))
                        label[label == label[x]] = label[i]


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_DOCS = "doc_id long, n_shingles long, fp_a long, fp_b long"


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, offs = shingle_sets(b.column("text"), words)
            fa, fb = set_prints(keys, offs)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offs)), _long(fa), _long(fb)],
                                             names=["doc_id", "n_shingles", "fp_a", "fp_b"])

    return run


_BLOB = "shard int, node binary, count binary, cls binary, cell binary"


def _cells(words: int, cells: Cells, shards: int):
    """Cells of every set, packed by shard: per set its print, number of cells, class and 32-bit cell names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def send() -> pa.RecordBatch:
            cell, node, cls = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            shard = ((cell >> U64(32)) % U64(shards)).astype(np.int32)
            order = np.lexsort((cls, node, shard))
            cell, node, cls, shard = (x[order] for x in (cell, node, cls, shard))
            new = np.ones(len(cell), bool)  # runs of one shard, set and class
            new[1:] = (shard[1:] != shard[:-1]) | (node[1:] != node[:-1]) | (cls[1:] != cls[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(cell))).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(shard[at])) + 1
            names = (cell & U64(0xFFFFFFFF)).astype(np.uint32)
            ends = np.append(at[cuts], len(cell))
            starts = np.append(0, at[cuts])
            return pa.RecordBatch.from_arrays([
                pa.array(shard[starts]),
                pa.array([x.tobytes() for x in np.split(node[at], cuts)], pa.binary()),
                pa.array([x.tobytes() for x in np.split(count, cuts)], pa.binary()),
                pa.array([x.astype(np.uint16).tobytes() for x in np.split(cls[at], cuts)], pa.binary()),
                pa.array([names[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())],
                names=["shard", "node", "count", "cls", "cell"])

        for b in slices(batches, "text"):
            keys, offs = shingle_sets(b.column("text"), words)
            if not len(keys):
                continue
            node, _ = set_prints(keys, offs)
            # equal sets of the slice count once
            _, one = np.unique(node, return_index=True)
            one = one[np.diff(offs)[one] > 0]
            size = np.diff(offs)[one]
            keys = keys[ragged(offs[one], size)]
            cell, owner, cls = cells.of(keys, np.append(0, np.cumsum(size)))
            held.append((cell, node[one][owner], cls))
            rows += len(cell)
            if rows >= CELL_ROWS:
                yield send()
                rows = 0
        if held:
            yield send()

    return run


_SHARED = "cell long, node long, cls int"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells that two sets or more have, of all shards of a partition (its size follows the input per partition).

    The packed form stays; cells are spelt out and sorted for SORT_CELLS or so at a time, by ranges of their names.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    for b in batches:
        for shard, node, count, cls, cell in zip(*(c.to_pylist() for c in b.columns), strict=True):
            n = np.frombuffer(count, np.uint32)
            parts.append((np.full(len(n), shard, np.int32), np.frombuffer(node, U64), n, np.frombuffer(cls, np.uint16),
                          np.frombuffer(cell, np.uint32)))
    give_back()
    if not parts:
        return
    of_shard, of_node, count, of_cls, names = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    runs = np.repeat(np.arange(len(count), dtype=np.uint32), count)
    bits = (len(names) // SORT_CELLS).bit_length()
    ranges = names >> np.uint32(32 - bits) if bits else np.zeros(len(names), np.uint32)
    for k in range(1 << bits):
        at = np.flatnonzero(ranges == k)
        run = runs[at]
        cell = names[at].astype(U64) | of_shard[run].astype(U64) << U64(32)
        order = np.argsort(cell, kind="stable")
        cell, run = cell[order], run[order]
        some = _twice(cell)
        cell, run = cell[some], run[some]
        node, cls = of_node[run], of_cls[run]
        order = np.lexsort((node, cell))
        cell, node, cls = cell[order], node[order], cls[order]
        keep = np.ones(len(cell), bool)  # a set once in a cell
        keep[1:] = (cell[1:] != cell[:-1]) | (node[1:] != node[:-1])
        cell, node, cls = cell[keep], node[keep], cls[keep]
        some = _twice(cell)
        cell, node, cls = cell[some], node[some], cls[some]
        for i in range(0, len(cell), 1 << 16):
            yield pa.RecordBatch.from_arrays([_long(cell[i:i + (1 << 16)]), _long(node[i:i + (1 << 16)]),
                                              pa.array(cls[i:i + (1 << 16)].astype(np.int32))],
                                             names=["cell", "node", "cls"])


def _twice(ascending: np.ndarray) -> np.ndarray:
    """Which of the sorted values occur more than once."""
    out = np.zeros(len(ascending), bool)
    same = ascending[1:] == ascending[:-1]
    out[1:] |= same
    out[:-1] |= same
    return out


def shared_cells(docs: DataFrame, words: int, cells: Cells, rounds: int = 1) -> DataFrame:
    """(cell, node, cls) of the sets that may link with another, without each set's commonest cells.

    Linked sets share ``need`` cells of one class.  So a set with fewer shared cells links with nothing, and of all
    cells in order of their size every set may give up its last ``need - kept``: linked sets still share ``kept`` of
    those that remain (prefix principle), while passages that very many texts hold drop out.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    blobs = docs.where("doc_id IS NOT NULL").mapInArrow(_cells(words, cells, n), _BLOB)
    shared = materialise(blobs.repartitionById(n, "shard").mapInArrow(_shared, _SHARED), "cells")
    for _ in range(rounds):
        shared = materialise(_enough(shared, cells.need), "cells")
    sizes = shared.groupBy("cell").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("node", "cls").orderBy(F.col("n").desc(), "cell"))
    drop = F.array(*[F.lit(int(x)) for x in cells.need - cells.kept])
    kept = shared.join(sizes, "cell").withColumn("rank", rank).where(
        F.col("rank") > F.element_at(drop, F.col("cls") + 1)).select("cell", "node", "cls")
    return materialise(_enough(materialise(kept, "cells"), cells.kept), "cells")


def _enough(shared: DataFrame, least: np.ndarray) -> DataFrame:
    """Rows of sets that have ``least`` shared cells of one class, in cells that two sets still have."""
    need = F.array(*[F.lit(int(x)) for x in least])
    able = shared.groupBy("node", "cls").agg(F.count("*").alias("n")).where(
        F.col("n") >= F.element_at(need, F.col("cls") + 1)).select("node", "cls")
    left = shared.join(able, ["node", "cls"], "left_semi")
    ends = left.groupBy("cell").agg(F.min("node").alias("lead"), F.max("node").alias("last"))
    return left.join(ends.where("lead < last").select("cell"), "cell", "left_semi")


_SETS = "node long, doc_id long, fp_a long, fp_b long, keys binary"


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, offs = shingle_sets(b.column("text"), words)
            fa, fb = (x.view(np.int64) for x in set_prints(keys, offs))
            # a repeated doc_id brings texts that are not the wanted one
            at = np.flatnonzero((b.column("fp_a").to_numpy() == fa) & (b.column("fp_b").to_numpy() == fb))
            yield pa.RecordBatch.from_arrays([
                pa.array(fa[at]), b.column("doc_id").take(pa.array(at)), pa.array(fa[at]), pa.array(fb[at]),
                pa.array([keys[offs[i]:offs[i + 1]].tobytes() for i in at.tolist()], pa.binary())],
                names=["node", "doc_id", "fp_a", "fp_b", "keys"])

    return run


def member_sets(docs: DataFrame, described: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """The set of one document for each wanted print: (node, doc_id, fp_a, fp_b, keys)."""
    reps = described.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("fp_a", "fp_b").agg(
        F.min("doc_id").alias("doc_id"))
    wanted = reps.join(nodes.select(F.col("node").alias("fp_a")), "fp_a", "left_semi")
    sets = docs.join(wanted, "doc_id").mapInArrow(_sets(words), _SETS)
    return materialise(sets.dropDuplicates(["fp_a", "fp_b"]), "sets")


_MEASURED = "lead long, node long, dist float"


def _brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, half): the sets with elements cut to 32 bits, enough to measure with."""
    for b in slices(batches, "keys"):
        half = [np.unique(np.frombuffer(x, U64).astype(np.uint32)).tobytes() for x in b.column("keys").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(half, pa.binary())], names=["node", "half"])


def _to_lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lead, salt, node or not): the leader's set, then the sets measured against it."""
    own, lead = None, np.zeros(0, np.uint32)
    for b in slices(batches, "half"):
        out: tuple[list, ...] = ([], [], [])
        for k, salt, node, half in zip(*(b.column(c).to_pylist() for c in ("lead", "salt", "node", "half")), strict=True):
            x = np.frombuffer(half, np.uint32)
            if node is None:
                own, lead = (k, salt), x
            elif own == (k, salt):
                at = np.minimum(np.searchsorted(lead, x), max(0, len(lead) - 1))
                common = int((lead[at] == x).sum()) if len(lead) else 0
                out[0].append(k)
                out[1].append(node)
                out[2].append(1.0 - common / max(1, len(x) + len(lead) - common))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.float32())], names=["lead", "node", "dist"])


def _measure_leads(pairs: DataFrame, halves: DataFrame) -> DataFrame:
    """Distance of every (node, lead) pair; a leader's nodes are dealt over pieces of SALT_DOCS."""
    spark = pairs.sparkSession
    pieces = pairs.groupBy("lead").agg(F.ceil(F.count("*") / SALT_DOCS).cast("int").alias("salts"))
    nodes = pairs.join(pieces, "lead").select(
        "lead", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), "node").join(halves, "node")
    leads = pieces.select(F.col("lead").alias("node"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
                          ).join(halves, "node").select(
        F.col("node").alias("lead"), "salt", F.lit(None).cast("long").alias("node"), "half")
    rows = leads.unionByName(nodes.select("lead", "salt", "node", "half"))
    return rows.repartition(partitions(spark), "lead", "salt").sortWithinPartitions(
        "lead", "salt", F.col("node").asc_nulls_first()).mapInArrow(_to_lead, _MEASURED)


def candidate_groups(shared: DataFrame, sets: DataFrame, cells: Cells, t: Threshold) -> DataFrame:
    """(node, label): groups of sets that a link never leaves.

    Every cell is a region around its leader (its smallest print).  Its sets are measured: those within near (NEAR, or
    r where that is more) of the leader are joined to it, those farther than near - r stay in the cell for another round.
    Two linked sets of a cell are at most r apart in their distance to the leader, so either both are near or both stay.
    A set that is left with fewer cells than linked sets share has no link left to find.

    The graph is contracted from round to round: a set is measured against a leader of another group only, edges
    connect groups, and a cell whose sets are of one group is done.  Sets of the leader's own group are measured only in
    cells that keep a far set, to see which of them may leave.
    """
    near = max(NEAR, t.r + MARGIN)
    halves = materialise(sets.select("node", "keys").mapInArrow(_brief, "node long, half binary").dropDuplicates(
        ["node"]), "halves")
    # first every set against one leader, the smallest of its cells; what that joins needs no other measuring
    leads = shared.groupBy("cell").agg(F.min("node").alias("lead"))
    one = shared.join(leads, "cell").groupBy("node").agg(F.min("lead").alias("lead")).where("node <> lead")
    first = materialise(_measure_leads(one, halves).where(F.col("dist") <= near).select("node", "lead"), "first")
    labels = components(first, "first")  # (node, label); a set without a row is its own group
    shared = _open(shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    for _ in range(ROUNDS):
        if shared.isEmpty():
            return labels
        leads = shared.groupBy("cell").agg(F.min(F.struct("node", "label")).alias("l")).select(
            "cell", F.col("l.node").alias("lead"), F.col("l.label").alias("lead_label"))
        led = materialise(shared.join(leads, "cell"), "led")
        strange = led.where("label <> lead_label").select("node", "lead").distinct()
        dist = materialise(_measure_leads(strange, halves), "dist")
        met = led.where("label <> lead_label").join(dist, ["node", "lead"])
        edges = met.where(F.col("dist") <= near).select("label", "lead_label").distinct()
        # cells that keep a set beyond the leader's reach; there its own group is measured too
        far = materialise(met.where(F.col("dist") > near - t.r - MARGIN).select("cell", "node", "cls", "label", "dist"), "far")
        held = led.join(far.where(F.col("dist") > near).select("cell").distinct(), "cell", "left_semi")
        own = materialise(held.where("label = lead_label AND node <> lead"), "own")
        kin = _measure_leads(own.select("node", "lead").distinct(), halves).where(F.col("dist") > near - t.r - MARGIN)
        stay = own.join(kin.select("node", "lead"), ["node", "lead"], "left_semi").select("cell", "node", "cls", "label")
        kept = far.join(far.where(F.col("dist") > near).select("cell").distinct(), "cell", "left_semi").select(
            "cell", "node", "cls", "label").unionByName(stay)
        labels, moved = _joined(labels, materialise(edges, "edges"))
        left = _enough(materialise(kept, "kept"), cells.kept)
        shared = _open(left.join(moved, F.col("label") == F.col("was"), "left").withColumn(
            "label", F.coalesce("now", "label")))
    if not shared.isEmpty():  # what the rounds left stays together cell by cell
        low = shared.groupBy("cell").agg(F.min("label").alias("low"))
        edges = shared.join(low, "cell").where("label <> low").select("label", "low").distinct()
        labels, _ = _joined(labels, materialise(edges, "edges"))
    return labels


def _open(shared: DataFrame) -> DataFrame:
    """(cell, node, cls, label) of the cells whose sets are not all of one group."""
    ends = shared.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return materialise(shared.join(ends.where("low < high").select("cell"), "cell", "left_semi").select(
        "cell", "node", "cls", "label"), "open")


def _joined(labels: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels after joining the groups that edges connect, (was, now) of the groups that moved)."""
    if edges.isEmpty():
        return labels, edges.sparkSession.createDataFrame([], "was long, now long")
    moved = materialise(components(edges, "groups").select(F.col("node").alias("was"), F.col("label").alias("now")), "moved")
    # groups of one set have no row in the labels yet
    lone = moved.join(labels.select(F.col("label").alias("was")).distinct(), "was", "left_anti").select(
        F.col("was").alias("node"), F.col("now").alias("label"))
    known = labels.join(moved, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label"))
    return materialise(known.unionByName(lone), "labels"), moved


_LABEL = "fp_a long, fp_b long, component_id long"


def _solve(t: Threshold):
    """Rows sorted by group: its components."""
    def solve(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[:3])
        bag, union = SetBag([np.frombuffer(r[3], U64) for r in rows]), Union(len(rows))
        voronoi(bag, np.arange(len(rows)), t, union)
        first = [rows[union.find(i)][0] for i in range(len(rows))]
        return pa.RecordBatch.from_arrays([
            pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
            pa.array(first, pa.int64())], names=["fp_a", "fp_b", "component_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = None, []
        for b in slices(batches, "keys"):
            for g, *row in zip(*(b.column(c).to_pylist() for c in ("grp", "doc_id", "fp_a", "fp_b", "keys")), strict=True):
                if g != own and rows:
                    yield solve(rows)
                    rows = []
                own = g
                rows.append(tuple(row))
        if rows:
            yield solve(rows)

    return run


_NEAR = "grp long, node long, pivot long, linked boolean"


def _measure(t: Threshold):
    """Distances of a salted piece's sets to its pivots: links, and what lies within 2r."""
    def run(sets: pa.Table, pivots: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [])
        if sets.num_rows and pivots.num_rows:
            own = [np.frombuffer(x, U64) for x in sets.column("keys").to_pylist()]
            piv = [np.frombuffer(x, U64) for x in pivots.column("keys").to_pylist()]
            bag = SetBag([*own, *piv])
            many = np.arange(len(own))
            grp, node = sets.column("grp")[0].as_py(), sets.column("node").to_numpy()
            for j, p in enumerate(pivots.column("node").to_pylist()):
                at = len(own) + j
                common = bag.common(at, many)
                linked = t.links(common, bag.size[at], bag.size[many])
                near = linked | (t.distance(common, bag.size[at], bag.size[many]) <= 2 * t.r + EPS)
                for i in np.flatnonzero(near).tolist():
                    if node[i] != p:
                        out[0].append(grp)
                        out[1].append(int(node[i]))
                        out[2].append(p)
                        out[3].append(bool(linked[i]))
        return pa.Table.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.bool_())],
                                    names=["grp", "node", "pivot", "linked"])

    return run


def _against(sets: DataFrame, pivots: DataFrame, salts: DataFrame, t: Threshold) -> DataFrame:
    """Measure all ``sets`` (grp, node, keys) against the pivots (grp, block, node, keys) of their group.

    ``salts`` (grp, salts) deals a group's sets over pieces; pivots are copied to every piece.
    """
    left = sets.join(salts, "grp").withColumn(
        "salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    blocks = pivots.select("grp", "block").distinct()
    left = left.join(blocks, "grp").select("grp", "block", "salt", "node", "keys")
    right = pivots.join(salts, "grp").select(
        F.col("grp").alias("of"), F.col("block").alias("part"),
        F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))).alias("copy"), "node", "keys")
    return left.groupBy("grp", "block", "salt").cogroup(right.groupBy("of", "part", "copy")).applyInArrow(
        _measure(t), _NEAR)


def _large_groups(sets: DataFrame, t: Threshold) -> DataFrame:
    """Components of groups too large for one task, by rounds of pivots; ``sets`` are stored."""
    salts = materialise(sets.groupBy("grp").agg(F.count("*").alias("n")).select(
        "grp", F.ceil(F.col("n") / SALT_DOCS).cast("int").alias("salts")), "salts")
    seen = []  # (grp, node, pivot, linked) of all rounds
    left = sets.select("grp", "node")
    while not left.isEmpty():
        rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("node", F.lit(len(seen))), "node"))
        chosen = left.withColumn("rank", rank).where(F.col("rank") <= min(PIVOTS << len(seen), MAX_PIVOTS)).select("grp", "node")
        chosen = materialise(sets.join(chosen, ["grp", "node"], "left_semi").select(
            "grp", F.lit(0).alias("block"), "node", "keys"), "pivots")
        near = materialise(_against(sets, chosen, salts, t), "near")
        seen.append(near)
        done = near.where("linked").select("grp", "node").unionByName(chosen.select("grp", "node")).distinct()
        left = materialise(left.join(done, ["grp", "node"], "left_anti"), "left")
    near = seen[0]
    for x in seen[1:]:
        near = near.unionByName(x)
    near = materialise(near, "near")
    links = near.where("linked").select("node", "pivot")
    color = components(links, "colors")  # balls that share a set, or whose pivots link
    # windows: sets within 2r of a pivot of another component, against that pivot's ball
    c1 = color.select("node", F.col("label").alias("mine"))
    c2 = color.select(F.col("node").alias("pivot"), F.col("label").alias("theirs"))
    window = near.where("NOT linked").join(c1, "node", "left").join(c2, "pivot", "left").withColumn(
        "mine", F.coalesce("mine", "node")).withColumn("theirs", F.coalesce("theirs", "pivot")).where("mine <> theirs")
    window = materialise(window.select("grp", "node", "pivot"), "window")
    if not window.isEmpty():
        # each window set becomes a pivot for the balls it may reach; blocks of PIVOTS bound a task's work
        order = F.row_number().over(Window.partitionBy("grp", "pivot").orderBy("node"))
        blocks = window.withColumn("block", F.floor((order - 1) / PIVOTS).cast("int"))
        pivots = blocks.join(sets.select("grp", "node", "keys"), ["grp", "node"]).select(
            F.xxhash64("grp", "pivot").alias("grp"), "block", "node", "keys")
        ball = near.where("linked").select("grp", "node", "pivot").unionByName(
            window.select("grp", F.col("pivot").alias("node"), "pivot").distinct())
        ball = ball.join(window.select("grp", "pivot").distinct(), ["grp", "pivot"], "left_semi")
        inside = ball.join(sets.select("grp", "node", "keys"), ["grp", "node"]).select(
            F.xxhash64("grp", "pivot").alias("grp"), "node", "keys")
        inside = materialise(inside, "balls")
        more = inside.groupBy("grp").agg(F.ceil(F.count("*") / SALT_DOCS).cast("int").alias("salts"))
        links = links.unionByName(_against(inside, pivots, more, t).where("linked").select("node", "pivot"))
        color = components(links, "colors")
    own = sets.select("node", "doc_id", "fp_a", "fp_b").join(color, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    first = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return own.join(first, "label").select("fp_a", "fp_b", "component_id")


def _both(*prints: str) -> Column:
    return F.xxhash64(*prints)


def _labelled(docs: DataFrame, words: int, num: int, den: int, group_docs: int) -> DataFrame:
    """doc_id, n_shingles, fp_a, fp_b (the set's print) and component_id of every row of (doc_id, text)."""
    spark = docs.sparkSession
    t, cells = Threshold(num, den), Cells(num, den)
    described = materialise(docs.mapInArrow(_describe(words), _DOCS), "described")
    shared = shared_cells(docs, words, cells)
    sets = member_sets(docs, described, shared.select("node").distinct(), words)
    groups = candidate_groups(shared, sets, cells, t)
    sizes = groups.groupBy("label").agg(F.count("*").alias("n"))
    groups = materialise(groups.join(sizes, "label"), "groups")
    grouped = sets.join(groups.select("node", F.col("label").alias("grp"), "n"), "node")
    small = grouped.where(F.col("n") <= group_docs).select("grp", "doc_id", "fp_a", "fp_b", "keys")
    solved = small.repartition(partitions(spark), "grp").sortWithinPartitions("grp", "doc_id").mapInArrow(
        _solve(t), _LABEL)
    if not groups.where(F.col("n") > group_docs).isEmpty():
        large = grouped.where(F.col("n") > group_docs).select("grp", _both("fp_a", "fp_b").alias("node"), "doc_id",
                                                              "fp_a", "fp_b", "keys")
        solved = solved.unionByName(_large_groups(materialise(large, "large-sets"), t))
    # a representative's component, then every document's by its set
    reps = described.where("n_shingles > 0").groupBy("fp_a", "fp_b").agg(F.min("doc_id").alias("rep"))
    named = materialise(reps.join(solved, ["fp_a", "fp_b"], "left").select(
        "fp_a", "fp_b", F.coalesce("component_id", "rep").alias("found")), "named")
    return described.join(named, ["fp_a", "fp_b"], "left").select(
        "doc_id", "n_shingles", "fp_a", "fp_b",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100,
                       group_docs: int = GROUP_DOCS) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id reachable by links J >= num/den."""
    return _labelled(doc_text(docs), words, num, den, group_docs).select("doc_id", "n_shingles", "component_id")


_PRINTS = ("martkit_print_a", "martkit_print_b")


def _with_prints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fa, fb = set_prints(*shingle_sets(b.column("text"), words))
            yield pa.RecordBatch.from_arrays([*b.columns, _long(fa), _long(fb)], names=[*b.schema.names, *_PRINTS])

    return run


def keep_one_of_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100,
                     group_docs: int = GROUP_DOCS) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns; rows without a doc_id stay."""
    docs = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    labels = materialise(_labelled(doc_text(docs), words, num, den, group_docs), "labels")
    keep = labels.where("doc_id = component_id").select("doc_id", "fp_a", "fp_b").distinct()
    repeated = materialise(labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where(
        "n > 1").select("doc_id"), "repeated")
    out = docs.join(keep.select("doc_id").distinct(), "doc_id", "left_semi")
    if not repeated.isEmpty():
        # rows that share a doc_id are told apart by their sets
        twice = docs.join(repeated, "doc_id", "left_semi")
        ddl = ", ".join(f"`{n}` {t}" for n, t in [*twice.dtypes, *((p, "long") for p in _PRINTS)])
        named = keep.select("doc_id", *(F.col(c).alias(p) for c, p in zip(("fp_a", "fp_b"), _PRINTS, strict=True)))
        twice = twice.mapInArrow(_with_prints(words), ddl).join(named, ["doc_id", *_PRINTS], "left_semi")
        out = out.join(repeated, "doc_id", "left_anti").unionByName(
            twice.dropDuplicates(["doc_id", *_PRINTS]).select(docs.columns))
    return out.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)
