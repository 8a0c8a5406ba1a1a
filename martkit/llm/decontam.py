"""Operator 5: benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised alike (lower case, runs of other characters than letters and digits become one
space).  An item of m characters may occur with k = m * error_rate edits, rounded down.  It is split into k + 1 pieces
of nearly equal length; k edits touch at most k of them, so every occurrence holds one piece unchanged, at most k
places from where it belongs.  An Aho-Corasick automaton over the pieces of all items finds the exact hits in one pass
over a text.  Hits are verified upwards: of two neighbouring groups of p and q pieces that hold p + q - 1 edits
together, one holds fewer edits than pieces, so a true hit's groups of two, four, ... pieces must each be found with
fewer edits than pieces; chance hits end at the first small group.  What remains is verified whole, over joined windows.
All verification is Myers' bit-parallel distance (one bit for each character, in an integer of that width).  The
best match of each item is reported.

Benchmark items go to the tasks in blocks of at most BLOCK_CHARS characters, each block a scan of its own, so what a
task holds is bounded however many items there are.

Defined results: null and empty texts match nothing; null items, and items without letters or digits, are left out;
an item too short for an edit (k = 0) must occur as whole words; repeated documents are matched each, repeated items
too; of equally good matches the first counts; a text of any length is searched whole; other columns are ignored; an empty
benchmark matches nothing, and an empty table of documents gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import doc_text, drop_caches, slices

ERROR_RATE = 0.1
BLOCK_CHARS = 1 << 20

_OTHER = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The k + 1 pieces of an item with their offsets."""
    n = k + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(cuts[i], item[cuts[i]:cuts[i + 1]]) for i in range(n)]


class Myers:
    """Approximate search of a pattern: smallest edit distance of the pattern to any substring of a text."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.eq: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.eq[c] = self.eq.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end): the first end of a substring with the smallest distance."""
        ones, top = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, score = ones, 0, self.m
        low, end = self.m, 0
        get = self.eq.get
        for j, c in enumerate(text, 1):
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & ones
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score < low:
                    low, end = score, j
            ph <<= 1
            mh <<= 1
            pv = (mh | ~(xv | ph)) & ones
            mv = ph & xv & ones
        return low, end


class Matcher:
    """Items of one block, ready to be searched in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = items
        self.budget = [int(len(t) * error_rate) for _, t in items]
        self.myers: dict[tuple[int, int, int], Myers] = {}
        holders: dict[str, list[tuple[int, int, tuple]]] = {}
        for i, (_, text) in enumerate(items):
            parts = pieces(text, self.budget[i])
            paths = self._paths(len(parts))
            cuts = [offset for offset, _ in parts] + [len(text)]
            for (offset, piece), path in zip(parts, paths, strict=True):
                holders.setdefault(piece, []).append(
                    (i, offset, tuple((cuts[a], cuts[z], z - a - 1) for a, z in path)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in holders.items():
            self.automaton.add_word(piece, (len(piece), where))
        if holders:
            self.automaton.make_automaton()
        self.empty = not holders

    @staticmethod
    def _paths(n: int) -> list[list[tuple[int, int]]]:
        """For each of n pieces its groups [a, z) of two pieces or more, smallest first, without the whole."""
        out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        todo = [(0, n)]
        while todo:
            a, z = todo.pop()
            if z - a < 2:
                continue
            if z - a < n:
                for j in range(a, z):
                    out[j].insert(0, (a, z))
            todo += [(a, (a + z) // 2), ((a + z) // 2, z)]
        return out

    def _distance(self, i: int, a: int, z: int, window: str) -> tuple[int, int]:
        key = (i, a, z)
        if key not in self.myers:
            self.myers[key] = Myers(self.items[i][1][a:z])
        return self.myers[key].best(window)

    def _holds(self, text: str, i: int, begin: int, path: tuple) -> bool:
        """Whether every group of a hit's path occurs with fewer edits than pieces; ``begin``: where the item would."""
        for a, z, edits in path:
            lo = begin + a - edits
            if self._distance(i, a, z, text[max(0, lo):begin + z + edits])[0] > edits:
                return False
        return True

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best match of every item within its budget; ``text`` is normalised."""
        if self.empty:
            return []
        places: dict[int, list[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            start = last - size + 1
            for i, offset, path in where:
                begin = start - offset
                seen = places.get(i)
                if seen is not None and seen[-1] == begin:
                    continue
                if self._holds(text, i, begin, path):
                    places.setdefault(i, []).append(begin)
        out = []
        for i, begins in places.items():
            item_id, item = self.items[i]
            k, m = self.budget[i], len(item)
            whole = next((b for b in begins if b >= 0 and text.startswith(item, b) and (
                k > 0 or self._whole(text, b, b + m))), None)
            if whole is not None:
                out.append((item_id, 0, whole, whole + m))
                continue
            if k == 0:
                continue
            low, at = k + 1, None
            for lo, hi in self._windows(sorted(set(begins)), k, m, len(text)):
                distance, end = self._distance(i, 0, m, text[lo:hi])
                if distance < low:
                    low, at = distance, lo + end
            if at is not None:
                # the match's start: the same search backwards from its end
                back = Myers(item[::-1]).best(text[max(0, at - m - k):at][::-1])[1]
                out.append((item_id, low, at - back, at))
        return out

    @staticmethod
    def _whole(text: str, start: int, end: int) -> bool:
        return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")

    @staticmethod
    def _windows(begins: list[int], k: int, m: int, size: int) -> Iterator[tuple[int, int]]:
        """Joined ranges of the text that can hold an occurrence beginning within k of one of ``begins``."""
        lo = hi = None
        for b in begins:
            a, z = max(0, b - k), min(size, b + m + k)
            if hi is not None and a <= hi:
                hi = max(hi, z)
                continue
            if hi is not None:
                yield lo, hi
            lo, hi = a, z
        if hi is not None:
            yield lo, hi


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of at most ``limit`` characters (one item at least)."""
    held: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    for item_id, text in rows.toLocalIterator():
        item = normalise(text)
        if not item:
            continue
        if held and size + len(item) > limit:
            yield held
            held, size = [], 0
        held.append((item_id, item))
        size += len(item)
    if held:
        yield held


_MATCH = "doc_id long, item_id long, distance int, start long, end long"


def _match(items: list[tuple[int, str]], error_rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        matcher = Matcher(items, error_rate)
        for b in slices(batches, "text"):
            rows = [(d, *found) for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                                                   strict=True) if text for found in matcher.find(normalise(text))]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "item_id", "distance", "start", "end"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item that it holds: doc_id, item_id, distance, start and end (in the
    normalised text)."""
    spark = docs.sparkSession
    texts = doc_text(docs)
    parts = [texts.mapInArrow(_match(items, error_rate), _MATCH) for items in blocks(benchmark, block_chars)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _MATCH)


def _clean(items: list[tuple[int, str]], error_rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        matcher = Matcher(items, error_rate)
        for b in slices(batches, "text"):
            yield b.filter(pa.array([not (t and matcher.find(normalise(t))) for t in b.column("text").to_pylist()]))

    return run


def remove_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no benchmark item, unchanged."""
    out = docs.withColumn("text", F.col("text").cast("string"))
    for items in blocks(benchmark, block_chars):
        out = out.mapInArrow(_clean(items, error_rate), out.schema)
    return out
