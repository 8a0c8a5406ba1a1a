"""Operator 12: phrase collocations mined by partitions (Savasere, Omiecinski and Navathe's two-scan method).

Per language, phrases of 2 to ``longest`` words with ``support`` occurrences or more inside pieces of text are found
exactly, scored at their weakest cut and ranked.

1. **Words.**  Exact counts of all words, pre-aggregated in the tasks; a phrase can only be frequent if all its words are.
2. **Mining.**  A shard is what a task gathers of one language, up to SHARD_BYTES of text.  It is mined completely, level by
   level, at the support times its share of the language's bytes, rounded up: what is frequent in the corpus is frequent
   in one shard at least.  A phrase that a shard does not report occurs there fewer times than its local support, so the
   reported counts and these gaps bound the phrase's count from above; the union of the shards' phrases that can reach the
   support holds every frequent phrase and all parts of each.  Shards a little smaller than two supports' share leave
   the smallest gaps.  Up to here phrases are packed arrays of 40-bit hashes, three or four bytes each; phrases that share
   a hash only make each other candidates.
3. **Counting.**  A second scan counts the candidates in all texts.  Tasks know them by a bit filter of a fixed greatest
   size (FILTER_BITS), so what a task loads does not grow with the corpus; what the filter lets through besides is counted
   as exactly and falls to the support.  Only counts pre-aggregated in the tasks are shuffled.
4. **Scores.**  Joins of the counted phrases with their parts, on whole numbers of 38 digits.

With more text than ``support`` shards the local support is 1 and mining packs all phrases of frequent words of a shard; the
gaps are then 0, the bounds are the counts themselves, and the candidates are the frequent phrases.

Defined results: a null or empty text has no words; a null lang is ``und``, one group with texts of that lang; rows with a
null or repeated doc_id count like others; ties in rank go to the greater a, then to the phrase in UTF-8 byte order;
languages without candidates have no rows; texts of any length are read whole, block by block; other columns are
ignored; an empty table gives an empty result.  A phrase is told from others by its words, never by a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.llm import files
from martkit.llm.common import U64, materialise, mix64, partitions, scratch, slices
from martkit.llm.ngram_lm import Packed, count

SUPPORT = 100
LONGEST = 5
TOP = 2000
NO_LANG = "und"
SHARD_BYTES = 10 << 20   # text of a shard that is mined or counted
HELD_BYTES = 24 << 20    # text that a task holds, of all languages
BLOCK_BYTES = 1 << 20    # text tokenised at a time
FILTER_BITS = 27         # the filter has 2**27 bits (16 MB) at most
PAGE_BITS = 21
PROBES = 4
SHORT_BITS = 40          # of a phrase's hash, until it is counted
DEALS = 4                # parts of the mined hashes for each shuffle partition

_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] += 32
_TABLE[0x09] = 0x20
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 0x0A
_TABLE = bytes(_TABLE)

_K1, _K2 = U64(0xA24BAED4963EE407), U64(0x9FB21C651E98DF25)
_BREAK, _NOTHING = -1, -2


class _Codes(dict):
    """Numbers of words in the order they are met; an end of piece is _BREAK."""

    def __init__(self):
        super().__init__({b"": _NOTHING, b"\n": _BREAK})
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words)
        self.words.append(word)
        return code


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place of every distinct key, which of them each key is, how often each occurs)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])
    starts = np.flatnonzero(new)
    which = np.empty(len(keys), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[starts], which, np.diff(np.append(starts, len(keys)))


class Shard:
    """Texts of one language: ``codes`` of their words with breaks between pieces, ``words`` by code."""

    def __init__(self, lang: str, texts: list[bytes]):
        known = _Codes()
        parts = []
        for text in texts:
            text, at = text.translate(_TABLE), 0
            while at < len(text):
                end = at + BLOCK_BYTES
                if end < len(text):
                    cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
                    if cut < at:  # a word longer than a block
                        cuts = [x for x in (text.find(b" ", end), text.find(b"\n", end)) if x >= 0]
                        cut = min(cuts, default=len(text) - 1)
                    end = cut + 1
                found = text[at:end].replace(b"\n", b" \n ").split(b" ")
                codes = np.fromiter(map(known.__getitem__, found), np.int32, len(found))
                parts.append(codes[codes != _NOTHING])
                at = end
            parts.append(np.array([_BREAK], np.int32))
        self.codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.words = known.words
        # words of one spelling differ by language
        salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        digest = hashlib.blake2b
        flat = b"".join([digest(w, digest_size=8).digest() for w in self.words])
        self.hashes = mix64(np.frombuffer(flat, "<u8") ^ U64(salt))

    def counts(self) -> np.ndarray:
        return np.bincount(self.codes[self.codes >= 0], minlength=len(self.words))

    def phrase(self, at: int, k: int) -> bytes:
        return b" ".join([self.words[c] for c in self.codes[at:at + k].tolist()])

    def levels(self, known: np.ndarray, longest: int, keep: Callable, fits: Callable | None = None
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Level by level (length, first places, counts, hashes) of the distinct phrases that ``keep(counts)`` wants.

        Both phrases of one word less inside a phrase must have been wanted.  ``known`` says which words are;
        ``fits(hashes)`` tells beforehand which places are worth counting.
        """
        codes = self.codes
        word = codes >= 0
        word[word] = known[codes[word]]
        at = np.flatnonzero(word).astype(np.int32)
        ids, hashes = codes[at], self.hashes[codes[at]]
        alive = np.zeros(len(codes) + 1, bool)
        for k in range(2, longest + 1):
            alive[:] = False
            alive[at] = True
            both = alive[at + 1]
            at, ids, hashes = at[both], ids[both], hashes[both]
            last = codes[at + k - 1]
            hashes = mix64(hashes * _K2 + self.hashes[last] * _K1 + U64(k))
            if fits is not None:
                some = fits(hashes)
                at, ids, hashes, last = at[some], ids[some], hashes[some], last[some]
            if not len(at):
                return
            first, ids, n = _groups(ids.astype(np.int64) * len(self.words) + last)
            wanted = keep(n)
            if wanted.any():
                yield k, at[first[wanted]], n[wanted], hashes[first[wanted]]
            some = wanted[ids]
            at, ids, hashes = at[some], ids[some], hashes[some]


class Filter:
    """Bits of hashes; what was put in is always found, other hashes seldom."""

    def __init__(self, bits: int, pages: list[tuple[int, str]]):
        self.bits = bits
        self.data = np.zeros(1 << (bits - 3), np.uint8)
        size = 1 << (PAGE_BITS - 3)
        for page, uri in pages:
            self.data[page * size:(page + 1) * size] = files.map_file(uri)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        step = mix64(hashes) | U64(1)
        for i in range(PROBES):
            yield ((hashes + U64(i) * step) >> U64(64 - bits)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.places(hashes, self.bits):
            out &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def build_filter(hashes: DataFrame, bits: int, folder: str) -> list[tuple[int, str]]:
    """Pages of the filter of all values of column ``h``, as files; at most 2**(bits - PAGE_BITS) rows return."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy().view(U64)
            at = np.unique(np.concatenate(list(Filter.places(h, bits)))) if len(h) else np.zeros(0, np.int64)
            if len(at):
                page = at >> PAGE_BITS
                first = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
                offs = (at & ((1 << PAGE_BITS) - 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(page[first].astype(np.int32)),
                    pa.array([x.tobytes() for x in np.split(offs, first[1:])], pa.binary())], names=["page", "offs"])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, page = None, np.zeros(0, np.uint8)

        def flush() -> pa.RecordBatch:
            uri = files.new_name(folder, f"filter-{own:04d}", ".bits")
            with files.create(uri) as out:
                out.write(np.packbits(page, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([uri])], names=["page", "uri"])

        for b in batches:
            for k, offs in zip(b.column("page").to_pylist(), b.column("offs").to_pylist(), strict=True):
                if k != own:
                    if own is not None:
                        yield flush()
                    own, page = k, np.zeros(1 << PAGE_BITS, np.uint8)
                page[np.frombuffer(offs, np.int32)] = 1
        if own is not None:
            yield flush()

    n = partitions(hashes.sparkSession)
    pages = materialise(hashes.select("h").mapInArrow(deal, "page int, offs binary").repartition(n, "page")
                        .sortWithinPartitions("page").mapInArrow(save, "page int, uri string"), "filter-pages")
    return sorted((r.page, r.uri) for r in pages.collect())


def filter_bits(n: int) -> int:
    return min(FILTER_BITS, max(PAGE_BITS, (16 * n).bit_length()))


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int, pieces: int = 1
            ) -> Iterator[tuple[str, int, int, Shard]]:
    """(lang, bytes, bytes of the lang in all texts, shard) of a task's rows (lang, total, text).

    A shard has ``shard_bytes`` of a language, or as much as makes ``pieces`` shards of all its texts if that is less.
    """
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    totals: dict[str, int] = {}

    def flush(lang: str) -> tuple[str, int, int, Shard]:
        return lang, sizes.pop(lang), totals[lang], Shard(lang, held.pop(lang))

    for b in slices(batches, "text"):
        texts = b.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
        for lang, total, text in zip(b.column("lang").to_pylist(), b.column("total").to_pylist(), texts, strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            totals[lang] = total
            if sizes[lang] >= min(shard_bytes, total // pieces + 1):
                yield flush(lang)
        while sum(sizes.values()) >= HELD_BYTES:
            yield flush(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


_COUNTED = "lang string, k int, phrase string, n long, h long"


def _rows(lang: str, k: int, phrases: list[bytes], n: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(phrases), pa.string()), pa.array(np.full(len(phrases), k, np.int32)),
        pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64)),
        pa.array(hashes.view(np.int64))], names=["lang", "k", "phrase", "n", "h"])


_BATCH = 1 << 15


def _emit(lang: str, k: int, shard: Shard, at: np.ndarray, n: np.ndarray, hashes: np.ndarray
          ) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(at), _BATCH):
        z = i + _BATCH
        yield _rows(lang, k, [shard.phrase(p, k) for p in at[i:z].tolist()], n[i:z], hashes[i:z])


def _count_words(shard_bytes: int):
    """Words of a task's shards; the row of length 0 has the number of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, _, shard in _shards(batches, max(shard_bytes, HELD_BYTES)):
            n = shard.counts()
            yield _rows(lang, 0, [b""], np.array([n.sum()]), np.zeros(1, U64))
            for i in range(0, len(n), _BATCH):
                yield _rows(lang, 1, shard.words[i:i + _BATCH], n[i:i + _BATCH], shard.hashes[i:i + _BATCH])

    return run


_MINED = "lang string, shard int, n long, body binary"


def _short(hashes: np.ndarray) -> np.ndarray:
    """Phrase hashes as mined phrases are told by until they are counted: phrases that share one become candidates together."""
    return hashes >> U64(64 - SHORT_BITS)


def _mine(support: int, longest: int, words: tuple, shard_bytes: int, deals: int):
    """Phrases that are frequent in a shard of a task, packed by a part of their hash, with what they have over the gap
    (the greatest count that a phrase may have unreported).  A row of part -1 has the gap itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for lang, size, total, shard in _shards(batches, shard_bytes, support // 2 + 1):
            known = known or Filter(*words)
            gap = max(1, -(-support * size // max(1, total))) - 1
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([-1], pa.int32()), pa.array([gap], pa.int64()),
                                              pa.array([b""])], names=["lang", "shard", "n", "body"])
            held = Packed(lambda k: (k % U64(deals)).astype(np.int64))
            for _, _, n, hashes in shard.levels(known.has(shard.hashes), longest, lambda n, t=gap: n > t):
                held.parts.append((*count(_short(hashes), n - gap)[:2], None))
                held.rows += len(n)
            for b in held.send():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * b.num_rows, pa.string()), *b.columns],
                                                 names=["lang", "shard", "n", "body"])

    return run


def _reach(support: int):
    """Hashes of the phrases that can reach the support, of rows sorted by part and language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, gaps = None, [], 0

        def able() -> pa.RecordBatch:
            keys, over, _ = count(np.concatenate([k for k, _, _ in parts]), np.concatenate([n for _, n, _ in parts]))
            return pa.RecordBatch.from_arrays([pa.array(mix64(keys[over + gaps >= support]).view(np.int64))], names=["h"])

        for b in batches:
            for shard, lang, g, n, body in zip(*(b.column(c).to_pylist() for c in ("shard", "lang", "gaps", "n", "body")),
                                               strict=True):
                if (shard, lang) != own and parts:
                    yield able()
                    parts = []
                own, gaps = (shard, lang), g
                parts.append(Packed.read(n, body))
        if parts:
            yield able()

    return run


def _count_phrases(longest: int, words: tuple, phrases: tuple, shard_bytes: int):
    """Occurrences of all candidates in a task's shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted = None
        for lang, _, _, shard in _shards(batches, shard_bytes):
            known, wanted = known or Filter(*words), wanted or Filter(*phrases)
            for k, at, n, hashes in shard.levels(known.has(shard.hashes), longest, lambda n: n > 0,
                                                   lambda h: wanted.has(mix64(_short(h)))):
                yield from _emit(lang, k, shard, at, n, hashes)

    return run


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, folder: str | None = None,
                     shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, k, phrase, n) of all phrases of 1 to ``longest`` words with ``support`` occurrences; k = 0: all words."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "phrases")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    totals = materialise(texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("total")), "lang-bytes")
    size = totals.agg(F.sum("total")).first()[0] or 0
    # small inputs in many partitions are read by fewer tasks, as the local support follows the shard's share
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    rows = texts.join(totals, "lang").select("lang", "total", "text").coalesce(int(tasks))

    def total(df: DataFrame) -> DataFrame:
        return df.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"), F.first("h").alias("h")).where(
            (F.col("n") >= support) | (F.col("k") == 0))

    words = materialise(total(rows.mapInArrow(_count_words(shard_bytes), _COUNTED)), "words")
    single = words.where("k = 1")
    bits = filter_bits(single.count())
    known = (bits, build_filter(single, bits, folder))
    parts = DEALS * partitions(spark)
    mined = materialise(rows.mapInArrow(_mine(support, longest, known, shard_bytes, parts), _MINED), "mined")
    gaps = mined.where("shard = -1").groupBy("lang").agg(F.sum("n").alias("gaps"))
    dealt = mined.where("shard >= 0").join(gaps, "lang").repartition(partitions(spark), "shard")
    candidates = materialise(dealt.sortWithinPartitions("shard", "lang").mapInArrow(_reach(support), "h long"), "candidates")
    bits = filter_bits(candidates.count())
    wanted = (bits, build_filter(candidates, bits, folder))
    counted = materialise(total(rows.mapInArrow(_count_phrases(longest, known, wanted, shard_bytes), _COUNTED)), "phrases")
    return words.unionByName(counted).select("lang", "k", "phrase", "n")


def _part(first: str, size: str) -> Column:
    return F.expr(f"array_join(slice(ws, {first}, {size}), ' ')")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int | None = TOP,
                 folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each lang's ranked phrases: lang, rank, phrase, a, l, r, n, score (``top``: so many a lang, None for all)."""
    found = frequent_phrases(docs, support, longest, folder, shard_bytes)
    total = found.where("k = 0").select("lang", F.col("n").alias("words"))
    part = found.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    phrases = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("ws"))
    # the weakest cut of every phrase
    cuts = phrases.select("lang", "phrase", "a", "k", "ws", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part("1", "cut").alias("first"), _part("cut + 1", "k - cut").alias("rest"))
    cuts = cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(total, "lang")

    # whole numbers of 38 digits; counts of fewer than 10**14 words cannot overflow
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(words as decimal(15,0))) "
                   "div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    weakest = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "words")).alias("best")).select("lang", "phrase", "best.*")
    # a phrase goes if a longer one that holds it is as frequent
    inner = phrases.where("k > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), "
        "i -> array_join(slice(ws, i, m), ' '))))")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = weakest.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
