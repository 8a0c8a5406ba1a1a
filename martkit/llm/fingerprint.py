"""Operator 10: homomorphic multiset hash of a document's paragraphs.

A document is the multiset of its paragraphs: the lines, and long lines further divided after words whose hash
is 0 modulo CUT, so that an edit changes only the pieces it touches.  Each paragraph is hashed to a wide vector
and the document's fingerprint is the sum of the vectors, lane by lane, modulo powers of two:

* STRONG lanes of 64 bits, summed modulo 2**64, decide equality;
* SIGN lanes of +1 / -1, summed modulo 2**16, carry likeness: the squared length of the difference of two
  fingerprints estimates how many paragraphs they do not share.

Sums do not depend on order; ``add`` and ``remove`` update a fingerprint for inserted or deleted paragraphs
without the rest of the document.  likeness = 1 - |a-b|^2 / (|a|^2 + |b|^2), cut to 0..1, and 1 for equal
fingerprints, where |.| is over the signed sign lanes; two empty documents are alike.  (A lane holds sums of
fewer than 32,768 in size exactly; beyond that only likeness coarsens, not equality.)

``edited_pairs`` deals documents over doc_id ranges in one shuffle; the first document of each range is also
sent to the range before, so every document meets its successor.

Defined results: a null text is empty and has the fingerprint of the empty multiset; null doc_ids come first in
the order; rows that repeat a doc_id are ordered by text, and equal ones are each other's successors; a text of any length is
hashed whole; a single document is its own successor; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import (U64, doc_text, partitions, range_part, slices, text_bytes, word_hashes,
                                word_spans)
from martkit.llm.token_store import doc_id_bounds

STRONG = 4     # lanes modulo 2**64
SIGN = 256     # lanes modulo 2**16
CUT = 8        # average words to a paragraph piece
WIDTH = STRONG * 8 + SIGN * 2
_PIECE_ROWS = 1 << 14

_BYTES = STRONG * 8 + SIGN // 8  # of a paragraph's hash: 64, as many as BLAKE2b gives


def paragraphs(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Hash of every paragraph piece of every text and, per text, the index of its first one (n+1).

    A line's newline belongs to it, and all white space counts.
    """
    col = pa.array(texts, pa.large_string())
    data, offs = text_bytes(col)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offs] = True
    cut[1:][data == 0x0A] = True  # a line ends after its newline
    _, ends, _ = word_spans(data, offs)
    cut[ends[word_hashes(col, lower=False)[0] % U64(CUT) == 0]] = True
    at = np.flatnonzero(cut)
    first = np.searchsorted(at[:-1], offs)
    raw, at = data.tobytes(), at.tolist()
    return [hashlib.blake2b(raw[a:z], digest_size=_BYTES).digest() for a, z in zip(at, at[1:], strict=False)], first


def vectors(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strong (uint64) and sign (int8) lanes of paragraph hashes, all from their own bits."""
    wide = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, _BYTES)
    strong = np.ascontiguousarray(wide[:, :STRONG * 8]).view("<u8").astype(U64)
    bits = np.unpackbits(wide[:, STRONG * 8:], axis=1)
    return strong, (bits.astype(np.int8) << 1) - 1


class Fingerprint:
    """Sum of paragraph vectors."""

    __slots__ = ("sign", "strong")

    def __init__(self, strong: np.ndarray | None = None, sign: np.ndarray | None = None):
        self.strong = np.zeros(STRONG, U64) if strong is None else strong
        self.sign = np.zeros(SIGN, np.uint16) if sign is None else sign

    @classmethod
    def of_hashes(cls, hashes: list[bytes]) -> Fingerprint:
        out = cls()
        for k in range(0, len(hashes), _PIECE_ROWS):
            strong, sign = vectors(hashes[k:k + _PIECE_ROWS])
            out.strong = out.strong + strong.sum(axis=0, dtype=U64)
            out.sign = out.sign + sign.sum(axis=0, dtype=np.int32).astype(np.uint16)
        return out

    @classmethod
    def of(cls, text: str | None) -> Fingerprint:
        return cls.of_hashes(paragraphs([text or ""])[0])

    def add(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.strong + other.strong, self.sign + other.sign)

    def remove(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.strong - other.strong, self.sign - other.sign)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.hex() == other.hex()

    def __hash__(self) -> int:
        return hash(self.hex())

    def hex(self) -> str:
        return (self.strong.astype("<u8").tobytes() + self.sign.astype("<u2").tobytes()).hex()

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw[:STRONG * 8], "<u8").astype(U64),
                   np.frombuffer(raw[STRONG * 8:], "<u2").astype(np.uint16))

    def likeness(self, other: Fingerprint) -> float:
        if (self.strong == other.strong).all() and (self.sign == other.sign).all():
            return 1.0
        a, b, d = (x.astype(np.int16).astype(np.float64) for x in (self.sign, other.sign, self.sign - other.sign))
        total = a @ a + b @ b
        return float(min(1.0, max(0.0, 1.0 - d @ d / total))) if total else 0.0


def fingerprints(texts: list[str]) -> list[Fingerprint]:
    """Fingerprints of many texts at a time."""
    hashes, first = paragraphs(texts)
    n = np.diff(first)
    if int(n.max(initial=0)) > _PIECE_ROWS or len(hashes) > 4 * _PIECE_ROWS:
        return [Fingerprint.of_hashes(hashes[first[i]:first[i + 1]]) for i in range(len(texts))]
    full = np.flatnonzero(n)
    out = [Fingerprint() for _ in texts]
    if len(full):
        strong, sign = vectors(hashes)
        strongs = np.add.reduceat(strong, first[full], axis=0)
        signs = np.add.reduceat(sign, first[full], axis=0, dtype=np.int16).view(np.uint16)
        for k, i in enumerate(full.tolist()):
            out[i] = Fingerprint(strongs[k], signs[k])
    return out


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_PAIR = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")
_CHUNK = 1 << 19  # characters fingerprinted together


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and order within it; a row with ``own`` false only ends its range."""
    ids: list[int | None] = []
    texts: list[str] = []
    part, ended = None, False

    def flush() -> Iterator[pa.RecordBatch]:
        """All held documents but the last, which only lends its beginning."""
        if len(texts) < 2:
            return
        changed = [edited(t, f) for t, f in zip(texts, texts[1:], strict=False)]
        own, new = fingerprints(texts), fingerprints(changed)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in changed]),
            pa.array([x.hex() for x in own[:-1]]), pa.array([x.hex() for x in new]),
            pa.array([x.likeness(y) for x, y in zip(own, new, strict=False)]),
            pa.array([x.likeness(y) for x, y in zip(own, own[1:], strict=False)])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                   "near_next"])

    size = 0
    for b in slices(batches, "text", _CHUNK):
        for p, own, doc, text in zip(*(b.column(c).to_pylist() for c in ("part", "own", "doc_id", "text")), strict=True):
            if p != part or size >= _CHUNK:
                yield from flush()
                same = p == part
                ids, texts = (ids[-1:], texts[-1:]) if same else ([], [])
                part, size, ended = p, 0, same and ended
            if ended:  # more rows of the doc_id that ends the range
                continue
            ended = not own
            ids.append(doc)
            texts.append(text)
            size += len(text)
    yield from flush()


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprint every document and its edited text, which borrows from the next document by doc_id."""
    spark = docs.sparkSession
    docs = doc_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    parts = partitions(spark)
    bounds = doc_id_bounds(docs, parts)
    ranged = docs.withColumn("part", range_part(F.col("doc_id"), bounds))
    # the smallest doc_id of every range: one row per range at most
    known = F.struct(F.col("doc_id").isNotNull(), "doc_id")
    heads = ranged.groupBy("part").agg(F.min(known)["doc_id"].alias("doc_id")).orderBy("part").collect()
    if not heads:
        return spark.createDataFrame([], _PAIR)
    firsts = spark.createDataFrame([(h["part"], h["doc_id"], heads[k - 1]["part"]) for k, h in enumerate(heads)],
                                   "head_part int, head_id long, before int")
    # every row goes to its range; a range's first also ends the range before
    own = F.struct(F.col("part"), F.lit(True).alias("own"))
    end = F.struct(F.col("before").alias("part"), F.lit(False).alias("own"))
    rows = ranged.join(F.broadcast(firsts), (F.col("part") == F.col("head_part"))
                       & F.col("doc_id").eqNullSafe(F.col("head_id")), "left").select(
        F.inline(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, end))), "doc_id", "text")
    dealt = rows.repartition(parts, "part").sortWithinPartitions(
        "part", F.col("own").desc(), F.col("doc_id").asc_nulls_first(), "text")
    return dealt.mapInArrow(_pair_rows, _PAIR)
