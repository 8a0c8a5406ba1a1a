"""Operator 2: language-model scoring with an Elias-Fano n-gram trie.

The model is of order 2 or 3, over white-space words and an end token; every order is smoothed towards the one below
by a Dirichlet prior: P(w | u v) = (c(u v w) + KAPPA * P(w | v)) / (c(u v) + KAPPA), P(w | v) = (c(v w) + KAPPA * P1(w))
/ (c(v) + KAPPA) and P1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).  A text begins in the context of the end token, so its
first token has no more context than that; an n-gram that was not seen backs off to the level below by its count of 0.

Texts are split into words and hashed once; every pass reads the tokens back as compressed numbers of a dictionary for
each slice.  The trie lies in shard files in the shared folder, mapped into memory by the tasks that score:

* the first level, cut by hash ranges: the words' 64-bit hashes as an Elias-Fano sequence (a word's place in all
  shards is its id) and the running sums of their counts as another;
* the second level, cut by a hash of (context, word) so that no common context lands in one shard: the contexts of
  the shard as a sequence, monotone pointers to each context's first successor, the successors as context-relative
  values (place of the context times V, plus word id), and for each the smoothed log10 probability and, below the top
  level, the weight of backing off from it as a context, both quantised to 16 bits (STEPS steps a decade);
* the third level, the same with a pair's place in all shards of the second level as the context, cut by a hash of the
  triple.

A lookup finds the context, takes its pointer range, and searches the successor in that range.  A text's score differs
from the unquantised one by less than 2 / STEPS a token.  What is gathered grows with the corpus (all distinct n-grams
of the training texts), never passes through the driver, and is counted in each task before it is shuffled as packed,
compressed arrays, a triple with its quantised probability one level below; a shard's share per
task is one row, so a common word or pair weighs no more than others.  The driver sees one manifest row for each shard.

Every shard is dealt to a task of its own.  A task that looks n-grams up maps the shards and copies nothing of them, so
its memory does not follow the corpus (a shared folder that is not mounted is read instead, and does).  A visit to a
shard has a price of its own and a lookup visits them all, so it takes TOGETHER slices at a time.

Word ids must fit 32 bits (4.29 billion distinct words), and distinct pairs times words 64 bits; beyond that building
raises.

Defined results: a null or empty text is the end token alone; rows with a null doc_id are learned from and scored;
repeated rows are learned from as often as they occur; with nothing to learn from N and V are 0 and both scores are
the sums of log10(0.1 / 0.1) = 0; a text of any length is scored whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm import files
from martkit.llm.common import (U64, doc_text, give_back, materialise, mix64, partitions, scratch, slices, word_hashes)
from martkit.llm.elias_fano import EliasFano

ALPHA = 0.1      # added to every unigram count (fixed by the contract)
KAPPA = 20.0     # weight of the level below in a probability
STEPS = 4096     # steps of a quantised decade; 16 bits hold 16 decades
FOLDS = 10       # texts with crc32(doc_id) mod FOLDS = 0 are held out
TEXT_BYTES = 3 << 20
TOGETHER = 4  # slices looked up together
HELD_ROWS = 1 << 20  # distinct n-grams that a task holds before it sends them on
MERGE_ROWS = 1 << 17  # n-grams sorted, or given a probability, at a time

END = mix64(np.array([0x0E0D], U64))[0]


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of every text, each closed by END, and the index of each text's first token (n+1)."""
    h, first = word_hashes(col)
    n = np.diff(first) + 1
    at = np.append(0, np.cumsum(n))
    out = np.full(int(at[-1]), END, U64)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = h
    return out, at


def _planes(values: np.ndarray) -> bytes:
    """Byte planes: the high bytes of small numbers are mostly zero."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(raw: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_SPELT = "doc_id array<bigint>, held_out array<boolean>, first array<bigint>, names binary, code binary"

# A row has megabytes, compressed already: written as they are, a few rows to a row group.  Else a task's rows make one
# page, which writers and readers hold several times, in buffers outside the heap too.
_SPELT_FILES = {"compression": "none", "parquet.block.size": str(TEXT_BYTES), "parquet.block.size.row.check.min": "1",
                "parquet.page.size.row.check.min": "1"}


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each slice of texts: its distinct tokens' hashes, which of them each token is, first tokens."""
    zstd = zstandard.ZstdCompressor(level=1)
    for b in slices(batches, "text", TEXT_BYTES):
        h, first = tokens(b.column("text"))
        names, code, n = np.unique(h, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent ones get small numbers; equally frequent ones ascend
        rank = np.empty(len(names), np.uint32)
        rank[order] = np.arange(len(names), dtype=np.uint32)
        names, code = names[order], rank[code]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                 for x in (b.column("doc_id"), b.column("held_out"), pa.array(first))]
        blobs = [pa.array([zstd.compress(_planes(x))], pa.binary())
                 for x in (np.diff(names, prepend=U64(0)), code)]
        yield pa.RecordBatch.from_arrays([*lists, *blobs], names=["doc_id", "held_out", "first", "names", "code"])


def _joined(parts: list[tuple]) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Slices as one, as ``spelt`` gives them.  ``parts`` is emptied."""
    if len(parts) == 1:
        return parts.pop()
    doc_id, held, names, code, first = zip(*parts, strict=True)
    parts.clear()
    upto = np.cumsum([0, *(len(x) for x in names)])
    names, place = np.unique(np.concatenate(names), return_inverse=True)
    place = place.astype(np.int32)
    code = np.concatenate([place[a:][x] for a, x in zip(upto, code)])
    return (pa.concat_arrays(doc_id), pa.concat_arrays(held), names, code,
            np.append(0, np.cumsum(np.concatenate([np.diff(x) for x in first]))))


def spelt(batches: Iterator[pa.RecordBatch], train: bool = False, together: int = 1
          ) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_id, held_out, hashes, which of them each token is, first token of every text) of every slice, or of some
    ``together``; to train, the tokens of held-out texts are left out."""
    unzip = zstandard.ZstdDecompressor()
    parts = []
    for b in batches:
        for i in range(b.num_rows):
            doc_id, held, first = (b.column(c)[i].values for c in ("doc_id", "held_out", "first"))
            names, code = (_from_planes(np.frombuffer(unzip.decompress(b.column(c)[i].as_py()), np.uint8), kind)
                           for c, kind in (("names", U64), ("code", np.uint32)))
            first, names = first.to_numpy(), np.cumsum(names, dtype=U64)
            order = np.argsort(names)
            place = np.empty(len(names), np.int32)
            place[order] = np.arange(len(names), dtype=np.int32)
            names, code = names[order], place[code]
            if train:
                own = ~held.to_numpy(zero_copy_only=False)
                n = np.diff(first)
                code, first = code[np.repeat(own, n)], np.append(0, np.cumsum(n[own]))
                if not len(code):
                    continue
            parts.append((doc_id, held, names, code, first))
            del doc_id, held, names, code, first, order, place
            if len(parts) == together:
                yield _joined(parts)
        del b
        give_back()
    if parts:
        yield _joined(parts)


def count(keys: np.ndarray, weights: np.ndarray | None = None, side: np.ndarray | None = None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Distinct keys, ascending, with their summed weights (1 each by default) and one of their side rows."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        n = np.diff(np.append(first, len(keys)))
    else:
        n = np.add.reduceat(weights[order], first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return keys[first], n.astype(np.int64, copy=False), None if side is None else side[order[first]]


def quantise(decades: np.ndarray) -> np.ndarray:
    """Decades (not negative) as whole STEPS."""
    return np.minimum(np.rint(decades * STEPS), 65535).astype(np.uint16)


def _merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Parts of distinct, ascending keys as one; a range of keys at a time, so that little is held beside them and what
    comes out.  ``parts`` is emptied."""
    if len(parts) == 1:
        return parts.pop()
    cuts = -(-sum(len(k) for k, _, _ in parts) // MERGE_ROWS)
    some = np.sort(np.concatenate([k[::64] for k, _, _ in parts]))  # every part counts by its length
    bounds = some[np.arange(1, cuts) * len(some) // cuts] if len(some) else some
    ends = [np.append(np.searchsorted(k, bounds), len(k)).tolist() for k, _, _ in parts]
    at, out = [0] * len(parts), []
    for i in range(len(bounds) + 1):
        pieces = [[x if x is None else x[a:end[i]] for x in part] for part, a, end in zip(parts, at, ends, strict=True)]
        at = [end[i] for end in ends]
        keys, n, side = zip(*pieces, strict=True)
        out.append(count(np.concatenate(keys), np.concatenate(n), None if side[0] is None else np.concatenate(side)))
    del pieces, keys, n, side
    parts.clear()
    columns = [list(x) for x in zip(*out, strict=True)]
    del out
    return tuple(x[0] if x[0] is None else np.concatenate(x) for x in (columns.pop(0) for _ in range(3)))


class Packed:
    """Counts that a task sends on: one row for each shard and send, keys as compressed differences."""

    SCHEMA = "shard int, n long, body binary"

    def __init__(self, shard_of: Callable[[np.ndarray], np.ndarray]):
        self.shard_of = shard_of
        self.parts: list[tuple] = []
        self.rows = 0

    def add(self, keys: np.ndarray, side: np.ndarray | None = None, n: np.ndarray | None = None
            ) -> Iterator[pa.RecordBatch]:
        """``side``: uint16 columns for each key, the same wherever the key occurs; ``n``: counts of distinct keys."""
        self.parts.append(count(keys, n, side))
        self.rows += len(self.parts[-1][0])
        if self.rows > HELD_ROWS:
            self.parts = [_merged(self.parts)]
            self.rows = len(self.parts[0][0])
            if self.rows > HELD_ROWS // 2:
                yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        k, n, side = _merged(self.parts)
        self.parts, self.rows = [], 0
        shard = self.shard_of(k)
        order = np.argsort(shard, kind="stable")
        k, n, shard = k[order], n[order], shard[order]
        cuts = np.flatnonzero(np.diff(shard)) + 1
        starts = np.append(0, cuts)
        zstd = zstandard.ZstdCompressor(level=1)
        bodies, sizes = [], []
        for a, z in zip(starts, np.append(cuts, len(k)), strict=True):
            plane = _planes(np.diff(k[a:z], prepend=U64(0)))
            rest = b"" if side is None else b"".join(_planes(np.ascontiguousarray(x)) for x in side[order[a:z]].T)
            bodies.append(zstd.compress(plane + n[a:z].astype(np.uint32).tobytes() + rest))
            sizes.append(z - a)
        yield pa.RecordBatch.from_arrays([pa.array(shard[starts].astype(np.int32)), pa.array(sizes, pa.int64()),
                                          pa.array(bodies, pa.binary())], names=["shard", "n", "body"])

    @staticmethod
    def read(n: int, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
        step = _from_planes(raw[:8 * n], U64)
        side = None
        if len(raw) > 12 * n:
            side = np.column_stack([_from_planes(x, np.uint16) for x in raw[12 * n:].reshape(-1, 2 * n)])
        return np.cumsum(step, dtype=U64), raw[8 * n:12 * n].view(np.uint32).astype(np.int64), side


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(shard, keys, counts, side) of rows sorted by shard; merges as it goes, so memory follows the distinct keys."""
    own, parts, rows, limit = None, [], 0, 6 * HELD_ROWS
    for b in batches:
        for i, (shard, n) in enumerate(zip(b.column("shard").to_pylist(), b.column("n").to_pylist(), strict=True)):
            if shard != own and parts:
                yield own, *_merged(parts)
                give_back()
                rows, limit = 0, 6 * HELD_ROWS
            own = shard
            keys, counts, side = Packed.read(n, b.column("body")[i].as_buffer())
            parts.append((keys, counts.astype(np.uint32), side))  # as they were sent
            del keys, counts, side
            rows += n
            if rows > limit:
                parts = [_merged(parts)]
                rows = len(parts[0][0])
                limit = max(limit, 2 * rows)
        del b
    if parts:
        yield own, *_merged(parts)


def write_arrays(folder: str, stem: str, arrays: dict[str, np.ndarray], facts: dict) -> str:
    """Named arrays in one file that can be mapped: a JSON head, then the arrays at multiples of 64 bytes."""
    at, places = 0, {}
    for name, a in arrays.items():
        places[name] = (at, len(a), a.dtype.str)
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"facts": facts, "arrays": places}).encode()
    start = -(-(len(head) + 8) // 64) * 64
    uri = files.new_name(folder, stem, ".trie")
    with files.create(uri) as out:
        out.write(len(head).to_bytes(8, "little") + head + b"\0" * (start - 8 - len(head)))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 64))
    return uri


def map_arrays(uri: str) -> tuple[dict[str, np.ndarray], dict]:
    data = files.map_file(uri)
    n = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8:8 + n].tobytes())
    start = -(-(n + 8) // 64) * 64
    arrays = {name: data[start + at:start + at + size * np.dtype(kind).itemsize].view(kind)
              for name, (at, size, kind) in head["arrays"].items()}
    return arrays, head["facts"]


def _flat(**sequences: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{name}.{part}": a for name, s in sequences.items() for part, a in s.items()}


def _sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano(**{key[len(name) + 1:]: a for key, a in arrays.items() if key.startswith(f"{name}.")})


def range_start(shard: int, shards: int) -> int:
    """Smallest hash of a range shard."""
    return -(-(shard << 32) // shards) << 32


class Vocabulary:
    """The first level: ids and counts of words, over mapped shards."""

    def __init__(self, manifest: list[tuple[int, str, int, int]], shards: int):
        """``manifest``: (shard, uri, words, tokens) of every shard that holds words."""
        self.shards = shards
        self.files: dict[int, tuple[EliasFano, EliasFano]] = {}
        self.uris = {s: uri for s, uri, _, _ in manifest}
        size = np.zeros(shards, np.int64)
        for s, _, words, _ in manifest:
            size[s] = words
        self.base = np.append(0, np.cumsum(size))
        self.words, self.tokens = int(size.sum()), sum(t for *_, t in manifest)

    def _open(self, shard: int) -> tuple[EliasFano, EliasFano]:
        if shard not in self.files:
            arrays, _ = map_arrays(self.uris[shard])
            self.files[shard] = _sequence(arrays, "hash"), _sequence(arrays, "sum")
        return self.files[shard]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending distinct hashes; -1 if unknown."""
        out = np.full(len(hashes), -1, np.int64)
        shard = ((hashes >> U64(32)) * U64(self.shards) >> U64(32)).astype(np.int64)
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in self.uris:
            a, z = int(cuts[s]), int(cuts[s + 1])
            if a < z:
                at, found = self._open(s)[0].find(hashes[a:z] - U64(range_start(s, self.shards)))
                out[a:z] = np.where(found, at + self.base[s], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of ascending distinct ids; 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.base)
        for s in self.uris:
            a, z = int(cuts[s]), int(cuts[s + 1])
            if a < z:
                k, sums = ids[a:z] - self.base[s], self._open(s)[1]
                upto = sums.access(k).astype(np.int64)
                before = np.zeros(len(k), np.int64)
                some = np.flatnonzero(k)
                before[some] = sums.access(k[some] - 1).astype(np.int64)
                out[a:z] = upto - before
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ALPHA) / (self.tokens + ALPHA * (self.words + 1))


_VOCAB = "shard int, uri string, words long, tokens long"
_TRIE = "shard int, uri string, grams long"


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Packed(lambda k: ((k >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64))
        for _, _, names, code, _ in spelt(batches, train=True):
            n = np.bincount(code, minlength=len(names))
            yield from held.add(names[n > 0], None, n[n > 0])
        yield from held.send()

    return run


def _write_words(folder: str, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, keys, n, _ in by_shard(batches):
            low = range_start(shard, shards)
            universe = (range_start(shard + 1, shards) if shard + 1 < shards else 1 << 64) - low
            sums = np.cumsum(n).astype(U64)
            arrays = _flat(hash=EliasFano.encode(keys - U64(low), universe, EliasFano.SEARCH),
                           sum=EliasFano.encode(sums, int(sums[-1]) + 1, EliasFano.ACCESS))
            uri = write_arrays(folder, f"words-{shard:06d}", arrays, {"shard": shard})
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([uri]), pa.array([len(keys)], pa.int64()),
                pa.array([int(n.sum())], pa.int64())], names=["shard", "uri", "words", "tokens"])

    return run


def _gram_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards as numbers that sort fast."""
    return (mix64(keys) % U64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)


class Shard:
    """One mapped shard of the second or third level."""

    def __init__(self, uri: str, words: int):
        arrays, _ = map_arrays(uri)
        self.words = words
        self.context, self.pointer, self.follow = (_sequence(arrays, k) for k in ("context", "pointer", "follow"))
        self.prob, self.back, self.weights = arrays["prob"], arrays.get("back"), arrays.get("weights")

    def lookup(self, ctx: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the shard or -1, quantised probability, quantised back-off weight) of (context, word) sorted by
        context; 0 where not found."""
        new = np.append(True, ctx[1:] != ctx[:-1])
        code = np.cumsum(new) - 1
        place, known = self.context.find(ctx[new])
        lo, hi = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        at = np.flatnonzero(known)
        lo[at], hi[at] = self.pointer.access_next(place[at])
        some = np.flatnonzero(known[code])
        c = code[some]
        index, hit = self.follow.find(place[c].astype(U64) * U64(self.words) + own[some], lo[c], hi[c])
        out = np.full(len(ctx), -1, np.int64)
        prob, back = np.zeros(len(ctx), np.uint16), np.zeros(len(ctx), np.uint16)
        some, index = some[hit], index[hit]
        out[some], prob[some] = index, self.prob[index]
        if self.back is not None:
            back[some] = self.weights[self.back[index]]
        return out, prob, back


class Grams:
    """The second or third level: places and counts of n-grams, over mapped shards."""

    def __init__(self, manifest: list[tuple[int, str, int]], shards: int, words: int):
        """``manifest``: (shard, uri, n-grams) of every shard that holds any."""
        self.shards, self.words = shards, words
        self.files: dict[int, Shard] = {}
        self.uris = {s: uri for s, uri, _ in manifest}
        size = np.zeros(shards, np.int64)
        for s, _, grams in manifest:
            size[s] = grams
        self.base = np.append(0, np.cumsum(size))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in all shards or -1, probability, back-off) of ascending distinct keys, context * words + word."""
        place = np.full(len(keys), -1, np.int64)
        prob, back = np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.uint16)
        shard = _gram_shard(keys, self.shards)
        deal = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[deal], np.arange(self.shards + 1))
        ctx = keys[deal]
        own = ctx % U64(self.words)
        ctx //= U64(self.words)
        for s, uri in self.uris.items():
            a, z = int(cuts[s]), int(cuts[s + 1])
            if a < z:
                if s not in self.files:
                    self.files[s] = Shard(uri, self.words)
                at = deal[a:z]
                inside, prob[at], back[at] = self.files[s].lookup(ctx[a:z], own[a:z])
                place[at] = np.where(inside >= 0, inside + self.base[s], -1)
        return place, prob, back

    def weights(self, places: np.ndarray) -> np.ndarray:
        """Quantised back-off weights of ascending places."""
        out = np.zeros(len(places), np.uint16)
        cuts = np.searchsorted(places, self.base)
        for s, uri in self.uris.items():
            a, z = int(cuts[s]), int(cuts[s + 1])
            if a < z:
                arrays, _ = map_arrays(uri)
                out[a:z] = arrays["weights"][arrays["back"][places[a:z] - self.base[s]]]
        return out

    def of(self, ctx: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``find`` for any contexts and words; an unknown one (-1) is not found.  The last two in STEPS a decade."""
        size = len(ctx)
        at = np.flatnonzero((ctx >= 0) & (own >= 0))
        keys = _key(ctx[at], own[at], self.words)
        del ctx, own
        order = np.argsort(keys)
        keys, at = keys[order], at[order]
        del order
        new = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
        keys = keys[new]
        found = self.find(keys)
        del keys
        code = np.cumsum(new, dtype=np.int32)
        code -= 1
        out = np.full(size, -1, np.int64), np.zeros(size, np.uint16), np.zeros(size, np.uint16)
        for x, values in zip(out, found, strict=True):
            x[at] = values[code]
        return out


def _key(ctx: np.ndarray, own: np.ndarray, words: int) -> np.ndarray:
    keys = ctx.astype(U64)
    keys *= U64(words)
    keys += own.view(U64)
    return keys


def _contexts(token_ids: np.ndarray, first: np.ndarray, end_id: int) -> np.ndarray:
    before = np.empty_like(token_ids)
    before[1:] = token_ids[:-1]
    before[first[:-1]] = end_id
    return before


def _end_id(vocab: Vocabulary) -> int:
    return int(vocab.ids(np.array([END], U64))[0])


def _inner(first: np.ndarray) -> np.ndarray:
    """Tokens that have a token of their own text before them."""
    out = np.ones(int(first[-1]), bool)
    out[first[:-1]] = False
    return np.flatnonzero(out)


def _known(words: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Counts of any distinct ids."""
    order = np.argsort(ids, kind="stable")
    out = np.empty(len(ids), np.int64)
    out[order] = words.counts(ids[order])
    return out


def _before(counts: np.ndarray, code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Count of the token before every token; a text begins after the end token."""
    out = np.empty(len(code), np.int64)
    out[1:] = counts[code[:-1]]
    out[first[:-1]] = counts[code[first[1] - 1]]  # every text ends in the end token
    return out


def _count_grams(vocab: tuple, shards: int, pairs: list[tuple[int, str, int]] | None = None):
    """Counts of pairs, or of triples if the pairs' level is given, those each with the quantised probability one level
    below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*vocab)
        level = None if pairs is None else Grams(pairs, shards, words.words)
        held = Packed(lambda k: _gram_shard(k, shards))
        end = _end_id(words)
        for _, _, names, code, first in spelt(batches, True, TOGETHER):
            own, side = words.ids(names)[code], None
            ctx = _contexts(own, first, end)
            del names, code
            if level is not None:
                place, prob, _ = level.of(ctx, own)
                at = _inner(first)
                side = prob[at][:, None]
                del prob
                own = own[at]
                at -= 1
                ctx = place[at]
                del place, at
            keys = _key(ctx, own, words.words)
            del ctx, own
            yield from held.add(keys, side)
            del keys, side
        yield from held.send()

    return run


def _write_grams(folder: str, stem: str, vocab: tuple, contexts: int, top: bool, shards: int = 0,
                 pairs: list[tuple[int, str, int]] | None = None):
    """Files of a level whose contexts are numbers under ``contexts``; the top one is no context itself.  ``pairs``: the
    level below that of triples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = Vocabulary(*vocab)
        words = level.words
        for shard, keys, n, side in by_shard(batches):
            size = len(keys)
            own = keys % U64(words)
            keys //= U64(words)
            new = np.append(True, keys[1:] != keys[:-1])
            start = np.flatnonzero(new)
            ctx = keys[start]
            follow = np.cumsum(new, dtype=U64, out=keys)  # place of the context in the shard, from 1
            del keys, new
            follow -= U64(1)
            follow *= U64(words)
            follow += own
            arrays = _flat(
                context=EliasFano.encode(ctx, contexts, EliasFano.SEARCH),
                pointer=EliasFano.encode(np.append(start, size), size + 1, EliasFano.ACCESS),
                follow=EliasFano.encode(follow, len(start) * words, EliasFano.SEARCH))
            del follow
            if side is None:  # pairs: the words' own counts
                ids, code = np.unique(own.view(np.int64), return_inverse=True)
                unigram = level.unigram(level.counts(ids))
                seen = level.counts(ctx.view(np.int64))
            else:
                seen = Grams(pairs, shards, words).weights(ctx.view(np.int64))
            del own, ctx
            arrays["prob"] = prob = np.empty(size, np.uint16)
            weight = np.empty(0 if top else size, np.uint16)
            for a in range(0, size, MERGE_ROWS):
                part = slice(a, min(size, a + MERGE_ROWS))
                context = seen[np.searchsorted(start, np.arange(part.start, part.stop), side="right") - 1]
                if side is None:
                    below = unigram[code[part]]
                else:
                    below, context = 10.0 ** -(side[part, 0] / STEPS), KAPPA * (10.0 ** (context / STEPS) - 1)
                below, context = (x.astype(np.float32).astype(np.float64) for x in (below, context))
                prob[part] = quantise(-np.log10(np.minimum((n[part] + KAPPA * below) / (context + KAPPA), 1.0)))
                if not top:
                    weight[part] = quantise(np.log10((n[part] + KAPPA) / KAPPA))
            if not top:
                # few distinct ones: a table and numbers into it
                some = np.bincount(weight, minlength=1 << 16) > 0
                arrays["weights"] = np.flatnonzero(some).astype(np.uint16)
                number = np.cumsum(some) - 1
                arrays["back"] = number.astype(np.uint8 if len(arrays["weights"]) <= 1 << 8 else np.uint16)[weight]
            uri = write_arrays(folder, f"{stem}-{shard:06d}", arrays, {"shard": shard})
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([uri]),
                                              pa.array([size], pa.int64())], names=["shard", "uri", "grams"])

    return run


_SCORE = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def _score(vocab: tuple, levels: list[list[tuple[int, str, int]]], shards: int):
    """Scores by the vocabulary and the levels above it (pairs, and triples if given)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*vocab)
        pairs, *triples = (Grams(x, shards, words.words) for x in levels)
        end = _end_id(words)
        for doc_id, held_out, names, code, first in spelt(batches, together=TOGETHER):
            ids = words.ids(names)
            counts = _known(words, ids)
            own = ids[code]
            place, p, back = pairs.of(_contexts(own, first, end), own)
            base = np.log10(words.unigram(counts))[code]
            # unseen n-grams back off to the level below; words without a count have context weight 1
            score = _before(counts, code, first) + KAPPA
            score /= KAPPA
            np.subtract(base, np.log10(score, out=score), out=score)
            hit = place >= 0
            score[hit] = -(p[hit] / STEPS)
            known = np.add.reduceat((own >= 0).astype(np.int64), first[:-1])
            del names, code
            if triples:
                at = _inner(first)
                score[at] -= back[at - 1] / STEPS
                at = at[hit[at] & hit[at - 1]]  # others were not seen
                place, own = place[at - 1], own[at]
                found, p, _ = triples[0].of(place, own)
                hit = found >= 0
                score[at[hit]] = -(p[hit] / STEPS)
                del at, found
            del place, own, p, back, hit
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays([
                doc_id, held_out, pa.array(n), pa.array(known),
                pa.array(np.full(len(n), words.tokens, np.int64)), pa.array(np.add.reduceat(base, first[:-1])),
                pa.array(np.add.reduceat(score, first[:-1]))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, folder: str | None = None, order: int = 2) -> DataFrame:
    """Build the trie from the texts that are not held out and score all: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (order 1), score (the given order, 2 or 3)."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    n = partitions(spark)
    folder = folder or scratch(spark, "ngram-trie")
    texts = doc_text(docs).withColumn("held_out", F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False)))
    texts = materialise(texts.mapInArrow(_spell, _SPELT), "spelt", _SPELT_FILES)  # words are split and hashed once

    def dealt(run: Callable, shards: int) -> DataFrame:
        """Every shard by itself in a partition: a task that had several would hold their rows at once."""
        return texts.mapInArrow(run, Packed.SCHEMA).repartitionById(shards, "shard").sortWithinPartitions("shard")

    # one row for each shard; a lookup visits them all, so they are fewer than partitions
    few, n = -(-n // 4), -(-n // 2)
    words = materialise(dealt(_count_words(few), few).mapInArrow(_write_words(folder, few), _VOCAB), "words").collect()
    vocab = (sorted(tuple(r) for r in words), few)
    size = sum(r[2] for r in vocab[0])
    if size >= 1 << 32:
        raise ValueError("more than 2**32 distinct words")
    levels, contexts = [], size
    for stem in ("pairs", "triples")[:order - 1]:
        if contexts * size >= 1 << 64:
            raise ValueError("more than 2**64 possible n-grams of seen contexts and words")
        found = materialise(dealt(_count_grams(vocab, n, *levels), n).mapInArrow(
            _write_grams(folder, stem, vocab, contexts, len(levels) == order - 2, n, *levels), _TRIE), stem).collect()
        levels.append(sorted(tuple(r) for r in found))
        contexts = sum(r[2] for r in found)
    return texts.mapInArrow(_score(vocab, levels, n), _SCORE)
