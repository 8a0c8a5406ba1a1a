import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard

from martkit.llm.packing import BestFit, best_fit_packing, pack
from martkit.llm.token_store import TokenShard, read_token_shards, write_token_shards
from martkit.llm.tokens import WordEncoder, encoder
from tests.llm.util import HARD, empty, hard_docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(text):
    return encoder(PATH).tok.encode(text or "", add_special_tokens=False).ids


def test_word_cache_equals_whole_text_encoding(monkeypatch):
    texts = [t for _, t in HARD] + ["don't WE'LL I'm", "İstanbul İ. áb é ́x", "a\x1cb c\x85d e", "A.B.C, ok?!",
                                    "x<|endoftext|>y <|startoftext|>", "12a3 ... ﬁ Å", "it's 's word. word, word!"]
    for limit in (2_000_000, 50):
        monkeypatch.setattr("martkit.llm.tokens.CACHE_WORDS", limit)
        e = WordEncoder(PATH)
        for _ in range(2):
            got, first = e.encode(pa.array(texts))
            for i, t in enumerate(texts):
                assert got[first[i]:first[i + 1]].tolist() == ids(t)


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_shards_round_trip(spark, tmp_root):
    docs = hard_docs(spark)
    manifest = write_token_shards(docs, tmp_root, PATH, end_id=2, shards=3)
    rows = read_token_shards(spark, manifest).orderBy("start").collect()
    key = lambda d: (d is not None, d or 0)  # noqa: E731 - nulls first
    assert [r.doc_id for r in rows] == sorted((d for d, _ in HARD), key=key)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len(ids(t)) + 1, crc([*ids(t), 2])) for d, t in HARD if d is not None)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    total = {r.uri for r in manifest.collect()}
    found = defaultdict(list)
    for uri in total:
        shard = TokenShard(uri)
        for d in (4, 8, 99):
            found[d] += [x.tolist() for x in shard.read(d)]
    assert found[4] == [[*ids(HARD[4][1]), 2]] * 2 and found[8] == [[*ids(HARD[7][1]), 2]] and not found[99]


def test_frames_stand_alone_and_damage_is_found(spark, tmp_root):
    docs = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(20)], "doc_id long, text string")
    uri = write_token_shards(docs, tmp_root, PATH, end_id=2, shards=1).collect()[0].uri
    shard = TokenShard(uri)
    raw = bytearray(open(uri.removeprefix("file:"), "rb").read())
    # the public layout: footer, one 12-byte entry for each frame, frames that decompress by themselves
    n, flags, magic = struct.unpack("<IBI", raw[-9:])
    assert (n, flags, magic) == (21, 0x80, 0x8F92EAB1)
    k = 7
    at, size = int(shard.offsets[k]), int(shard.sizes[k])
    alone = zstandard.ZstdDecompressor().decompress(bytes(raw[at:at + size]))
    assert np.frombuffer(alone, f"<u{shard.width}").tolist() == shard.frame(k).tolist()
    whole = zstandard.ZstdDecompressor().stream_reader(bytes(raw), read_across_frames=True).read()
    assert len(whole) == int(shard.raw.sum())
    # one frame swapped for another of the same size in the table must not pass
    other = zstandard.ZstdCompressor().compress(bytes(reversed(alone)))
    if len(other) == size:
        raw[at:at + size] = other
    else:
        raw[at + size // 2] ^= 0xFF
    bad = f"{tmp_root}/bad.zst"
    open(bad, "wb").write(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        TokenShard(bad).frame(k)
    assert TokenShard(bad).frame(k + 1).tolist() == shard.frame(k + 1).tolist()


def test_store_of_an_empty_table(spark, tmp_root):
    manifest = write_token_shards(empty(hard_docs(spark)), tmp_root, PATH, end_id=2)
    assert read_token_shards(spark, manifest).count() == 0


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(3)
    sizes = sorted(rng.integers(1, 101, 400).tolist(), reverse=True)
    fit, room = BestFit(100), []
    for s in sizes:
        fits = [r for r in room if r >= s]
        bin_, offset = fit.place(s)
        if not fits:
            assert bin_ == len(room) and offset == 0
            room.append(100 - s)
        else:
            assert room[bin_] == min(fits) and offset == 100 - room[bin_]
            room[bin_] -= s


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_keeps_every_token(spark):
    rows = best_fit_packing(hard_docs(spark), PATH, end_id=0, capacity=64).collect()
    check_packing(rows, 64)
    own = sorted((d, len(ids(t)) + 1) for d, t in HARD if d is not None and d != 4)
    got, whole = defaultdict(list), {d: [*ids(t), 0] for d, t in HARD}
    for r in sorted((r for r in rows if r.doc_id not in (None, 4)), key=lambda r: (r.doc_id, r.piece)):
        assert r.start == sum(got[r.doc_id]) and r.piece == len(got[r.doc_id])
        assert r.ids_crc32 == crc(whole[r.doc_id][r.start:r.start + r.length])
        got[r.doc_id].append(r.length)
    assert sorted((d, sum(x)) for d, x in got.items()) == own
    assert all(n == 64 for x in got.values() for n in x[:-1])
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * (len(ids(HARD[4][1])) + 1)


def test_groups_cost_little(spark):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 2049, 4000).tolist()
    pieces = spark.createDataFrame([(None, 0, 0, s, 0) for s in sizes],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    bound = -(-sum(sizes) // 2048)
    one = check_packing(pack(pieces, 2048).collect(), 2048)
    many = check_packing(pack(pieces, 2048, group_pieces=500).collect(), 2048)
    assert one <= bound * 1.01 and many <= one + 8 * 6


def test_packing_an_empty_table(spark):
    assert best_fit_packing(empty(hard_docs(spark)), PATH).count() == 0
