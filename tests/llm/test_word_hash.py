"""Words that a polynomial hash modulo 2**64 cannot tell apart, whatever its base (Thue-Morse strings)."""

import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from martkit.llm import common
from martkit.llm.fingerprint import edited_pairs
from martkit.llm.jaccard_join import jaccard_components
from martkit.llm.ngram_lm import score_texts
from martkit.llm.packing import best_fit_packing
from martkit.llm.token_store import token_store
from martkit.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def thue_morse(n):
    one, two = "a", "b"
    while len(one) < n:
        one, two = one + two, two + one
    return one, two


PAIRS = [thue_morse(n) for n in (256, 512, 1024, 2048, 4096)]


def test_hashes_and_ids_differ():
    tok = Tokenizer.from_file(PATH)
    for a, b in PAIRS:
        h, first = common.word_hashes(pa.array([a, b, a + " " + b]))
        assert h[0] != h[1] and h[2] == h[0] and h[3] == h[1] and first.tolist() == [0, 1, 2, 4]
        ids, first = encoder(PATH).encode(pa.array([a, b]))
        for t, s, e in zip((a, b), first[:-1], first[1:], strict=True):
            assert ids[s:e].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_queries_tell_them_apart(spark):
    rows = [(2 * i + j, t) for i, pair in enumerate(PAIRS) for j, t in enumerate(pair)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    tok = Tokenizer.from_file(PATH)
    size = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows}
    stored = {r.doc_id: r for r in token_store(docs, PATH, 2).collect()}
    assert {d: r.n_tokens for d, r in stored.items()} == size
    assert len({r.ids_crc32 for r in stored.values()}) == len(rows)
    packed = best_fit_packing(docs, PATH, 0, 2048).collect()
    assert len({(r.length, r.ids_crc32) for r in packed if r.piece == 0}) == len(rows)
    joined = jaccard_components(docs).collect()
    assert all(r.component_id == r.doc_id for r in joined)
    prints = edited_pairs(docs).collect()
    assert len({r.fingerprint for r in prints}) == len(rows) and all(r.near_next < 1 for r in prints)
    scored = score_texts(docs).collect()
    held = [r for r in scored if r.held_out]
    assert all(r.n_known == (1 if r.held_out else 2) for r in scored) and held  # the end token alone is known


def test_hash_is_the_same_in_every_process():
    code = ("import pyarrow as pa; from martkit.llm import common; "
            "print(common.word_hashes(pa.array(['one two THREE \\u00e9\\u00c9', None, 'one']))[0].tolist())")
    out = {subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True, timeout=60).stdout
           for _ in range(3)}
    assert len(out) == 1


def test_long_texts_are_split_as_a_whole(monkeypatch):
    text = ("ab  cd\t" * 50 + "x" * 100 + "\n" + "é ü" * 40).encode()
    for size in (1, 5, 64, 1 << 20):
        monkeypatch.setattr(common, "WORD_BLOCK", size)
        assert [w for part in common.split_words(text) for w in part] == text.split()
    monkeypatch.setattr(common, "WORDS_KEPT", 3)
    h, _ = common.word_hashes(pa.array([text.decode()] * 2))
    assert (h[:len(h) // 2] == h[len(h) // 2:]).all() and len(np.unique(h)) == len(set(text.split()))
