"""Words are looked up once for each distinct one of a group of texts, and plain words are encoded together."""

import numpy as np
import pyarrow as pa
import pytest

from martkit.llm import common, tokens
from martkit.llm.common import blobs, word_numbers
from martkit.llm.queries import tokenizer_path
from martkit.llm.tokens import WordEncoder

PATH = tokenizer_path()
TEXTS = ["one two one", None, "", " \t\n", "  two\vthree\f one ", "é é é", "\x1cone one\x1c", "x"]


@pytest.mark.parametrize("block, group", [(1 << 20, 1 << 22), (3, 5), (1, 1), (4, 1 << 22)])
def test_every_word_gets_its_number(monkeypatch, block, group):
    monkeypatch.setattr(common, "WORD_BLOCK", block)
    monkeypatch.setattr(common, "GROUP_BYTES", group)
    names: dict[bytes, int] = {}
    code, first = word_numbers(blobs(pa.array(TEXTS)), lambda w: names.setdefault(w, len(names)), np.int32)
    back, want = list(names), [(t or "").encode().split() for t in TEXTS]
    assert [[back[c] for c in code[first[i]:first[i + 1]]] for i in range(len(TEXTS))] == want
    assert len(first) == len(TEXTS) + 1 and first[-1] == len(code) == sum(map(len, want))


def test_no_texts_and_no_words():
    for texts in ([], [b""], [b" ", b"\n\n"]):
        code, first = word_numbers(texts, {}.__getitem__, np.int32)
        assert code.dtype == np.int32 and code.tolist() == [] and first.tolist() == [0] * (len(texts) + 1)


def test_a_word_is_looked_up_once():
    asked = []
    word_numbers([b"a b a", b"b a c"] * 50, lambda w: (asked.append(w), len(w))[1], np.int32)
    assert sorted(asked) == [b"a", b"b", b"c"]


def test_plain_words_are_encoded_together(monkeypatch):
    enc, calls = WordEncoder(PATH), []
    many = enc._many
    monkeypatch.setattr(enc, "_many", lambda *a: (calls.append(len(a[-1])), many(*a))[1])
    words = [f"{w}{mark}{i}" for i in range(40) for w in ("Tion", "éAU", "a-b_c", "$") for mark in ("$$$", "...", "%!", "7")]
    ids, first = enc.encode(pa.array(words))
    assert [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:], strict=True)] == [
        enc.tok.encode(w, add_special_tokens=False).ids for w in words]
    assert sum(calls) <= len(words) // 16


def test_words_that_are_not_plain():
    enc = WordEncoder(PATH)
    words = ["<|endoftext|>", "a<|endoftext|>b", "it's", "'s", "O'Neil'll", "'", "<", "ΑΣ", "ﬁn", "ét́", "²", "½x",
             "x y", "İ", "ªº", "日本語", "×÷", "ÿ.", "ß", "\x1f", "\x7f", "a\u0085b", "🙂ok"]
    for texts in (words, [" ".join(words)], [w + "." for w in words], ["a " + w + " b" for w in words]):
        ids, first = enc.encode(pa.array(texts))
        assert [ids[a:z].tolist() for a, z in zip(first[:-1], first[1:], strict=True)] == [
            enc.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_have_no_plain_words(tmp_path):
    other = tmp_path / "other.json"
    with open(PATH, encoding="utf-8") as f:
        other.write_text(f.read().replace('"Lowercase"', '"NFKC"'), encoding="utf-8")
    enc = WordEncoder(str(other))
    ids, _ = enc.encode(pa.array(["One TWO three."]))
    assert enc.plain is None and ids.tolist() == enc.tok.encode("One TWO three.", add_special_tokens=False).ids
    assert tokens.plain_tokenizer(WordEncoder(PATH).tok, PATH) is not None
