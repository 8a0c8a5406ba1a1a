"""Token ids of whole texts with a public BPE tokenizer file, encoded word by word through a bounded cache.

The tokenizer's normaliser and pre-tokenizer never look across ASCII white space, so the ids of a text
are the ids of its white-space words one after the other (checked against whole-text encoding in the tests).
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa

from martkit.llm.common import blobs, ragged, word_numbers, worker_cache

CACHE_WORDS = 700_000    # words kept by a worker (about 200 bytes each), besides those of the batch at hand
_JOIN = 64               # simple words encoded in one call

# Words that the normaliser below only lower-cases, and the pieces into which the expression below splits them.  Without
# apostrophes, which may begin a piece of letters, and "<", with which special tokens begin.
_LETTER = rb"[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]"
_PLAIN = re.compile(rb"(?:[!-&(-;=-~]|" + _LETTER + rb")+")
_PIECE = re.compile(rb"(?:" + _LETTER + rb")+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def plain_tokenizer(tok, path: str):
    """The tokenizer's model for lower-cased pieces of plain words set apart by spaces, without the normaliser and the
    expression that would leave them as they are; None if the file has others."""
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if (spec["normalizer"], spec["pre_tokenizer"]) != (_NORMALIZER, _SPLIT) or any(
            a["content"][:1] != "<" for a in spec["added_tokens"]):
        return None
    out = Tokenizer(tok.model)
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


class _Numbers(dict):
    """Numbers of words in the order they are met; ``new`` holds those that came since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Ids of words, kept by the words themselves.

    When CACHE_WORDS is passed, the words stay that were met again after the texts that brought them, or since the last time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.plain = plain_tokenizer(self.tok, path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.is_end = np.zeros(self.size, dtype=bool)
        for piece, i in vocab.items():
            self.is_end[i] = piece.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.at = np.zeros(1024, dtype=np.int64)
        self.n = np.zeros(1024, dtype=np.int32)
        self.again = np.zeros(1024, dtype=bool)
        self.known = 0
        self.pool = np.zeros(1024, dtype=np.uint32)
        self.used = 0

    def _forget(self) -> None:
        """Keep the words that were met again; all go if these are more than half of CACHE_WORDS."""
        keep = np.flatnonzero(self.again[:self.known])
        if len(keep) > CACHE_WORDS // 2:
            self.clear()
            return
        numbers = _Numbers()
        numbers.update(zip(compress(self.numbers, self.again[:self.known].tolist()), range(len(keep)), strict=True))
        n = self.n[keep]
        pool = self.pool[ragged(self.at[keep], n)]
        self.clear()
        self.numbers, self.known, self.pool, self.used = numbers, len(keep), pool, len(pool)
        self.at, self.n, self.again = np.cumsum(n, dtype=np.int64) - n, n, np.zeros(len(keep), dtype=bool)

    def _store(self, ids: np.ndarray) -> int:
        """Add ids to the pool; the place of the first."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), dtype=np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _many(self, tok, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts, one after the other, and where each begins (n+1)."""
        lists = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        offs = np.append(0, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists))))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(offs[-1])), offs

    def _together(self, tok, words: np.ndarray, groups: list[str], marks: np.ndarray) -> np.ndarray:
        """Ids of the words of these numbers, _JOIN to a group, cut at the word-end pieces, of which each word has
        ``marks``; gives the numbers of the words in groups whose cuts do not add up."""
        starts = np.arange(0, len(words), _JOIN)
        ids, offs = self._many(tok, groups)
        is_end = self.is_end[ids]
        upto = np.append(0, np.cumsum(is_end))
        fine = (upto[offs[1:]] - upto[offs[:-1]] == np.add.reduceat(marks, starts)) & (np.diff(offs) > 0)
        fine &= is_end[np.maximum(offs[1:] - 1, 0)]
        group = np.arange(len(words)) // _JOIN
        took = np.cumsum(marks)
        took -= (took[starts] - marks[starts])[group]  # marks of the group up to and with the word
        ok = np.flatnonzero(fine[group])
        stop = np.flatnonzero(is_end) + 1
        last = np.zeros(len(words), np.int64)
        last[ok] = stop[upto[offs[:-1]][group[ok]] + took[ok] - 1]
        first = np.where(np.arange(len(words)) % _JOIN, np.append(0, last[:-1]), offs[:-1][group])
        where = self._store(ids)
        self.at[words[ok]] = where + first[ok]
        self.n[words[ok]] = last[ok] - first[ok]
        return words[~fine[group]]

    def _learn(self, words: list[bytes]) -> None:
        """Ids of words that got the next numbers.

        Plain words, and others of letters with one closing mark at most, are encoded _JOIN to a call and cut at the
        word-end pieces; a group whose cuts do not add up is encoded one by one, like all other words.
        """
        base, end = self.known, self.known + len(words)
        if end > len(self.n):
            more = max(end - len(self.n), len(self.n))
            self.at, self.n, self.again = (np.concatenate([x, np.zeros(more, x.dtype)])
                                           for x in (self.at, self.n, self.again))
        self.known = end
        odd, left = [], range(len(words))
        if self.plain is not None:
            plain = [i for i, w in enumerate(words) if w.isalpha() or _PLAIN.fullmatch(w)]  # bytes: ASCII letters
            left = sorted(set(left).difference(plain))
            if plain:
                pieces = [[w] if w.isalpha() else _PIECE.findall(w) for w in (words[i] for i in plain)]
                marks = np.fromiter(map(len, pieces), np.int64, len(pieces))
                groups = [b" ".join(chain.from_iterable(pieces[g:g + _JOIN])).decode().lower()
                          for g in range(0, len(pieces), _JOIN)]
                odd += self._together(self.plain, np.array(plain) + base, groups, marks).tolist()
        texts = {i: words[i].decode("utf-8") for i in left}
        simple, marks = [], []  # word-end pieces that a simple word has
        for i, w in texts.items():
            n = 1 if w.isalpha() else 2 if w[-1] in ".,;:!?" and w[:-1].isalpha() else 0
            if n:
                simple.append(i)
                marks.append(n)
            else:
                odd.append(base + i)
        if simple:
            groups = [" ".join([texts[i] for i in simple[g:g + _JOIN]]) for g in range(0, len(simple), _JOIN)]
            odd += self._together(self.tok, np.array(simple) + base, groups, np.array(marks)).tolist()
        if odd:
            ids, offs = self._many(self.tok, [words[i - base].decode("utf-8") for i in odd])
            odd = np.array(odd)
            self.at[odd] = self._store(ids) + offs[:-1]
            self.n[odd] = np.diff(offs)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and, per text, the index of its first id (n+1)."""
        if len(self.numbers) > CACHE_WORDS:
            self._forget()
        code, first = word_numbers(blobs(col), self.numbers.__getitem__, np.int32)
        self.again[code[code < self.known]] = True
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        n = self.n[code]
        ids = self.pool[ragged(self.at[code], n)]
        upto = np.zeros(len(n) + 1, dtype=np.int64)
        np.cumsum(n, out=upto[1:])
        return ids, upto[first]


def encoder(path: str) -> WordEncoder:
    return worker_cache((WordEncoder, path), lambda: WordEncoder(path))
