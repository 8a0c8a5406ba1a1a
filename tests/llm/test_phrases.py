import collections
import random
import re

import pytest

from martkit.llm import phrases
from tests.llm.util import HARD, LONG, empty, hard_docs

UPPER = {i: i + 32 for i in range(65, 91)}


def brute(rows, support, longest=5, top=2000):
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if a >= support}
        gone = {p[i:i + m] for p, a in c.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                if 100 * a >= 100 * c[p[i:i + m]]}
        found = []
        for p, a in c.items():
            if len(p) > 1 and p not in gone:
                score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s)
                for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "É", "é", "x'y", "a-b", "日本", "0", "un\xa0due", "z z"]
    seps = [" "] * 12 + ["  ", "\t", ".", ", ", "\n", "\x0b", "\r\n", "?! ", " ;"]
    rows = []
    for i in range(150):
        t = "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), t))
    return rows + [("en", "a a a a a a a a a a"), ("de", "Nur einmal hier."), ("fr", ".,;"), (None, None), ("en", "")]


@pytest.mark.parametrize("size", [phrases.SHARD_BYTES, 600])
def test_against_brute_force(spark, size):
    rows = corpus(size)
    docs = hard_docs(spark).drop("lang").selectExpr("*", "'en' AS lang", "1 AS total", "'p' AS phrase", "2 AS k").unionByName(
        spark.createDataFrame(rows, "lang string, text string"), allowMissingColumns=True)
    every = [("en", t) for _, t in HARD] + rows
    for support, top in ((12, 2000), (40, 7)):
        got = sorted(tuple(r) for r in phrases.collocations(docs.repartition(7), support, top=top, shard_bytes=size).collect())
        assert got == brute(every, support, top=top) and (got or support > 12)
    assert phrases.collocations(empty(docs)).count() == 0


def test_blocks_keep_words_and_phrases_whole():
    text = (LONG + " " + "w" * 5000 + " end\nlast").encode()
    for size in (7, 64, 1 << 20):
        was, phrases.BLOCK_BYTES = phrases.BLOCK_BYTES, size
        try:
            s = phrases.Shard("en", [text])
        finally:
            phrases.BLOCK_BYTES = was
        assert [s.words[c] if c >= 0 else b"\n" for c in s.codes.tolist()] == [
            *(w for line in text.lower().split(b"\n") for w in [*line.split(), b"\n"])]


def test_whole_numbers_beyond_64_bits(spark, monkeypatch):
    big = 9 * 10**12
    rows = [("en", 0, "", 4 * big), ("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)]
    found = spark.createDataFrame(rows, "lang string, k int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: found)
    (r,) = phrases.collocations(found).collect()
    assert r.score == 1000 * big * 4 * big // ((big + 1) * (big + 3)) and (r.l, r.r, r.n) == (big + 1, big + 3, 4 * big)
