import collections
import math
import random
import zlib

import pytest

from martkit.llm import ngram_lm
from martkit.llm.queries import QUERIES
from tests.llm.util import HARD, empty, hard_docs


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def brute(rows, order):
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    c = [collections.Counter() for _ in range(3)]
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            w = tokens(t)
            c[0].update(w)
            c[1].update(zip([b"\n", *w], w))
            c[2].update(zip([b"\n", *w], w, w[1:]))
    n, v, k = sum(c[0].values()), len(c[0]), ngram_lm.KAPPA
    out = []
    for d, t in rows:
        w, total = tokens(t), 0.0
        for i, x in enumerate(w):
            p = (c[0][x] + 0.1) / (n + 0.1 * (v + 1))
            last = w[i - 1] if i else b"\n"
            p = (c[1][last, x] + k * p) / (c[0][last] + k)
            if order == 3 and i:
                pair = (w[i - 2] if i > 1 else b"\n", last)
                p = (c[2][*pair, x] + k * p) / (c[1][pair] + k)
            total += math.log10(p)
        out.append((d or -1, len(w), total))
    return sorted(out)


@pytest.mark.parametrize("order", [2, 3])
def test_orders_against_brute_force(spark, order):
    rng = random.Random(11)
    words = "aB c the The of x1 é".split()
    more = [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    more += [(300, "a b a c"), (301, "y z " * 600), (302, "c a b a")]  # counts over 255
    docs = hard_docs(spark).unionByName(spark.createDataFrame(more, "doc_id long, text string"),
                                        allowMissingColumns=True)
    got = sorted((r.doc_id or -1, r.n_tokens, r.score) for r in ngram_lm.score_texts(docs, order=order).collect())
    for g, x in zip(got, brute([*HARD, *more], order), strict=True):
        assert g[:2] == x[:2] and abs(g[2] - x[2]) < 2 / ngram_lm.STEPS * x[1]


def test_context_beyond_the_previous_word_counts(spark):
    only = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(i, "p q r" if i % 2 else "s q t") for i in range(200)] + [(only, "p q r"), (None, "s q r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, other = (ngram_lm.score_texts(docs, order=3).where(x).first().score for x in (
        f"doc_id = {only}", "doc_id IS NULL"))
    assert seen > other + 0.5


def test_the_query_is_of_order_three(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((r.doc_id or -1, r.n_tokens, r.score) for r in QUERIES["op2_ngram_trie"](spark, sf).collect())
    for g, x in zip(got, brute(rows, 3), strict=True):
        assert g[:2] == x[:2] and abs(g[2] - x[2]) < 2 / ngram_lm.STEPS * x[1]


def test_edges(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(held, "some text")], "doc_id long, text string")
    assert ngram_lm.score_texts(docs, order=3).first()[1:] == (True, 3, 0, 0, 0.0, 0.0)
    assert ngram_lm.score_texts(empty(docs), order=3).count() == 0
    with pytest.raises(ValueError):
        ngram_lm.score_texts(docs, order=4)
