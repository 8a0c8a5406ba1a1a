import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from martkit.llm import langid, ngram_lm
from martkit.llm.decontam import Matcher, Myers, find_leaks, normalise, remove_leaks
from martkit.llm.elias_fano import EliasFano
from tests.llm.util import HARD, LONG, empty, hard_docs


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 10), (5, 5), (100, 101), (1000, 50), (3000, 2**62)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    e = EliasFano(**EliasFano.encode(v, universe))
    assert (e.access(np.arange(n)) == v).all()
    x = np.concatenate([v, rng.integers(0, universe, 200, dtype=np.uint64)])
    at, found = e.successor(x)
    if n:
        assert (at == np.searchsorted(v, x)).all()
    assert (found == np.isin(x, v)).all()


def lm_tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def test_scores_against_brute_force(spark):
    rng = random.Random(4)
    rows = [*HARD, *((100 + i, " ".join(rng.choice("aB c the The of x1 é".split()) for _ in range(rng.randint(0, 40))))
                     for i in range(60))]
    docs = hard_docs(spark).select("doc_id", "text", "score", "held_out").unionByName(
        spark.createDataFrame(rows[len(HARD):], "doc_id long, text string"), allowMissingColumns=True)
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    assert any(held)
    c, b = collections.Counter(), collections.Counter()
    for (_, t), h in zip(rows, held, strict=True):
        if not h:
            w = lm_tokens(t)
            c.update(w)
            b.update(zip([b"\n", *w[:-1]], w))
    n, v, k = sum(c.values()), len(c), ngram_lm.KAPPA
    p1 = {w: (c[w] + 0.1) / (n + 0.1 * (v + 1)) for _, t in rows for w in lm_tokens(t)}
    want = []
    for (d, t), h in zip(rows, held, strict=True):
        w = lm_tokens(t)
        want.append((d or -1, h, len(w), sum(x in c for x in w), n, sum(math.log10(p1[x]) for x in w),
                     sum(math.log10((b[(a, x)] + k * p1[x]) / (c[a] + k)) for a, x in zip([b"\n", *w[:-1]], w))))
    got = sorted((r.doc_id or -1, *r[1:]) for r in ngram_lm.score_texts(docs).collect())
    for g, x in zip(got, sorted(want), strict=True):
        assert g[:5] == x[:5] and abs(g[5] - x[5]) < 1e-6 * x[2] and abs(g[6] - x[6]) < 2 / ngram_lm.STEPS * x[2]


def test_model_beats_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    base, score = ngram_lm.score_texts(docs).where("held_out").selectExpr("sum(base_score)", "sum(score)").first()
    assert score > base


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(only, "some text")], "doc_id long, text string")
    r = ngram_lm.score_texts(docs).first()
    assert r[1:] == (True, 3, 0, 0, 0.0, 0.0)
    assert ngram_lm.score_texts(empty(docs)).count() == 0


def brute_distance(pattern, text):
    row, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for j, c in enumerate(text, 1):
        before = row[0]
        for i, p in enumerate(pattern, 1):
            before, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, before + (p != c))
        if row[-1] < best[0]:
            best = row[-1], j
    return best


def test_myers_against_a_table():
    rng = random.Random(6)
    for _ in range(200):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 100)))
        t = t[:30] + "".join(x for x in p if rng.random() > 0.1) + t[30:]
        assert Myers(p).best(t) == brute_distance(p, t)


def test_every_occurrence_within_the_budget_is_found():
    rng = random.Random(7)
    items = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(5, 60))).strip() or "abc") for i in range(12)]
    m = Matcher(items, 0.2)
    for _ in range(150):
        i, item = rng.choice(items)
        edited = list(item)
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(edited)) if edited else 0
            edited[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "zz"])
        text = "".join(rng.choice("abcd ") for _ in range(80)) + "".join(edited) + "qq abca"
        got = {r[0]: r[1] for r in m.find(text)}
        for j, other in items:
            d, k = Myers(other).best(text)[0], int(len(other) * 0.2)
            whole = k or f" {other} " in f" {text} "
            assert got.get(j) == (d if d <= k and whole else None)


def test_leaks(spark):
    items = [(1, "Which fox, quick and brown, jumps over a lazy dog at dawn?"), (2, None), (3, "..."), (4, "x"),
             (1, "Which fox, quick and brown, jumps over a lazy dog at dawn?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    near = "WHICH fox  quick und brown jumps over a lazy dog at dwn"
    docs = hard_docs(spark).unionByName(spark.createDataFrame(
        [(50, f"{LONG} {near} {LONG}"), (51, near), (51, near), (52, "which fox, quick")], "doc_id long, text string"),
        allowMissingColumns=True)
    for size in (1 << 20, 10):
        got = sorted((r.doc_id, r.item_id, r.distance) for r in find_leaks(docs, bench, block_chars=size).collect())
        assert got == [(10, 4, 0), *[(50, 1, 2)] * 2, *[(51, 1, 2)] * 4]
    row = find_leaks(docs.where("doc_id = 50"), bench).first()
    text = normalise(f"{LONG} {near} {LONG}")
    assert text[row.start:row.end] == normalise(near)
    kept = remove_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 4
    assert find_leaks(docs, empty(bench)).count() == 0 and find_leaks(empty(docs), bench).count() == 0
    assert remove_leaks(docs, empty(bench)).count() == docs.count()


def tiny_model():
    texts = ["the cat and the dog are in the house", "le chat et le chien sont dans la maison",
             "der hund und die katze sind in dem haus"] * 6
    return langid.fit(texts, ["en", "fr", "de"] * 6)


def test_marginals_against_all_label_sequences(monkeypatch):
    m = tiny_model()
    w = langid.Words(["the dog et la maison", "", "und", None])
    score = m.emissions(w)
    for block in (2, 48):
        monkeypatch.setattr(langid, "BLOCK", block)
        p = m.marginals(score, w.doc)
        for d in range(4):
            a, z = w.doc[d], w.doc[d + 1]
            total = np.zeros((z - a, 3))
            for y in itertools.product(range(3), repeat=z - a):
                s = sum(score[a + i, k] for i, k in enumerate(y)) + sum(m.move[i, j] for i, j in zip(y, y[1:]))
                for i, k in enumerate(y):
                    total[i, k] += math.exp(s)
            if z > a:
                assert np.abs(total / total.sum(axis=1, keepdims=True) - p[a:z]).max() < 1e-9


def test_code_switched_words():
    m = tiny_model()
    labels = [x for _, x in m.label_words("the cat and the dog le chat et le chien sont dans la maison")]
    assert labels == ["en"] * 5 + ["fr"] * 9


def test_identify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select("doc_id", "lang").join(langid.identify(docs), "doc_id").where("held_out").selectExpr(
        "avg(CAST(lang = lang_pred AS DOUBLE))", "min(score)", "max(score)").first()
    assert got[0] > 0.97 and 0 <= got[1] and got[2] <= 1


def test_identify_hard_rows(spark):
    docs = hard_docs(spark)
    rows = langid.identify(docs).collect()  # no label at all
    assert len(rows) == len(HARD) and {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    train = [(200 + i, t, x) for i, (t, x) in enumerate(zip(["the cat and the dog", "le chat et le chien"] * 12,
                                                            ["en", "fr"] * 12, strict=True))]
    both = docs.drop("lang").unionByName(spark.createDataFrame(train, "doc_id long, text string, lang string"),
                                         allowMissingColumns=True)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(both).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (200, "en"), (201, "fr")} <= got
    kept = langid.keep_known(both)
    assert kept.columns == both.columns
    assert not {1, 2, 3} & {r.doc_id for r in kept.select("doc_id").collect()}
    assert langid.identify(empty(both)).count() == 0


def test_labels_and_ids_are_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = langid.fit_sample(docs, ~langid.held_out())
    texts = [r.text for r in docs.limit(20).collect()]
    assert m.predict(texts) == m.predict(list(texts)) and pa.array(texts).null_count == 0
