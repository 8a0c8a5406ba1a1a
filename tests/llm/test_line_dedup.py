import collections
import random

import numpy as np
import pytest

from martkit.llm import line_dedup
from martkit.llm.perfect_hash import PerfectHash
from tests.llm.util import HARD, empty, hard_docs

UPPER = {i: i + 32 for i in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(rows, min_chars, min_docs):
    held = collections.Counter()
    last = {}
    for d, t in rows:
        if d is not None:
            for k in {key(x) for x in (t or "").split("\n")}:
                held[k] += 1
                last[k] = max(last.get(k, d), d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < min_chars or held[key(x)] < min_docs or last[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("held", [line_dedup.HELD_LINES, 7])
def test_against_brute_force(spark, held):
    rng = random.Random(3)
    pool = [f"a line that many documents hold, number {i}" for i in range(30)] + [
        "ÀÉÎ ünïcødé line of twenty-five", "ÀÉÎ ünïcødé line of twe", "short", "", "   ", "x" * 20, "é" * 20, "é" * 19]
    pool += [f"\t{x.upper()}\x0b " for x in pool[:15]]
    rows = [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(120)]
    # a line that a third of the documents hold, more often than an 8-bit count can say
    rows += [(1000 + i, f"the hot line of all documents\nown line of document {i}, not repeated") for i in range(400)]
    docs = hard_docs(spark).unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    for min_chars, min_docs in ((20, 3), (1, 2), (20, 255)):
        got = rows_of(line_dedup.drop_repeated_lines(docs.repartition(5), min_chars, min_docs, held_lines=held))
        assert got == brute(HARD + rows, min_chars, min_docs)


def test_empty_and_all_dropped(spark):
    docs = hard_docs(spark)
    assert line_dedup.drop_repeated_lines(empty(docs)).count() == 0
    line = "exactly the same line in every document"
    got = rows_of(line_dedup.drop_repeated_lines(spark.createDataFrame(
        [(i, line) for i in (1, 2, 3)], "doc_id long, text string")))
    assert got == [(1, 1, 1, ""), (2, 1, 1, ""), (3, 1, 0, line)]
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(docs, min_docs=256)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (2, n), dtype=np.uint64)
    if n > 2:
        keys[1, :n // 2] = 7  # halves that repeat
    index = PerfectHash(**PerfectHash.build(keys[0], keys[1]))
    assert sorted(index.slots(keys[0], keys[1]).tolist()) == list(range(n))
    bits = 64 * (len(index.bits) + len(index.rank))
    assert n < 1000 or bits < 8 * n
    other = index.slots(keys[0] ^ np.uint64(1 << 63), keys[1])
    assert ((other >= -1) & (other < max(n, 1))).all()


def test_probe_refuses_another_corpus(spark, tmp_root):
    docs = spark.createDataFrame([(i, f"line number {i % 4} of this corpus") for i in range(40)], "doc_id long, text string")
    line_dedup.drop_repeated_lines(docs, folder=tmp_root).collect()
    import glob

    index = line_dedup.LineIndex(sorted(glob.glob(tmp_root + "/*.trie"))[0])
    foreign = np.zeros(50, line_dedup._KEY)
    foreign["high"], foreign["low"] = np.arange(50), np.arange(50) * 977
    with pytest.raises(ValueError):
        index.probe(foreign, 3)
