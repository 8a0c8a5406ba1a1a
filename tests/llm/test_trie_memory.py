"""A task's memory does not grow with the trie: sequences are read in place, shards are built in blocks."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from martkit.llm import ngram_lm as lm
from martkit.llm.common import U64
from martkit.llm.elias_fano import EliasFano


def _peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("n", [1 << 18, 1 << 21])
def test_a_mapped_sequence_is_read_without_a_copy(tmp_path, n):
    v = np.cumsum(np.random.default_rng(n).integers(1, 1000, n, dtype=np.uint64))
    uri = lm.write_arrays(str(tmp_path), "x", lm._flat(x=EliasFano.encode(v, int(v[-1]) + 1)), {})
    some = np.sort(np.random.default_rng(1).integers(0, n - 1, 50))

    def read():
        e = lm._sequence(lm.map_arrays(uri)[0], "x")
        return e.access(some), *e.access_next(some), *e.find(v[some])

    read()
    (own, also, after, at, hit), peak = _peak(read)
    assert (own == v[some]).all() and (also == own).all() and (after == v[some + 1]).all()
    assert hit.all() and (at == some).all()
    assert peak < 1 << 16  # n / 2^6 words and their directories would take more


def test_a_sequence_without_a_directory_that_it_does_not_need():
    v = np.arange(0, 90_000, 7, dtype=np.uint64)
    e = EliasFano(**EliasFano.encode(v, 90_000, EliasFano.SEARCH))
    assert e.ones is None and e.find(v)[1].all() and not e.find(v + U64(1))[1].any()
    e = EliasFano(**EliasFano.encode(v, 90_000, EliasFano.ACCESS))
    assert e.zeros is None and (e.access(np.arange(len(v))) == v).all()


def test_parts_are_merged_by_ranges(monkeypatch):
    rng = np.random.default_rng(3)
    parts = []
    for size in (0, 1, 700, 5000, 64):
        keys = np.unique(rng.integers(0, 4000, size, dtype=np.uint64) * U64(1 << 50))
        parts.append((keys, rng.integers(1, 9, len(keys)), (keys >> U64(50)).astype(np.uint16)[:, None]))
    keys, n, side = (np.concatenate(x) for x in zip(*parts, strict=True))
    want = lm.count(keys, n, side)
    for rows in (1 << 17, 100, 7):
        monkeypatch.setattr(lm, "MERGE_ROWS", rows)
        for a, b in zip(lm._merged(list(parts)), want, strict=True):
            assert a.dtype == b.dtype and a.shape == b.shape and (a == b).all()
        assert lm._merged([(k, c, None) for k, c, _ in parts])[2] is None


def _rows(grams, words, tasks=4):
    """Packed rows of one shard; every task has most of its n-grams."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, (words << 20) - 1, grams, dtype=np.uint64))
    for _ in range(tasks):
        held = lm.Packed(lambda k: np.zeros(len(k), np.int64))
        held.parts.append((k := keys[rng.random(len(keys)) < 0.8], rng.integers(1, 300, len(k)), None))
        held.rows = len(k)
        yield from held.send()


def test_a_shard_is_built_in_little_more_than_its_rows(tmp_path):
    words, grams = 1 << 10, 300_000
    # every word as often as it is numbered
    hashes = np.arange(words, dtype=np.uint64) << U64(54)
    held = lm.Packed(lambda k: np.zeros(len(k), np.int64))
    list(held.add(hashes, None, np.arange(1, words + 1)))
    entry = [tuple(c[0].as_py() for c in b.columns) for b in lm._write_words(str(tmp_path), 1)(held.send())]
    rows = list(_rows(grams, words))
    run = lm._write_grams(str(tmp_path), "pairs", (entry, 1), 1 << 20, False)
    monkey = pytest.MonkeyPatch()
    monkey.setattr(lm.Vocabulary, "counts", lambda self, ids: ids % words + 1)
    try:
        (out,), peak = _peak(lambda: list(run(iter(rows))))
    finally:
        monkey.undo()
    size = out.column("grams")[0].as_py()
    assert peak < 100 * size
    # all are found, with the counts of all tasks
    n = {}
    for b in rows:
        k, c, _ = lm.Packed.read(b.column("n")[0].as_py(), b.column("body")[0].as_py())
        for key, x in zip(k.tolist(), c.tolist(), strict=True):
            n[key] = n.get(key, 0) + x
    keys = np.array(sorted(n), U64)
    place, prob, back = lm.Grams([(0, out.column("uri")[0].as_py(), size)], 1, words).find(keys)
    c = np.array([n[k] for k in keys.tolist()])
    unigram = (keys % U64(words) + U64(1) + 0.1) / (words * (words + 1) / 2 + 0.1 * (words + 1))
    context = (keys // U64(words) % U64(words)).astype(float) + 1
    assert size == len(keys) and (np.sort(place) == np.arange(size)).all()
    # steps and single precision
    assert (np.abs(prob + np.log10(np.minimum((c + 20 * unigram) / (context + 20), 1)) * lm.STEPS) <= 0.51).all()
    assert (np.abs(back - np.log10((c + 20) / 20) * lm.STEPS) <= 0.51).all()


def test_slices_taken_together_score_the_same(tmp_path, monkeypatch):
    texts = ["a b a c", None, "", "b  a\tB zz", "a b a c", "never seen", "zz c a b a b zz", "x"]
    held = [False, False, True, False, False, True, True, False]
    monkeypatch.setattr(lm, "TEXT_BYTES", 8)
    batch = pa.RecordBatch.from_arrays([pa.array([3, None, 5, 7, 7, 9, 11, 12], pa.int64()), pa.array(texts),
                                        pa.array(held)], names=["doc_id", "text", "held_out"])
    rows = list(lm._spell(iter([batch])))
    assert len(rows) > 3

    def dealt(run):
        out = [b.slice(i, 1) for b in run(iter(rows)) for i in range(b.num_rows)]
        return iter(sorted(out, key=lambda b: b.column(0)[0].as_py()))

    def manifest(batches):
        return sorted(tuple(c[0].as_py() for c in b.columns) for b in batches)

    def scores():
        vocab = manifest(lm._write_words(str(tmp_path), 2)(dealt(lm._count_words(2)))), 2
        levels, contexts = [], sum(r[2] for r in vocab[0])
        for stem in ("pairs", "triples"):
            levels.append(manifest(lm._write_grams(str(tmp_path), stem, vocab, contexts, stem == "triples", 5, *levels)(
                dealt(lm._count_grams(vocab, 5, *levels)))))
            contexts = sum(r[2] for r in levels[-1])
        return pa.Table.from_batches(list(lm._score(vocab, levels, 5)(iter(rows)))).to_pylist()

    monkeypatch.setattr(lm, "TOGETHER", 1)
    alone = scores()
    for together in (2, 3, 100):
        monkeypatch.setattr(lm, "TOGETHER", together)
        assert scores() == alone
    assert [r["doc_id"] for r in alone] == [3, None, 5, 7, 7, 9, 11, 12]
    assert [r["n_tokens"] for r in alone] == [5, 1, 1, 5, 5, 3, 8, 2]


def test_spelt_rows_are_written_as_they_are_a_few_together(spark):
    rows = spark.range(12).selectExpr("cast(repeat(cast(id AS string), 1048576) AS binary) AS names").coalesce(1)
    back = lm.materialise(rows, "spelt", lm._SPELT_FILES)
    assert sorted(len(r.names) for r in back.collect()) == [1 << 20] * 10 + [2 << 20] * 2
    file, = back.inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert meta.num_row_groups >= 4 and meta.row_group(0).column(0).compression == "UNCOMPRESSED"
