"""The language model splits and hashes words once; the passes after that read numbers."""

import numpy as np
import pyarrow as pa

from martkit.llm import ngram_lm as lm

TEXTS = ["a b a c", None, "", "b  a\tB zz", "a b a c", "never seen"]
HELD = [False, False, True, False, False, True]


def _batch() -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([3, None, 5, 7, 7, 9], pa.int64()), pa.array(TEXTS), pa.array(HELD)],
                                      names=["doc_id", "text", "held_out"])


def test_spelt_tokens_come_back_and_held_out_ones_are_not_learned():
    rows = list(lm._spell(iter([_batch()])))
    (doc_id, held, names, code, first), = lm.spelt(iter(rows))
    want, at = lm.tokens(pa.array(TEXTS))
    assert doc_id.to_pylist() == [3, None, 5, 7, 7, 9] and held.to_pylist() == HELD
    assert (names[code] == want).all() and (first == at).all()
    (_, _, names, code, first), = lm.spelt(iter(rows), train=True)
    want, at = lm.tokens(pa.array([t for t, h in zip(TEXTS, HELD, strict=True) if not h]))
    assert (names[code] == want).all() and (first == at).all()
    only = [b.set_column(1, "held_out", pa.array([[True] * 6])) for b in rows]
    assert not list(lm.spelt(iter(only), train=True))


def test_passes_do_not_hash_words_again(tmp_path, monkeypatch):
    rows = list(lm._spell(iter([_batch()])))

    def again(*_):
        raise AssertionError("words are hashed again")

    monkeypatch.setattr(lm, "word_hashes", again)

    def dealt(run):
        out = [b.slice(i, 1) for b in run(iter(rows)) for i in range(b.num_rows)]
        return iter(sorted(out, key=lambda b: b.column(0)[0].as_py()))

    def manifest(batches):
        return sorted(tuple(c[0].as_py() for c in b.columns) for b in batches)

    vocab = manifest(lm._write_words(str(tmp_path), 3)(dealt(lm._count_words(3)))), 3
    size = sum(r[2] for r in vocab[0])
    levels, contexts = [], size
    for stem in ("pairs", "triples"):
        levels.append(manifest(lm._write_grams(str(tmp_path), stem, vocab, contexts, stem == "triples", 3, *levels)(
            dealt(lm._count_grams(vocab, 3, *levels)))))
        contexts = sum(r[2] for r in levels[-1])
    out = pa.Table.from_batches(list(lm._score(vocab, levels, 3)(iter(rows))))
    count = {"a": 5, "b": 4, "c": 2, "zz": 1, "": 4}
    n, v = sum(count.values()), len(count)
    words = [[*(t or "").lower().split(), ""] for t in TEXTS]
    want = [sum(np.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for ws in words]
    np.testing.assert_allclose(out["base_score"].to_numpy(), want, rtol=1e-12)
    assert out["n_known"].to_pylist() == [sum(w in count for w in ws) for ws in words]
    assert out["train_tokens"].to_pylist() == [n] * 6
