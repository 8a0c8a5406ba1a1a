"""Searches in Elias-Fano sequences: equal values only, and with one select for each."""

import numpy as np
import pytest

from martkit.llm.common import U64
from martkit.llm.elias_fano import EliasFano


@pytest.mark.parametrize("n, universe", [(1, 1), (1, 5), (3, 1 << 64), (500, 600), (500, 100_000), (5000, 1 << 40), (300, 300)])
def test_find_against_sets(n, universe):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, universe - 1, 2 * n, dtype=np.uint64, endpoint=True))[:n]
    v = np.sort(np.append(v, v[:1] + U64(1)))[:n] if len(v) < n else v
    v = np.unique(np.minimum(v, U64(universe - 1)))
    e = EliasFano(**EliasFano.encode(v, universe))
    x = np.concatenate([v, rng.integers(0, universe - 1, 1000, dtype=np.uint64, endpoint=True)])
    at, hit = e.find(x)
    assert (hit == np.isin(x, v)).all() and (v[at[hit]] == x[hit]).all()
    lo = rng.integers(0, len(v), len(x))
    hi = rng.integers(0, len(v) + 1, len(x))
    place = np.searchsorted(v, x)
    at, hit = e.find(x, lo, hi)
    assert (hit == (np.isin(x, v) & (place >= lo) & (place < hi))).all() and (at[hit] == place[hit]).all()
    at, hit = e.successor(x)
    assert (at == place).all() and (hit == np.isin(x, v)).all()


def test_runs_over_many_words_of_the_high_bits():
    v = np.concatenate([np.full(500, 7, U64), np.full(64, 9, U64)])
    e = EliasFano(**EliasFano.encode(v, 1 << 20))
    for x, at, hit in ((0, 0, False), (7, 0, True), (8, 500, False), (9, 500, True), (10, 564, False)):
        got = e.successor(np.array([x], U64))
        assert (int(got[0][0]), bool(got[1][0])) == (at, hit) and bool(e.find(np.array([x], U64))[1][0]) == hit


def test_a_search_selects_once(monkeypatch):
    v = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 20_000, dtype=np.uint64))
    e, places = EliasFano(**EliasFano.encode(v, 1 << 30)), []
    select = e._select
    monkeypatch.setattr(e, "_select", lambda k, *a: (places.append(len(k)), select(k, *a))[1])
    assert e.successor(v)[1].all()
    assert sum(places) < 1.2 * len(v)
