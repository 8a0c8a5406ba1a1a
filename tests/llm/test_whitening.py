import math

import numpy as np
import pytest

from martkit.llm import symmetric_eigen as se
from martkit.llm import whitening


def matrices():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 8, 40):
        a = rng.standard_normal((n, n))
        yield a + a.T
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    yield q @ np.diag([5.0] * 6 + [3.0, 3.0 + 1e-13] + [1.0] * 22) @ q.T   # repeated and nearly repeated values
    yield q @ np.diag(10.0 ** -np.arange(30)) @ q.T                        # of very different sizes
    yield np.diag(np.arange(12.0))
    yield np.eye(9)
    yield np.zeros((5, 5))
    w = np.diag(np.abs(np.arange(-10.0, 11.0))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield w                                                                # pairs that agree to many digits
    yield 1e150 * (q + q.T)


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: str(len(a)))
def test_leading_eigenpairs(a):
    a = (a + a.T) / 2
    k = min(8, len(a))
    values, rows = se.leading_eigenpairs(a, 8)
    norm = max(np.abs(a).max() * len(a), 1e-300)
    want = np.linalg.eigvalsh(a / norm)[::-1][:k]
    assert np.allclose(values / norm, want, rtol=0, atol=1e-14)
    assert np.allclose(rows @ rows.T, np.eye(k), atol=1e-12)
    assert np.abs((a / norm) @ rows.T - rows.T * (values / norm)).max() < 1e-13


def test_sturm_counts_are_numbers_of_smaller_eigenvalues():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(15), rng.standard_normal(14)
    e[5] = 0.0
    own = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    x = np.linspace(-5, 5, 101)
    assert se.sturm_count(d, e, x).tolist() == [(own < v).sum() for v in x]


def brute(rows, k=8):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in good]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array([[c - t / n for c, t in zip(r, s, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True)) for r in x]
    return [i for i, _ in good], deviation, y @ vectors / np.sqrt(values), values / np.trace(y.T @ y / n)


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.selectExpr("*", "'x' AS vec", "1 AS n", "2 AS i", "3 AS width")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    mix = rng.standard_normal((12, 12))
    rows = [(i, np.float32(rng.standard_normal(12) @ mix).tolist()) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(150)]  # one vector a third of all
    bad = [(900, None), (901, []), (902, [None] + rows[1][1][1:]), (903, [float("nan")] + rows[1][1][1:]),
           (904, [float("inf")] + rows[1][1][1:]), (905, rows[2][1][:5]), (None, rows[3][1])]
    got = whitening.whiten(frame(spark, rows + bad, kind).repartition(6)).collect()
    ids, deviation, white, explained = brute(rows + [(None, rows[3][1])])
    assert len(got) == 8 * len(ids)
    at = {i: k for k, i in enumerate(ids)}
    sign = np.zeros(8)
    for r in got:
        k, c = at[r.vec_id], r.component - 1
        assert r.n == len(ids) and r.deviation == deviation[k]
        sign[c] = sign[c] or np.sign(white[k, c] * r.whitened)
        assert abs(r.whitened * sign[c] - white[k, c]) < 1e-8
        assert abs(r.explained / explained[c] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_flat_few_and_no_rows(spark):
    df = frame(spark, [(1, [1.0, 2.0, 3.0])])
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    line = frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)])  # one direction only
    got = whitening.whiten(line).collect()
    assert len(got) == 10 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    far = frame(spark, [(1, [1e9, 1.0]), (2, [-1e9, 2.0]), (3, [1e300, 3.0]), (4, [5.0, 3.0])], "double")
    got = {r.vec_id: r for r in whitening.whiten(far).collect()}
    assert set(got) == {1, 2, 4} and got[1].deviation is None  # does not fit a long


def test_offset_does_not_cancel(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (1e6 + rng.standard_normal(6) * 0.01).tolist()) for i in range(200)]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    _, deviation, white, _ = brute(rows)
    one = [r for r in got if r.component == 1]
    assert [r.deviation for r in sorted(one, key=lambda r: r.vec_id)] == deviation
    assert np.allclose(np.abs([r.whitened for r in sorted(one, key=lambda r: r.vec_id)]), np.abs(white[:, 0]), atol=1e-6)
