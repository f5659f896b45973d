import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycheck.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>"


def check(spark, rows, most=16, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row", "x", "index", "vector", "n")})
    found, fit = whiten(df, most=most, **options)
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["deviation"], r["whitened"]))
    good = [(i, v) for i, v in rows if v and not any(c is None or not np.isfinite(c) or abs(c) > 2.0**46 for c in v)]
    sizes = [len(v) for _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, v) for i, v in good if len(v) == size]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in good], dtype=object)
    fits = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, s = len(fits), fits.sum(axis=0)
    centred = ((n * fits - s) / n).astype(float)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = len(fit.variances)
    assert fit.n == n and fit.sums.tolist() == s.tolist() and k <= min(most, size)
    assert np.allclose(fit.variances, e[:k], rtol=1e-9) and np.allclose(fit.explained, e[:k] / e.sum(), rtol=1e-6)
    assert fit.identity_error < 1e-6
    want = {}
    for (i, _), row in zip(good, x):
        off = n * row - s
        want.setdefault(i, []).append((int((off * off).sum()), (off / n).astype(float) @ fit.vectors / np.sqrt(fit.variances)))
    assert set(got) == set(want)
    for i, rows_ in want.items():
        assert len(rows_) == len(got[i])
        for (a, y), (b, z) in zip(sorted(rows_, key=lambda t: t[0]), sorted(got[i], key=lambda t: t[0])):
            assert a == b and np.allclose(y, z, atol=1e-8)
    return fit


def vectors(n, d, seed=1):
    r = np.random.default_rng(seed)
    return [[float(c) for c in v] for v in r.normal(size=(n, d)) * np.arange(1, d + 1)]


def test_against_numpy(spark):
    rows = list(enumerate(vectors(300, 6)))
    nan, inf = float("nan"), float("inf")
    rows += [(900, None), (901, []), (902, [1.0, None, 0, 0, 0, 0]), (903, [nan] * 6), (904, [inf] + [0.0] * 5),
             (905, [1e300] + [0.0] * 5), (906, [1.0, 2.0]), (None, rows[0][1]), (907, rows[0][1]), (907, rows[0][1])]
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows]
    assert len(check(spark, rows).variances) == 6
    assert len(check(spark, rows, most=2, block_entries=60).variances) == 2  # blocks of ten rows


def test_vector_with_a_third_of_the_rows_counts_once(spark):
    some = vectors(60, 3, 4)
    check(spark, [(k, some[0] if k % 3 == 0 else some[k % 60]) for k in range(300)])


def test_components_without_variance_are_left_out(spark):
    rows = [(k, [float(k % 7), 2.0 * (k % 7), 5.0]) for k in range(40)]
    assert len(check(spark, rows).variances) == 1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_fit(spark, rows):
    found, fit = whiten(spark.createDataFrame(rows, SCHEMA))
    assert fit is None and found.count() == 0
