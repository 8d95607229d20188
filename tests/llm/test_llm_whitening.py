import math

import numpy as np
import pytest

from roamsight.llm import whitening
from roamsight.llm.common import table
from roamsight.llm.queries import op11_secular_whitening


def close(found, matrix):
    """The spectrum is that of the matrix, and its vectors are orthogonal."""
    size = len(matrix)
    scale = max(np.abs(matrix).max(), 1e-300)
    assert np.abs(found.vectors.T @ found.vectors - np.eye(size)).max() < 1e-12
    assert np.abs((found.vectors * found.values) @ found.vectors.T - matrix).max() < 1e-11 * scale
    assert (np.diff(found.values) >= 0).all()


def scatter(x):
    x = x - x.mean(0)
    return x.T @ x


def of(x):
    found = whitening.Spectrum(x.shape[1])
    for row in x:
        found.add(row)
    return found


def test_secular_roots():
    poles, z = np.array([1.0, 2.0, 2.0 + 1e-9, 5.0]), np.array([0.5, 1e-3, 2.0, 1.0])
    roots, apart = whitening.secular_roots(poles, z)
    assert (roots[:-1] > poles[:-1]).all() and (roots[:-1] < poles[1:]).all() and roots[-1] > poles[-1]
    expected = np.linalg.eigvalsh(np.diag(poles) + np.outer(z, z))
    assert np.abs(roots - expected).max() < 1e-14 * 10
    assert np.abs(apart - (poles[:, None] - roots)).max() < 1e-14


@pytest.mark.parametrize("seed", range(12))
def test_spectrum_follows_its_rows(seed):
    rng = np.random.default_rng(seed)
    n, d = rng.integers(1, 60), rng.integers(1, 12)
    x = rng.standard_normal((n, d)) * rng.choice([1e-3, 1, 1e4])
    kind = seed % 4
    if kind == 1:  # few different rows
        x = x[rng.integers(0, min(3, n), n)]
    if kind == 2:  # whole numbers, many ties between eigenvalues
        x = np.round(rng.standard_normal((n, d)))
    if kind == 3:  # fewer directions than entries
        x[:, 1:] = x[:, :1]
    close(of(x), scatter(x))
    cut = rng.integers(0, n + 1)
    first, second = of(x[:cut]), of(x[cut:])
    first.merge(second)
    assert first.n == n
    close(first, scatter(x))
    assert np.abs(first.mean - x.mean(0)).max() <= 1e-12 * np.abs(x).max()


def brute(vectors):
    """Per row: whitened components, deviation; shares of the variance."""
    x = np.array([[math.floor(float(np.float32(c)) * 1024) + 100_000 for c in v] for v in vectors])
    n, total = len(x), x.sum(0)
    apart = n * x - total
    centred = apart / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    return centred @ directions / np.sqrt(values), (apart**2).sum(1), values / values.sum()


def test_registered_query_against_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    assert all(r.embedding and None not in r.embedding for r in rows)
    expected, deviation, share = brute([r.embedding for r in rows])
    found = op11_secular_whitening(spark, sf_dir).toPandas()
    assert len(found) == 8 * len(rows) and set(found.n) == {len(rows)}
    place = {r.vec_id: i for i, r in enumerate(rows)}
    assert (found.deviation == [deviation[place[v]] for v in found.vec_id]).all()
    assert found.identity_error.nunique() == 1 and 0 <= found.identity_error[0] < 1e-10
    for k, part in found.groupby("component"):
        theirs = expected[[place[v] for v in part.vec_id], k - 1]
        sign = np.sign(theirs @ part.whitened)
        assert np.abs(part.whitened * sign - theirs).max() < 1e-8
        assert np.abs(part.explained / share[k - 1] - 1).max() < 1e-10


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_dirty_rows(spark, clashing):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 0.5], 0), (2, [0.0, 1.0, 3.0], None), (2, [0.0, 1.0, 3.0], None), (None, [5.0, 4.0, 1.0], 1), (4, [2.0, 2.0], 1)]
    bad = [(5, None, 0), (6, [1.0, None, 2.0], 0), (7, [1.0, nan, 2.0], 0), (8, [inf, 1.0, 2.0], 0)]
    df = clashing(vectors(spark, good + bad), "x", "whitened", "n", "values")
    done, model = whitening.whiten(df)
    rows = done.collect()
    expected, deviation, share = brute([v if len(v) == 3 else [*v, 0.0] for _, v, _ in good])
    assert sorted((r.vec_id or 0, r.deviation) for r in rows) == sorted(zip([1, 2, 2, 0, 4], deviation.tolist(), strict=True))
    assert {r.x for r in rows} == {"extra x"} and model.n == 5 and np.abs(model.explained / share - 1).max() < 1e-9
    found = np.array([r.whitened for r in sorted(rows, key=lambda r: (r.vec_id is None, r.vec_id))])[:, 0]
    theirs = expected[[0, 1, 2, 4, 3], 0]
    assert min(np.abs(found - theirs).max(), np.abs(found + theirs).max()) < 1e-9


def test_tables_without_variance(spark):
    df = vectors(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])
    for frame in (df, df.limit(1), df.limit(0), vectors(spark, [(1, [], 0), (2, None, 0)])):
        done, model = whitening.whiten(frame)
        assert len(model.values) == 0 and all(r.whitened is None for r in done.collect())
    line = vectors(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)])
    done, model = whitening.whiten(line)  # one direction only
    assert len(model.values) == 1 and abs(model.explained[0] - 1) < 1e-12 and model.identity_error < 1e-9


def test_huge_entries(spark):
    done, model = whitening.whiten(vectors(spark, [(1, [3e38, 1.0], 0), (2, [0.0, -3e38], 0), (3, [1.0, 2.0], 0)]))
    assert model.identity_error < 1e-6
    limit = whitening.LARGEST
    x = [(limit + 100_000, 101_024), (100_000, 100_000 - limit), (101_024, 102_048)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((3 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert {r.vec_id: r.deviation for r in done.collect()} == {i + 1: v if v < 1 << 63 else None for i, v in enumerate(exact)}


def test_many_partitions_are_combined_in_rounds(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (300, 4))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<bigint>").repartition(40)
    found = whitening.spectrum(df, 4, 300, x.sum(0))
    assert found.n == 300
    close(found, scatter(x.astype(float)))
