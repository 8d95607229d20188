import math
import time

import numpy as np
import pytest

from roamsight.llm import itq
from roamsight.llm.common import table
from roamsight.llm.queries import op3_quantisation

SHAPE = "vec_id bigint, embedding array<float>, label int"


def naive(rows, least):
    """Links between all pairs of equal label, in double precision."""

    def fits(vector, label):
        return label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)

    links = {i: set() for i in range(len(rows))}
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if fits(a, la) and fits(b, lb) and la == lb and len(a) == len(b):
                u, v = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                u, v = u / np.abs(u).max(), v / np.abs(v).max()
                if u @ v / math.sqrt((u @ u) * (v @ v)) >= least:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        smallest = min(ids, default=None)
        out.append((rows[i][0], len(links[i]), smallest, rows[i][0] is not None and rows[i][0] == smallest))
    return out


def clusters(n, size, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        centre = rng.standard_normal(size)
        for _ in range(rng.integers(1, 6)):
            noise = rng.standard_normal(size) * rng.choice([0, 0.05, 0.12, 0.2])
            rows.append((len(rows), (centre + noise).astype(np.float32).tolist(), int(rng.integers(0, 2))))
    return rows


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("size", [64, 128, 3])
def test_recall_and_precision(spark, size):
    rows = clusters(150 if size > 3 else 12, size, 5)
    got = {r.id: r for r in itq.near_duplicates(spark.createDataFrame(rows, SHAPE)).collect()}
    true = {r[0]: r for r in naive(rows, 0.98)}
    found, wanted = sum(r.n_links for r in got.values()), sum(r[1] for r in true.values())
    assert all(got[i].n_links <= true[i][1] for i in got)  # none below the threshold
    assert wanted > 0 and found >= 0.95 * wanted


def test_codes_are_balanced():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((2000, 32)) * np.linspace(0.2, 3, 32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    mean, projection = itq.learn(vectors)
    ones = ((vectors - mean) @ projection >= 0).mean(0)
    assert projection.shape == (32, itq.BITS) and (abs(ones - 0.5) < 0.1).all()


def test_dirty_rows(spark, clashing):
    v, w = [1.0, 2.0, 3.0], [-1.0, 0.5, 2.0]
    nan, inf = float("nan"), float("inf")
    rows = [
        (7, v, 1), (3, v, 1), (3, v, 1), (5, v, 2), (6, v, None), (None, v, 1), (8, None, 1), (9, [], 1), (10, [0.0, 0.0, 0.0], 1),
        (11, [1.0, None, 3.0], 1), (12, [nan, 1.0, 1.0], 1), (13, [inf, 1.0, 1.0], 1), (14, [1.0, 2.0], 1), (15, [2.0, 4.0, 6.0], 1),
        (16, w, 1), (17, [-0.0, 1.0, 0.0], 3), (18, [0.0, 1.0, 0.0], 3), (None, None, None), (19, [1e-30, 2e-30, 3e-30], 1), (20, [1e30, 2e30, 3e30], 1),
    ]
    frame = clashing(spark.createDataFrame(rows, SHAPE), "node", "code", "n_links", "component")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in itq.near_duplicates(frame).collect()), key=key)
    assert got == sorted(naive(rows, 0.98), key=key)
    assert itq.near_duplicates(frame.limit(0)).collect() == []


def test_a_large_group_of_copies(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 1) for i in range(3000)] + [(5000, [1.0, 2.0, 3.0, 4.01], 1)]
    got = {r.id: (r.n_links, r.component_id) for r in itq.near_duplicates(spark.createDataFrame(rows, SHAPE)).collect()}
    assert set(got.values()) == {(3000, 0)} and len(got) == 3001


def test_registered_query_against_brute_force(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding, r.label) for r in table(spark, sf_dir, "embeddings").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op3_quantisation(spark, sf_dir).collect())
    assert got == sorted(naive(vectors, 0.98))


def test_pairs_count_nothing_that_one_vector_tells(spark):
    """Largest components and lengths are stored per vector; a pair that meets in several tables comes once without a shuffle."""
    rows = [(i, 1, v) for i, (_, v, _) in enumerate(clusters(40, 64, 9))]
    found = itq.links(spark.createDataFrame(rows, "node bigint, label int, vector array<float>"), 0.98)
    pairs = [(r.a, r.b) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) > 0 and all(a < b for a, b in pairs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array_max" not in plan and "SQRT" not in plan.upper() and "Aggregate [" not in plan


def test_long_vectors_that_all_link(spark):
    """Cost per pair is in proportion to the components: 1,225 pairs of 1,500, whose largest one was sought anew for each component."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(1500)
    rows = [(i, (centre + 0.05 * rng.standard_normal(1500)).tolist(), 1) for i in range(50)]
    start = time.monotonic()
    got = {(r.n_links, r.component_id) for r in itq.near_duplicates(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == {(49, 0)} and time.monotonic() - start < 60
