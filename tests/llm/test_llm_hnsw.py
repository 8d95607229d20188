import numpy as np
import pytest
from pyspark.sql import functions as F

from roamsight.llm import hnsw
from roamsight.llm.common import table
from roamsight.llm.queries import op12_hnsw


def exact(rows, k=20, step=20):
    """(query_id, rank) -> (id, score) by comparing all, rows being (id, vector)."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if i % step == 0:
            scores = x @ np.array(v, float)
            near = [(-s, j) for s, j in zip(scores.tolist(), ids.tolist(), strict=True) if j != i]
            out |= {(i, r): (j, -s) for r, (s, j) in enumerate(sorted(near)[:k], 1)}
    return out


def recall(found, expected):
    hits = {(r.query_id, r.vec_id) for r in found} & {(q, j) for (q, _), (j, _) in expected.items()}
    return len(hits) / len(expected)


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")


def test_registered_query_against_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    found = op12_hnsw(spark, sf_dir).collect()
    expected = exact(rows)
    assert {(r.query_id, r.rank) for r in found} == expected.keys() and len(found) == len(expected)
    assert recall(found, expected) >= 0.95
    by_id = dict(rows)
    for r in found:
        assert r.query_id != r.vec_id and abs(r.score - np.dot(by_id[r.query_id], by_id[r.vec_id])) < 1e-12
    ranked = sorted(found, key=lambda r: (r.query_id, -r.score, r.vec_id))
    assert [(r.query_id, r.rank) for r in ranked] == sorted((r.query_id, r.rank) for r in found)


@pytest.mark.parametrize("lengths", ["equal", "various"])
def test_recall_of_several_shards_with_layers(spark, lengths):
    """Clustered vectors in graphs of some layers; also where the longest vectors win whatever their direction."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 24))
    x = centres[rng.integers(0, 30, 4000)] + 0.5 * rng.standard_normal((4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "various":
        x *= rng.uniform(0.5, 2.0, (4000, 1))
    rows = list(enumerate(x.tolist()))
    found = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 10, shard_rows=1500).collect()
    assert recall(found, exact(rows, 10)) >= 0.95


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = list(enumerate(rng.integers(-3, 4, (120, 4)).tolist()))  # many ties
    rows = [(i, v) for i, v in rows if any(v)]
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect()}
    assert found == exact(rows)


def test_copies_come_in_order_of_their_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 3000, 3)] + [(i, [0.0, 1.0]) for i in range(1, 300, 3)]
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, 5).collect()}
    assert found == exact(rows, 5)


def test_dirty_rows(spark, clashing):
    nan, inf = float("nan"), float("inf")
    bad = [(20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [0.0, 0.0]), (120, []), (None, [1.0, 1.0])]
    good = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [2.0]), (2, [1e300, -1e300]), (3, [0.5, 0.25]), (140, [0.0, 3.0])]
    df = clashing(vectors(spark, bad + good), "ids", "query", "block", "shard", "vector", "best")
    found = hnsw.nearest(df, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    padded = [(i, [*v, 0.0][:2]) for i, v in good[1:]]
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()} == exact(padded)
    for frame in (df.limit(0), vectors(spark, bad)):
        assert hnsw.nearest(frame, F.col("vec_id") % 20 == 0).collect() == []
    alone = vectors(spark, [(20, [1.0])])
    assert hnsw.nearest(alone, F.col("vec_id") % 20 == 0).collect() == []


def test_links_lead_everywhere():
    """Every node is reached from the first one, and no list names a node twice or its own node."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.standard_normal((300, 8)) * 0.01 + c for c in rng.standard_normal((5, 8)) * 10])
    rng.shuffle(x)
    graph = hnsw.Graph.build(hnsw.even_lengths(x, np.linalg.norm(x, axis=1).max()), [1500, 60, 3])
    for links in graph.layers:
        reached, new = {0}, [0]
        while new:
            new = [j for j in {int(j) for i in new for j in links[i] if j >= 0} if j not in reached]
            reached |= set(new)
        assert len(reached) >= 0.99 * len(links)
        for i, mine in enumerate(links.tolist()):
            mine = [j for j in mine if j >= 0]
            assert len(set(mine)) == len(mine) and i not in mine
