import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roamsight.llm import sharding
from roamsight.llm.common import table
from roamsight.llm.queries import op4_hash_tree
from roamsight.llm.sharding import Shard


def naive(key, nodes):
    """Level by level, in plain Python."""
    names = lambda n: ("", f"region {n.region}", f"rack {n.region}.{n.rack}", str(n.shard))
    at = ""
    for level in range(1, 4):
        below = {}
        for n in nodes:
            if names(n)[level - 1] == at and n.weight > 0:
                below[names(n)[level]] = below.get(names(n)[level], 0.0) + n.weight
        draws = []
        for place, (node, weight) in enumerate(below.items()):
            word = int(hashlib.md5(f"{key}/{node}".encode()).hexdigest()[:13], 16)
            draws.append((-math.log((word + 0.5) / 2**52) / weight, place, node))
        at = min(draws)[2]
    return int(at)


def shards(spark, n, nodes):
    frame = spark.range(n).select(F.col("id").alias("doc_id"), sharding.placed(F.col("id"), nodes).alias("shard"))
    return {r.doc_id: r.shard for r in frame.collect()}


def test_against_plain_python(spark):
    nodes = [Shard(0, 0, 0, 2.0), Shard(0, 0, 1), Shard(0, 1, 2, 0.5), Shard(1, 0, 3, 3.0), Shard(2, 0, 4, 0.0)]
    found = shards(spark, 500, nodes)
    assert all(found[i] == naive(i, nodes) for i in range(500))
    assert set(found.values()) == {0, 1, 2, 3}


def test_rows_follow_weights(spark):
    nodes = [Shard(0, 0, 0, 1.0), Shard(0, 0, 1, 3.0), Shard(0, 1, 2, 2.0), Shard(1, 0, 3, 2.0)]
    counts = Counter(shards(spark, 20_000, nodes).values())
    for n in nodes:
        assert counts[n.shard] == pytest.approx(20_000 * n.weight / 8, rel=0.06)


def test_a_changed_weight_moves_rows_only_to_its_subtree(spark):
    before = [Shard(r, k, 4 * r + 2 * k + s) for r in range(3) for k in range(2) for s in range(2)]
    after = [Shard(n.region, n.rack, n.shard, 2.0 if n.shard == 5 else 1.0) for n in before]
    a, b = shards(spark, 5000, before), shards(spark, 5000, after)
    home = {n.shard: (n.region, n.rack) for n in before}
    moved = [(a[i], b[i]) for i in a if a[i] != b[i]]
    assert moved and all(home[to][0] == 1 for _, to in moved)  # into the region whose weight grew
    inside = [(x, y) for x, y in moved if home[x][0] == 1 and home[x][1] == home[5][1]]
    assert inside and all(y == 5 for _, y in inside)


@pytest.mark.parametrize("n", [1, 5, 16, 17])
def test_one_more_shard_only_takes_rows(spark, n):
    nodes = sharding.tree(n)
    a, b = shards(spark, 4000, nodes), shards(spark, 4000, sharding.grown(nodes))
    assert all(b[i] in (a[i], n) for i in a)
    assert sum(b[i] == n for i in b) == pytest.approx(4000 / (n + 1), rel=0.2)
    assert sum(a[i] != b[i] for i in a) == sum(b[i] == n for i in b)


def test_every_tree_beyond_the_first_is_grown(spark):
    assert all(sharding.tree(n + 1) == sharding.grown(sharding.tree(n)) for n in range(16, 40))
    assert all(len({s.shard for s in sharding.tree(n)}) == n for n in range(1, 41))
    sizes = (16, 17, 18, 24, 25)
    trees = [sharding.placed(F.col("id"), sharding.tree(n)).alias(f"t{n}") for n in sizes]
    for r in spark.range(2000).select(*trees).collect():
        for a, b in zip(sizes, sizes[1:], strict=False):
            assert r[f"t{b}"] == r[f"t{a}"] or r[f"t{b}"] >= a


def test_registered_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = op4_hash_tree(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    nodes = sharding.tree(16)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (naive(r.doc_id, nodes), naive(r.doc_id, sharding.grown(nodes)))
    for shard in range(16):
        mine = sorted(r.slot for r in rows if r.shard == shard)
        assert mine == list(range(len(mine)))


def test_dirty_rows(make_docs, clashing):
    docs = make_docs([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None), (2, ""), (3, "x" * 100_000)])
    docs = clashing(docs, "shard", "SLOT", "bucket", "ahead", "of_shard")
    rows = sharding.slots(docs, sharding.tree(4)).collect()
    assert len(rows) == 7 and all(r.bucket == "extra bucket" and r.of_shard == "extra of_shard" for r in rows)
    for shard in {r.shard for r in rows}:
        mine = sorted(r.slot for r in rows if r.shard == shard)
        assert mine == list(range(len(mine)))
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1 and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.slots(docs.limit(0), sharding.tree(4)).collect() == []
    for nodes in ([], [Shard(0, 0, 0, 0.0)], [Shard(0, 0, 0, -1.0), Shard(0, 0, 1)], [Shard(0, 0, 0), Shard(1, 0, 0)]):
        with pytest.raises(ValueError):
            sharding.placed(F.lit("x"), nodes)


def test_plan_has_no_python(spark, sf_dir):
    plan = op4_hash_tree(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
