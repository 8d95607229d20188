"""Approximate nearest neighbours by hierarchical navigable small-world graphs, one per shard, merged.

Nearness is the largest inner product. All vectors get one more entry that gives them equal length, which changes no inner product
with a query (whose entry is zero) and makes the nearest by inner product also the nearest by angle, as a graph needs it.

Equal vectors are one node with the smallest ``k`` + 1 ids that have it (a query leaves out its own), so copies cannot
crowd a graph. Nodes are dealt to shards by hash. Within a shard a node's top layer is drawn from its hash; layer 0 holds
all. Layers are built from the top. A node enters a layer next to what a beam search finds there from the layer
above, and links to candidates that are nearer to it than to those linked already, so that links lead in all directions; a
full list is chosen anew when a link comes in. Nodes enter in batches: these search the graph without each other and compare
themselves directly. A graph is stored as one flat array of neighbours per layer, nodes of upper layers first.

Queries go to every shard in blocks of ``BLOCK``, each block and shard a task's row of bounded size; they descend greedily
through the upper layers and search layer 0 with a beam of ``EF``. What the beam holds is scored again in double precision
with the original vectors, and the shards' best ``k`` are merged per query. A shard of up to ``EF`` nodes is compared as a whole,
so small tables are exact.

Work per query grows with the number of shards. ``SHARD_ROWS`` nodes take some 15 MB and can be raised with the memory of a task.

Vectors that are null, empty or zero or hold null or non-finite entries take no part, nor do rows without id. Shorter vectors
have zeros in place of missing entries. Rows equal in id and vector are one; rows of the same id never find each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.llm.common import kept_by
from roamsight.sources.staging import stage

SHARD_ROWS = 16_384
BLOCK = 1024
#: Links of a node in upper layers; twice as many in layer 0.
LINKS = 24
EF_BUILD = 100
EF = 160
WIDTH = 4
BATCH = 256
MIXED = 16


def _dots(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return np.einsum("fd,fd->f", vectors[rows], queries[owner])


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ef nodes found for each query, nearest first, -1 where there are fewer; all queries step together.

    ``start`` has the first nodes of each query. Each step looks at the neighbours of a query's ``WIDTH`` best nodes whose
    neighbours it has not looked at; a query is done when its beam holds no such node.
    """
    n, width = len(queries), min(WIDTH, ef)
    ids, scores = np.full((n, ef), -1, np.int32), np.full((n, ef), -np.inf, np.float32)
    looked = np.ones((n, ef), bool)
    seen = np.zeros((n, len(links) + 1), bool)  # the last column stands for no neighbour
    seen[:, -1] = True
    rows = np.arange(n)
    fresh = start.copy()
    active = rows
    while True:
        fresh = np.sort(fresh, axis=1)
        new = ~seen[active[:, None], fresh]
        new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        owner, column = np.nonzero(new)
        found = fresh[owner, column]
        seen[active[owner], found] = True
        more = np.full(fresh.shape, -np.inf, np.float32)
        more[owner, column] = _dots(vectors, found, queries, active[owner])
        both = np.concatenate([scores[active], more], axis=1)
        if both.shape[1] > 2 * ef:
            order = np.argpartition(-both, ef, axis=1)[:, :ef]
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(both, order, 1), axis=1, kind="stable"), 1)
        else:
            order = np.argsort(-both, axis=1, kind="stable")[:, :ef]
        scores[active] = np.take_along_axis(both, order, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], fresh], axis=1), order, 1)
        looked[active] = np.take_along_axis(np.concatenate([looked[active], np.zeros(fresh.shape, bool)], axis=1), order, 1)
        looked[active] |= np.isinf(scores[active])
        open_ = ~looked[active]
        chosen = open_ & (np.cumsum(open_, axis=1) <= width)
        going = chosen.any(1)
        active, chosen = active[going], chosen[going]
        if not len(active):
            ids[np.isinf(scores)] = -1
            return ids, scores
        looked[active] |= chosen
        owner, column = np.nonzero(chosen)
        place = np.cumsum(chosen, axis=1)[owner, column] - 1
        at = np.full((len(active), width), -1, np.int32)
        at[owner, place] = ids[active[owner], column]
        around = links[at]
        around[at < 0] = -1
        fresh = around.reshape(len(active), -1)
        fresh = np.where(fresh < 0, len(links), fresh)


def choose(vectors: np.ndarray, candidates: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (-1 for none) up to ``most``: nearest first those nearer to the row than to a chosen one, then the rest."""
    order = np.argsort(-scores, axis=1, kind="stable")
    candidates, scores = np.take_along_axis(candidates, order, 1), np.take_along_axis(scores, order, 1)
    out = np.full((len(candidates), most), -1, np.int32)
    for low in range(0, len(candidates), 512):
        mine, score = candidates[low : low + 512], scores[low : low + 512]
        there = mine >= 0
        around = vectors[mine]
        between = around @ around.transpose(0, 2, 1)
        taken, count = np.zeros(mine.shape, bool), np.zeros(len(mine), np.int64)
        for i in range(mine.shape[1]):
            nearer = (taken & (between[:, :, i] > score[:, i : i + 1])).any(1)
            taken[:, i] = there[:, i] & ~nearer & (count < most)
            count += taken[:, i]
        rank = np.argsort(np.where(taken, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.take_along_axis(mine, rank, 1)
        out[low : low + 512, : picked.shape[1]] = picked
    return out


@dataclass
class Graph:
    """``layers[0]`` are the links of all nodes, ``layers[i]`` those of the first nodes, which reach up to layer i."""

    vectors: np.ndarray
    layers: list[np.ndarray] = field(default_factory=list)

    def descend(self, queries: np.ndarray, layer: int) -> np.ndarray:
        """The nearest node that greedy steps find above the layer."""
        at = np.zeros((len(queries), 1), np.int32)
        for links in reversed(self.layers[layer + 1 :]):
            at = beam(self.vectors, links, queries, at, 1)[0]
        return at

    def search(self, queries: np.ndarray, ef: int) -> np.ndarray:
        n = len(self.vectors)
        if n <= ef:
            return np.tile(np.arange(n, dtype=np.int32), (len(queries), 1))
        step = max(16, (1 << 24) // n)
        parts = [queries[low : low + step] for low in range(0, len(queries), step)]
        return np.concatenate([beam(self.vectors, self.layers[0], q, self.descend(q, 0), ef)[0] for q in parts])

    @classmethod
    def build(cls, vectors: np.ndarray, sizes: list[int]) -> Graph:
        """``sizes`` are the numbers of nodes in each layer, from layer 0 on."""
        graph = cls(vectors, [np.full((n, LINKS * (2 if i == 0 else 1)), -1, np.int32) for i, n in enumerate(sizes)])
        for layer in reversed(range(len(sizes))):
            graph._fill(layer, sizes[layer + 1] if layer + 1 < len(sizes) else 0)
        return graph

    def _fill(self, layer: int, above: int) -> None:
        links, low = self.layers[layer], 1
        while low < len(links):
            high = min(len(links), low + min(low, BATCH), above if low < above else len(links))
            queries = self.vectors[low:high]
            start = self.descend(queries, layer) if low >= above > 0 else np.zeros((high - low, 1), np.int32)
            found, scores = beam(self.vectors, links[:low], queries, start, min(EF_BUILD, low))
            each = queries @ queries.T
            np.fill_diagonal(each, -np.inf)
            nearest = np.argsort(-each, axis=1, kind="stable")[:, :LINKS]
            scores = np.concatenate([scores, np.take_along_axis(each, nearest, 1)], axis=1)
            found = np.concatenate([found, (nearest + low).astype(np.int32)], axis=1)
            found[np.isinf(scores)] = -1
            mine = choose(self.vectors, found, scores, LINKS)
            links[low:high, :LINKS] = mine
            owner, column = np.nonzero(mine >= 0)
            self._link_back(links, mine[owner, column], (owner + low).astype(np.int32))
            low = high

    def _link_back(self, links: np.ndarray, nodes: np.ndarray, new: np.ndarray) -> None:
        """Add ``new`` to the lists of ``nodes``, ``MIXED`` for one node at a time; full lists are chosen anew."""
        order = np.argsort(nodes, kind="stable")
        nodes, new = nodes[order], new[order]
        while len(nodes):
            distinct, first = np.unique(nodes, return_index=True)
            nth = np.arange(len(nodes)) - np.repeat(first, np.diff(np.append(first, len(nodes))))
            now = nth < MIXED
            row = np.searchsorted(distinct, nodes[now])
            more = np.full((len(distinct), MIXED), -1, np.int32)
            more[row, nth[now]] = new[now]
            old = links[distinct]
            more[(more[:, :, None] == old[:, None, :]).any(2)] = -1  # linked already
            width = links.shape[1]
            both = np.concatenate([old, more], axis=1)
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
            full = (both[:, width:] >= 0).any(1)
            links[distinct[~full]] = both[~full, :width]
            if full.any():
                crowded = both[full]
                scores = np.einsum("rwd,rd->rw", self.vectors[crowded], self.vectors[distinct[full]])
                scores[crowded < 0] = -np.inf
                links[distinct[full]] = choose(self.vectors, crowded, scores, width)
            nodes, new = nodes[~now], new[~now]


def even_lengths(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors divided by the longest one's length, with one more entry that makes all lengths one."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(1)))
    return np.ascontiguousarray(np.column_stack([scaled, rest]), dtype=np.float32)


def usable(vector: Column) -> Column:
    double = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(double, lambda x: x != 0)


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), size))
    out[np.arange(size) < lengths[:, None]] = flat
    return out


_INDEX = "shard int, ids binary, ends binary, vectors binary, sizes array<int>, links binary"


def _indexed(size: int, scale: float, longest: float):
    """One shard's graph from its nodes (node, vector, ids)."""

    def build(key: tuple, nodes: pa.Table) -> pa.Table:
        nodes = nodes.combine_chunks().sort_by("node")
        vectors = _matrix(nodes["vector"].combine_chunks(), size)
        drawn = nodes["drawn"].to_numpy().view(np.uint64).astype(np.float64) / 2.0**64
        layer = np.floor(-np.log(np.maximum(drawn, 1e-18)) / math.log(LINKS)).astype(np.int64)
        order = np.argsort(-layer, kind="stable")
        vectors, layer = vectors[order], layer[order]
        sizes = [int((layer >= i).sum()) for i in range(layer.max() + 1)]
        graph = Graph.build(even_lengths(vectors / scale, longest), sizes)
        ids = nodes["ids"].combine_chunks().take(pa.array(order))
        ends = np.cumsum(np.diff(ids.offsets.to_numpy()))
        row = {
            "shard": key[0].as_py(),
            "ids": ids.flatten().to_numpy().astype("<i8").tobytes(),
            "ends": ends.astype("<i8").tobytes(),
            "vectors": vectors.astype("<f8").tobytes(),
            "sizes": sizes,
            "links": b"".join(links.astype("<i4").tobytes() for links in graph.layers),
        }
        schema = pa.schema(
            [("shard", pa.int32()), ("ids", pa.binary()), ("ends", pa.binary()), ("vectors", pa.binary()), ("sizes", pa.list_(pa.int32())), ("links", pa.binary())]
        )
        return pa.Table.from_pylist([row], schema)

    return build


@dataclass
class Shard:
    graph: Graph
    vectors: np.ndarray
    ids: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, row: dict, size: int, scale: float, longest: float) -> Shard:
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, size)
        layers, at, flat = [], 0, np.frombuffer(row["links"], "<i4")
        for i, n in enumerate(row["sizes"]):
            width = LINKS * (2 if i == 0 else 1)
            layers.append(flat[at : at + n * width].reshape(n, width))
            at += n * width
        graph = Graph(even_lengths(vectors / scale, longest), layers)
        return cls(graph, vectors, np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["ends"], "<i8"))

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int, ef: int) -> list[list[tuple[int, float]]]:
        """(id, score) of the k nearest found, by falling score and rising id."""
        most = np.abs(queries).max(axis=1, keepdims=True)
        even = np.column_stack([queries / most, np.zeros(len(queries))]).astype(np.float32)
        out = []
        for low in range(0, len(queries), 256):
            found = self.graph.search(even[low : low + 256], max(ef, k + 1))
            for query, mine, nodes in zip(queries[low : low + 256], own[low : low + 256], found, strict=True):
                nodes = nodes[nodes >= 0]
                scores = np.einsum("fd,d->f", self.vectors[nodes], query)
                nodes = nodes[np.argsort(-scores, kind="stable")]
                scores = -np.sort(-scores)
                last = scores[min(k, len(scores) - 1)]
                at = int(np.searchsorted(-scores, -last, side="right"))  # with all that tie with the last one needed
                entries = []
                for node, score in zip(nodes[:at].tolist(), scores[:at].tolist(), strict=True):
                    ids = self.ids[self.ends[node - 1] if node else 0 : self.ends[node]]
                    entries += [(-score, i) for i in ids.tolist() if i != mine]
                out.append([(i, -score) for score, i in sorted(entries)[:k]])
        return out


_FOUND = "query bigint, query_id bigint, best array<struct<id:bigint,score:double>>"


def _searched(size: int, scale: float, longest: float, k: int, ef: int):
    schema = pa.schema(
        [("query", pa.int64()), ("query_id", pa.int64()), ("best", pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())])))]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                number = row["shard"][0].as_py()
                index = {name: row[name][0].as_py() for name in ("ids", "ends", "vectors", "sizes", "links")}
                shard = kept_by(("hnsw", number, hash(index["ids"])), lambda index=index: Shard.of(index, size, scale, longest))
                block = row["block"].flatten()
                own = block.field("vec_id").to_numpy()
                found = shard.nearest(_matrix(block.field("vector"), size), own, k, ef)
                best = [[{"id": i, "score": s} for i, s in entries] for entries in found]
                yield pa.RecordBatch.from_pydict(
                    {"query": block.field("query"), "query_id": block.field("vec_id"), "best": pa.array(best, schema.field("best").type)}, schema
                )

    return search


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    ef: int = EF,
) -> DataFrame:
    """For each row that ``queries`` (a condition on ``vec_id``) picks: query_id, rank, vec_id and score of its k nearest rows."""
    spark = df.sparkSession
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    rows = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = stage(rows.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector")).distinct(), "vectors")
    most = F.array_max(F.transform("vector", F.abs))
    size, scale = rows.agg(F.max(F.size("vector")), F.max(most)).first()
    if size is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.lit(scale)) * (x / F.lit(scale)))
    longest = math.sqrt(rows.agg(F.max(squares)).first()[0])

    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = rows.withColumn("nth", first).where(F.col("nth") <= k + 1).groupBy("vector")
    nodes = nodes.agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("node", F.monotonically_increasing_id())
    nodes = stage(nodes, "nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumns({"shard": F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"), "drawn": F.xxhash64("vector", F.lit(1))})
    built = dealt.groupBy("shard").applyInArrow(_indexed(size, scale, longest), _INDEX)
    index = stage(built, "shards")

    asked = stage(rows.where(queries).withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    spread = -(-blocks // 8)
    block = asked.withColumn("number", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")).groupBy("number")
    block = block.agg(F.collect_list(F.struct("query", "vec_id", "vector")).alias("block"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = block.select(numbers(shards).alias("shard"), (F.col("number") % spread).alias("part"), "block")
    pairs = index.withColumn("part", numbers(spread)).join(block, ["shard", "part"])
    pairs = pairs.select("shard", "ids", "ends", "vectors", "sizes", "links", "block")
    found = pairs.mapInArrow(_searched(size, scale, longest, k, ef), _FOUND)
    entry = F.transform(F.flatten(F.collect_list("best")), lambda e: F.struct((-e["score"]).alias("far"), e["id"].alias("id")))
    merged = found.groupBy("query", "query_id").agg(F.slice(F.array_sort(entry), 1, k).alias("best"))
    ranked = merged.select("query_id", F.posexplode("best").alias("place", "best"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("best.id").alias("vec_id"), (-F.col("best.far")).alias("score"))
