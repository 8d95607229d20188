"""Embedding near-duplicates by iterative quantisation, multi-index Hamming tables, and reranking.

Vectors are projected on their principal directions and rotated so that signs lose least: the rotation is learned by taking
signs and the best rotation towards them in turn. The signs are a code of 64 balanced bits. Codes are cut into ``TABLES``
pieces; of a close pair at least one piece differs in no more than one bit, so each vector is entered in every table under its
piece and looks up its piece and all pieces one bit away. Candidates whose whole codes are near are reranked with the
original vectors: the cosine in double precision decides, so no link is wrong, and few are missed. What a cosine needs of one
vector alone is counted once per vector; a pair takes one product of its components, and pairs are not made distinct by a shuffle.

Only vectors with the same label meet. Equal vectors of a label are one vector with members, so groups of copies cost nothing.
Vectors that are null, empty or zero, or hold null or non-finite components, and vectors without label, link with
nothing; vectors of different length do not either. A vector without id counts as a partner but names no component.

The rotation is learned on at most ``SAMPLE`` distinct vectors, the first by a hash of their components; every vector is
encoded and entered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.llm.common import components
from roamsight.sources.staging import stage

SAMPLE = 10_000
BITS = 64
TABLES = 4
#: Codes of vectors with a cosine of 0.98 differ in about 4 of 64 bits; rerank up to four times that.
MOST_BITS = 16
ROUNDS = 50
#: Distance from the mean, as a root mean square, from which on the mean is subtracted.
SPREAD = 0.5


def learn(vectors: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection to ``BITS`` numbers whose signs are the code. ``vectors`` are rows of length one.

    Seen from the mean, vectors that all lie close to it would seem far apart; then the angle is measured from zero.
    """
    rng = np.random.default_rng(seed)
    mean = vectors.mean(0)
    if np.sqrt(((vectors - mean) ** 2).sum(1).mean()) < SPREAD:
        mean = np.zeros_like(mean)
    centred = vectors - mean
    _, directions = np.linalg.eigh(centred.T @ centred)
    directions = directions[:, ::-1][:, :BITS]
    projected = centred @ directions
    size = directions.shape[1]
    parts = []
    while sum(p.shape[1] for p in parts) < BITS:  # short vectors get several rotations
        rotation, _ = np.linalg.qr(rng.standard_normal((size, size)))
        for _ in range(ROUNDS):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            rotation = left @ right
        parts.append(directions @ rotation)
    return mean, np.concatenate(parts, axis=1)[:, :BITS]


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Rows of length one; shorter vectors are padded, longer ones cut, for the code only."""
    out = np.zeros((len(lists), size))
    for row, values in zip(out, lists, strict=True):
        if values.is_valid:
            v = values.values.to_numpy(zero_copy_only=False).astype(np.float64)[:size]
            row[: len(v)] = v / (np.abs(v).max() or 1.0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def codes(vector: Column, mean: np.ndarray, projection: np.ndarray) -> Column:
    """The code of each vector as a signed 64-bit number."""

    @F.arrow_udf("bigint")
    def encode(lists: pa.Array) -> pa.Array:
        signs = (_matrix(lists, len(mean)) - mean) @ projection >= 0
        return pa.array(np.packbits(signs, axis=1, bitorder="little").view("<i8").ravel() if len(lists) else [], pa.int64())

    return encode(vector)


def usable(vector: Column) -> Column:
    double = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(double, lambda x: x != 0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def measures(vector: str) -> Column:
    """What the cosines of a vector need of it alone: its largest component, and its length once divided by that."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))

    def scaled(m: Column) -> Column:
        return F.sqrt(_total(F.transform(vector, lambda x: (x.cast("double") / m) * (x.cast("double") / m))))

    # a lambda's argument is counted once, an expression inside a lambda once per component
    return F.get(F.transform(F.array(most), lambda m: F.struct(m.alias("most"), scaled(m).alias("length"))), F.lit(0))


def cosine() -> Column:
    """Of ``vector_a`` and ``vector_b`` in double precision; components are divided by the largest one first, so that squares
    neither overflow nor vanish."""
    product = lambda x, y: (x.cast("double") / F.col("size_a.most")) * (y.cast("double") / F.col("size_b.most"))
    return _total(F.zip_with("vector_a", "vector_b", product)) / (F.col("size_a.length") * F.col("size_b.length"))


def links(distinct: DataFrame, cosine_min: float) -> DataFrame:
    """Links (a, b), a < b, between distinct vectors (node, label, vector) found with at least this cosine."""
    spark = distinct.sparkSession
    sample = distinct.select("node", "vector").orderBy("node").limit(SAMPLE).toArrow()
    if not len(sample):
        return spark.createDataFrame([], "a bigint, b bigint")
    lists = sample["vector"].combine_chunks()
    size = max(len(v) for v in lists)
    mean, projection = learn(_matrix(lists, size))
    code = codes(F.col("vector"), mean, projection).alias("code")
    coded = stage(distinct.select("node", "label", "vector", code, measures("vector").alias("size")), "codes")

    width = BITS // TABLES
    pieces = ", ".join(f"struct({t} as place, shiftrightunsigned(code, {t * width}) & {(1 << width) - 1}L as piece)" for t in range(TABLES))
    entered = coded.select("node", "label", "code", F.expr(f"inline(array({pieces}))"))
    near = F.expr(f"array_prepend(transform(sequence(0, {width - 1}), i -> piece ^ shiftleft(1L, i)), piece)")
    asked = entered.select(F.col("node").alias("a"), "label", "place", F.col("code").alias("code_a"), F.explode(near).alias("piece"))
    entered = entered.select(F.col("node").alias("b"), "label", "place", F.col("code").alias("code_b"), "piece")
    met = asked.join(entered, ["label", "place", "piece"])
    met = met.where(f"a < b and bit_count(code_a ^ code_b) <= {MOST_BITS}")
    # a pair that meets in several tables counts in the first of them
    meets = [f"bit_count(shiftrightunsigned(code_a ^ code_b, {t * width}) & {(1 << width) - 1}L) <= 1" for t in range(TABLES)]
    met = met.where(F.col("place") == F.coalesce(*[F.when(F.expr(here), t) for t, here in enumerate(meets)])).select("a", "b")
    left, right = (coded.select(F.col("node").alias(x), F.col("vector").alias(f"vector_{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
    pairs = met.join(left, "a").join(right, "b").where(F.size("vector_a") == F.size("vector_b"))
    return pairs.where(cosine() >= cosine_min).select("a", "b")


def near_duplicates(
    vectors: DataFrame, cosine_min: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per row: ``id``, ``n_links`` (other rows linked directly), ``component_id``, ``kept``.

    ``component_id`` is the smallest id that links reach; the row's own id where nothing does.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    fits = usable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.withColumn("node", F.when(fits, F.xxhash64("label", F.transform("vector", lambda x: x + F.lit(0).cast("float")))))
    distinct = rows.where("node is not null").groupBy("node")
    distinct = distinct.agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("members"), F.min("id").alias("least")
    )
    distinct = stage(distinct, "distinct_vectors")
    found = stage(links(distinct.select("node", "label", "vector"), cosine_min), "vector_links")
    both = found.union(found.select("b", "a")).toDF("node", "other")
    sizes = distinct.select(F.col("node").alias("other"), F.col("members").alias("others"))
    others = both.join(sizes, "other").groupBy("node").agg(F.sum("others").alias("others"))
    graph = components(found)
    placed = distinct.join(graph, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("smallest"))
    placed = placed.join(smallest, "component").join(others, "node", "left")
    placed = placed.select("node", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "smallest")
    loose = rows.where("node is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.where("node is not null").select("id", "node").join(placed, "node")
    linked = linked.select("id", "n_links", F.coalesce("smallest", "id").alias("component_id"))
    return linked.union(loose).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
