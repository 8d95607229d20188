"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.sources.staging import stage, unstage

T = TypeVar("T")

#: A task has one core; what a batch has needed goes back to the system rather than to the worker's own stock.
WORKERS = {
    "OPENBLAS_NUM_THREADS": "1",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
}

_kept: dict = {}


def kept_by(owner: object, make: Callable[[], T]) -> T:
    """What a worker keeps from one batch to the next. Workers outlive stages; only the last owner's is kept."""
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; Arrow batches small enough for very long texts in it, workers that find this package."""
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    for variable, value in WORKERS.items():
        environment.setdefault(variable, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """Append result columns; input columns of the same name, in whatever case, give way to them."""
    taken = {name.lower() for name in results}
    kept = [df[f"`{name}`"] for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *[column.alias(name) for name, column in results.items()])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b): one row (node, component) per node, component its smallest node.

    Alternates two steps until nothing changes: every node hangs its larger neighbours on its smallest neighbour, then
    its smaller ones. Both are a minimum per node, combined before the shuffle, and a join with one row per node, so a
    node with very many neighbours is never gathered in one task. Rounds grow with the logarithm of the longest path.
    Every round is written to the staging folder, which ends its lineage, and the round before it is removed.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = stage(edges.where("a <> b").select(larger, smaller).distinct(), "links")
    state = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = stage(hung.where("a <> b").distinct(), "links")
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        lifted = hung.join(least, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        following = stage(lifted.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        unstage(current, hung)
        current = following
        now = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
