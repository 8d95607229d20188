"""Writing a table that is read more than once, so that its plan runs only once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Stores a table under a name and takes measures of it on the way: (table, name, name=aggregate) to (copy, {name: value}).
Keep = Callable[..., tuple[DataFrame, dict]]


def staging_folder(spark: SparkSession) -> str:
    """One folder per application below ``spark.checkpoint.dir``, or below the warehouse where that is not set.

    Both are folders that every executor reaches; a folder of one machine is never used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/staged/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet and read it back.

    The copy outlives lost executors, cuts the lineage and lets later steps read only the columns they need.
    Each call writes a new folder; :func:`release` removes all of them.
    """
    path = f"{staging_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Stage df and take aggregates of its rows while they are written, which costs no further job."""
    if not measures:
        return stage(df, name), {}
    seen = Observation()
    copy = stage(df.observe(seen, *[column.alias(key) for key, column in measures.items()]), name)
    return copy, dict(seen.get)


@dataclass
class _Shared:
    plan: DataFrame
    files: frozenset[str]
    copy: DataFrame
    values: dict
    readers: int = 0


_shared: dict[str, dict[tuple, list[_Shared]]] = {}


def shared(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`measured`, but a table with the same plan over the same files is written once per application.

    Plans are compared as Spark does for cached ones, so names of the variables that made them do not matter. Each call
    counts as a reader; :func:`done` takes one away, and with the last reader the copy goes.
    """
    held = _shared.setdefault(df.sparkSession.sparkContext.applicationId, {})
    same = held.setdefault((name, df.semanticHash(), frozenset(measures)), [])
    files = frozenset(df.inputFiles())
    for entry in same:
        if entry.files == files and entry.plan.sameSemantics(df):
            break
    else:
        entry = _Shared(df, files, *measured(df, name, **measures))
        same.append(entry)
    entry.readers += 1
    return entry.copy, entry.values


def done(*copies: DataFrame) -> None:
    """A reader of each of these shared copies needs it no longer. Other frames are left alone."""
    for copy in copies:
        for same in _shared.get(copy.sparkSession.sparkContext.applicationId, {}).values():
            for entry in [e for e in same if e.copy is copy]:
                entry.readers -= 1
                if not entry.readers:
                    same.remove(entry)
                    unstage(copy)


def unstage(*staged: DataFrame) -> None:
    """Remove copies that nothing will read again."""
    for df in staged:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            _delete(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Remove every staged copy of this application; results that still read them must have been written before."""
    _shared.pop(spark.sparkContext.applicationId, None)
    _delete(spark, staging_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
