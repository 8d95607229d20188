"""Storing the large tables the way the jobs read them: sessions by day, flights and hotels in buckets by trip.

A job that starts at a date then lists the files of later days only. A join by trip moves no flight and no hotel, as
their rows lie by trip already; the sessions' trips, which are fewer, come to them.
"""

from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamsight.sources.destinations import destination_countries
from roamsight.sources.tables import DAY, FLIGHTS, HOTELS, SESSIONS, USERS, Tables

_BY_DAY = "sessions_by_day"
_BY_TRIP = re.compile(r"(flights|hotels)_in_(\d+)_buckets")


def write_laid_out(tables: Tables, path: str, buckets: int) -> None:
    """Write all tables below ``path``; :func:`read_laid_out` finds them there.

    Sessions are dealt out in ranges of time, so a day with very many sessions is written by several tasks and a task
    writes few days. Sessions without a start are a day of their own. Each bucket is one sorted file.
    """
    base = path.rstrip("/")
    by_time = tables.sessions.withColumn(DAY, F.to_date("session_start")).repartitionByRange("session_start", "session_id")
    by_time.write.partitionBy(DAY).parquet(f"{base}/{_BY_DAY}")
    tables.users.write.parquet(f"{base}/users")
    for name in ("flights", "hotels"):
        rows = getattr(tables, name).repartition(buckets, "trip_id").write.bucketBy(buckets, "trip_id").sortBy("trip_id")
        folder = f"{base}/{name}_in_{buckets}_buckets"
        rows.format("parquet").option("path", folder).saveAsTable(_table_name(folder))


def read_laid_out(spark: SparkSession, path: str) -> Tables:
    """Tables that :func:`write_laid_out` wrote. Buckets are known to the session's catalog under a name made of the path."""
    base = path.rstrip("/")
    matches = [match for name in _names(spark, base) if (match := _BY_TRIP.fullmatch(name))]
    found = {match[1]: int(match[2]) for match in matches}
    if set(found) != {"flights", "hotels"} or len(set(found.values())) != 1:
        raise ValueError(f"no flights and hotels in equally many buckets below {path}")
    buckets = found["flights"]

    def by_trip(name: str, schema) -> DataFrame:
        folder = f"{base}/{name}_in_{buckets}_buckets"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table_name(folder)} ({columns}) USING parquet"
            f" CLUSTERED BY (trip_id) SORTED BY (trip_id) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return spark.table(_table_name(folder))

    days = T.StructType([*SESSIONS, T.StructField(DAY, T.DateType())])
    return Tables(
        sessions=spark.read.schema(days).parquet(f"{base}/{_BY_DAY}"),
        users=spark.read.schema(USERS).parquet(f"{base}/users"),
        flights=by_trip("flights", FLIGHTS),
        hotels=by_trip("hotels", HOTELS),
        mapping=destination_countries(spark),
        trip_buckets=buckets,
    )


def _table_name(folder: str) -> str:
    return f"laid_out_{sha256(folder.encode()).hexdigest()[:24]}"


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(path)]
