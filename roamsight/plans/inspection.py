"""Session- and user-level rows of a few users without the work for all others.

A user's rows need more than the user's own sessions: the status of a trip comes from every member's sessions about it, and
whether somebody else is a member from all of their sessions. So the wanted users lead to their trips, the trips to all users
with sessions about them, and these to the sessions, flights and hotels that are read. Scores and features are left out:
they compare a user with the whole cohort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamsight.params import Params
from roamsight.plans.cohort import Cohort, recent_sessions
from roamsight.plans.sessions import session_base
from roamsight.plans.users import user_averages
from roamsight.sources.staging import Keep, shared
from roamsight.sources.tables import Tables


def tables_around(tables: Tables, params: Params, user_ids: Sequence, keep: Keep = shared) -> Tables:
    """The tables without rows that cannot bear on the sessions of these users."""
    ids = list(dict.fromkeys(user_ids))
    recent = recent_sessions(tables, params)
    own = recent.where(F.col("user_id").isin(ids) & F.col("trip_id").isNotNull())
    count = F.count(F.lit(1))

    def only(df: DataFrame, key: str, keys: tuple[DataFrame, dict]) -> DataFrame:
        found, size = keys
        return df.join(F.broadcast(found) if size["n"] <= params.broadcast_ids else found, key, "left_semi")

    trips = keep(own.select("trip_id").distinct(), "trips_around", n=count)
    others = only(recent, "trip_id", trips).select("user_id")
    wanted = tables.users.select("user_id").where(F.col("user_id").isin(ids))
    users = keep(others.union(wanted).where("user_id is not null").distinct(), "users_around", n=count)
    return replace(
        tables,
        sessions=only(recent, "user_id", users),
        users=only(tables.users, "user_id", users),
        flights=only(tables.flights, "trip_id", trips),
        hotels=only(tables.hotels, "trip_id", trips),
    )


def inspect_sessions(tables: Tables, params: Params, user_ids: Sequence) -> DataFrame:
    """The users' rows of the session base."""
    around = tables_around(tables, params, user_ids)
    return session_base(around, Cohort(around, params), params).where(F.col("user_id").isin(list(user_ids)))


def inspect_averages(tables: Tables, params: Params, user_ids: Sequence) -> DataFrame:
    """The users' rows of the user averages."""
    around = tables_around(tables, params, user_ids)
    return user_averages(around, Cohort(around, params), params).where(F.col("user_id").isin(list(user_ids)))
