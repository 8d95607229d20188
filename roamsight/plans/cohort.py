"""Who belongs to the cohort, and which trips their sessions are about."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamsight.functions.exprs import full_years
from roamsight.operators.membership import filter_words, key_filter, perhaps_in
from roamsight.operators.skew import hot_keys, join_sliced
from roamsight.params import Params
from roamsight.sources.staging import Keep, done, shared
from roamsight.sources.tables import DAY, Tables

ROW_NUMBER = "_row"


def recent_sessions(tables: Tables, params: Params) -> DataFrame:
    """Sessions from the cohort date on; of sessions that are laid out by day, earlier days are not even listed."""
    start = params.cohort_start.isoformat()
    recent = tables.sessions.where(F.col("session_start") >= F.lit(start).cast("timestamp_ntz"))
    if DAY in recent.columns:
        recent = recent.where(F.col(DAY) >= F.lit(start).cast("date")).drop(DAY)
    return recent


def active_users(tables: Tables, params: Params) -> DataFrame:
    """user_id and session count of users with enough recent sessions."""
    return (
        recent_sessions(tables, params)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("cohort_sessions"))
        .where(F.col("cohort_sessions") > params.min_sessions)
    )


def _with_age(users: DataFrame, params: Params) -> DataFrame:
    age = F.col("age_years")
    group = F.when(age.isNull(), "unknown")
    for limit, label in ((26, "18-25"), (36, "26-35"), (46, "36-45"), (56, "46-55")):
        group = group.when(age < limit, label)
    aged = users.withColumn("age_years", full_years(params.as_of_date, F.col("birthdate")))
    return aged.withColumn("age_group", group.otherwise("55+"))


def _user_trips(sessions: DataFrame) -> DataFrame:
    """Aggregating by trip and user first keeps copies of one trip out of the later shuffles."""
    any_true = lambda name: F.bool_or(F.coalesce(F.col(name), F.lit(False)))
    return (
        sessions.where(F.col("trip_id").isNotNull())
        .groupBy("trip_id", "user_id")
        .agg(
            F.count(F.lit(1)).alias("trip_sessions"),
            any_true("cancellation").alias("any_cancelled"),
            any_true("flight_booked").alias("any_flight"),
            any_true("hotel_booked").alias("any_hotel"),
        )
    )


class Cohort:
    """What every session- and user-level job reads; each part is prepared when first asked for.

    ``profiles`` is the users table restricted to members, with age and session count. ``user_trips`` has one row per
    trip and user. Both are stored, so reading them again is cheap.

    ``sessions`` are the recent sessions. A member list of at most ``params.broadcast_ids`` ids is broadcast and drops
    all other sessions at the scan; then ``members_only`` is set. For a longer list a filter of bounded size drops nearly all
    of them at the scan (:mod:`roamsight.operators.membership`); the joins that follow drop the rest and need no extra
    shuffle for it. Flights and hotels are reduced to the cohort's trips the same way.

    What is stored is shared with other cohorts of the same tables and parameters; :meth:`close` gives it up.
    """

    def __init__(self, tables: Tables, params: Params, keep: Keep = shared):
        self._tables, self._params, self._stored, self._store = tables, params, [], keep
        weight = F.coalesce(F.sum("cohort_sessions"), F.lit(0))
        self._active, all_ = self._keep(active_users(tables, params), "active_users", sessions=weight)
        members = _with_age(tables.users, params).join(self._active, "user_id")
        self.profiles, size = self._keep(members, "profiles", users=F.count(F.lit(1)), sessions=weight)
        self._users, self._weights = size["users"], (all_["sessions"], size["sessions"])
        self.members_only = size["users"] <= params.broadcast_ids
        self._too_few_for_hot_keys = self.members_only and size["sessions"] <= params.skew.target_rows

    def _keep(self, df: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
        kept = self._store(df, name, **measures)
        self._stored.append(kept[0])
        return kept

    def close(self) -> None:
        """Results that read this cohort have been written. Tables that nobody else shares go."""
        done(*self._stored)
        self._stored.clear()

    def _only(self, df: DataFrame, keys: DataFrame, key: str, few: bool, distinct: int) -> DataFrame:
        """Rows whose key is among the keys: exactly these if the keys are few, else nearly only these."""
        if few:
            return df.join(F.broadcast(keys.select(key)), key, "left_semi")
        words = filter_words(distinct, self._params.filter_words)
        return perhaps_in(df, key, self._keep(key_filter(keys, key, words), f"{key}_filter")[0], words)

    @cached_property
    def sessions(self) -> DataFrame:
        recent = recent_sessions(self._tables, self._params)
        return self._only(recent, self.profiles, "user_id", self.members_only, self._users)

    def numbered(self, sessions: DataFrame) -> DataFrame:
        """Copies of one session share every column, so slices need a number of their own.

        Numbered in the stage of the scan, where a task that runs again reads the same rows in the same order.
        """
        if self._too_few_for_hot_keys:
            return sessions
        return sessions.withColumn(ROW_NUMBER, F.monotonically_increasing_id())

    @cached_property
    def _trips(self) -> tuple[DataFrame, dict]:
        sessions = F.coalesce(F.sum("trip_sessions"), F.lit(0))
        return self._keep(_user_trips(self.sessions), "user_trips", rows=F.count(F.lit(1)), sessions=sessions)

    @property
    def user_trips(self) -> DataFrame:
        return self._trips[0]

    @cached_property
    def hot_users(self) -> DataFrame | None:
        if self._too_few_for_hot_keys:
            return None
        weights = self.profiles if self.members_only else self._active
        total = self._weights[self.members_only]
        return hot_keys(weights, "user_id", "cohort_sessions", self._params.skew, self._keep, total)

    @cached_property
    def hot_trips(self) -> DataFrame | None:
        if self._too_few_for_hot_keys:
            return None
        weights = self.user_trips.groupBy("trip_id").agg(F.sum("trip_sessions").alias("trip_sessions"))
        return hot_keys(weights, "trip_id", "trip_sessions", self._params.skew, self._keep, self._trips[1]["sessions"])

    def of_members(self, df: DataFrame, row_id: str) -> DataFrame:
        """Rows of sessions or user_trips that belong to members; ``row_id`` tells rows of one user apart."""
        if self.members_only:
            return df
        return join_sliced(df, self.profiles.select("user_id"), "user_id", row_id, self.hot_users, "left_semi")

    def of_trips(self, df: DataFrame) -> DataFrame:
        """Flights or hotels without rows that no session of the cohort can meet."""
        rows = self._trips[1]["rows"]
        return self._only(df, self.user_trips, "trip_id", rows <= self._params.broadcast_ids, rows)

    @property
    def member_sessions(self) -> DataFrame:
        return self.of_members(self.numbered(self.sessions), ROW_NUMBER).drop(ROW_NUMBER)

    @property
    def member_trips(self) -> DataFrame:
        return self.of_members(self.user_trips, "trip_id")
