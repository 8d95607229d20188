"""Yearly KPIs, for full years or for the part of each year up to the latest session's month and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.functions.exprs import month_day, ratio
from roamsight.sources.staging import shared
from roamsight.sources.tables import Tables

GROWTH = {
    "growth_sessions_pct": "sessions",
    "growth_trips_pct": "trips_booked",
    "growth_active_users_pct": "active_users",
    "growth_new_users_pct": "new_users",
    "growth_total_users_pct": "total_users",
}
_COUNTS = ("sessions", "trips_booked", "active_users", "repeat_bookers", "bookers_total", "new_users")


def session_days(tables: Tables) -> tuple[DataFrame, date | None]:
    """User, trip and day of every session, all that KPIs and retention read of them, and the latest day.

    Stored in one pass over the sessions, which also finds the latest day; all reports of an application share the copy.
    """
    days = tables.sessions.select("user_id", "trip_id", F.to_date("session_start").alias("day"))
    found, seen = shared(days, "session_days", latest=F.max("day"))
    return found, seen["latest"]


def ytd_cutoff(tables: Tables) -> DataFrame:
    """One row: date, month and day of the latest session."""
    latest = F.lit(session_days(tables)[1]).cast("date")
    row = tables.sessions.sparkSession.range(1)
    return row.select(latest.alias("max_sess_date"), F.month(latest).alias("m"), F.dayofmonth(latest).alias("d"))


def up_to_cutoff(tables: Tables, day: Column) -> Column:
    """True for days up to the cutoff's month and day in their own year; 29 February needs no special case."""
    latest = session_days(tables)[1]
    return month_day(day) <= F.lit(latest and latest.month * 100 + latest.day).cast("int")


def yearly_sessions(tables: Tables, ytd: bool) -> DataFrame:
    days, day = session_days(tables)[0], F.col("day")
    chosen = days.where(up_to_cutoff(tables, day)) if ytd else days
    return chosen.select(F.year(day).alias("year"), "user_id", "trip_id")


def trips_per_user_year(tables: Tables, ytd: bool = False) -> DataFrame:
    """Distinct trips of each user in each year with any."""
    trips = yearly_sessions(tables, ytd).where(F.col("trip_id").isNotNull()).distinct()
    return trips.groupBy("year", "user_id").agg(F.count(F.lit(1)).alias("trips_user_year"))


def user_years(sessions: DataFrame) -> DataFrame:
    """Sessions of each user in each year, and whether they are about any trip and about more than one.

    Two trips differ when the smallest id is not the largest, so nothing has to be shuffled per trip.
    """
    first, last = F.min("trip_id"), F.max("trip_id")
    return sessions.groupBy("year", "user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        first.isNotNull().alias("booked"),
        F.coalesce(first != last, F.lit(False)).alias("booked_again"),
    )


def _activity() -> list[Column]:
    return [F.sum("sessions").alias("sessions"), F.count("user_id").alias("active_users")]


def _bookers() -> list[Column]:
    return [F.count_if("booked_again").alias("repeat_bookers"), F.count_if("booked").alias("bookers_total")]


def trips_by_year(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where(F.col("trip_id").isNotNull())
        .select("year", "trip_id")
        .distinct()
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("trips_booked"))
    )


def _add_up(parts: list[DataFrame]) -> DataFrame:
    """Merge per-year frames with different columns; a few rows each. Counts missing for a year are 0."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    counts = [c for c in merged.columns if c != "year"]
    return merged.groupBy("year").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts])


def sessions_by_year(tables: Tables, ytd: bool = False) -> DataFrame:
    """Sessions, active users and distinct trips (cancelled ones included) per year."""
    sessions = yearly_sessions(tables, ytd)
    activity = user_years(sessions).groupBy("year").agg(*_activity())
    return _add_up([activity, trips_by_year(sessions)])


def repeat_bookers_by_year(tables: Tables, ytd: bool = False) -> DataFrame:
    """Users with more than one trip and users with any, per year that has trips."""
    booked = yearly_sessions(tables, ytd).where(F.col("trip_id").isNotNull())
    return user_years(booked).groupBy("year").agg(*_bookers())


def _signups(tables: Tables, ytd: bool) -> DataFrame:
    """Per signup year: distinct users and rows that count in that year, and all rows, which count from the next on."""
    day = F.col("sign_up_date")
    if ytd:
        users = tables.users.where(day.isNotNull()).withColumn("counts", up_to_cutoff(tables, day))
    else:
        users = tables.users.withColumn("counts", F.lit(True))
    return users.groupBy(F.year(day).alias("year")).agg(
        F.count_distinct(F.when(F.col("counts"), F.col("user_id"))).alias("new_users"),
        F.count_if("counts").alias("signups_counted"),
        F.count(F.lit(1)).alias("signups"),
    )


def new_users_by_year(tables: Tables, ytd: bool = False) -> DataFrame:
    return _signups(tables, ytd).where("signups_counted > 0").select("year", "new_users")


def _yearly_counts(tables: Tables, ytd: bool) -> DataFrame:
    """All base counts per report year. Windows here run over one row per year.

    Registered users are a running sum of signups, also over years that are not reported; comparing every user with
    every year would multiply the users table by the number of years.
    """
    sessions = yearly_sessions(tables, ytd)
    activity = user_years(sessions).groupBy("year").agg(*_activity(), *_bookers())
    before = Window.orderBy(F.asc_nulls_last("year")).rowsBetween(Window.unboundedPreceding, -1)
    registered = F.coalesce(F.sum("signups").over(before), F.lit(0)) + F.col("signups_counted")
    counts = _add_up([activity, trips_by_year(sessions), _signups(tables, ytd)])
    reported = counts.withColumn("total_users", registered).where("sessions > 0 or signups_counted > 0")
    # rows without a date keep their own line, but nothing can be attributed to it
    known = F.col("year").isNotNull()
    return reported.select(
        "year", *[F.when(known, F.col(c)).otherwise(F.lit(0)).alias(c) for c in (*_COUNTS, "total_users")]
    )


def total_users_by_year(tables: Tables, ytd: bool = False) -> DataFrame:
    """Users registered up to each report year that has any."""
    return _yearly_counts(tables, ytd).select("year", "total_users").where("total_users > 0")


def _percent(part: Column | str, whole: str) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    return ratio(part * 100, F.col(whole), 2)


def _growth(column: str) -> Column:
    """Percent change from the previous reported year, which need not be the calendar year before."""
    previous = F.lag(column).over(Window.orderBy(F.asc_nulls_last("year")))
    return ratio((F.col(column) - previous) * 100, previous, 2)


def _kpis(tables: Tables, ytd: bool) -> DataFrame:
    dormant = F.col("total_users") - F.col("active_users")
    return (
        _yearly_counts(tables, ytd)
        .select(
            "year",
            "sessions",
            "trips_booked",
            "active_users",
            "new_users",
            "total_users",
            dormant.alias("dormant_users"),
            *[_growth(column).alias(name) for name, column in GROWTH.items()],
            _percent("trips_booked", "sessions").alias("session_to_booking_conv_pct"),
            ratio(F.col("trips_booked"), F.col("active_users"), 2).alias("trips_per_active_user"),
            ratio(F.col("sessions"), F.col("active_users"), 2).alias("sessions_per_active_user"),
            _percent("repeat_bookers", "bookers_total").alias("repeat_booker_share_pct"),
            _percent("active_users", "total_users").alias("active_user_rate_pct"),
            _percent("bookers_total", "total_users").alias("booker_rate_pct"),
            _percent(dormant, "total_users").alias("dormant_rate_pct"),
        )
        .orderBy(F.asc_nulls_last("year"))
    )


def kpi_full_year(tables: Tables) -> DataFrame:
    return _kpis(tables, ytd=False).withColumnRenamed("year", "the_year")


def kpi_ytd(tables: Tables) -> DataFrame:
    return _kpis(tables, ytd=True).withColumnRenamed("year", "ytd_year")


def kpi_dashboard(tables: Tables) -> DataFrame:
    """The year-to-date columns the dashboard shows."""
    return kpi_ytd(tables).select(
        "ytd_year",
        "total_users",
        "new_users",
        "active_users",
        "trips_booked",
        "sessions",
        "trips_per_active_user",
        "growth_total_users_pct",
        "growth_new_users_pct",
        "growth_active_users_pct",
        "growth_trips_pct",
        "growth_sessions_pct",
    )
