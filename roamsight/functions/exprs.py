"""Date, ratio and distance expressions shared by all jobs."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end; the time of day does not matter."""
    return F.datediff(F.to_date(end), F.to_date(start))


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(day) + 1


def month_day(day: Column) -> Column:
    """A number that orders days within a year: 28 July -> 728."""
    return F.month(day) * 100 + F.dayofmonth(day)


def full_years(on: date, born: Column) -> Column:
    """Completed years between a birthdate and a fixed day, truncated towards zero."""
    on_day = on.month * 100 + on.day
    grown = F.lit(on.year) - F.year(born) - (month_day(born) > on_day).cast("int")
    unborn = F.lit(on.year) - F.year(born) + (month_day(born) < on_day).cast("int")
    return F.when(born <= F.lit(on), grown).when(born > F.lit(on), unborn)


def minute_hundredths(start: Column, end: Column) -> Column:
    """Time between two timestamps in hundredths of a minute, rounded half away from zero, as bigint.

    Interval arithmetic on whole microseconds: exact, free of time zones, and no decimal division per row.
    """
    per_hundredth = (end - start) / F.lit(600_000)  # as many microseconds as there are hundredths
    return (per_hundredth * F.lit(1_000_000)).cast("interval second").cast("bigint")


def hundredths_to_minutes(hundredths: Column, precision: int = 12) -> Column:
    whole = hundredths.cast(f"decimal({precision},0)")
    return (whole * F.lit(Decimal("0.01"))).cast(f"decimal({precision},2)")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half away from zero; NULL when the denominator is 0.

    Decimal arithmetic throughout. The quotient keeps 20 decimals before rounding, so rounding twice
    cannot move a result across a tie.
    """
    exact = numerator.cast("decimal(22,6)") / F.nullif(denominator, F.lit(0)).cast("decimal(13,0)")
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(18,4)"))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lon = F.sin((lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    # rounding may lift the chord of opposite points above 1; a missing coordinate stays missing
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def season(ts: Column) -> Column:
    """Northern-hemisphere season of a date; December opens the winter. NULL without a date."""
    month = F.month(ts)  # not an index: in ANSI mode element_at takes a missing one for the last
    named = F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring")
    return named.when(month.isin(6, 7, 8), "summer").when(month.isin(9, 10, 11), "fall")
