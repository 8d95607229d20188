"""Features of a user relative to the cohort: scaled values, percentile flags, conditions and quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.functions.exprs import flag, or_zero, ratio
from roamsight.operators.percentiles import Percentile, exact_percentiles
from roamsight.params import Params

_SCALED = ("avg_bags", "avg_seats", "avg_nights_total")

# flag: (column, "low" or "high" tail). The frequent-traveler limit is a value that occurs, all others interpolate.
_TAILS = {
    "is_quick_booker_p20": ("avg_min_booking", "low"),
    "is_slow_booker_p80": ("avg_min_booking", "high"),
    "is_low_clicks_booker_p20": ("avg_clicks_booking", "low"),
    "is_high_clicks_booker_p80": ("avg_clicks_booking", "high"),
    "is_short_leadtime_p20": ("avg_leadtime_combined", "low"),
    "is_frequent_traveler_p80": ("valid_bookings", "high"),
    "is_high_price_flight_p80": ("avg_flight_price_per_km", "high"),
    "is_budget_price_flight_p20": ("avg_flight_price_per_km", "low"),
    "is_high_price_hotel_p80": ("avg_hotel_price_per_night", "high"),
    "is_budget_price_hotel_p20": ("avg_hotel_price_per_night", "low"),
}
_OCCURRING = {"is_frequent_traveler_p80"}

# columns only the inspection output needs; the short job leaves them out
EXTRA_FEATURES = [
    "is_short_leadtime_p20",
    "domestic_flight_quote",
    "international_flight_quote",
    "intercontinental_flight_quote",
]


def _wanted(params: Params, flags: list[str] | None) -> list[Percentile]:
    tail = {"low": params.low_percentile, "high": params.high_percentile}
    return [
        Percentile(name, column, tail[side], cont=name not in _OCCURRING)
        for name, (column, side) in _TAILS.items()
        if flags is None or name in flags
    ]


def percentile_limits(users: DataFrame, params: Params, flags: list[str] | None = None) -> DataFrame:
    """One row: for each flag the cohort percentile it compares with, in a column named after the flag."""
    found = exact_percentiles(users, wanted := _wanted(params, flags), params.percentile_buckets)
    shape = ", ".join(f"{w.name} decimal(28,10)" for w in wanted)
    return users.sparkSession.createDataFrame([tuple(found[w.name] for w in wanted)], shape)


def value_ranges() -> dict[str, Column]:
    """Cohort minimum and maximum of the scaled columns."""
    return {f"min_{c}": F.min(c) for c in _SCALED} | {f"max_{c}": F.max(c) for c in _SCALED}


def _number(value) -> Column:
    return F.lit(value).cast("decimal(28,10)")


def _inverted(column: str, ranges: dict) -> Column:
    """1 at the cohort minimum, 0 at the maximum; 0 for users without a value or when all values are equal."""
    low, high = _number(ranges[f"min_{column}"]), _number(ranges[f"max_{column}"])
    part = (F.col(column) - low).cast("decimal(17,4)") / F.nullif(high - low, F.lit(0)).cast("decimal(17,4)")
    return or_zero((1 - F.round(part, 4)).cast("decimal(18,4)"))


def _quote(part: str, whole: str) -> Column:
    return or_zero(ratio(F.col(part), F.col(whole), 4))


def _beyond(name: str, limits: dict) -> Column:
    column, side = _TAILS[name]
    limit = _number(limits[name])
    return flag(F.col(column) < limit if side == "low" else F.col(column) > limit)


def features(users: DataFrame, params: Params, short: bool = False) -> DataFrame:
    """Features per user. ``users`` is read a few times: stage it first.

    Cohort-wide values are one small set of aggregates, computed here and used as constants, so that no later step computes
    them again; an unpartitioned window would move all users to one task.
    """
    flags = [name for name in _TAILS if not (short and name in EXTRA_FEATURES)]
    cohort = exact_percentiles(users, _wanted(params, flags), params.percentile_buckets, value_ranges())
    valid = F.col("valid_bookings")
    columns = {f"{c}_norm_invert": _inverted(c, cohort) for c in _SCALED}
    columns |= {name: _beyond(name, cohort) for name in flags}
    columns |= {
        "is_dreamer_no_bookings": flag(
            (F.col("total_sessions") == F.col("total_browsing_only")) | ((F.col("total_bookings") >= 1) & (valid == 0))
        ),
        "is_new_customer_booking": flag(F.col("last_booking_since_signup") <= params.new_customer_days),
        "has_middle_num_seats": flag(F.col("avg_seats").between(*params.middle_seats)),
        "has_middle_num_bags": flag(F.col("avg_bags").between(*params.middle_bags)),
        "has_middle_num_rooms": flag(F.col("avg_rooms").between(*params.middle_rooms)),
        "is_senior_traveler": flag((F.col("age") >= params.senior_age) & (valid >= 1)),
        "is_young_traveler": flag((F.col("age") <= params.young_age) & (valid >= 1)),
        "discount_booking_quote": _quote("sum_discount_bookings", "valid_bookings"),
        "discount_flight_quote": _quote("discount_flight_bookings", "valid_flight_bookings"),
        "discount_hotel_quote": _quote("discount_hotel_bookings", "valid_hotel_bookings"),
    }
    if not short:
        columns |= {
            f"{kind}_flight_quote": _quote(f"{kind}_flight_bookings", "valid_flight_bookings")
            for kind in ("domestic", "international", "intercontinental")
        }
    passed = ["user_id", "has_children", "is_in_working_age", "weekdays_travel_quote", "weekend_travel_quote"]
    return users.select(*passed, *[c.alias(name) for name, c in columns.items()])
