"""Session level: the trip and user a session belongs to, and everything that follows from them.

Every column is computed at the coarsest grain that knows its inputs (user, trip, session), so date and price arithmetic
runs once per trip and the session stage is left with cheap conditions. Names with a leading underscore are
helpers that do not leave this module's results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.functions.exprs import (
    days_between,
    haversine_km,
    hundredths_to_minutes,
    iso_weekday,
    minute_hundredths,
    ratio,
    season,
)
from roamsight.operators.skew import join_sliced, join_split
from roamsight.params import Params
from roamsight.plans.cohort import ROW_NUMBER, Cohort
from roamsight.sources.tables import Tables

_BROADCAST_DESTINATIONS = 100_000
_FRI_SAT = (5, 6)
_SAT_SUN = (6, 7)


def _is_true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


# --- trips ------------------------------------------------------------------------------------------------------------


def _stay() -> dict[str, Column]:
    nights, return_time, check_in = F.col("nights"), F.col("return_time"), F.col("check_in_time")
    until_return = days_between(check_in, return_time)
    return {
        "nights_cleaned": F.when(nights < 0, F.when(return_time.isNull(), -nights).otherwise(until_return))
        .when(nights == 0, F.when(return_time.isNull(), F.lit(1)).otherwise(until_return))
        .otherwise(days_between(check_in, F.col("check_out_time"))),
        "hotel_city": F.when(
            F.col("hotel_name").contains("-"), F.trim(F.regexp_replace("hotel_name", r"(?s)^.*-\s*", ""))
        ),
        "departure_dow": iso_weekday(F.col("departure_time")),
        "return_dow": iso_weekday(return_time),
        "check_in_dow": iso_weekday(check_in),
        "_away": days_between(F.col("departure_time"), return_time),
        "_departure_day": F.to_date("departure_time"),
        "_check_in_day": F.to_date(check_in),
    }


def _trip_shape() -> dict[str, Column]:
    """What follows from the stay; whether the session booked it is decided later."""
    with_return, away, nights = F.col("return_flight_booked"), F.col("_away"), F.col("nights_cleaned")
    departs, returns, arrives = F.col("departure_dow"), F.col("return_dow"), F.col("check_in_dow")
    fare, seats = F.col("base_fare_usd"), F.col("seats")
    return {
        "dow_check_out_cleaned": iso_weekday(F.date_add(F.col("_check_in_day"), nights)),
        "_season_hotel": season(F.col("_check_in_day")),
        "_season_flight": season(F.col("_departure_day")),
        "_weekender_flight": with_return & departs.isin(*_FRI_SAT) & away.between(1, 2),
        "_weekender_hotel": arrives.isin(*_FRI_SAT) & nights.between(1, 2),
        "_weekday_flight": with_return
        & (away <= 4)
        & ~departs.isin(*_SAT_SUN)
        & ~returns.isin(*_SAT_SUN)
        & (returns > departs),
        # the weekday after the stay is deliberately not wrapped at 7: Friday plus three nights counts
        "_weekday_hotel": nights.between(1, 4) & ~arrives.isin(*_SAT_SUN) & ~(arrives + nights).isin(*_SAT_SUN),
        "_seat_price": F.when(seats > 0, ratio(fare, seats, 2)),
        "_seat_fare": F.when(seats > 0, fare.cast("double") / seats),
        "_legs": F.when(with_return, 2).when(~with_return, 1),
    }


def _countries(tables: Tables) -> DataFrame:
    """The destination list, broadcast if it is as short as the built-in one or at least bounded."""
    short = tables.mapping.limit(_BROADCAST_DESTINATIONS + 1).count() <= _BROADCAST_DESTINATIONS
    return F.broadcast(tables.mapping) if short else tables.mapping


def trips(tables: Tables, cohort: Cohort) -> DataFrame:
    """One row per trip of the cohort: its status, flight, hotel and destination country.

    A booking only counts when the matching flight or hotel row is there.
    """
    seen = cohort.member_trips
    if tables.trip_buckets:  # the trips seen go where flights and hotels lie
        seen = seen.repartition(tables.trip_buckets, "trip_id")
    seen = seen.groupBy("trip_id").agg(*[F.bool_or(c).alias(c) for c in ("any_cancelled", "any_flight", "any_hotel")])
    flights = cohort.of_trips(tables.flights).join(_countries(tables), "destination", "left")
    booked = (F.col("any_flight") & F.col("trip_airline").isNotNull()) | (
        F.col("any_hotel") & F.col("hotel_name").isNotNull()
    )
    status = F.when(F.col("any_cancelled"), "cancelled").when(booked, "booked").otherwise("none")
    return (
        seen.join(flights, "trip_id", "left")
        .join(cohort.of_trips(tables.hotels), "trip_id", "left")
        .withColumns({"trip_status": status, **_stay()})
        .withColumns(_trip_shape())
        .drop("any_cancelled", "any_flight", "any_hotel")
    )


def joined_sessions(tables: Tables, cohort: Cohort) -> DataFrame:
    """Cohort sessions with the columns of their user, flight, hotel, destination country and trip status.

    Trips come first and users last: rows then lie by user, and a per-user aggregation that follows
    has little left to move.
    """
    described = trips(tables, cohort)
    with_trip = join_split(cohort.sessions, described, "trip_id", ROW_NUMBER, cohort.hot_trips, cohort.numbered)
    with_trip = with_trip.withColumn("trip_status", F.coalesce(F.col("trip_status"), F.lit("none")))
    profiles = cohort.profiles.drop("cohort_sessions")
    return join_sliced(with_trip, profiles, "user_id", ROW_NUMBER, cohort.hot_users, "inner")


# --- sessions ---------------------------------------------------------------------------------------------------------


def _cleaned() -> dict[str, Column]:
    """Columns computed from source columns alone."""
    at_home = F.col("origin_airport") == F.col("home_airport")
    return {
        "flight_discount_cleaned": _is_true("flight_discount") & F.col("flight_discount_amount").isNotNull(),
        "hotel_discount_cleaned": _is_true("hotel_discount") & F.col("hotel_discount_amount").isNotNull(),
        "flight_booked_cleaned": _is_true("flight_booked") & F.col("trip_airline").isNotNull(),
        "hotel_booked_cleaned": _is_true("hotel_booked") & F.col("hotel_name").isNotNull(),
        "flight_trip_length": F.greatest(F.col("_away"), F.lit(1)),  # 1 also without a flight
        "_hundredths": minute_hundredths(F.col("session_start"), F.col("session_end")),
        "_session_day": F.to_date("session_start"),
        # haversine is NULL when a coordinate is
        "flight_distance_km": F.when(
            at_home,
            haversine_km(
                F.col("home_airport_lat"),
                F.col("home_airport_lon"),
                F.col("destination_airport_lat"),
                F.col("destination_airport_lon"),
            ),
        ),
    }


def _categories(params: Params) -> dict[str, Column]:
    flight, hotel = F.col("flight_booked_cleaned"), F.col("hotel_booked_cleaned")
    nights, km = F.col("nights_cleaned"), F.col("flight_distance_km")
    home, target = F.col("home_country"), F.col("destination_country")
    return {
        "booking_category": F.when(hotel & flight, "flight+hotel")
        .when(hotel, "hotel only")
        .when(flight, "flight only")
        .otherwise("browsing only"),
        "stay_length": F.when(
            hotel, F.when(nights <= 3, "short (1-3)").when(nights <= 7, "mid (4-7)").otherwise("long (8+)")
        ),
        "season_hotel": F.when(hotel, F.col("_season_hotel")),
        "season_flight": F.when(flight, F.col("_season_flight")),
        "flight_distance_category": F.when(
            km.isNotNull(),
            F.when(km <= params.short_haul_km, "short-haul")
            .when(km <= params.medium_haul_km, "medium-haul")
            .otherwise("long-haul"),
        ),
        "flight_destination_category": F.when(
            km.isNotNull(),
            F.when(home == target, "domestic")
            .when((home != target) & target.isin(*params.neighbour_countries), "international")
            .otherwise("intercontinental"),
        ),
    }


def _splits() -> dict[str, Column]:
    """Clicks and minutes kept for one kind of session; NULL for all others."""
    flight, hotel = F.col("flight_booked_cleaned"), F.col("hotel_booked_cleaned")
    clicks, hundredths, status = F.col("page_clicks"), F.col("_hundredths"), F.col("trip_status")
    minutes = hundredths_to_minutes(hundredths)
    kinds = {"booking": status == "booked", "cancellation": status == "cancelled", "browsing": ~flight & ~hotel}
    split = {
        "session_duration_min": minutes,
        "clicks_per_min": ratio(clicks * 100, hundredths, 2),
        "clicks_hotel_only": F.when(hotel & ~flight, clicks),
        "clicks_flight_only": F.when(flight & ~hotel, clicks),
        "clicks_flight_hotel": F.when(hotel & flight, clicks),
        "clicks_browsing_only": F.when(~hotel & ~flight, clicks),
    }
    for kind, when in kinds.items():
        split[f"clicks_{kind}"] = F.when(when, clicks)
        split[f"session_duration_{kind}"] = F.when(when, minutes)
    return split


def _travel() -> dict[str, Column]:
    """Lead times, lengths and the weekend and weekday flags."""
    flight, hotel = F.col("flight_booked_cleaned"), F.col("hotel_booked_cleaned")
    booked, away = F.col("trip_status") == "booked", F.col("_away")
    to_departure = F.datediff("_departure_day", "_session_day")
    to_check_in = F.datediff("_check_in_day", "_session_day")
    one_way = ~flight | ~F.col("return_flight_booked")  # unknown when the return flag is, and then the length is given
    return {
        "leadtime_flight_hotel_combined": F.when(booked & hotel & flight, to_departure),
        "leadtime_hotel_only": F.when(booked & hotel & ~flight, to_check_in),
        "leadtime_flight_only": F.when(booked & ~hotel & flight, to_departure),
        "flight_trip_nights": F.when(one_way, None).otherwise(away),
        "flight_trip_days": F.when(one_way, None).otherwise(away + 1),
        "is_weekender_flight": flight & F.col("_weekender_flight"),
        "is_weekender_hotel": hotel & F.col("_weekender_hotel"),
        "is_short_weekday_flight": flight & F.col("_weekday_flight"),
        "is_short_weekday_hotel": hotel & F.col("_weekday_hotel"),
    }


def _prices() -> dict[str, Column]:
    flight, km = F.col("flight_booked_cleaned"), F.col("flight_distance_km")
    per_km = F.col("_seat_fare") / (km * F.col("_legs"))
    return {
        "flight_price_per_seat": F.when(flight, F.col("_seat_price")),
        "flight_price_per_km": F.when(flight & (km > 0), per_km.cast("decimal(18,4)")),  # the cast rounds
    }


def describe_sessions(joined: DataFrame, params: Params) -> DataFrame:
    """Add every cleaned and derived session column; no shuffle."""
    return joined.withColumns(_cleaned()).withColumns(_categories(params) | _splits() | _travel() | _prices())


def session_base(tables: Tables, cohort: Cohort, params: Params) -> DataFrame:
    """The cleaned session table: one row per cohort session."""
    described = describe_sessions(joined_sessions(tables, cohort), params)
    return described.drop(*[c for c in described.columns if c.startswith("_")])
