"""User level: totals over a user's sessions and averages per session, booking or trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.functions.exprs import flag, hundredths_to_minutes, or_zero, ratio
from roamsight.params import Params
from roamsight.plans.cohort import Cohort
from roamsight.plans.sessions import describe_sessions, joined_sessions
from roamsight.sources.tables import Tables


def _totals() -> dict[str, Column]:
    flight, hotel = F.col("flight_booked_cleaned"), F.col("hotel_booked_cleaned")
    booked = F.col("trip_status") == "booked"
    category, destination = F.col("booking_category"), F.col("flight_destination_category")
    seats, bags, rooms = F.col("seats"), F.col("checked_bags"), F.col("rooms")
    flight_nights, hotel_nights = F.col("flight_trip_nights"), F.col("nights_cleaned")
    flight_off, hotel_off = F.col("flight_discount_amount"), F.col("hotel_discount_amount")
    per_km, per_night = F.col("flight_price_per_km"), F.col("hotel_per_room_usd")
    discounted = (F.col("flight_discount_cleaned") & flight) | (F.col("hotel_discount_cleaned") & hotel)
    weekday_trip = F.col("is_short_weekday_flight") | F.col("is_short_weekday_hotel")
    weekend_trip = F.col("is_weekender_flight") | F.col("is_weekender_hotel")

    def amount(when: Column, value: Column) -> Column:
        return F.sum(F.when(when, value).otherwise(0))

    def minutes(when: Column) -> Column:
        """Added up as integers; a decimal sum would cost several times as much per session."""
        return hundredths_to_minutes(F.sum(F.when(when, F.col("_hundredths"))), 20)

    def mean(when: Column, value: Column) -> Column:
        kept = F.when(when, value)
        return ratio(F.sum(kept), F.count(kept), 4)

    def after_discount(price: Column, off: Column) -> Column:
        return price - price * F.coalesce(off, F.lit(0))

    return {
        "total_min_sessions": minutes(F.lit(True)),
        "total_min_booking": minutes(booked),
        "total_min_cancellation": minutes(F.col("trip_status") == "cancelled"),
        "total_min_browsing": minutes(~flight & ~hotel),
        "total_page_clicks": F.sum("page_clicks"),
        "total_clicks_booking": F.sum("clicks_booking"),
        "total_clicks_cancellation": F.sum("clicks_cancellation"),
        "total_clicks_browsing": F.sum("clicks_browsing"),
        "total_sessions": F.count("session_id"),
        "total_browsing_only": F.count_if(F.col("trip_id").isNull()),
        "total_cancellations": F.count_if("cancellation"),
        "valid_combined_bookings": F.count_if(booked & flight & hotel),
        "valid_flight_bookings": F.count_if(booked & flight),
        "flight_bookings_only": F.count_if(booked & flight & (category == "flight only")),
        "domestic_flight_bookings": F.count_if(booked & flight & (destination == "domestic")),
        "international_flight_bookings": F.count_if(booked & flight & (destination == "international")),
        "intercontinental_flight_bookings": F.count_if(booked & flight & (destination == "intercontinental")),
        "valid_hotel_bookings": F.count_if(booked & hotel),
        "hotel_bookings_only": F.count_if(booked & hotel & (category == "hotel only")),
        "discount_flight_bookings": F.count_if(booked & flight & F.col("flight_discount_cleaned")),
        "avg_flight_discount": mean(booked & flight, flight_off),
        "sum_flight_price_per_km": F.sum(F.when(booked & flight, after_discount(per_km, flight_off))),
        "discount_hotel_bookings": F.count_if(booked & hotel & F.col("hotel_discount_cleaned")),
        "avg_hotel_discount": mean(booked & hotel, hotel_off),
        "sum_hotel_price_per_night": F.sum(F.when(booked & hotel, after_discount(per_night, hotel_off))),
        "sum_discount_bookings": F.count_if(booked & discounted),
        "valid_seats": amount(booked, seats),
        "single_seat_bookings": F.count_if(booked & (seats == 1)),
        "valid_bags": amount(booked, bags),
        "no_bag_bookings": F.count_if(booked & (bags == 0)),
        "valid_rooms": amount(booked, rooms),
        "one_room_bookings": F.count_if(booked & (rooms == 1)),
        "single_room_bookings": F.count_if(booked & flight & hotel & (rooms == 1) & (seats == 1)),
        "double_room_bookings": F.count_if(booked & flight & hotel & (rooms == 1) & (seats == 2)),
        "nights_combined_flight_hotel": amount(booked & (category == "flight+hotel"), flight_nights),
        "nights_flight_total": amount(booked & flight, flight_nights),
        "nights_hotel_only": amount(booked & (category == "hotel only"), hotel_nights),
        "nights_flight_only": amount(booked & (category == "flight only"), flight_nights),
        "short_weekday_trips": F.count_if(booked & weekday_trip),
        "weekend_trips": F.count_if(booked & weekend_trip),
        "sum_leadtime_flight_hotel": F.sum("leadtime_flight_hotel_combined"),
        "sum_leadtime_hotel_only": F.sum("leadtime_hotel_only"),
        "sum_leadtime_flight_only": F.sum("leadtime_flight_only"),
        "age": F.max("age_years"),
        "is_married": F.max(flag(F.col("married"))),
        "has_children": F.max(flag(F.col("has_children"))),
        "last_booking_since_signup": F.datediff(
            F.max(F.when(F.col("trip_id").isNotNull() & booked, F.col("_session_day"))), F.max("sign_up_date")
        ),
        "last_session_since_signup": F.datediff(F.max(F.col("_session_day")), F.max("sign_up_date")),
    }


def user_totals(tables: Tables, cohort: Cohort, params: Params) -> DataFrame:
    """One row per cohort user.

    Distinct trips are counted from the (trip, user) pairs and joined per user. As a COUNT DISTINCT inside the
    large aggregation they would make Spark shuffle all other totals once per trip.
    """
    bookings = cohort.user_trips.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_bookings"))
    sessions = describe_sessions(joined_sessions(tables, cohort), params)
    totals = sessions.groupBy("user_id").agg(*[c.alias(name) for name, c in _totals().items()])
    return totals.join(bookings, "user_id", "left").withColumn(
        "total_bookings", F.coalesce(F.col("total_bookings"), F.lit(0).cast("bigint"))
    )


# average: (total, number it is divided by)
_AVERAGES = {
    "avg_min_per_session": ("total_min_sessions", "total_sessions"),
    "avg_min_booking": ("total_min_booking", "valid_bookings"),
    "avg_min_cancellation": ("total_min_cancellation", "total_cancellations"),
    "avg_min_browsing": ("total_min_browsing", "total_browsing_only"),
    "avg_page_clicks": ("total_page_clicks", "total_sessions"),
    "avg_clicks_booking": ("total_clicks_booking", "valid_bookings"),
    "avg_clicks_cancellation": ("total_clicks_cancellation", "total_cancellations"),
    "avg_clicks_browsing": ("total_clicks_browsing", "total_browsing_only"),
    "avg_flight_price_per_km": ("sum_flight_price_per_km", "valid_flight_bookings"),
    "avg_hotel_price_per_night": ("sum_hotel_price_per_night", "valid_hotel_bookings"),
    "avg_seats": ("valid_seats", "valid_flight_bookings"),
    "avg_bags": ("valid_bags", "valid_flight_bookings"),
    "avg_rooms": ("valid_rooms", "valid_hotel_bookings"),
    "avg_nights_combined": ("nights_combined_flight_hotel", "valid_combined_bookings"),
    "avg_nights_flight_total": ("nights_flight_total", "valid_flight_bookings"),
    "avg_nights_hotel_only": ("nights_hotel_only", "hotel_bookings_only"),
    "avg_nights_flight_only": ("nights_flight_only", "flight_bookings_only"),
    "avg_leadtime_combined": ("sum_leadtime_flight_hotel", "valid_combined_bookings"),
    "avg_leadtime_hotel_only": ("sum_leadtime_hotel_only", "hotel_bookings_only"),
    "avg_leadtime_flight_only": ("sum_leadtime_flight_only", "flight_bookings_only"),
}


def with_averages(totals: DataFrame, params: Params) -> DataFrame:
    """Add the per-user averages next to the totals; the rows are already one per user, so this is a projection."""
    valid = F.col("total_bookings") - F.col("total_cancellations")
    all_nights = F.col("nights_combined_flight_hotel") + F.col("nights_flight_only") + F.col("nights_hotel_only")
    averages = {name: ratio(F.col(total), F.col(by), 4) for name, (total, by) in _AVERAGES.items()}
    return totals.withColumn("valid_bookings", valid).withColumns(
        {
            "is_in_working_age": F.col("age").between(*params.working_age).cast("int"),
            **averages,
            "avg_nights_total": ratio(all_nights, F.col("valid_bookings"), 4),
            "weekdays_travel_quote": or_zero(ratio(F.col("short_weekday_trips"), F.col("valid_bookings"), 4)),
            "weekend_travel_quote": or_zero(ratio(F.col("weekend_trips"), F.col("valid_bookings"), 4)),
        }
    )


def user_table(tables: Tables, cohort: Cohort, params: Params) -> DataFrame:
    """Totals and averages of every cohort user."""
    return with_averages(user_totals(tables, cohort, params), params)


AVERAGE_COLUMNS = [
    "is_in_working_age",
    "avg_min_per_session",
    "avg_min_booking",
    "avg_min_cancellation",
    "avg_min_browsing",
    "avg_page_clicks",
    "avg_clicks_booking",
    "avg_clicks_cancellation",
    "avg_clicks_browsing",
    "valid_bookings",
    "avg_flight_price_per_km",
    "avg_hotel_price_per_night",
    "avg_seats",
    "avg_bags",
    "avg_rooms",
    "avg_nights_combined",
    "avg_nights_flight_total",
    "avg_nights_hotel_only",
    "avg_nights_flight_only",
    "avg_nights_total",
    "weekdays_travel_quote",
    "weekend_travel_quote",
    "avg_leadtime_combined",
    "avg_leadtime_hotel_only",
    "avg_leadtime_flight_only",
]


def user_averages(tables: Tables, cohort: Cohort, params: Params) -> DataFrame:
    return user_table(tables, cohort, params).select("user_id", *AVERAGE_COLUMNS)
