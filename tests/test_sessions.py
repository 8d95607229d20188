"""Dirty and borderline sessions, one user and trip each, all described in one run."""

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import SMALL, make_tables
from roamsight.params import Params
from roamsight.plans.cohort import Cohort
from roamsight.plans.sessions import session_base

MAPPING = [("paris", "france"), ("toronto", "canada"), ("boston", "usa")]
LATE = datetime(2023, 3, 1, 23, 59, 30)
FRIDAY = {"departure_time": datetime(2023, 4, 7, 8), "return_time": datetime(2023, 4, 9, 8)}


def nights(n, returns):
    return {"flight": {"return_time": returns}, "hotel": {"nights": n}}


def friday_stay(n):
    return {"check_in_time": datetime(2023, 4, 7, 8), "check_out_time": datetime(2023, 4, 7 + n, 8), "nights": n}


# what differs from an ordinary trip; False leaves the flight or hotel row out
CASES = {
    "ordinary": {},
    "negative nights": nights(-2, None),
    "negative nights with return": nights(-2, datetime(2023, 4, 8, 1, 0)),
    "zero nights": nights(0, None),
    "zero nights with return": nights(0, datetime(2023, 4, 5, 23, 0)),
    "nights missing": nights(None, None),
    "nights wrong": nights(9, None),
    "discounts": {
        "session": {"flight_discount": True, "hotel_discount": True, "hotel_discount_amount": Decimal("0.10")}
    },
    "discount flag missing": {"session": {"flight_discount": None, "flight_discount_amount": Decimal("0.10")}},
    "no airline, no hotel name": {"flight": {"trip_airline": None}, "hotel": {"hotel_name": None}},
    "no rows": {"flight": False, "hotel": False},
    "booking flags missing": {"session": {"flight_booked": None, "hotel_booked": None}},
    "nothing booked": {"session": {"flight_booked": False, "hotel_booked": False}},
    "cancellation missing": {"session": {"cancellation": None}},
    "hotel only": {"session": {"flight_booked": False}, "flight": False},
    "flight only": {"session": {"hotel_booked": False}, "hotel": False},
    "return flag missing": {"flight": {"return_flight_booked": None}},
    "one way": {"flight": {"return_flight_booked": False, "return_time": None}},
    "other airport": {"flight": {"origin_airport": "AWAY"}},
    "coordinate missing": {"flight": {"destination_airport_lat": None}},
    "to toronto": {"flight": {"destination": "toronto"}},
    "to boston": {"flight": {"destination": "boston"}},
    "to nowhere": {"flight": {"destination": "atlantis"}},
    "to home": {"flight": {"destination_airport_lat": 40.0, "destination_airport_lon": -75.0}},
    "no seats": {"flight": {"seats": 0}},
    "price tie": {"flight": {"seats": 2, "base_fare_usd": Decimal("123.45")}},
    "two dashes": {"hotel": {"hotel_name": "Stay-Inn -  new york "}},
    "no dash": {"hotel": {"hotel_name": "Grand Hotel"}},
    "no time": {"session": {"session_start": LATE, "session_end": LATE}},
    "over midnight": {"session": {"session_start": LATE, "session_end": datetime(2023, 3, 2, 0, 0, 0, 300_000)}},
    "clock change": {
        "session": {"session_start": datetime(2023, 3, 26, 1, 0), "session_end": datetime(2023, 3, 26, 4, 0)}
    },
    "weekend": {"flight": FRIDAY, "hotel": friday_stay(2)},
    "friday, three nights": {"hotel": friday_stay(3)},
    "long stay": {"hotel": friday_stay(8)},
    "middle stay": {"hotel": friday_stay(7)},
    **{
        f"born {born}": {"user": {"birthdate": born}}
        for born in (
            date(2003, 12, 31),
            date(1998, 12, 31),
            date(1997, 12, 31),
            date(1968, 1, 1),
            date(1967, 12, 31),
            None,
        )
    },
}


def describe(spark, cases):
    ids = {name: i for i, name in enumerate(cases)}
    part = lambda name, kind, key: {key: ids[name], **(cases[name].get(kind) or {})}
    made = make_tables(
        spark,
        sessions=[{**part(n, "session", "session_id"), "user_id": ids[n], "trip_id": ids[n]} for n in cases],
        users=[part(n, "user", "user_id") for n in cases],
        flights=[part(n, "flight", "trip_id") for n in cases if cases[n].get("flight") is not False],
        hotels=[part(n, "hotel", "trip_id") for n in cases if cases[n].get("hotel") is not False],
        mapping=MAPPING,
    )
    found = {r.session_id: r.asDict() for r in session_base(made, Cohort(made, SMALL), SMALL).collect()}
    return {name: found[i] for name, i in ids.items()}


@pytest.fixture(scope="module")
def described(spark):
    return describe(spark, CASES)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("negative nights", 2),
        ("negative nights with return", 5),
        ("zero nights", 1),
        ("zero nights with return", 2),
        ("nights missing", 3),
        ("nights wrong", 3),
    ],
)
def test_nights(described, name, expected):
    assert described[name]["nights_cleaned"] == expected


def test_ordinary_trip(described):
    row = described["ordinary"]
    assert row["trip_status"] == "booked"
    assert row["booking_category"] == "flight+hotel"
    assert row["hotel_city"] == "paris"
    assert row["session_duration_min"] == Decimal("5.00")
    assert row["clicks_per_min"] == Decimal("2.00")
    assert (row["departure_dow"], row["return_dow"], row["check_in_dow"]) == (1, 4, 1)
    assert row["dow_check_out_cleaned"] == 4
    assert (row["flight_trip_nights"], row["flight_trip_days"], row["flight_trip_length"]) == (3, 4, 3)
    assert row["leadtime_flight_hotel_combined"] == 33
    assert row["leadtime_hotel_only"] is None and row["leadtime_flight_only"] is None
    assert row["is_short_weekday_flight"] and row["is_short_weekday_hotel"]
    assert not row["is_weekender_flight"] and not row["is_weekender_hotel"]
    assert (row["season_hotel"], row["season_flight"]) == ("spring", "spring")
    assert row["stay_length"] == "short (1-3)"
    assert row["flight_distance_category"] == "long-haul"
    assert row["flight_destination_category"] == "intercontinental"
    assert row["flight_price_per_seat"] == Decimal("300.00")
    assert row["flight_price_per_km"] == round(Decimal(300 / (2 * row["flight_distance_km"])), 4)
    assert not [c for c in row if c.startswith("_")]


def test_discount_needs_an_amount(described):
    assert described["discounts"]["flight_discount_cleaned"] is False
    assert described["discounts"]["hotel_discount_cleaned"] is True
    assert described["discount flag missing"]["flight_discount_cleaned"] is False


def test_booking_needs_flight_and_hotel_rows(described):
    row = described["no airline, no hotel name"]
    assert row["flight_booked_cleaned"] is False and row["hotel_booked_cleaned"] is False
    assert row["trip_status"] == "none" and row["booking_category"] == "browsing only"
    assert row["clicks_browsing"] == 10 and row["clicks_booking"] is None
    assert described["no rows"]["trip_status"] == "none"
    assert described["no rows"]["flight_trip_length"] == 1  # also without a flight


def test_missing_flags_are_false(described):
    row = described["booking flags missing"]
    assert row["flight_booked_cleaned"] is False and row["hotel_booked_cleaned"] is False
    assert described["cancellation missing"]["trip_status"] == "booked"


def test_single_bookings(described):
    row = described["hotel only"]
    assert row["booking_category"] == "hotel only" and row["clicks_hotel_only"] == 10
    assert (row["leadtime_hotel_only"], row["leadtime_flight_only"]) == (33, None)
    row = described["flight only"]
    assert row["booking_category"] == "flight only" and row["stay_length"] is None and row["season_hotel"] is None
    assert (row["leadtime_hotel_only"], row["leadtime_flight_only"]) == (None, 33)


def test_return_flag_missing_or_false(described):
    row = described["return flag missing"]
    assert row["flight_trip_nights"] == 3 and row["flight_price_per_km"] is None
    assert row["is_short_weekday_flight"] is None
    row = described["one way"]
    assert row["flight_trip_nights"] is None
    assert row["flight_price_per_km"] == round(Decimal(300 / row["flight_distance_km"]), 4)


@pytest.mark.parametrize("name", ["other airport", "coordinate missing"])
def test_no_distance(described, name):
    for column in ("flight_distance_km", "flight_distance_category", "flight_destination_category", "flight_price_per_km"):
        assert described[name][column] is None


def test_destination_categories(described):
    found = {n: described[n]["flight_destination_category"] for n in ("to boston", "to toronto", "to nowhere")}
    assert found == {"to boston": "domestic", "to toronto": "international", "to nowhere": "intercontinental"}


def test_zero_distance_has_no_price(described):
    row = described["to home"]
    assert row["flight_distance_km"] == 0 and row["flight_price_per_km"] is None
    assert row["flight_distance_category"] == "short-haul"


def test_seats(described):
    assert described["no seats"]["flight_price_per_seat"] is None
    assert described["price tie"]["flight_price_per_seat"] == Decimal("61.73")  # 61.725, away from zero


def test_hotel_names(described):
    assert described["two dashes"]["hotel_city"] == "new york"
    assert described["no dash"]["hotel_city"] is None


def test_durations(described):
    row = described["no time"]
    assert row["session_duration_min"] == 0 and row["clicks_per_min"] is None
    assert described["over midnight"]["session_duration_min"] == Decimal("0.51")  # 0.505 minutes
    assert described["clock change"]["session_duration_min"] == 180  # whatever the session time zone does that night


def test_ages(described):
    found = {n: (r["age_years"], r["age_group"]) for n, r in described.items() if n.startswith("born")}
    assert found == {
        "born 2003-12-31": (20, "18-25"),
        "born 1998-12-31": (25, "18-25"),
        "born 1997-12-31": (26, "26-35"),
        "born 1968-01-01": (55, "46-55"),
        "born 1967-12-31": (56, "55+"),
        "born None": (None, "unknown"),
    }


def test_weekend_and_weekday_flags(described):
    row = described["weekend"]
    assert row["is_weekender_flight"] and row["is_weekender_hotel"]
    assert not row["is_short_weekday_flight"] and not row["is_short_weekday_hotel"]
    # Friday plus three nights is Monday, and counts although a weekend lies between
    assert described["friday, three nights"]["is_short_weekday_hotel"] is True
    row = described["nothing booked"]
    assert row["is_weekender_flight"] is False and row["is_short_weekday_hotel"] is False


def test_stay_lengths(described):
    assert described["middle stay"]["stay_length"] == "mid (4-7)"
    assert described["long stay"]["stay_length"] == "long (8+)"


def test_seasons_by_month_and_without_a_date(spark):
    days = {month: datetime(2023, month, 15, 8) for month in range(1, 13)} | {None: None}
    cases = {m: {"flight": {"departure_time": day}, "hotel": {"check_in_time": day}} for m, day in days.items()}
    found = describe(spark, cases)
    names = 2 * ["winter"] + 3 * ["spring"] + 3 * ["summer"] + 3 * ["fall"] + ["winter"]
    expected = {month: (name, name) for month, name in enumerate(names, 1)} | {None: (None, None)}
    assert {m: (row["season_hotel"], row["season_flight"]) for m, row in found.items()} == expected


def test_trip_status(spark):
    """A cancelling session marks the whole trip, unless it lies before the cohort."""
    early = datetime(2023, 1, 3, 23, 59)
    made = make_tables(
        spark,
        sessions=[
            {"session_id": 1, "user_id": 1, "trip_id": 1},
            {"session_id": 2, "user_id": 1, "trip_id": 1, "cancellation": True},
            {"session_id": 3, "user_id": 1, "flight_booked": None, "hotel_booked": None},
            {"session_id": 4, "user_id": 1, "trip_id": 2},
            {"session_id": 5, "user_id": 1, "trip_id": 2, "cancellation": True, "session_start": early},
        ],
        users=[{"user_id": 1}],
        flights=[{"trip_id": 1}, {"trip_id": 2}],
        hotels=[{"trip_id": 1}],
    )
    found = {r.session_id: r for r in session_base(made, Cohort(made, SMALL), SMALL).collect()}
    assert {k: v.trip_status for k, v in found.items()} == {1: "cancelled", 2: "cancelled", 3: "none", 4: "booked"}
    assert found[1].clicks_cancellation == 10 and found[1].leadtime_flight_hotel_combined is None
    assert found[3].booking_category == "browsing only" and found[3].seats is None


def test_completed_years(spark):
    params = replace(SMALL, as_of_date=date(2023, 2, 28))
    made = make_tables(
        spark,
        sessions=[{"session_id": 1, "user_id": u} for u in (1, 2, 3)],
        users=[
            {"user_id": 1, "birthdate": date(2000, 2, 29)},
            {"user_id": 2, "birthdate": date(2000, 2, 28)},
            {"user_id": 3, "birthdate": date(2023, 6, 1)},
        ],
    )
    ages = {r.user_id: r.age_years for r in Cohort(made, params).profiles.collect()}
    assert ages == {1: 22, 2: 23, 3: 0}


def test_cohort_needs_more_sessions_than_the_limit_and_a_user_row(spark):
    sessions = [{"session_id": 100 * u + i, "user_id": u} for u, n in ((1, 7), (2, 8), (3, 8)) for i in range(n)]
    made = make_tables(spark, sessions=sessions, users=[{"user_id": 1}, {"user_id": 2}])
    cohort = Cohort(made, Params())
    assert [r.user_id for r in cohort.profiles.collect()] == [2]
    assert cohort.member_sessions.count() == 8
