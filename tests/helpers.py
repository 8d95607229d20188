"""Small hand-made travel tables."""

from datetime import date, datetime
from decimal import Decimal

from roamsight.params import Params
from roamsight.sources.tables import FLIGHTS, HOTELS, MAPPING, SESSIONS, USERS, Tables

SMALL = Params(min_sessions=0)

_SESSION = dict(
    session_start=datetime(2023, 3, 1, 10, 0),
    session_end=datetime(2023, 3, 1, 10, 5),
    page_clicks=10,
    flight_booked=True,
    hotel_booked=True,
    flight_discount=False,
    hotel_discount=False,
    cancellation=False,
)
_USER = dict(
    birthdate=date(1990, 6, 15),
    married=False,
    has_children=False,
    home_country="usa",
    home_airport="HOME",
    home_airport_lat=40.0,
    home_airport_lon=-75.0,
    sign_up_date=date(2022, 1, 1),
)
_FLIGHT = dict(
    origin_airport="HOME",
    destination="paris",
    seats=1,
    return_flight_booked=True,
    departure_time=datetime(2023, 4, 3, 8, 0),  # Monday
    return_time=datetime(2023, 4, 6, 8, 0),
    checked_bags=0,
    trip_airline="Air",
    destination_airport_lat=49.0,
    destination_airport_lon=2.5,
    base_fare_usd=Decimal("300.00"),
)
_HOTEL = dict(
    hotel_name="Brand - paris",
    nights=3,
    rooms=1,
    check_in_time=datetime(2023, 4, 3, 11, 0),
    check_out_time=datetime(2023, 4, 6, 11, 0),
    hotel_per_room_usd=Decimal("100.00"),
)


def _frame(spark, schema, defaults, rows):
    filled = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in filled], schema)


def make_tables(spark, sessions=(), users=(), flights=(), hotels=(), mapping=(("paris", "france"),)):
    """Rows are dicts with the columns that differ from an ordinary row."""
    return Tables(
        sessions=_frame(spark, SESSIONS, _SESSION, sessions),
        users=_frame(spark, USERS, _USER, users),
        flights=_frame(spark, FLIGHTS, _FLIGHT, flights),
        hotels=_frame(spark, HOTELS, _HOTEL, hotels),
        mapping=spark.createDataFrame(list(mapping), MAPPING),
    )


def rows(df):
    """Rows as sorted tuples, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
