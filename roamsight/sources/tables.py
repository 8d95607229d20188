"""The five input tables and their schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamsight.sources.destinations import destination_countries

_ID, _INT, _TEXT, _BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
_TIME, _DATE, _DEGREES = T.TimestampNTZType(), T.DateType(), T.DoubleType()
_USD, _FRACTION = T.DecimalType(10, 2), T.DecimalType(4, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SESSIONS = _schema(
    session_id=_ID,
    user_id=_ID,
    trip_id=_ID,
    session_start=_TIME,
    session_end=_TIME,
    page_clicks=_INT,
    flight_booked=_BOOL,
    hotel_booked=_BOOL,
    flight_discount=_BOOL,
    hotel_discount=_BOOL,
    flight_discount_amount=_FRACTION,
    hotel_discount_amount=_FRACTION,
    cancellation=_BOOL,
)
USERS = _schema(
    user_id=_ID,
    birthdate=_DATE,
    married=_BOOL,
    has_children=_BOOL,
    home_country=_TEXT,
    home_airport=_TEXT,
    home_airport_lat=_DEGREES,
    home_airport_lon=_DEGREES,
    sign_up_date=_DATE,
)
FLIGHTS = _schema(
    trip_id=_ID,
    origin_airport=_TEXT,
    destination=_TEXT,
    seats=_INT,
    return_flight_booked=_BOOL,
    departure_time=_TIME,
    return_time=_TIME,
    checked_bags=_INT,
    trip_airline=_TEXT,
    destination_airport_lat=_DEGREES,
    destination_airport_lon=_DEGREES,
    base_fare_usd=_USD,
)
HOTELS = _schema(
    trip_id=_ID,
    hotel_name=_TEXT,
    nights=_INT,
    rooms=_INT,
    check_in_time=_TIME,
    check_out_time=_TIME,
    hotel_per_room_usd=_USD,
)
MAPPING = _schema(destination=_TEXT, destination_country=_TEXT)


@dataclass(frozen=True)
class Tables:
    """sessions may repeat a trip; users, flights, hotels and mapping have one row per key.

    ``trip_buckets`` is set where flights and hotels are stored in so many buckets by trip. Sessions that are laid out by
    day have one more column, ``DAY``.
    """

    sessions: DataFrame
    users: DataFrame
    flights: DataFrame
    hotels: DataFrame
    mapping: DataFrame
    trip_buckets: int | None = None


DAY = "session_day"
_IDS = {"session_id", "user_id", "trip_id"}


def read_tables(spark: SparkSession, path: str, file_format: str = "parquet", text_ids: bool = False) -> Tables:
    """Read ``path/{sessions,users,flights,hotels}``; the destination list is built in.

    With ``text_ids``, ids are strings. Fares may carry other precisions; pass such frames to :func:`conform` instead.
    """

    def read(name: str, schema: T.StructType) -> DataFrame:
        if text_ids:
            schema = T.StructType([T.StructField(f.name, _TEXT if f.name in _IDS else f.dataType) for f in schema])
        reader = spark.read.format(file_format).schema(schema)
        if file_format == "csv":
            reader = reader.option("header", True)
        return reader.load(f"{path.rstrip('/')}/{name}")

    return Tables(
        sessions=read("sessions", SESSIONS),
        users=read("users", USERS),
        flights=read("flights", FLIGHTS),
        hotels=read("hotels", HOTELS),
        mapping=destination_countries(spark),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the schema's columns and cast each to its type; id columns keep the type they have."""
    return df.select(
        *[F.col(f.name) if f.name in _IDS else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    )


def duplicate_keys(tables: Tables) -> DataFrame:
    """Keys that break the one-row-per-key rule. An empty result means the joins cannot multiply sessions."""
    checks = [
        ("users", tables.users, "user_id"),
        ("flights", tables.flights, "trip_id"),
        ("hotels", tables.hotels, "trip_id"),
        ("mapping", tables.mapping, "destination"),
    ]
    found = None
    for name, df, key in checks:
        repeated = (
            df.groupBy(F.col(key).cast("string").alias("key"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .where("rows > 1")
            .select(F.lit(name).alias("table"), "key", "rows")
        )
        found = repeated if found is None else found.unionByName(repeated)
    return found
