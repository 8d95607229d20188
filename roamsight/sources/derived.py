"""Travel tables derived from order data, for runs where no real ones are at hand.

Each order becomes a web session, two fifths of them with a trip; flights, hotels, cancellations and dirty values follow
from the order key by integer arithmetic, so any engine derives the same rows.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.params import Params
from roamsight.sources.destinations import DESTINATION_COUNTRIES, destination_countries
from roamsight.sources.tables import FLIGHTS, HOTELS, SESSIONS, USERS, Tables, conform

DERIVED_PARAMS = replace(
    Params(),
    cohort_start=date(1997, 1, 1),
    as_of_date=date(2001, 12, 31),
    retention_cohort_year=1995,
)


#: Every fifth of the built-in destinations stands for a nation; the last nation is a place that the list does not know.
CITIES = [*DESTINATION_COUNTRIES[:120:5], ("atlantis", "nowhere")]
SALTS = 8


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    city, country = (F.array(*[F.lit(pair[i]) for pair in CITIES])[key.cast("int")] for i in (0, 1))
    return spark.read.parquet(f"{folder}/nation.parquet").select(
        key.alias("nation"),
        city.alias("city"),
        country.alias("country"),
        F.concat(F.lit("AP"), key).alias("airport"),
        (key + 20).cast("double").alias("lat"),
        (key * 4 - 120).cast("double").alias("lon"),
    )


def _later(ts: Column | str, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, F.col(ts) if isinstance(ts, str) else ts)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        key.alias("order"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("day"),
        (key * 7919 % 10007).alias("h1"),
        (key * 104729 % 10009).alias("h2"),
        (key * 1299709 % 10037).alias("h3"),
        (priority != "5-LOW").alias("by_air"),
        (priority != "1-URGENT").alias("with_stay"),
    ).withColumn("is_trip", (F.col("h1") % 5).isin(0, 1))


def _sessions(orders: DataFrame) -> DataFrame:
    cancelled_later = F.col("is_trip") & (F.col("h3") % 10 == 0)
    rows = orders.withColumn("visit", F.explode(F.when(cancelled_later, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    booked = lambda kind: F.when(F.col("is_trip"), F.col(kind)).when(F.col("h2") % 3 != 0, F.lit(False))
    amount = F.when(F.col("h3") % 9 != 0, F.col("h3") % 7 * 5 / 100)
    start = _later(_later("day", "SECOND", (F.col("h2") % 86400).cast("int")), "DAY", F.col("visit"))
    return rows.select(
        (F.col("order") + F.col("visit") * 1_000_000_000).alias("session_id"),
        F.col("customer").alias("user_id"),
        F.when(F.col("is_trip"), F.col("order")).alias("trip_id"),
        start.alias("session_start"),
        _later(start, "SECOND", (F.col("h3") % 3000 + 60).cast("int")).alias("session_end"),
        (F.col("h1") % 60 + 1).alias("page_clicks"),
        booked("by_air").alias("flight_booked"),
        booked("with_stay").alias("hotel_booked"),
        (F.col("h1") % 3 == 0).alias("flight_discount"),
        (F.col("h2") % 3 == 0).alias("hotel_discount"),
        amount.alias("flight_discount_amount"),
        amount.alias("hotel_discount_amount"),
        (F.col("visit") == 1).alias("cancellation"),
    )


def _flights(trips: DataFrame, customers: DataFrame, nations: DataFrame) -> DataFrame:
    target = nations.select(F.col("nation").alias("target"), "city", "lat", "lon")
    departure = _later("day", "DAY", (F.col("h3") % 60 + 7).cast("int"))
    with_return = F.col("h2") % 6 != 0
    return (
        trips.where(F.col("by_air") & (F.col("h3") % 50 != 1))
        .withColumn("target", F.col("h2") % 25)
        .join(F.broadcast(target), "target")
        .withColumn("salt", F.pmod("order", F.lit(SALTS)).cast("int"))  # a customer may hold a large share of all trips
        .join(customers.select("customer", "airport", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")), ["customer", "salt"])
        .select(
            F.col("order").alias("trip_id"),
            F.when(F.col("h1") % 17 == 0, "ELSEWHERE").otherwise(F.col("airport")).alias("origin_airport"),
            F.col("city").alias("destination"),
            (F.col("h2") % 4 + 1).alias("seats"),
            with_return.alias("return_flight_booked"),
            departure.alias("departure_time"),
            F.when(with_return, _later(departure, "DAY", (F.col("h1") % 9 + 1).cast("int"))).alias("return_time"),
            (F.col("h3") % 3).alias("checked_bags"),
            F.concat(F.lit("Air"), F.col("h1") % 5).alias("trip_airline"),
            F.col("lat").alias("destination_airport_lat"),
            F.col("lon").alias("destination_airport_lon"),
            ((F.col("h2") * 13 % 90000 + 5000).cast("decimal(10,0)") / 100).alias("base_fare_usd"),
        )
    )


def _hotels(trips: DataFrame, nations: DataFrame) -> DataFrame:
    target = nations.select(F.col("nation").alias("target"), "city")
    nights = (F.col("h3") % 12 - 2).cast("int")
    check_in = _later(_later("day", "DAY", (F.col("h3") % 60 + 7).cast("int")), "HOUR", F.lit(14))
    link = F.when(F.col("h1") % 13 == 0, " ").otherwise(" - ")
    return (
        trips.where(F.col("with_stay") & (F.col("h3") % 50 != 2))
        .withColumn("target", F.col("h2") % 25)
        .join(F.broadcast(target), "target")
        .select(
            F.col("order").alias("trip_id"),
            F.concat(F.lit("Brand"), F.col("h1") % 9, link, F.col("city")).alias("hotel_name"),
            nights.alias("nights"),
            (F.col("h2") % 3 + 1).alias("rooms"),
            check_in.alias("check_in_time"),
            _later(check_in, "DAY", F.greatest(nights, F.lit(1))).alias("check_out_time"),
            (F.col("h1") % 400 + 40).alias("hotel_per_room_usd"),
        )
    )


def _users(customers: DataFrame, orders: DataFrame) -> DataFrame:
    span = orders.groupBy("customer").agg(F.to_date(F.min("day")).alias("first"), F.to_date(F.max("day")).alias("last"))
    key = F.col("customer")
    signed_up = F.when(key % 10 == 0, F.date_sub("last", 10)).otherwise(F.date_sub("first", (key % 40).cast("int")))
    born = F.date_add(F.lit(date(1930, 1, 1)), (key * 7919 % 20000).cast("int"))
    return customers.join(span, "customer", "left").select(
        key.alias("user_id"),
        F.when(key % 97 != 0, born).alias("birthdate"),
        (key % 3 == 0).alias("married"),
        (key % 5 == 0).alias("has_children"),
        F.col("country").alias("home_country"),
        F.col("airport").alias("home_airport"),
        F.col("lat").alias("home_airport_lat"),
        F.col("lon").alias("home_airport_lon"),
        F.coalesce(signed_up, F.lit(date(1995, 6, 1))).alias("sign_up_date"),
    )


def derive_tables(spark: SparkSession, folder: str) -> Tables:
    nations = _nations(spark, folder)
    customers = (
        spark.read.parquet(f"{folder}/customer.parquet")
        .select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("nation"))
        .join(F.broadcast(nations), "nation")
    )
    orders = _orders(spark, folder)
    trips = orders.where("is_trip")
    return Tables(
        sessions=conform(_sessions(orders), SESSIONS),
        users=conform(_users(customers, orders), USERS),
        flights=conform(_flights(trips, customers, nations), FLIGHTS),
        hotels=conform(_hotels(trips, nations), HOTELS),
        mapping=destination_countries(spark),
    )
