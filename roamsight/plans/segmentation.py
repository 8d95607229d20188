"""The segmentation job from source tables to summary, with its intermediate tables open to inspection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamsight.params import Params
from roamsight.plans.cohort import Cohort
from roamsight.plans.features import features
from roamsight.plans.segments import assign_segments, score_users, scores_tall, summarise_segments
from roamsight.plans.users import user_table
from roamsight.sources.staging import Keep, shared
from roamsight.sources.tables import Tables

# what scoring reads from the user table
SCORING_COLUMNS = [
    "user_id",
    "has_children",
    "is_in_working_age",
    "weekdays_travel_quote",
    "weekend_travel_quote",
    "avg_bags",
    "avg_seats",
    "avg_rooms",
    "avg_nights_total",
    "avg_min_booking",
    "avg_clicks_booking",
    "avg_flight_price_per_km",
    "avg_hotel_price_per_night",
    "valid_bookings",
    "total_sessions",
    "total_browsing_only",
    "total_bookings",
    "last_booking_since_signup",
    "age",
    "sum_discount_bookings",
    "discount_flight_bookings",
    "discount_hotel_bookings",
    "valid_flight_bookings",
    "valid_hotel_bookings",
]


@dataclass(frozen=True)
class Segmentation:
    """Every stage of one run. Only ``users`` is stored; the others are computed when read."""

    users: DataFrame
    features: DataFrame
    scores: DataFrame
    scores_tall: DataFrame
    assigned: DataFrame
    summary: DataFrame


def stored_users(
    tables: Tables,
    params: Params,
    short: bool = False,
    cohort: Cohort | None = None,
    keep: Keep = shared,
) -> DataFrame:
    """The user table, or the columns of it that scoring reads, written once."""
    users = user_table(tables, cohort or Cohort(tables, params, keep), params)
    return keep(users.select(*SCORING_COLUMNS) if short else users, "users")[0]


def segment_users(
    tables: Tables,
    params: Params,
    short: bool = False,
    cohort: Cohort | None = None,
    keep: Keep = shared,
) -> Segmentation:
    """Run the segmentation.

    The user table feeds the cohort statistics and the scoring, so it is written once and read back. ``short`` stores
    only the columns that scoring reads and Catalyst drops all work behind the others; the summary is the same.
    """
    users = stored_users(tables, params, short, cohort, keep)
    described = features(users, params, short)
    scores = score_users(described, params)
    assigned = assign_segments(scores, params)
    return Segmentation(
        users=users,
        features=described,
        scores=scores,
        scores_tall=scores_tall(scores, params),
        assigned=assigned,
        summary=summarise_segments(assigned, params),
    )


def inspect_users(df: DataFrame, user_ids: list[int]) -> DataFrame:
    """Rows of selected users from any user- or session-level stage."""
    return df.where(F.col("user_id").isin(*user_ids))
