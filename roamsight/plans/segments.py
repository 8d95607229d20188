"""Scores per segment, the best segment per user, and the summary with perks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.functions.exprs import ratio
from roamsight.params import Params

_SCORE = "decimal(12,8)"


@dataclass(frozen=True)
class Segment:
    name: str
    score: str
    perk: str
    optional: bool = False


# Segment, score column, perk.
SEGMENTS = [
    Segment("Business", "score_business", "Free Cancellation"),
    Segment("Family", "score_family", "Free Hotel Meal"),
    Segment("Weekender", "score_weekender", "Welcome Drink & Free Late Check-Out", optional=True),
    Segment("Frequent Traveler", "score_frequent_traveler", "Free Cancellation & Lounge"),
    Segment("New Customer", "score_new_booking_customer", "Free Hotel Night With Flight"),
    Segment("Dreamer", "score_dreamer", "Welcome Discount & 48h Free Cancellation"),
    Segment("Senior Traveler", "score_senior_traveler", "Free Hotel Meal", optional=True),
    Segment("Young Traveler", "score_young_traveler", "Welcome Drink & Free Late Check-Out"),
    Segment("Premium Traveler", "score_premium_traveler", "Priority Check-In & Lounge"),
    Segment("Budget Traveler", "score_budget_traveler", "Free Checked-Bag"),
    Segment("Deal Hunter", "score_deal_hunter", "Special Deal - Discount Offers"),
]
OTHERS = "Others"
OTHERS_PERK = "Baseline Discount - TBD"
NO_PERK = "NULL"


def chosen_segments(params: Params) -> list[Segment]:
    return [s for s in SEGMENTS if not s.optional or s.name in params.optional_segments]


def _score_columns(params: Params) -> dict[str, Column]:
    w = params.weights

    def weighted(*terms: tuple[str, object]) -> Column:
        total = F.lit(0)
        for column, weight in terms:
            total = total + F.col(column) * F.lit(weight)
        return total

    def unless(excluded: Column, score: Column) -> Column:
        return F.when(excluded, F.lit(0)).otherwise(score)

    weekday, weekend, discount = (
        F.col(c) for c in ("weekdays_travel_quote", "weekend_travel_quote", "discount_booking_quote")
    )
    return {
        "score_business": unless(
            (F.col("is_in_working_age") == 0) | (weekday < params.min_quote),
            weighted(
                ("avg_bags_norm_invert", w.business_bags),
                ("avg_seats_norm_invert", w.business_seats),
                ("weekdays_travel_quote", w.business_weekdays),
            ),
        ),
        "score_family": unless(
            F.col("has_children") == 0,
            weighted(
                ("has_middle_num_seats", w.family_seats),
                ("has_middle_num_rooms", w.family_rooms),
                ("has_middle_num_bags", w.family_bags),
                ("has_children", w.family_children),
            ),
        ),
        "score_weekender": unless(weekend < params.min_quote, weekend),
        "score_frequent_traveler": F.col("is_frequent_traveler_p80"),
        "score_new_booking_customer": F.col("is_new_customer_booking"),
        "score_dreamer": F.col("is_dreamer_no_bookings"),
        "score_senior_traveler": F.col("is_senior_traveler"),
        "score_young_traveler": F.col("is_young_traveler"),
        "score_premium_traveler": weighted(
            ("is_high_price_hotel_p80", w.price_hotel), ("is_high_price_flight_p80", w.price_flight)
        ),
        "score_budget_traveler": weighted(
            ("is_budget_price_hotel_p20", w.price_hotel), ("is_budget_price_flight_p20", w.price_flight)
        ),
        "score_deal_hunter": unless(
            discount < params.min_quote,
            weighted(
                ("is_high_clicks_booker_p80", w.deal_clicks),
                ("is_slow_booker_p80", w.deal_slow),
                ("discount_booking_quote", w.deal_discounts),
            ),
        ),
    }


def score_users(features: DataFrame, params: Params) -> DataFrame:
    """Features plus one decimal score per segment, so thresholds and ties are exact."""
    formulas = _score_columns(params)
    return features.withColumns({s.score: formulas[s.score].cast(_SCORE) for s in chosen_segments(params)})


def scores_tall(scores: DataFrame, params: Params) -> DataFrame:
    """One row per user and segment."""
    named = scores.select("user_id", *[F.col(s.score).alias(s.name) for s in chosen_segments(params)])
    return named.unpivot("user_id", [f"`{s.name}`" for s in chosen_segments(params)], "segment", "score")


def assign_segments(scores: DataFrame, params: Params) -> DataFrame:
    """The best segment of each user; equal scores go to the alphabetically first one, low scores to Others.

    The scores of a user are on one row, so the best is found there: no unpivot, no shuffle.
    """
    ranked = F.array(
        *[
            F.struct((-F.col(s.score)).alias("minus_score"), F.lit(s.name).alias("segment"))
            for s in chosen_segments(params)
        ]
    )
    best = F.array_min(ranked)
    return (
        scores.select("user_id", best.alias("best"))
        .select(
            "user_id", F.col("best.segment").alias("assigned_segment"), (-F.col("best.minus_score")).alias("score")
        )
        .withColumn(
            "final_segment",
            F.when(F.col("score") < params.others_threshold, OTHERS).otherwise(F.col("assigned_segment")),
        )
    )


def summarise_segments(assigned: DataFrame, params: Params) -> DataFrame:
    """Users, share of the cohort, share of good matches and perk per segment; a handful of rows."""
    perk_of = F.create_map(*[F.lit(x) for s in [*SEGMENTS, Segment(OTHERS, "", OTHERS_PERK)] for x in (s.name, s.perk)])
    everyone = F.sum("users").over(Window.partitionBy())
    return (
        assigned.groupBy("final_segment")
        .agg(
            F.count(F.lit(1)).alias("users"), F.count_if(F.col("score") >= params.good_match_threshold).alias("good")
        )
        .select(
            "final_segment",
            "users",
            ratio(F.col("users"), everyone, 2).alias("share_perc"),
            ratio(F.col("good"), F.col("users"), 2).alias("good_match_perc"),
            F.coalesce(perk_of[F.col("final_segment")], F.lit(NO_PERK)).alias("perk"),
        )
        .orderBy(F.desc("users"), "final_segment")
    )
