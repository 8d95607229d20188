"""Features, scores, assignment and summary."""

from dataclasses import replace
from decimal import Decimal

import pytest

from helpers import make_tables, rows
from roamsight.params import Params
from roamsight.plans.cohort import Cohort
from roamsight.plans.features import features
from roamsight.plans.segmentation import inspect_users, segment_users
from roamsight.plans.segments import SEGMENTS, assign_segments, score_users, summarise_segments
from roamsight.plans.users import user_totals, with_averages
from roamsight.sources.derived import DERIVED_PARAMS

NAMES = [s.name for s in SEGMENTS if not s.optional]


@pytest.fixture(scope="module")
def run(tables):
    return segment_users(tables, DERIVED_PARAMS)


def test_everybody_is_in_one_segment(run):
    summary = run.summary.collect()
    members = run.users.count()
    assert sum(r.users for r in summary) == members
    assert abs(sum(r.share_perc for r in summary) - 1) <= Decimal("0.05")  # each share is rounded
    assert [r.users for r in summary] == sorted((r.users for r in summary), reverse=True)
    assert run.scores_tall.count() == members * len(NAMES)
    assert not run.scores_tall.where("score is null").count()


def test_others_match_nobody(run):
    others = run.summary.where("final_segment = 'Others'").first()
    assert others is None or others.good_match_perc == 0


def test_same_again(tables, run, spark):
    """Idempotent, and independent of how the work is cut."""
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows(segment_users(tables, DERIVED_PARAMS).assigned) == rows(run.assigned)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_short_job_gives_the_same_summary(tables, run):
    short = segment_users(tables, DERIVED_PARAMS, short=True)
    assert rows(short.summary) == rows(run.summary)
    assert set(short.users.columns) < set(run.users.columns)
    assert "is_short_leadtime_p20" not in short.features.columns


def test_inspection(run):
    ids = [r.user_id for r in run.assigned.limit(2).collect()]
    for stage in (run.assigned, run.features, run.users):
        assert {r.user_id for r in inspect_users(stage, ids).collect()} == set(ids)


SCORES = [s.score for s in SEGMENTS]


def scored(spark, *users):
    """Users with the given scores; all others are 0."""
    schema = "user_id bigint, " + ", ".join(f"{c} decimal(12,8)" for c in SCORES)
    return spark.createDataFrame(
        [(i, *[Decimal(str(u.get(c, 0))) for c in SCORES]) for i, u in enumerate(users)], schema
    )


def test_assignment(spark):
    found = assign_segments(
        scored(
            spark,
            {"score_family": 0.6, "score_business": 0.7},
            {"score_young_traveler": 1, "score_dreamer": 1},  # a tie
            {},  # no score at all
            {"score_business": 0.29999999},
            {"score_deal_hunter": 0.3},
            {"score_weekender": 1},  # not in use
        ),
        Params(),
    )
    by_id = {r.user_id: (r.assigned_segment, r.final_segment) for r in found.collect()}
    assert by_id == {
        0: ("Business", "Business"),
        1: ("Dreamer", "Dreamer"),
        2: ("Budget Traveler", "Others"),
        3: ("Business", "Others"),
        4: ("Deal Hunter", "Deal Hunter"),
        5: ("Budget Traveler", "Others"),
    }


def test_optional_segments(spark):
    params = replace(Params(), optional_segments=("Weekender",))
    found = assign_segments(scored(spark, {"score_weekender": 1}, {"score_senior_traveler": 1}), params)
    assert {r.user_id: r.final_segment for r in found.collect()} == {0: "Weekender", 1: "Others"}
    perks = {r.final_segment: r.perk for r in summarise_segments(found, params).collect()}
    assert perks == {"Weekender": "Welcome Drink & Free Late Check-Out", "Others": "Baseline Discount - TBD"}


def test_summary(spark):
    assigned = spark.createDataFrame(
        [(i, s, Decimal(x)) for i, (s, x) in enumerate([("Family", "0.6"), ("Family", "0.4"), ("Dreamer", "1"), ("New", "1")])],
        "user_id bigint, final_segment string, score decimal(12,8)",
    )
    assert [tuple(r) for r in summarise_segments(assigned, Params()).collect()] == [
        ("Family", 2, Decimal("0.50"), Decimal("0.50"), "Free Hotel Meal"),
        ("Dreamer", 1, Decimal("0.25"), Decimal("1.00"), "Welcome Discount & 48h Free Cancellation"),
        ("New", 1, Decimal("0.25"), Decimal("1.00"), "NULL"),
    ]


FLAGS = (
    "has_children is_in_working_age has_middle_num_seats has_middle_num_rooms has_middle_num_bags"
    " is_frequent_traveler_p80 is_new_customer_booking is_dreamer_no_bookings is_senior_traveler is_young_traveler"
    " is_high_price_hotel_p80 is_high_price_flight_p80 is_budget_price_hotel_p20 is_budget_price_flight_p20"
    " is_high_clicks_booker_p80 is_slow_booker_p80"
).split()
QUOTES = (
    "weekdays_travel_quote weekend_travel_quote avg_bags_norm_invert avg_seats_norm_invert discount_booking_quote"
).split()


def described(spark, *users):
    schema = ", ".join([f"{c} int" for c in FLAGS] + [f"{c} decimal(18,4)" for c in QUOTES])
    return spark.createDataFrame(
        [
            tuple([u.get(c, 0) for c in FLAGS] + [Decimal(str(u[c])) if c in u else Decimal(0) for c in QUOTES])
            for u in users
        ],
        schema,
    )


def test_scores(spark):
    working = {"is_in_working_age": 1, "avg_bags_norm_invert": 1, "avg_seats_norm_invert": 0.5}
    found = score_users(
        described(
            spark,
            {**working, "weekdays_travel_quote": 0.5},
            {**working, "weekdays_travel_quote": 0.4999},
            {**working, "weekdays_travel_quote": 1, "is_in_working_age": 0},
            {**working, "weekdays_travel_quote": 1, "is_in_working_age": None},  # unknown age is let through
            {"has_children": 1, "has_middle_num_rooms": 1},
            {"has_middle_num_rooms": 1},
            {"is_high_price_hotel_p80": 1, "is_budget_price_hotel_p20": 1, "is_budget_price_flight_p20": 1},
            {"discount_booking_quote": 0.5, "is_slow_booker_p80": 1},
            {"discount_booking_quote": 0.4, "is_slow_booker_p80": 1},
        ),
        Params(),
    ).collect()
    assert [float(r.score_business) for r in found][:4] == [0.6, 0, 0, 0.9]
    assert [float(r.score_family) for r in found][4:6] == [0.7, 0]
    assert (float(found[6].score_premium_traveler), float(found[6].score_budget_traveler)) == (0.5, 1)
    assert [float(r.score_deal_hunter) for r in found][7:] == [0.5, 0]


def totals(spark, sessions, **more):
    params = Params(min_sessions=0)
    made = make_tables(spark, sessions=sessions, **more)
    return with_averages(user_totals(made, Cohort(made, params), params), params), params


def test_only_cancelled_trips_make_a_dreamer(spark):
    users, params = totals(
        spark,
        [
            {"session_id": 1, "user_id": 1, "trip_id": 1},
            {"session_id": 2, "user_id": 1, "trip_id": 1, "cancellation": True},
            {"session_id": 3, "user_id": 2},
            {"session_id": 4, "user_id": 3, "trip_id": 3},
        ],
        users=[{"user_id": u} for u in (1, 2, 3)],
        flights=[{"trip_id": 1}, {"trip_id": 3}],
        hotels=[{"trip_id": 3}],
    )
    found = {r.user_id: r for r in users.collect()}
    assert (found[1].total_bookings, found[1].total_cancellations, found[1].valid_bookings) == (1, 1, 0)
    assert found[1].avg_min_booking is None and found[1].avg_clicks_cancellation == 20
    assert found[2].total_bookings == 0 and found[2].weekdays_travel_quote == 0
    dreamers = {r.user_id: r.is_dreamer_no_bookings for r in features(users, params).collect()}
    assert dreamers == {1: 1, 2: 1, 3: 0}


def test_two_cancellations_of_one_trip_stay_negative(spark):
    users, _ = totals(
        spark,
        [{"session_id": i, "user_id": 1, "trip_id": 1, "cancellation": True} for i in (1, 2)],
        users=[{"user_id": 1}],
    )
    row = users.first()
    assert (row.valid_bookings, row.avg_min_booking, row.sum_flight_price_per_km) == (-1, None, None)


def test_equal_values_scale_to_zero(spark):
    users, params = totals(
        spark,
        [{"session_id": u, "user_id": u, "trip_id": u} for u in (1, 2)],
        users=[{"user_id": 1}, {"user_id": 2}],
        flights=[{"trip_id": 1}, {"trip_id": 2}],
    )
    assert {r.avg_seats_norm_invert for r in features(users, params).collect()} == {0}


def test_discounted_prices(spark):
    users, _ = totals(
        spark,
        [{"session_id": 1, "user_id": 1, "trip_id": 1, "hotel_discount": True, "hotel_discount_amount": Decimal("0.15")}],
        users=[{"user_id": 1}],
        hotels=[{"trip_id": 1, "hotel_per_room_usd": Decimal("99.99")}],
    )
    row = users.first()
    assert row.sum_hotel_price_per_night == Decimal("84.9915")
    assert row.avg_hotel_price_per_night == Decimal("84.9915") and row.avg_hotel_discount == Decimal("0.15")
    assert row.discount_hotel_bookings == row.sum_discount_bookings == 1


def test_empty_cohort(spark):
    made = make_tables(spark, users=[{"user_id": 1}])
    assert segment_users(made, Params()).summary.collect() == []
