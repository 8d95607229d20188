"""Everything an analyst may want to tune, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class Skew:
    """When a join key counts as hot, and into what its rows are cut.

    A key is hot when it has more rows than one task should get, ``target_rows``; it is cut into slices of at most that
    many. The list of hot keys may be broadcast, so it is bounded: the target grows to ``1 / max_keys`` of all rows where
    that is more, and fewer than ``max_keys`` keys can each hold a larger share.
    """

    target_rows: int = 1_000_000
    max_keys: int = 1_000_000


@dataclass(frozen=True)
class Weights:
    """Score weights. Each group adds up to 1."""

    business_bags: Decimal = Decimal("0.2")
    business_seats: Decimal = Decimal("0.2")
    business_weekdays: Decimal = Decimal("0.6")
    family_seats: Decimal = Decimal("0.2")
    family_rooms: Decimal = Decimal("0.1")
    family_bags: Decimal = Decimal("0.1")
    family_children: Decimal = Decimal("0.6")
    price_hotel: Decimal = Decimal("0.5")
    price_flight: Decimal = Decimal("0.5")
    deal_clicks: Decimal = Decimal("0.2")
    deal_slow: Decimal = Decimal("0.2")
    deal_discounts: Decimal = Decimal("0.6")


@dataclass(frozen=True)
class Params:
    # cohort
    cohort_start: date = date(2023, 1, 4)
    min_sessions: int = 7  # a user needs strictly more
    as_of_date: date = date(2023, 12, 31)  # ages are counted on this day

    # session categories
    short_haul_km: int = 1500
    medium_haul_km: int = 3500
    neighbour_countries: tuple[str, ...] = ("usa", "canada", "mexico")

    # features
    low_percentile: Decimal = Decimal("0.2")
    high_percentile: Decimal = Decimal("0.8")
    working_age: tuple[int, int] = (20, 67)
    senior_age: int = 60
    young_age: int = 25
    middle_seats: tuple[int, int] = (3, 6)
    middle_bags: tuple[int, int] = (1, 4)
    middle_rooms: tuple[int, int] = (1, 4)
    new_customer_days: int = 28

    # scores
    weights: Weights = field(default_factory=Weights)
    min_quote: Decimal = Decimal("0.5")  # business, weekender and deal-hunter scores are 0 below it
    others_threshold: Decimal = Decimal("0.3")
    good_match_threshold: Decimal = Decimal("0.5")
    optional_segments: tuple[str, ...] = ()  # any of "Weekender", "Senior Traveler"

    # retention
    retention_cohort_year: int = 2021

    # execution
    skew: Skew = field(default_factory=Skew)
    broadcast_ids: int = 2_000_000  # longest list of user or trip ids that may be broadcast
    filter_words: int = 1 << 21  # of 64 bits, broadcast in place of a longer list; four ids a word let one stranger in 300 pass
    percentile_buckets: int = 4096  # counted per wanted rank and round
