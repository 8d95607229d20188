"""Yearly KPIs and retention: identities that must hold, and borderline calendars."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import make_tables
from roamsight.plans import kpis
from roamsight.plans.retention import retention, retention_heatmap


def by_year(df, column):
    return {r[column]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def full(tables):
    return by_year(kpis.kpi_full_year(tables), "the_year")


@pytest.fixture(scope="module")
def ytd(tables):
    return by_year(kpis.kpi_ytd(tables), "ytd_year")


def test_totals_add_up(full):
    running = 0
    for year in sorted(full):
        running += full[year]["new_users"]
        assert full[year]["total_users"] == running
        assert full[year]["dormant_users"] == running - full[year]["active_users"]


def test_ytd_total_is_last_years_total_plus_new(full, ytd):
    for year in ytd:
        before = full[year - 1]["total_users"] if year - 1 in full else 0
        assert ytd[year]["total_users"] == before + ytd[year]["new_users"]


def test_last_year_ends_at_the_cutoff(full, ytd):
    last = max(full)
    same = [c for c in full[last] if not c.startswith("growth") and c != "the_year" and "user" not in c]
    assert {c: full[last][c] for c in same if "dormant" not in c and "booker_rate" not in c} == {
        c: ytd[last][c] for c in same if "dormant" not in c and "booker_rate" not in c
    }


def test_first_year_has_no_growth(full, ytd):
    for found in (full, ytd):
        first = found[min(found)]
        assert all(first[c] is None for c in first if c.startswith("growth"))


def test_dashboard_is_part_of_ytd(tables, ytd):
    for year, row in by_year(kpis.kpi_dashboard(tables), "ytd_year").items():
        assert row == {c: ytd[year][c] for c in row}


def test_retention_starts_with_everybody(tables, ytd):
    found = retention(tables).collect()
    for r in found:
        assert r.compare_year_ytd >= r.cohort_year_ytd and r.retained_users <= r.cohort_size
        if r.compare_year_ytd == r.cohort_year_ytd:
            assert r.retained_users == r.cohort_size and r.retention_rate_pct == 100
    first = min(ytd, key=lambda y: y if ytd[y]["sessions"] else 9999)
    sizes = {r.cohort_size for r in found if r.cohort_type == "active" and r.cohort_year_ytd == first}
    assert sizes == {ytd[first]["active_users"]}


def session(i, user, start, trip=None, **more):
    return {"session_id": i, "user_id": user, "trip_id": trip, "session_start": start, **more}


@pytest.fixture(scope="module")
def calendar(spark):
    """The latest session is on 29 February; 2021 has sign-ups only, 2022 nothing; one user and session lack a date."""
    return make_tables(
        spark,
        sessions=[
            session(1, 1, datetime(2020, 2, 29, 12), trip=1),
            session(2, 1, datetime(2020, 3, 1, 12), trip=2),
            session(3, 2, datetime(2023, 2, 28, 23, 59), trip=3),
            session(4, 1, datetime(2023, 3, 1, 0, 0), trip=3),
            session(5, 3, datetime(2024, 2, 29, 0, 0), trip=4),
            session(6, 3, datetime(2024, 1, 1, 0, 0), trip=4),
            session(7, 1, datetime(2024, 1, 1, 0, 0)),
            session(8, 9, None, trip=5),
        ],
        users=[
            {"user_id": 1, "sign_up_date": date(2020, 2, 29)},
            {"user_id": 2, "sign_up_date": date(2021, 12, 1)},
            {"user_id": 3, "sign_up_date": date(2024, 3, 1)},
            {"user_id": 4, "sign_up_date": None},
        ],
    )


def test_cutoff_on_a_leap_day(calendar):
    assert tuple(kpis.ytd_cutoff(calendar).first()) == (date(2024, 2, 29), 2, 29)
    found = by_year(kpis.kpi_ytd(calendar), "ytd_year")
    counts = {y: (r["sessions"], r["trips_booked"], r["active_users"], r["new_users"], r["total_users"]) for y, r in found.items()}
    # 2021 is no report year, as its only sign-up came after the cutoff, but that user counts from 2022 on
    assert counts == {2020: (1, 1, 1, 1, 1), 2023: (1, 1, 1, 0, 2), 2024: (3, 1, 2, 0, 2)}


def test_growth_compares_with_the_previous_line(calendar):
    found = by_year(kpis.kpi_full_year(calendar), "the_year")
    counts = {
        y: (r["sessions"], r["trips_booked"], r["active_users"], r["new_users"], r["total_users"]) for y, r in found.items()
    }
    assert counts == {
        2020: (2, 2, 1, 1, 1),
        2021: (0, 0, 0, 1, 2),
        2023: (2, 1, 2, 0, 2),  # both users had a session about trip 3
        2024: (3, 1, 2, 1, 3),
        None: (0, 0, 0, 0, 0),  # undated rows keep a line of zeros
    }
    assert found[2021]["growth_sessions_pct"] == -100
    assert found[2023]["growth_sessions_pct"] is None  # 2021 had none
    assert found[2024]["growth_sessions_pct"] == 50
    assert found[2024]["growth_total_users_pct"] == 50
    assert found[2020]["repeat_booker_share_pct"] == 100 and found[2023]["repeat_booker_share_pct"] == 0
    assert found[2021]["session_to_booking_conv_pct"] is None
    assert found[2024]["session_to_booking_conv_pct"] == Decimal("33.33")


def test_counts_per_year(calendar):
    assert {r.year: (r.sessions, r.active_users, r.trips_booked) for r in kpis.sessions_by_year(calendar).collect()} == {
        2020: (2, 1, 2),
        2023: (2, 2, 1),
        2024: (3, 2, 1),
        None: (1, 1, 1),
    }
    assert {r.year: tuple(r)[1:] for r in kpis.repeat_bookers_by_year(calendar, ytd=True).collect()} == {
        2020: (0, 1),
        2023: (0, 1),
        2024: (0, 1),
    }
    assert {r.year: r.new_users for r in kpis.new_users_by_year(calendar, ytd=True).collect()} == {2020: 1}


def test_retention_by_first_year(calendar):
    found = [tuple(r)[:5] for r in retention_heatmap(calendar, 2020).collect()]
    assert found == [("active", 2020, 2020, 1, 1), ("active", 2020, 2024, 1, 1), ("booker", 2020, 2020, 1, 1)]


def test_years_beyond_the_bitmap_are_refused(spark):
    from datetime import datetime

    from pyspark.errors import PySparkException

    from helpers import make_tables

    edge = [{"session_id": 1, "user_id": 1, "session_start": datetime(1980, 1, 1)}, {"session_id": 2, "user_id": 1, "session_start": datetime(2042, 1, 1)}]
    found = {tuple(r)[:5] for r in retention(make_tables(spark, sessions=edge)).collect()}
    assert ("active", 1980, 2042, 1, 1) in found
    for year in (1979, 2043):
        wrong = make_tables(spark, sessions=[{"session_id": 1, "user_id": 1, "session_start": datetime(year, 1, 1)}])
        with pytest.raises(PySparkException, match=f"year outside 1980 to 2042: {year}"):
            retention(wrong).collect()
