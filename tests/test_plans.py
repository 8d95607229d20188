"""What Spark makes of the jobs: pushed filters, pruned columns, no needless or single-task shuffles."""

import os
import re
from dataclasses import replace
from decimal import Decimal
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from roamsight.params import Params, Skew
from roamsight.plans import kpis
from roamsight.plans.cohort import Cohort, active_users, recent_sessions
from roamsight.plans.inspection import inspect_sessions, tables_around
from roamsight.plans.segmentation import SCORING_COLUMNS, segment_users, stored_users
from roamsight.plans.retention import retention
from roamsight.plans.sessions import joined_sessions, session_base, trips
from roamsight.plans.users import user_table
from roamsight.sources.derived import DERIVED_PARAMS
from roamsight.sources.layout import read_laid_out, write_laid_out
from roamsight.sources.staging import release, staging_folder
from roamsight.sources.tables import DAY, read_tables


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """The derived tables as files, joined without broadcast, as large ones would be."""
    folder = tmp_path_factory.mktemp("tables")
    for name in ("sessions", "users", "flights", "hotels"):
        getattr(tables, name).write.parquet(str(folder / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield read_tables(spark, str(folder))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(text, keys=""):
    return [line for line in text.splitlines() if f"Exchange hashpartitioning({keys}" in line]


def test_date_filter_reaches_the_scan(stored):
    text = plan(active_users(stored, DERIVED_PARAMS))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(session_start,1997-01-01", text)
    assert "ReadSchema: struct<user_id:bigint,session_start:timestamp_ntz>" in text
    assert "partial_count(1)" in text


def test_no_cartesian_product_and_no_single_task(stored):
    cohort = Cohort(stored, DERIVED_PARAMS)
    for df in (session_base(stored, cohort, DERIVED_PARAMS), user_table(stored, cohort, DERIVED_PARAMS)):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "SinglePartition" not in text


def test_short_member_list_is_broadcast_at_the_scan(stored):
    text = plan(Cohort(stored, DERIVED_PARAMS).member_sessions)
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and not exchanges(text)


def below_exchanges(text):
    """For each scan in a plan, the operators between it and the exchange above it, or the plan's top."""
    path, found = [], []
    for line in text.splitlines():
        name = line.lstrip(" :+-").split(" ", 1)[-1] if line.lstrip(" :+-").startswith("*(") else line.lstrip(" :+-")
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, n) for d, n in path if d < depth] + [(depth, name)]
        if "FileScan" in name:
            above = [n for _, n in path]
            last = max((i for i, n in enumerate(above) if n.startswith("Exchange") or n.startswith("BroadcastExchange")), default=-1)
            found.append((above[last] if last >= 0 else "", above[last + 1 :]))
    return found


def test_long_member_list_becomes_a_filter_of_bounded_size(spark, stored):
    """The ids are not broadcast; the words of a filter are, and drop most strangers before the first exchange."""
    params = replace(DERIVED_PARAMS, broadcast_ids=0, skew=Skew(target_rows=50))
    cohort = Cohort(stored, params)
    assert not cohort.members_only
    recent = recent_sessions(stored, params)
    members = {r.user_id for r in cohort.profiles.select("user_id").collect()}
    passed = {r.user_id for r in cohort.sessions.select("user_id").distinct().collect()}
    everybody = {r.user_id for r in recent.select("user_id").distinct().collect()}
    assert members & everybody <= passed and len(passed - members) <= 0.05 * len(everybody - members)
    scans = [ops for _, ops in below_exchanges(plan(joined_sessions(stored, cohort))) if "session_start" in ops[-1]]
    assert scans and all(any("BroadcastHashJoin" in op and "LeftSemi" in op for op in ops) for ops in scans)
    few = Cohort(stored, replace(params, filter_words=1))  # a filter that passes nearly everybody changes nothing
    assert few.sessions.count() > 0.9 * recent.count()
    assert rows(few.member_sessions) == rows(cohort.member_sessions)


def test_flights_and_hotels_in_buckets_stay_where_they_are(spark, stored, tmp_path):
    write_laid_out(stored, str(tmp_path / "tables"), 6)
    laid_out = read_laid_out(spark, str(tmp_path / "tables"))
    params = replace(DERIVED_PARAMS, broadcast_ids=0)
    text = plan(trips(laid_out, Cohort(laid_out, params)))
    for column in ("origin_airport", "hotel_name"):
        (ops,) = [(above, ops) for above, ops in below_exchanges(text) if column in ops[-1]]
        assert not ops[0].startswith("Exchange") and "Bucketed: true" in ops[1][-1]
    moved = [(above, ops) for above, ops in below_exchanges(plan(trips(stored, Cohort(stored, params)))) if "hotel_name" in ops[-1]]
    assert moved and all(above.startswith("Exchange hashpartitioning(trip_id") for above, _ in moved)
    for name in ("sessions", "users", "flights", "hotels"):
        assert rows(getattr(laid_out, name).drop(DAY)) == rows(getattr(stored, name))
    assert rows(trips(laid_out, Cohort(laid_out, params))) == rows(trips(stored, Cohort(stored, params)))
    with pytest.raises(ValueError, match="buckets"):
        read_laid_out(spark, str(tmp_path))


def test_sessions_by_day_are_pruned(spark, stored, tmp_path):
    write_laid_out(stored, str(tmp_path / "tables"), 4)
    laid_out = read_laid_out(spark, str(tmp_path / "tables"))
    text = plan(active_users(laid_out, DERIVED_PARAMS))
    assert re.search(r"PartitionFilters: \[.*session_day.* >= 1997-01-01", text)
    assert "PartitionFilters: []" in plan(active_users(stored, DERIVED_PARAMS))
    assert rows(active_users(laid_out, DERIVED_PARAMS)) == rows(active_users(stored, DERIVED_PARAMS))
    both = [session_base(t, Cohort(t, DERIVED_PARAMS), DERIVED_PARAMS) for t in (laid_out, stored)]
    assert both[0].columns == both[1].columns and rows(both[0]) == rows(both[1])


def test_users_need_one_wide_shuffle_per_join(stored):
    """Sessions move once by trip and once by user; the totals then move as one row per user and task."""
    cohort = Cohort(stored, DERIVED_PARAMS)
    text = plan(user_table(stored, cohort, DERIVED_PARAMS))
    by_trip, by_user = exchanges(text, "trip_id"), exchanges(text, "user_id")
    assert len(by_trip) == 4  # sessions, trips seen, flights, hotels
    assert len(by_user) <= 4  # sessions, profiles, totals (none if they already lie by user), bookings
    assert not exchanges(text, "user_id#\\d+L, trip_id")  # no shuffle per distinct trip


def test_browsing_sessions_are_not_shuffled_by_trip(stored):
    text = plan(session_base(stored, Cohort(stored, DERIVED_PARAMS), DERIVED_PARAMS))
    assert "isnotnull(trip_id" in text and "isnull(trip_id" in text


def test_short_job_reads_fewer_columns(stored):
    short = segment_users(stored, DERIVED_PARAMS, short=True)
    assert short.users.columns == SCORING_COLUMNS


def test_cohort_statistics_are_constants_for_later_steps(stored):
    run = segment_users(stored, DERIVED_PARAMS)
    for step in (run.features, run.scores, run.assigned):
        assert "Exchange" not in plan(step) and "Window" not in plan(step) and "Join" not in plan(step)


def test_percentiles_move_a_bounded_number_of_counts(stored, monkeypatch):
    """Each round is one partial count per bucket; nothing ranks or sketches values."""
    from roamsight.operators import percentiles

    texts, taken = [], []
    users = stored_users(stored, DERIVED_PARAMS)
    real = type(users).collect
    monkeypatch.setattr(type(users), "collect", lambda df: (texts.append(plan(df)), taken.append(real(df)), taken[-1])[2])
    limits = percentiles.exact_percentiles(users, [percentiles.Percentile("p", "avg_clicks_booking", Decimal("0.2"))], 16)
    assert limits["p"] is not None and texts
    assert all("partial_count" in t and "Window" not in t and "percentile" not in t for t in texts)
    assert all(len(t) <= 2 * 16 for t in taken)


def test_yearly_counts_shuffle_narrow_rows(stored):
    text = plan(kpis.sessions_by_year(stored))
    assert "Expand" not in text
    assert "ReadSchema: struct<user_id:bigint,day:date>" in text
    assert "ReadSchema: struct<trip_id:bigint,day:date>" in text


def test_cutoff_needs_no_scan_of_its_own(stored):
    """It is found while the days are stored, so it is a constant in the plan."""
    for report in (kpis.kpi_ytd, kpis.kpi_dashboard):
        text = plan(report(stored))
        assert "Subquery" not in text and "NestedLoopJoin" not in text and "session_start" not in text
        assert len(re.findall("FileScan", text)) == 3  # days for activity and for trips, users
    assert "FileScan" not in plan(kpis.ytd_cutoff(stored))


def test_retention_combines_bitmaps_before_one_shuffle(stored):
    text = plan(retention(stored))
    assert len(re.findall(r"ReadSchema: struct<user_id", text)) == 1
    assert "Join" not in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text
    assert "partial_bit_or" in text
    assert len(exchanges(text, "user_id")) == 1 and "Window [min" not in text


def test_inspection_reads_what_bears_on_the_users(stored):
    text = plan(tables_around(stored, DERIVED_PARAMS, [1, 2]).sessions)
    assert "LeftSemi" in text and "BroadcastHashJoin" in text and not exchanges(text)
    few = inspect_sessions(stored, DERIVED_PARAMS, [1, 2, 4])
    assert rows(few) == rows(session_base(stored, Cohort(stored, DERIVED_PARAMS), DERIVED_PARAMS).where("user_id in (1, 2, 4)"))


def test_jobs_of_a_segmentation(spark, stored):
    """No job only counts: numbers of rows are taken while tables are stored, and a second run stores nothing anew.

    Without adaptive execution, which runs every shuffle as a job of its own.
    """

    def jobs(group):
        spark.sparkContext.setJobGroup(group, group)
        segment_users(stored, replace(DERIVED_PARAMS, good_match_threshold=Decimal("0.51"))).summary.collect()
        spark.sparkContext._jsc.clearJobGroup()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    release(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first, second, folder = jobs("first"), jobs("second"), staging_folder(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    names = sorted(name.split("-")[0] for name in os.listdir(urlparse(folder).path))
    assert first <= 20 and names == ["active_users", "profiles", "user_trips", "users"]
    assert second <= first - 4  # the four tables are there


def test_hot_lists_are_small(stored):
    """The list that is broadcast has fewer rows than allowed, whatever the data, and slices follow the target."""
    for keys in (5, 50, 500):
        params = Params(cohort_start=DERIVED_PARAMS.cohort_start, skew=Skew(target_rows=0, max_keys=keys))
        hot = Cohort(stored, params).hot_users
        assert hot is None or hot.count() < keys


def test_large_routes_read_each_table_once(stored):
    """With hot keys and no broadcast: trips are described once, and conditions on trip_id reach the scan."""
    params = replace(DERIVED_PARAMS, broadcast_ids=0, skew=Skew(target_rows=9))
    cohort = Cohort(stored, params)
    assert cohort.hot_users is not None
    text = plan(session_base(stored, cohort, params))
    assert len(re.findall(r"ReadSchema: struct<trip_id:bigint,origin_airport", text)) == 1
    assert len(re.findall(r"ReadSchema: struct<trip_id:bigint,hotel_name", text)) == 1
    assert "IsNotNull(trip_id)" in text and "IsNull(trip_id)" in text
