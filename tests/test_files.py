"""Sources, staging and sinks."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from helpers import make_tables, rows
from roamsight.plans.kpis import kpi_full_year
from roamsight.sources import staging
from roamsight.sources.destinations import DESTINATION_COUNTRIES
from roamsight.sources.sinks import write_summary_csv, write_table
from roamsight.sources.tables import FLIGHTS, HOTELS, SESSIONS, USERS, conform, duplicate_keys, read_tables


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_tables_come_back_as_written(spark, tables, tmp_path, file_format):
    for name in ("sessions", "users", "flights", "hotels"):
        getattr(tables, name).write.option("header", True).format(file_format).save(str(tmp_path / name))
    found = read_tables(spark, str(tmp_path), file_format)
    for name, schema in (("sessions", SESSIONS), ("users", USERS), ("flights", FLIGHTS), ("hotels", HOTELS)):
        df = getattr(found, name)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]
        assert rows(df) == rows(getattr(tables, name))


def test_string_ids_are_kept(spark):
    made = make_tables(spark, users=[{"user_id": 1}])
    text = conform(made.users.withColumn("user_id", F.concat(F.lit("u"), "user_id")), USERS)
    assert text.first().user_id == "u1"


def test_summary_csv(tables, tmp_path):
    path = str(tmp_path / "kpis")
    write_summary_csv(kpi_full_year(tables), path)
    (file,) = glob.glob(path + "/part-*")
    with open(file) as lines:
        text = lines.read().splitlines()
    assert text[0] == ",".join(f'"{name}"' for name in kpi_full_year(tables).columns)
    assert all(line.startswith('"') for line in text[1:])
    first = next(csv.DictReader(text))
    assert first["growth_sessions_pct"] == ""
    assert len(text) == kpi_full_year(tables).count() + 1


def test_table_sink(spark, tables, tmp_path):
    write_table(tables.users, str(tmp_path / "users"))
    assert rows(spark.read.parquet(str(tmp_path / "users"))) == rows(tables.users)


@pytest.mark.parametrize("setting", ["spark.checkpoint.dir", "spark.sql.warehouse.dir"])
def test_staging_uses_a_shared_folder_and_releases_it(spark, tmp_path, monkeypatch, setting):
    real = type(spark.conf).get
    shown = {"spark.checkpoint.dir": None, setting: str(tmp_path)}
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, key, *d: shown[key] if key in shown else real(conf, key, *d))
    folder = staging.staging_folder(spark)
    assert folder == f"{tmp_path}/staged/{spark.sparkContext.applicationId}"
    kept = staging.stage(spark.range(5), "five")
    gone = staging.stage(spark.range(0), "none")
    assert kept.count() == 5 and kept.inputFiles()[0].startswith(f"file://{folder}/five-")
    staging.unstage(gone)
    assert [path.split("-")[0] for path in os.listdir(folder)] == ["five"]
    staging.release(spark)
    assert not os.path.exists(folder)


def test_duplicate_keys(spark, tables):
    assert duplicate_keys(tables).count() == 0
    made = make_tables(spark, users=[{"user_id": 1}, {"user_id": 1}], flights=[{"trip_id": 5}] * 3)
    assert sorted(map(tuple, duplicate_keys(made).collect())) == [("flights", "5", 3), ("users", "1", 2)]


def test_destinations():
    assert len(DESTINATION_COUNTRIES) == len(dict(DESTINATION_COUNTRIES)) == 124
    countries = dict(DESTINATION_COUNTRIES)
    assert len(set(countries.values())) == 44
    assert (countries["xi'an"], countries["london"], countries["rome"]) == ("china", "canada", "usa")


def test_command_line(spark, tables, tmp_path):
    from roamsight.__main__ import SUMMARIES, TABLES, main
    from roamsight.plans.segmentation import segment_users
    from roamsight.sources.derived import DERIVED_PARAMS

    source = tmp_path / "in"
    for name in ("sessions", "users", "flights", "hotels"):
        getattr(tables, name).write.parquet(str(source / name))
    dates = ["--cohort-start", "1997-01-01", "--as-of", "2001-12-31", "--cohort-year", "1995"]
    for job in ("segments", "retention", "assigned"):
        main([job, str(source), str(tmp_path / job), *dates])
    with_header = spark.read.option("header", True)
    # only the destination categories depend on the built-in country list, and no score reads them
    expected = segment_users(tables, DERIVED_PARAMS)
    assert sorted(r.final_segment for r in with_header.csv(str(tmp_path / "segments")).collect()) == sorted(
        r.final_segment for r in expected.summary.collect()
    )
    assert with_header.csv(str(tmp_path / "retention")).count() == 14
    assert rows(spark.read.parquet(str(tmp_path / "assigned"))) == rows(expected.assigned)
    assert len(TABLES) + len(SUMMARIES) == 11
    two = [str(r.user_id) for r in expected.assigned.orderBy("user_id").limit(2).collect()]
    main(["assigned", str(source), str(tmp_path / "two"), *dates, "--user-id", two[0], "--user-id", two[1]])
    assert sorted(str(r.user_id) for r in spark.read.parquet(str(tmp_path / "two")).collect()) == sorted(two)
    tuned = ["--others-threshold", "2", "--weight", "family_children=0.5", "--low-percentile", "0.1", "--high-percentile", "0.9"]
    main(["segments", str(source), str(tmp_path / "tuned"), *dates, *tuned])
    assert [r.final_segment for r in with_header.csv(str(tmp_path / "tuned")).collect()] == ["Others"]
    for wrong in (["segments", "--user-id", "1"], ["assigned", "--weight", "nothing=1"]):
        with pytest.raises(SystemExit):
            main([wrong[0], str(source), str(tmp_path / "wrong"), *wrong[1:]])


def test_command_line_with_text_ids(spark, tables, tmp_path):
    from roamsight.__main__ import main

    for name in ("sessions", "users", "flights", "hotels"):
        df = getattr(tables, name)
        ids = {c: F.concat(F.lit("id-"), c) for c in ("session_id", "user_id", "trip_id") if c in df.columns}
        df.withColumns(ids).write.parquet(str(tmp_path / "in" / name))
    main(["assigned", str(tmp_path / "in"), str(tmp_path / "out"), "--cohort-start", "1997-01-01", "--text-ids"])
    users = [r.user_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert users and all(u.startswith("id-") for u in users)


def test_tables_with_the_same_plan_are_stored_once(spark, tables):
    """Plans are told apart by what they do and read, and the last reader takes the copy along."""
    staging.release(spark)
    make = lambda n: tables.users.where(F.col("user_id") > n).select("user_id")
    first, values = staging.shared(make(5), "some", n=F.count(F.lit(1)))
    again, _ = staging.shared(make(5), "some", n=F.count(F.lit(1)))
    other, more = staging.shared(make(6), "some", n=F.count(F.lit(1)))
    assert again is first and other is not first and values["n"] == first.count() and more["n"] == other.count()
    folder = staging.staging_folder(spark).removeprefix("file:")
    assert len(os.listdir(folder)) == 2
    staging.done(first)
    assert again.count() == values["n"]
    staging.done(again, spark.range(1))
    assert len(os.listdir(folder)) == 1
    assert staging.shared(make(5), "some", n=F.count(F.lit(1)))[0].count() == values["n"]
    staging.release(spark)
    assert not os.path.exists(folder) and staging.shared(make(6), "some", n=F.count(F.lit(1)))[0].count() == more["n"]


def test_measures_of_empty_tables(spark):
    empty = spark.range(5).where("id > 9")
    copy, values = staging.measured(empty, "none", n=F.count(F.lit(1)), most=F.max("id"))
    assert copy.count() == 0 and values == {"n": 0, "most": None}


def test_a_closed_cohort_leaves_nothing(spark, tables):
    from roamsight.plans.cohort import Cohort
    from roamsight.sources.derived import DERIVED_PARAMS

    staging.release(spark)
    one, two = Cohort(tables, DERIVED_PARAMS), Cohort(tables, DERIVED_PARAMS)
    folder = staging.staging_folder(spark).removeprefix("file:")
    assert one.user_trips is two.user_trips and len(os.listdir(folder)) == 3
    one.close()
    assert two.profiles.count() and len(os.listdir(folder)) == 3
    two.close()
    assert os.listdir(folder) == []


def test_command_line_over_laid_out_tables(spark, tables, tmp_path):
    from roamsight.__main__ import main

    source, days = tmp_path / "in", str(tmp_path / "days")
    for name in ("sessions", "users", "flights", "hotels"):
        getattr(tables, name).write.parquet(str(source / name))
    dates = ["--cohort-start", "1997-01-01", "--as-of", "2001-12-31", "--cohort-year", "1995"]
    main(["lay-out", str(source), days, "--buckets", "3"])
    both = ["--also", "user-averages", "--also", "kpi-ytd"]
    main(["session-base", str(source), str(tmp_path / "plain"), *dates, *both])
    main(["session-base", days, str(tmp_path / "laid"), *dates, *both, "--laid-out"])
    for job in ("session-base", "user-averages"):
        assert rows(spark.read.parquet(str(tmp_path / "laid" / job))) == rows(spark.read.parquet(str(tmp_path / "plain" / job)))
    assert os.listdir(tmp_path / "laid" / "kpi-ytd")
    main(["session-base", days, str(tmp_path / "one"), *dates, "--laid-out", "--user-id", "1", "--user-id", "4"])
    one = spark.read.parquet(str(tmp_path / "one"))
    assert rows(one) == rows(spark.read.parquet(str(tmp_path / "plain" / "session-base")).where("user_id in (1, 4)"))
    for wrong in (["session-base", "--laid-out", "--text-ids"], ["user-averages", "--also", "kpi-ytd", "--user-id", "1"]):
        with pytest.raises(SystemExit):
            main([wrong[0], days, str(tmp_path / "wrong"), *wrong[1:]])
