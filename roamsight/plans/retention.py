"""Year-to-date retention of the users who were first active, or first booked, in a given year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamsight.functions.exprs import ratio
from roamsight.plans.kpis import yearly_sessions
from roamsight.sources.tables import Tables

#: Years fit a bitmap of 63 bits; sessions outside of them are an error in the data.
FIRST_YEAR, YEARS = 1980, 63


def _bit(year: Column) -> Column:
    """The year's bit in a bitmap; null for null."""
    place = year - FIRST_YEAR
    wrong = F.concat(F.lit(f"year outside {FIRST_YEAR} to {FIRST_YEAR + YEARS - 1}: "), year.cast("string"))
    fits = F.assert_true(year.isNull() | place.between(0, YEARS - 1), wrong).isNull()
    return F.when(fits & year.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), place))


def _years(bits: Column) -> Column:
    """The years of a bitmap, rising."""
    every = F.array(*[F.lit(year) for year in range(FIRST_YEAR, FIRST_YEAR + YEARS)])
    return F.filter(every, lambda year: F.call_function("getbit", bits, year - FIRST_YEAR) == 1)


def retention(tables: Tables, kinds: tuple[str, ...] = ("active", "booker"), cohort_year: int | None = None) -> DataFrame:
    """Cohort size and users seen again per cohort kind, cohort year and later year.

    One shuffle by user reduces the sessions to the few years a user was active and booked in, for both kinds at once, each a
    bitmap of fixed width that tasks combine before the shuffle; the first year is the user's cohort, which replaces a join of
    the users with themselves.
    """
    seen = yearly_sessions(tables, ytd=True).where(F.col("user_id").isNotNull()).groupBy("user_id")
    years = {"active": F.col("year"), "booker": F.when(F.col("trip_id").isNotNull(), F.col("year"))}
    seen = seen.agg(*[F.bit_or(_bit(years[kind])).alias(kind) for kind in kinds])
    seen = seen.select(*[_years(F.col(kind)).alias(kind) for kind in kinds])
    cohorts = [F.struct(F.lit(kind).alias("cohort_type"), F.array_min(kind).alias("first"), F.col(kind).alias("years")) for kind in kinds]
    seen = seen.select(F.inline(F.array(*cohorts)))
    if cohort_year is not None:
        seen = seen.where(F.col("first") == cohort_year)
    counted = (
        seen.select("cohort_type", F.col("first").alias("cohort_year_ytd"), F.explode("years").alias("compare_year_ytd"))
        .groupBy("cohort_type", "cohort_year_ytd", "compare_year_ytd")
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    # everybody in a cohort is seen in its own year; these windows run over one row per year
    in_first_year = F.when(F.col("compare_year_ytd") == F.col("cohort_year_ytd"), F.col("retained_users"))
    size = F.max(in_first_year).over(Window.partitionBy("cohort_type", "cohort_year_ytd"))
    return (
        counted.withColumn("cohort_size", size)
        .select(
            "cohort_type",
            "cohort_year_ytd",
            "compare_year_ytd",
            "cohort_size",
            "retained_users",
            ratio(F.col("retained_users") * 100, F.col("cohort_size"), 2).alias("retention_rate_pct"),
        )
        .orderBy("cohort_type", "cohort_year_ytd", "compare_year_ytd")
    )


def retention_heatmap(tables: Tables, cohort_year: int) -> DataFrame:
    """Both cohort kinds of one cohort year."""
    return retention(tables, cohort_year=cohort_year)
