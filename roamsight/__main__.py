"""Run jobs over stored tables: ``spark-submit run.py JOB INPUT OUTPUT`` or ``python -m roamsight JOB INPUT OUTPUT``.

INPUT holds the folders sessions, users, flights and hotels, or what the job ``lay-out`` has made of them (``--laid-out``); small
results are written as CSV, large ones as Parquet. ``--also JOB`` runs further jobs over the same tables, which then share what
they have in common; their results go to folders of their names below OUTPUT, as does that of the first.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import fields, replace
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.params import Params, Weights
from roamsight.plans import kpis, retention
from roamsight.plans.cohort import Cohort
from roamsight.plans.inspection import inspect_averages, inspect_sessions
from roamsight.plans.segmentation import inspect_users, segment_users
from roamsight.plans.sessions import session_base
from roamsight.plans.users import user_averages
from roamsight.sources.layout import read_laid_out, write_laid_out
from roamsight.sources.session import tune, tuned
from roamsight.sources.sinks import write_summary_csv, write_table
from roamsight.sources.staging import release
from roamsight.sources.tables import Tables, read_tables

Job = Callable[[Tables, Params], DataFrame]

TABLES: dict[str, Job] = {
    "session-base": lambda t, p: session_base(t, Cohort(t, p), p),
    "user-averages": lambda t, p: user_averages(t, Cohort(t, p), p),
    "features": lambda t, p: segment_users(t, p).features,
    "scores": lambda t, p: segment_users(t, p).scores,
    "assigned": lambda t, p: segment_users(t, p).assigned.orderBy(F.desc("score"), "user_id"),
}
SUMMARIES: dict[str, Job] = {
    "segments": lambda t, p: segment_users(t, p).summary,
    "segments-short": lambda t, p: segment_users(t, p, short=True).summary,
    "kpi-full-year": lambda t, p: kpis.kpi_full_year(t),
    "kpi-ytd": lambda t, p: kpis.kpi_ytd(t),
    "kpi-dashboard": lambda t, p: kpis.kpi_dashboard(t),
    "retention": lambda t, p: retention.retention_heatmap(t, p.retention_cohort_year),
}


#: Jobs that read only what bears on the users of ``--user-id``.
INSPECTIONS = {"session-base": inspect_sessions, "user-averages": inspect_averages}
LAY_OUT = "lay-out"

_WEIGHTS = [f.name for f in fields(Weights)]


def _weight(text: str) -> tuple[str, Decimal]:
    name, _, value = text.partition("=")
    if name not in _WEIGHTS:
        raise argparse.ArgumentTypeError(f"{name} is none of {', '.join(_WEIGHTS)}")
    return name, Decimal(value)


def run(
    spark: SparkSession,
    job: str,
    source: str,
    target: str,
    params: Params,
    file_format: str = "parquet",
    user_ids: Sequence[str] = (),
    text_ids: bool = False,
    laid_out: bool = False,
    buckets: int = 200,
) -> None:
    tables = read_laid_out(spark, source) if laid_out else read_tables(spark, source, file_format, text_ids)
    if job == LAY_OUT:
        write_laid_out(tables, target, buckets)
    elif job in SUMMARIES:
        write_summary_csv(SUMMARIES[job](tables, params), target)
    elif user_ids and job in INSPECTIONS:
        ids = list(user_ids) if text_ids else [int(i) for i in user_ids]
        write_table(INSPECTIONS[job](tables, params, ids), target)
    else:
        found = TABLES[job](tables, params)
        write_table(inspect_users(found, list(user_ids)) if user_ids else found, target)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roamsight", description=__doc__)
    parser.add_argument("job", choices=[*TABLES, *SUMMARIES, LAY_OUT])
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "orc"], help="of the input")
    parser.add_argument("--also", action="append", default=[], choices=[*TABLES, *SUMMARIES], help="one more job")
    parser.add_argument("--laid-out", action="store_true", help=f"INPUT was written by {LAY_OUT}")
    parser.add_argument("--buckets", type=int, default=200, help=f"of flights and hotels, for {LAY_OUT}")
    parser.add_argument("--cohort-start", type=date.fromisoformat, default=Params.cohort_start)
    parser.add_argument("--min-sessions", type=int, default=Params.min_sessions, help="members need more than this")
    parser.add_argument("--as-of", type=date.fromisoformat, default=Params.as_of_date, help="day on which ages count")
    parser.add_argument("--cohort-year", type=int, default=Params.retention_cohort_year, help="for retention")
    parser.add_argument("--low-percentile", type=Decimal, default=Params.low_percentile)
    parser.add_argument("--high-percentile", type=Decimal, default=Params.high_percentile)
    parser.add_argument("--others-threshold", type=Decimal, default=Params.others_threshold, help="below it nobody is assigned")
    parser.add_argument("--weight", action="append", default=[], type=_weight, metavar="NAME=VALUE", help=", ".join(_WEIGHTS))
    parser.add_argument("--user-id", action="append", default=[], help="keep only these users (session and user tables)")
    parser.add_argument("--text-ids", action="store_true", help="user, trip and session ids are strings")
    parser.add_argument("--with-segment", action="append", default=[], choices=["Weekender", "Senior Traveler"])
    chosen = parser.parse_args(arguments)
    params = replace(
        Params(),
        cohort_start=chosen.cohort_start,
        min_sessions=chosen.min_sessions,
        as_of_date=chosen.as_of,
        retention_cohort_year=chosen.cohort_year,
        optional_segments=tuple(chosen.with_segment),
        low_percentile=chosen.low_percentile,
        high_percentile=chosen.high_percentile,
        others_threshold=chosen.others_threshold,
        weights=replace(Weights(), **dict(chosen.weight)),
    )
    jobs = list(dict.fromkeys([chosen.job, *chosen.also]))
    if chosen.user_id and not TABLES.keys() >= set(jobs):
        parser.error("--user-id needs a job that returns sessions or users")
    if chosen.text_ids and (chosen.laid_out or LAY_OUT in jobs):
        parser.error("tables that are laid out have numbers as ids")
    spark = tune(tuned(SparkSession.builder.appName(f"roamsight {' '.join(jobs)}")).getOrCreate())
    for job in jobs:
        target = f"{chosen.output.rstrip('/')}/{job}" if len(jobs) > 1 else chosen.output
        options = (chosen.format, chosen.user_id, chosen.text_ids, chosen.laid_out, chosen.buckets)
        run(spark, job, chosen.input, target, params, *options)


def command() -> None:
    """The jobs, then their staged tables are removed."""
    main()
    release(SparkSession.active())


if __name__ == "__main__":
    command()
