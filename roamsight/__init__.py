"""Travel customer analytics on Spark: session cleaning, user features, segments, yearly KPIs and retention."""

from roamsight.params import Params, Skew, Weights
from roamsight.plans.cohort import Cohort
from roamsight.plans.kpis import kpi_dashboard, kpi_full_year, kpi_ytd
from roamsight.plans.segmentation import Segmentation, segment_users
from roamsight.plans.retention import retention, retention_heatmap
from roamsight.plans.sessions import session_base
from roamsight.plans.users import user_averages, user_table
from roamsight.sources.tables import Tables, duplicate_keys, read_tables

__all__ = [
    "Cohort",
    "Params",
    "Segmentation",
    "Skew",
    "Tables",
    "Weights",
    "duplicate_keys",
    "kpi_dashboard",
    "kpi_full_year",
    "kpi_ytd",
    "read_tables",
    "retention",
    "retention_heatmap",
    "segment_users",
    "session_base",
    "user_averages",
    "user_table",
]
