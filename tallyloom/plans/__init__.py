from .daily import (
    DailyRun,
    daily_backfill,
    daily_job,
    daily_table,
    missed_run_dates,
    noted_run_dates,
    run_daily,
    run_daily_backfill,
)
from .incremental import customer_kpi_incremental, run_customer_kpi
from .monthly import customer_kpi, kpi_columns

__all__ = [
    "DailyRun",
    "customer_kpi",
    "customer_kpi_incremental",
    "daily_backfill",
    "daily_job",
    "daily_table",
    "kpi_columns",
    "missed_run_dates",
    "noted_run_dates",
    "run_customer_kpi",
    "run_daily",
    "run_daily_backfill",
]
