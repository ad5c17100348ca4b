"""Which accounts are due, and the date range of a campaign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import day_literal, utc_date


def due_reason(last_run: Column, status: Column, run_date: dt.date) -> Column:
    today, last_day = day_literal(run_date), utc_date(last_run)
    return (
        F.when(last_run.isNull(), fv.DUE_FIRST)
        .when((last_day == today) & (status == fv.ACCOUNT_OK), fv.DUE_DONE_TODAY)
        .when((last_day == today) & status.isin(fv.ACCOUNT_RUNNING, fv.ACCOUNT_FAILED), fv.DUE_RETRY)
        .when(last_day < today, fv.DUE_NEW_DAY)
        .otherwise(fv.DUE_UNCHANGED)
    )


def with_due(accounts: DataFrame, run_date: dt.date) -> DataFrame:
    """Adds ``motivo`` and ``extraer``."""
    reason = due_reason(F.col("ultima_extraccion"), F.col("extraction_status"), run_date)
    marked = accounts.withColumn("motivo", reason)
    return marked.withColumn("extraer", F.col("motivo").isin(fv.DUE_FIRST, fv.DUE_RETRY, fv.DUE_NEW_DAY))


def range_mode(last_insight_date: Column) -> Column:
    """Everything for a campaign never extracted, else the recent days."""
    return F.when(last_insight_date.isNull(), fv.MODE_ALL).otherwise(fv.MODE_RECENT)


def in_range(day: Column, mode: Column, run_date: dt.date) -> Column:
    """Days before the run date, and only recent ones unless the mode is everything."""
    today = day_literal(run_date)
    recent = day >= F.date_sub(today, fv.RECENT_DAYS)
    return (day < today) & ((mode == fv.MODE_ALL) | recent)
