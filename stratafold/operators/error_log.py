"""Rows for the error log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import utc_day
from stratafold.sources.tables import LakeTable

# Rows of one fault are numbered in parts of so many.
PART_ROWS = 10_000


def _id(column: Column | None) -> Column:
    """Empty ids are no ids."""
    if column is None:
        return F.lit(None).cast("string")
    return F.nullif(column.cast("string"), F.lit(""))


def error_rows(
    df: DataFrame,
    process: str,
    *,
    platform: Column,
    entity_id: Column | None,
    entity_kind: str,
    kind: str,
    message: Column,
    parent_id: Column | None = None,
    parent_kind: str | None = None,
    child_id: Column | None = None,
    child_kind: str | None = None,
    attempts: int = 1,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One error-log row per input row; id, time and the open mark are defaults of the table."""
    return df.select(
        F.lit(process).alias("proceso"),
        platform.alias("platform"),
        _id(parent_id).alias("parent_id"),
        F.lit(parent_kind).cast("string").alias("parent_tipo"),
        _id(child_id).alias("child_id"),
        F.lit(child_kind).cast("string").alias("child_tipo"),
        _id(entity_id).alias("entidad_id"),
        F.lit(entity_kind).alias("entidad_tipo"),
        F.lit(kind).alias("tipo_error"),
        message.alias("mensaje_error"),
        F.lit(attempts).cast("bigint").alias("intentos"),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )


def account_errors(
    df: DataFrame,
    process: str,
    kind: str,
    message: Column,
    child_id: Column | None = None,
    child_kind: str | None = None,
    *,
    file: Column | None = None,
) -> DataFrame:
    """Errors that belong to an advertising account, found in ``file``."""
    return error_rows(
        df, process, platform=F.lower("platform"), entity_id=F.col("account_id"), entity_kind=fv.ENTITY_ACCOUNT,
        kind=kind, message=message, parent_id=F.col("account_id"), parent_kind=fv.ENTITY_ACCOUNT,
        child_id=child_id, child_kind=child_kind, extra={} if file is None else {"file": file},
    )


def log_once(log: LakeTable, errors: DataFrame, run_ts: dt.datetime) -> None:
    """Add errors (with their ``file``) that this day's runs have not logged yet.

    The id is a digest of day and row, and of how often the row came before. So a
    load that died behind its log and is repeated logs nothing twice, while the same
    fault on another day is a new row. Only the day's part of the log is read. Equal
    rows are counted where they lie and numbered in parts, so one fault that a
    whole file repeats is spread over all tasks.
    """
    today = utc_day(run_ts)
    counted = errors.groupBy(*errors.columns).agg(F.count("*").alias("n"))
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {PART_ROWS}L"))))
    dealt = parts.repartition(*errors.columns, "part")
    first = F.col("part") * PART_ROWS
    nth = F.explode(F.sequence(first + 1, F.least(F.col("n"), first + PART_ROWS)))
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in errors.columns]
    digest = F.md5(F.concat_ws("\u0001", F.lit(str(today)), *texts, F.col("nth").cast("string")))
    keyed = dealt.withColumn("nth", nth).withColumn("error_id", digest).drop("file", "n", "part", "nth")
    log.append(keyed.join(log.read([today]).select("error_id"), "error_id", "left_anti"), run_ts)
