"""The extraction work list and its lots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import day_literal, utc_date
from stratafold.operators.due import in_range, range_mode

GROUP = ("account_id", "mode")
# Hex digits of the id's MD5 that split a group for numbering: 3 give 4096 parts.
SPLIT_DIGITS = 3


def work_list(
    subitems: DataFrame,
    campaigns: DataFrame,
    control: DataFrame,
    run_date: dt.date,
    platform: str | None = fv.PLATFORM,
) -> DataFrame:
    """Campaigns in use that have started and are not closed, with their last date.

    Subitems are made distinct before the join, so a campaign with very many of
    them weighs no more than the others.
    """
    started = campaigns.where(utc_date(F.col("start_time")) <= day_literal(run_date))
    if platform is not None:
        started = started.where(F.lower("platform") == platform.lower())
    status = F.coalesce("extraction_status", F.lit(fv.CAMPAIGN_PENDING))
    return (
        subitems.select("campaign_id")
        .distinct()
        .join(started.select("campaign_id", "account_id"), "campaign_id")
        .join(control.select("campaign_id", "last_insight_date", "extraction_status"), "campaign_id", "left")
        .select("campaign_id", "account_id", "last_insight_date", status.alias("extraction_status"))
        .where(F.col("extraction_status").isin(*fv.OPEN_CAMPAIGN_STATUSES))
        .distinct()
        .withColumn("mode", range_mode(F.col("last_insight_date")))
    )


def with_lot(work: DataFrame, size: int = fv.LOT_SIZE) -> DataFrame:
    """Numbers full lots of ``size`` ids within each account and mode.

    Ids are ordered by a prefix of their MD5, then by themselves. The prefix
    splits a group into parts that are numbered on their own; the part sizes,
    at most a few thousand per group, give each part its offset. No task ever
    holds a whole group.
    """
    split = work.withColumn("part", F.substring(F.md5("campaign_id"), 1, SPLIT_DIGITS))
    before = Window.partitionBy(*GROUP).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy(*GROUP, "part")
        .agg(F.count("*").alias("n"))
        .select(*GROUP, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy(*GROUP, "part").orderBy("campaign_id")
    numbered = split.withColumn("rank", F.row_number().over(within)).join(offsets, [*GROUP, "part"])
    lot = F.floor((F.col("offset") + F.col("rank") - 1) / size).cast("bigint")
    return numbered.withColumn("lot", lot).select(*work.columns, "lot")


def lots(work: DataFrame, size: int = fv.LOT_SIZE) -> DataFrame:
    """One row per lot with its ids; no list is longer than ``size``."""
    return (
        with_lot(work, size)
        .groupBy(*GROUP, "lot")
        .agg(F.sort_array(F.collect_list("campaign_id")).alias("campaign_ids"))
    )


def group_sizes(work: DataFrame, size: int = fv.LOT_SIZE) -> DataFrame:
    """Account -> mode -> number of campaigns and of lots."""
    counted = work.groupBy(*GROUP).agg(F.count("*").alias("n_campaigns"))
    return counted.withColumn("n_lots", F.ceil(F.col("n_campaigns") / size).cast("bigint"))


def requested_rows(metrics: DataFrame, work: DataFrame, run_date: dt.date) -> DataFrame:
    """Daily metrics that the work list asks for: its campaigns, each in its range."""
    asked = work.select("campaign_id", "mode").distinct()
    joined = metrics.join(asked, "campaign_id")
    return joined.where(in_range(F.col("date_information"), F.col("mode"), run_date)).select(*metrics.columns, "mode")


def daily_metrics(events: DataFrame) -> DataFrame:
    """Campaign and day rollup of single actions.

    Input: ``account_id, campaign_id, ts, action_type, cents, platform``. Sums
    are whole cents, so the order of addition does not matter.
    """
    def cents_as_units(cents: Column) -> Column:
        return F.coalesce(F.sum(cents), F.lit(0)) / F.lit(float(fv.CENTS_PER_UNIT))

    bought = F.col("action_type") == fv.PURCHASE
    return events.groupBy(
        "account_id", "campaign_id", F.to_date("ts").alias("date_information"), "platform"
    ).agg(
        F.count("*").alias("impressions"),
        F.count_if(F.col("action_type") == "click").alias("clicks"),
        cents_as_units(F.col("cents")).alias("spend"),
        F.count_if(bought).alias("purchases"),
        cents_as_units(F.when(bought, F.col("cents"))).alias("value_purchases"),
    )
