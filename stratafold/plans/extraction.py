"""Planning the extraction of daily metrics and recording how it went."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import day_literal
from stratafold.operators import rules
from stratafold.operators.commit import Outcome, commit
from stratafold.operators.error_log import account_errors
from stratafold.operators.worklist import lots, work_list
from stratafold.plans.lake import Lake, staging
from stratafold.sources.page_lots import flatten_pages, lot_outcomes, opened
from stratafold.sources.raw_files import land_items

LOT = ("account_id", "mode", "lot")


def plan_extraction(lake: Lake, run_date: dt.date) -> DataFrame:
    """Rows (account, mode, lot, ids) that are due on the run date."""
    return lots(work_list(lake.subitems.read(), lake.campaigns.read(), lake.control.read(), run_date))


def with_stop_time(outcomes: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Adds the stop time, NULL for campaigns the silver table does not know.

    Campaigns are first reduced to the ids in question, so that a short list
    does not shuffle the whole table.
    """
    known = campaigns.select("campaign_id", "stop_time").join(outcomes.select("campaign_id"), "campaign_id", "left_semi")
    return outcomes.join(known, "campaign_id", "left")


def record_outcomes(
    lake: Lake, outcomes: DataFrame, run_date: dt.date, run_ts: dt.datetime, *, failed_keeps_date: bool = False
) -> Outcome:
    """Rows (campaign_id, account_id, intent) into the extraction control."""
    with staging(lake.spark) as stage:
        source = stage.write(with_stop_time(outcomes, lake.campaigns.read()), "outcomes")
        rule = rules.extraction_outcome(run_date, run_ts, failed_keeps_date=failed_keeps_date)
        return commit(lake.control, source, rule)


def campaign_intents(planned: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Lot outcomes spread over their campaigns; a lot without pages has failed."""
    ended = planned.join(outcomes.select(*LOT, "error", F.lit(True).alias("arrived")), list(LOT), "left")
    ok = F.col("arrived").isNotNull() & F.col("error").isNull()
    return ended.select(
        F.explode("campaign_ids").alias("campaign_id"), "account_id",
        F.when(ok, fv.CAMPAIGN_EXTRACTED).otherwise(fv.CAMPAIGN_FAILED).alias("intent"),
    )


def collect_insights(
    lake: Lake,
    planned: DataFrame,
    pages: DataFrame,
    run_date: dt.date,
    run_ts: dt.datetime,
    *,
    numbered: bool = False,
    **options,
) -> Outcome:
    """Fetched pages of planned lots to the raw layer and the extraction control.

    ``pages``: account_id, mode, lot, page, body. One raw folder per account
    and day holds the rows of all its good lots. ``numbered``: pages count up by one.
    """
    with staging(lake.spark) as stage:
        planned = stage.write(planned, "planned")
        pages = stage.write(opened(pages), "pages")
        ended = stage.write(lot_outcomes(pages, LOT, numbered=numbered), "lots")
        rows = flatten_pages(pages, ended, LOT).select(
            F.lit(fv.PLATFORM).alias("source"), F.lit("insights").alias("tipo"),
            F.col("account_id").alias("id"), day_literal(run_date).alias("fecha"), "item",
        )
        land_items(rows, lake.root)
        failed = ended.where("error IS NOT NULL").withColumn("platform", F.lit(fv.PLATFORM))
        lake.errors.append(account_errors(failed, fv.PROCESS_GET_INSIGHTS, "PageError", F.col("error")), run_ts)
        return record_outcomes(lake, campaign_intents(planned, ended), run_date, run_ts, **options)
