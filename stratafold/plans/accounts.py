"""The account cycle: who is due, fetch, land, and the resulting status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import day_literal
from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.operators.due import with_due
from stratafold.operators.error_log import account_errors
from stratafold.plans.lake import Lake, staging
from stratafold.sources.page_lots import flatten_pages, lot_outcomes, opened
from stratafold.sources.raw_files import land_items

ACCOUNT = ("account_id",)
NO_ROWS = "no campaigns were fetched"


def due_accounts(catalogue: DataFrame, run_date: dt.date, platform: str = fv.PLATFORM) -> DataFrame:
    """Active accounts of a platform with the verdict of the due rule."""
    active = catalogue.where(F.col("activo") & (F.lower("platform") == platform.lower()))
    return with_due(active, run_date)


def fetch_status(due: DataFrame, fetched: DataFrame) -> DataFrame:
    """Status per due account: failed if any page failed or nothing came back."""
    ended = due.join(fetched, list(ACCOUNT), "left")
    error = F.coalesce("error", F.when(F.coalesce("n_rows", F.lit(0)) == 0, F.lit(NO_ROWS)))
    return ended.select(
        "account_id", "platform", error.alias("error"),
        F.when(error.isNull(), fv.ACCOUNT_OK).otherwise(fv.ACCOUNT_FAILED).alias("status"),
    )


def account_cycle(
    lake: Lake, pages: DataFrame, run_date: dt.date, run_ts: dt.datetime, platform: str = fv.PLATFORM
) -> dict[str, int]:
    """Fetched campaign pages (account_id, page, body) of the due accounts.

    Marks the due accounts, lands their campaigns, sets the final status and
    logs one error per failed account. Returns accounts per status.
    """
    with staging(lake.spark) as stage:
        marked = due_accounts(lake.accounts.read(), run_date, platform).where("extraer").select("account_id", "platform")
        due = stage.write(marked, "due-accounts")
        rule = rules.account_status(run_ts)
        commit(lake.accounts, due.select("account_id", F.lit(fv.ACCOUNT_RUNNING).alias("status")), rule, compare=False)

        wanted = stage.write(opened(pages.join(due.select("account_id"), list(ACCOUNT), "left_semi")), "pages")
        fetched = stage.write(lot_outcomes(wanted, ACCOUNT), "fetched")
        rows = flatten_pages(wanted, fetched, ACCOUNT)
        land_items(
            rows.select(
                F.lit(platform).alias("source"), F.lit("campaigns").alias("tipo"),
                F.col("account_id").alias("id"), day_literal(run_date).alias("fecha"), "item",
            ),
            lake.root,
        )
        ended = stage.write(fetch_status(due, fetched), "account-status")
        failed = ended.where("error IS NOT NULL")
        lake.errors.append(account_errors(failed, fv.PROCESS_GET_CAMPAIGNS, "FetchError", F.col("error")), run_ts)
        commit(lake.accounts, ended.select("account_id", "status"), rule, compare=False)
        return {r["status"]: r["n"] for r in ended.groupBy("status").agg(F.count("*").alias("n")).collect()}
