"""The upsert rules of the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import day_literal, instant_literal, utc_date
from stratafold.operators.merge import ERROR, UNIQUE, MergeRule, same_name
from stratafold.schemas import CAMPAIGNS, FACT, INSIGHTS

METRICS = ("impressions", "clicks", "spend", "purchases", "value_purchases")
INSIGHT_KEYS = ("campaign_id", "date_information")


def _all_but(columns: list[str], *left_out: str) -> list[str]:
    return [c for c in columns if c not in left_out]


def newest_campaign(
    run_ts: dt.datetime, *, advance_version: bool = False, on_duplicate: str = ERROR, order_by: tuple[str, ...] = ()
) -> MergeRule:
    """The newer ``updated_time`` wins; NULL counts as the epoch.

    By default an update leaves ``updated_time`` as it was, so the same source
    row updates again on the next load; ``advance_version`` moves it on.
    """
    epoch = F.lit(fv.EPOCH + "T00:00:00Z").cast("timestamp")
    now = instant_literal(run_ts)
    changed = ["status", "stop_time", "daily_budget", "lifetime_budget", "budget_rebalance_flag", "campaign_name"]
    if advance_version:
        changed.append("updated_time")
    return MergeRule(
        keys=("campaign_id",),
        when=F.coalesce(F.col("s.updated_time"), epoch) > F.coalesce(F.col("t.updated_time"), epoch),
        update={**same_name(changed), "loaded_at": now},
        insert={**same_name(_all_but(CAMPAIGNS.columns, "loaded_at")), "loaded_at": now},
        on_duplicate=on_duplicate,
        order_by=order_by,
    )


def changed_insight(
    run_ts: dt.datetime, *, keys: tuple[str, ...] = INSIGHT_KEYS, on_duplicate: str = ERROR, order_by: tuple[str, ...] = ()
) -> MergeRule:
    """A differing row hash updates the metrics; a NULL hash never differs."""
    now = instant_literal(run_ts)
    return MergeRule(
        keys=keys,
        when="t.row_hash <> s.row_hash",
        update={**same_name([*METRICS, "row_hash"]), "updated_at": now},
        insert={**same_name(_all_but(INSIGHTS.columns, "updated_at")), "updated_at": now},
        on_duplicate=on_duplicate,
        order_by=order_by,
    )


def changed_fact(
    run_ts: dt.datetime, *, keys: tuple[str, ...] = INSIGHT_KEYS, on_duplicate: str = UNIQUE
) -> MergeRule:
    """As for insights; the source is the silver table, which is unique by key."""
    now = instant_literal(run_ts)
    return MergeRule(
        keys=keys,
        when="t.row_hash <> s.row_hash",
        update={**same_name([*METRICS, "row_hash"]), "inserted_at": now},
        insert={**same_name(_all_but(FACT.columns, "inserted_at")), "inserted_at": now},
        on_duplicate=on_duplicate,
    )


def started_load(run_ts: dt.datetime) -> MergeRule:
    """A file being loaded: known or not, it is now in progress without an error."""
    now, running = instant_literal(run_ts), F.lit(fv.LEDGER_RUNNING)
    return MergeRule(
        keys=("gcs_path",),
        update={"status": running, "fecha_carga": now, "error_mensaje": F.lit(None).cast("string")},
        insert={
            **same_name(["gcs_path", "business_line", "entity_id", "fecha_archivo"]),
            "load_id": F.expr("uuid()"),
            "status": running,
            "fecha_carga": now,
        },
    )


def finished_load() -> MergeRule:
    """End of a load: only files in progress move on; an error is set when given."""
    return MergeRule(
        keys=("gcs_path",),
        when=F.col("t.status") == fv.LEDGER_RUNNING,
        update={"status": "s.status", "error_mensaje": "coalesce(s.error, t.error_mensaje)"},
    )


def account_status(run_ts: dt.datetime) -> MergeRule:
    """A new status for known accounts; unknown ones are left out."""
    return MergeRule(
        keys=("account_id",),
        update={"extraction_status": "s.status", "ultima_extraccion": instant_literal(run_ts)},
    )


def lifecycle_status(intent: Column, stop_time: Column, run_date: dt.date) -> Column:
    """Failed stays failed; closed a week after its stop day; else extracted."""
    closing = F.date_add(utc_date(stop_time), fv.CLOSING_DAYS)
    return (
        F.when(intent == fv.CAMPAIGN_FAILED, fv.CAMPAIGN_FAILED)
        .when(stop_time.isNotNull() & (day_literal(run_date) >= closing), fv.CAMPAIGN_COMPLETE)
        .otherwise(fv.CAMPAIGN_EXTRACTED)
    )


def extraction_outcome(
    run_date: dt.date, run_ts: dt.datetime, *, failed_keeps_date: bool = False
) -> MergeRule:
    """Outcome per campaign: intent and stop time decide the next status.

    By default a failed campaign gets today's date as well; with
    ``failed_keeps_date`` it keeps the date of its last success.
    """
    today = day_literal(run_date)
    status = lifecycle_status(F.col("s.intent"), F.col("s.stop_time"), run_date)
    failed = F.col("s.intent") == fv.CAMPAIGN_FAILED
    update_day = F.when(failed, F.col("t.last_insight_date")).otherwise(today) if failed_keeps_date else today
    insert_day = F.when(~failed, today) if failed_keeps_date else today
    set_always = {"extraction_status": status, "ultima_extraccion": instant_literal(run_ts)}
    return MergeRule(
        keys=("campaign_id",),
        update={**set_always, "last_insight_date": update_day},
        insert={
            **set_always,
            **same_name(["campaign_id", "account_id"]),
            "last_insight_date": insert_day,
            "platform": F.lit(fv.PLATFORM),
        },
    )
