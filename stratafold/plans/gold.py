"""The gold layer: the daily fact table and its campaign dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame

from stratafold.operators import rules
from stratafold.operators.casts import cast_to
from stratafold.operators.commit import Outcome, commit
from stratafold.plans.lake import Lake
from stratafold.schemas import DIM_CAMPAIGNS, FACT

# The mark under which the fact table keeps silver's state.
SILVER = "insights"


def fact_rows(insights: DataFrame) -> DataFrame:
    """Silver rows in the fact table's types."""
    return cast_to(insights, FACT, "inserted_at")


def refresh_gold(
    lake: Lake, run_ts: dt.datetime, days: Iterable[dt.date] | None = None, *, everything: bool = False
) -> Outcome:
    """Merge silver into the fact table.

    Without ``days``, the rows that silver has changed since the last refresh are
    taken: the fact table's manifest says up to which state of silver it goes, so a
    change is not lost whichever job died before. Where a state between has been
    vacuumed, the days that differ are taken whole. ``days`` narrows the refresh to
    some days and leaves that mark; ``everything`` compares all of silver.
    """
    silver = lake.insights
    state = silver.manifest().number
    if days is not None:
        return commit(lake.fact, fact_rows(silver.read(days, number=state)), rules.changed_fact(run_ts))
    known = lake.fact.manifest().marks.get(SILVER)
    changes = None
    if known is not None and not everything:
        changes = silver.changes_since(known, state)
        days = silver.days_changed_since(known) if changes is None else None
    source = fact_rows(silver.read(days, number=state) if changes is None else changes)
    return commit(lake.fact, source, rules.changed_fact(run_ts), marks={SILVER: state})


def campaign_dimension(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(*DIM_CAMPAIGNS.columns)


def refresh_dimension(lake: Lake) -> None:
    lake.dim_campaigns.publish(campaign_dimension(lake.campaigns.read()))


def fact_with_dimension(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Facts with what is known of their campaign; facts without one stay.

    No hint: the dimension is broadcast when its size allows, else both sides
    are shuffled and hot campaigns split while running.
    """
    attributes = [c for c in dimension.columns if c not in fact.columns]
    return fact.join(dimension.select("campaign_id", *attributes), "campaign_id", "left")
