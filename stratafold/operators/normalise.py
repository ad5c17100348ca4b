"""Raw items to typed rows; bad rows keep their place with a reason.

Input: ``gcs_path, account_id, fecha_archivo, file_fault, item, platform``.
Output: the table's columns plus

* ``item_id``   the item's own id, for the error log,
* ``row_error`` why this row is left out (NULL for a good row),
* ``file_error`` why the whole file fails (NULL if this row gives no cause),
* ``has_item``  false for the one row that stands for an empty or bad file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions import json_fields as jf
from stratafold.functions.actions import first_action, open_actions
from stratafold.functions.hashing import row_hash
from stratafold.functions.json_fields import Field, Rule, first_error, open_scalars, read_fields
from stratafold.schemas import CAMPAIGN_FIELDS, CAMPAIGNS, INSIGHT_FIELDS, TableSpec

Normaliser = Callable[[DataFrame], DataFrame]

HASHED = (
    "account_id", "campaign_id", "impressions", "clicks", "spend", "date_information",
    "purchases", "value_purchases", "platform",
)
GOOD = "has_item AND row_error IS NULL"
BAD = "has_item AND row_error IS NOT NULL"
TRAIL = ("gcs_path", "fecha_archivo", "item_id", "row_error", "file_error", "has_item")


CAMPAIGN_RULES = (
    Rule("campaign_id", "id", lambda f: (f.text, F.lit(False)), "missing"),
    *[
        Rule(name, name, lambda f: jf.cents_or_null(f, fv.CENTS_PER_UNIT), "not a number")
        for name in ("daily_budget", "lifetime_budget")
    ],
    *[
        Rule(name, name, jf.instant_or_null, "not a timestamp")
        for name in ("start_time", "stop_time", "created_time", "updated_time")
    ],
)
# broken by a good row, these fail the whole file
CAMPAIGN_FILE_RULES = (Rule("budget_rebalance_flag", "budget_rebalance_flag", jf.flag_or_false, "not a flag"),)

INSIGHT_RULES = (
    Rule("impressions", "impressions", jf.integer_or_zero, "not a whole number"),
    Rule("clicks", "clicks", jf.integer_or_zero, "not a whole number"),
    Rule("spend", "spend", jf.number_or_zero, "not a number"),
    Rule("purchases", "actions", lambda f: first_action(f, money=False), "unreadable action list"),
    Rule("value_purchases", "action_values", lambda f: first_action(f, money=True), "unreadable action list"),
)
INSIGHT_FILE_RULES = (
    Rule("campaign_id", "campaign_id", lambda f: (f.text, F.lit(False)), "missing"),
    Rule("date_information", "date_stop", jf.day_required, "not a date"),
)


def _judge(df: DataFrame, id_field: str, row_rules: Sequence[Rule], file_rules: Sequence[Rule]) -> DataFrame:
    """Read the fields and attach the verdicts.

    A row that is left out gives no cause to fail its file.
    """
    has_item = F.col("item").isNotNull()
    read = read_fields(df, [*row_rules, *file_rules]).withColumns(
        {
            "has_item": has_item,
            "item_id": F.when(
                has_item, F.when(Field(id_field).missing, F.lit(fv.UNKNOWN_ITEM)).otherwise(Field(id_field).text)
            ),
            "row_error": F.when(has_item, first_error(row_rules)),
        }
    )
    cause = F.when(has_item & F.col("row_error").isNull(), first_error(file_rules))
    return read.withColumn("file_error", F.coalesce("file_fault", cause))


def _computed_once(rows: DataFrame) -> DataFrame:
    """The same rows behind a generator, through which no filter is pushed.

    Selecting good or bad rows would otherwise repeat the reading of every field
    inside the filter.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _open(items: DataFrame, fields: Sequence[str]) -> DataFrame:
    return open_scalars(items, {f: F.col("item")[f] for f in fields})


def normalise_campaigns(items: DataFrame) -> DataFrame:
    opened = _open(items, [name for name, kind in CAMPAIGN_FIELDS.items() if kind == "variant"])
    texts = {"campaign_name": "name", "status": "status", "objective": "objective"}
    named = opened.withColumns({column: F.col("item")[f] for column, f in texts.items()})
    rows = _judge(named, "id", CAMPAIGN_RULES, CAMPAIGN_FILE_RULES)
    return _computed_once(rows.select(*[c for c in CAMPAIGNS.columns if c != "loaded_at"], *TRAIL))


def normalise_insights(items: DataFrame) -> DataFrame:
    lists = ("actions", "action_values")
    opened = open_actions(_open(items, [f for f in INSIGHT_FIELDS if f not in lists]), lists)
    rows = _judge(opened, "campaign_id", INSIGHT_RULES, INSIGHT_FILE_RULES).select(*HASHED, *TRAIL)
    return _computed_once(rows.withColumn("row_hash", row_hash(rows, HASHED)))


def normaliser_for(platform: str, normalisers: Mapping[str, Normaliser]) -> Normaliser | None:
    """A platform's normaliser, compared without case."""
    return {name.lower(): normalise for name, normalise in normalisers.items()}.get(platform.lower())


def fail_unsupported(files: DataFrame, spec: TableSpec, *left_out: str) -> DataFrame:
    """One row per file of a platform without a normaliser: the file fails unread."""
    known = ("gcs_path", "fecha_archivo", "account_id", "platform")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema.fields if f.name not in (*known, *left_out)}
    reason = F.concat(F.lit("no normaliser for platform "), F.col("platform"))
    return files.select(*known).distinct().withColumns(
        {
            **blank,
            "item_id": F.lit(None).cast("string"),
            "row_error": F.lit(None).cast("string"),
            "file_error": reason,
            "has_item": F.lit(False),
        }
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(GOOD)


def bad_rows(rows: DataFrame) -> DataFrame:
    return rows.where(BAD)
