"""The registered queries: operators and whole jobs over the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions import paths
from stratafold.functions.actions import first_value
from stratafold.operators import rules
from stratafold.operators.casts import cast_to
from stratafold.operators.due import range_mode
from stratafold.operators.commit import commit
from stratafold.operators.error_log import account_errors
from stratafold.operators.guards import split_missing
from stratafold.operators.ledger import account_days, not_yet_loaded
from stratafold.operators.merge import merge
from stratafold.operators.normalise import bad_rows, good_rows, normalise_campaigns, normalise_insights, normaliser_for
from stratafold.operators.worklist import daily_metrics, group_sizes, lots, requested_rows, work_list
from stratafold.plans.accounts import account_cycle, due_accounts
from stratafold.plans.extraction import collect_insights, plan_extraction, with_stop_time
from stratafold.plans.gold import campaign_dimension, fact_rows, fact_with_dimension, refresh_gold
from stratafold.plans.lake import Lake, Staging
from stratafold.plans.silver_load import load_campaigns, load_insights
from stratafold.registry import frames as fr
from stratafold.registry.frames import stamp, table, text
from stratafold.schemas import CAMPAIGN_FIELDS, INSIGHT_FIELDS, INSIGHTS
from stratafold.session import scratch_path
from stratafold.sources.array_split import read_split_items
from stratafold.sources.catalogue import active_accounts, active_platforms
from stratafold.sources.listing import LINES, day_glob
from stratafold.sources.page_lots import flatten_pages, lot_outcomes
from stratafold.sources.raw_files import land_arrays, land_items, open_items, read_items
from stratafold.streaming.silver_stream import stream_files

METRIC_COLUMNS = (
    "account_id", "campaign_id", "date_information", "impressions", "clicks", "spend", "purchases",
    "value_purchases", "platform",
)


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake")).create_tables()


# --- daily metrics and the insight upsert -----------------------------------
def daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return daily_metrics(fr.actions(spark, sf))


def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    return fr.late_metrics(spark, sf).select("campaign_id", "date_information", "row_hash")


def insights_upsert(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge(
        cast_to(fr.early_silver(spark, sf), INSIGHTS), fr.late_metrics(spark, sf), rules.changed_insight(fr.LATE_TS)
    )
    return merged.select(*METRIC_COLUMNS, "row_hash", stamp("updated_at"), "action")


def older_fact(spark: SparkSession, sf: str) -> DataFrame:
    """A fact table of the early pull in which single-impression rows have no hash."""
    fact = fact_rows(fr.early_silver(spark, sf))
    known = F.when(F.col("impressions") > 1, F.col("row_hash"))
    return fact.withColumn("row_hash", known).withColumn("inserted_at", fr.instant_literal(fr.EARLY_TS))


def gold_upsert(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge(
        older_fact(spark, sf), fact_rows(fr.late_metrics(spark, sf)), rules.changed_fact(fr.LATE_TS)
    )
    return merged.select(*METRIC_COLUMNS, "row_hash", stamp("inserted_at"), "action")


def gold_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The gold job on written tables: older fact, newer silver, one refresh."""
    lake = new_lake(spark)
    lake.fact.publish(older_fact(spark, sf))
    silver = fr.late_metrics(spark, sf).withColumn("updated_at", fr.instant_literal(fr.LATE_TS))
    lake.insights.publish(cast_to(silver, INSIGHTS))
    refresh_gold(lake, fr.LATE_TS)
    return lake.fact.read().select(*METRIC_COLUMNS, "row_hash", stamp("inserted_at"))


def range_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Daily metrics in the range of their campaign's mode."""
    seen = fr.early_metrics(spark, sf).groupBy("campaign_id").agg(F.max("date_information").alias("last_insight_date"))
    late = seen.where(F.col("last_insight_date") >= F.lit(dt.date(2024, 1, 19)))
    metrics = daily_rollup(spark, sf)
    ids = metrics.select("campaign_id").distinct()
    work = ids.join(late, "campaign_id", "left").withColumn("mode", range_mode(F.col("last_insight_date")))
    return requested_rows(metrics, work, dt.date(2024, 1, 30)).select(
        "campaign_id", "date_information", "mode", "impressions"
    )


# --- campaigns ----------------------------------------------------------------
CAMPAIGN_OUTPUT = (
    "account_id", "campaign_id", "campaign_name", "status", "objective", "budget_rebalance_flag",
    "daily_budget", "lifetime_budget",
)
CAMPAIGN_TIMES = ("start_time", "stop_time", "created_time", "updated_time", "loaded_at")


def campaigns_upsert(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge(
        fr.known_campaigns(spark, sf), fr.pulled_campaigns(spark, sf), rules.newest_campaign(fr.ORDERS_TS)
    )
    return merged.select(*CAMPAIGN_OUTPUT, *[stamp(c) for c in CAMPAIGN_TIMES], "platform", "action")


def star_join(spark: SparkSession, sf: str) -> DataFrame:
    """Daily facts with the name of their campaign; customers stand in for campaigns."""
    fact = fact_rows(fr.late_metrics(spark, sf))
    named = table(spark, sf, "customer").select(
        text("c_custkey").alias("campaign_id"), F.col("c_name").alias("campaign_name"),
        F.col("c_mktsegment").alias("objective"),
    )
    joined = fact_with_dimension(fact, named)
    return joined.select("campaign_id", "date_information", "spend", "campaign_name", "objective")


def dim_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    dim = campaign_dimension(fr.campaigns(spark, sf))
    return dim.select("campaign_id", "campaign_name", "status", "objective", stamp("start_time"), stamp("stop_time"), "platform")


# --- normalising raw text -------------------------------------------------------
def campaign_rows(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_campaigns(open_items(fr.raw_campaign_lines(spark, sf), CAMPAIGN_FIELDS))


def insight_rows(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_insights(open_items(fr.raw_insight_lines(spark, sf), INSIGHT_FIELDS))


def normalize_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    rows = good_rows(campaign_rows(spark, sf))
    return rows.select(
        *CAMPAIGN_OUTPUT, stamp("start_time"), stamp("stop_time"), stamp("updated_time"), "platform"
    )


def normalize_insights(spark: SparkSession, sf: str) -> DataFrame:
    return good_rows(insight_rows(spark, sf)).select(*METRIC_COLUMNS)


def row_errors(spark: SparkSession, sf: str) -> DataFrame:
    campaigns = bad_rows(campaign_rows(spark, sf)).select(F.lit("campaigns").alias("kind"), "item_id", "row_error")
    insights = bad_rows(insight_rows(spark, sf)).select(F.lit("insights").alias("kind"), "item_id", "row_error")
    return campaigns.unionByName(insights)


def error_log(spark: SparkSession, sf: str) -> DataFrame:
    """Bad insight rows as rows of the error log, without its generated columns."""
    bad = bad_rows(insight_rows(spark, sf))
    return account_errors(bad, fv.PROCESS_LOAD_INSIGHTS, "RowError", F.col("row_error"), F.col("item_id"), "item")


def not_null_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Daily metrics without an account stay out, named by the missing column."""
    owners = table(spark, sf, "customer").where("c_acctbal >= 0").select(
        text("c_custkey").alias("campaign_id"), F.col("c_mktsegment").alias("platform")
    )
    rows = daily_rollup(spark, sf).drop("platform").join(owners, "campaign_id", "left").withColumn(
        "row_hash", F.when(F.col("impressions") > 1, F.lit("h"))
    )
    good, bad = split_missing(rows, INSIGHTS.required)
    kept = good.select("campaign_id", "date_information", F.lit(None).cast("string").alias("missing_column"))
    return kept.unionByName(bad.select("campaign_id", "date_information", "missing_column"))


def first_action(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's words as actions, typed by their first letter; the first ``p`` counts."""
    words = F.transform(
        F.split("text", " "),
        lambda w: F.struct(F.lower(F.substring(w, 1, 1)).alias("action_type"), F.length(w).alias("value")),
    )
    value = F.coalesce(first_value(words, "p"), F.lit(0)).cast("bigint")
    return table(spark, sf, "documents").select("doc_id", value.alias("first_value"))


# --- due work -------------------------------------------------------------------
def due_rule(spark: SparkSession, sf: str) -> DataFrame:
    due = due_accounts(fr.accounts(spark, sf), dt.date(2001, 6, 1))
    return due.select("account_id", "extraction_status", stamp("ultima_extraccion"), "extraer", "motivo")


def extraction_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return work_list(fr.subitems(spark, sf), fr.campaigns(spark, sf), fr.control(spark, sf), fr.ORDERS_DAY)


def nation_work(spark: SparkSession, sf: str) -> DataFrame:
    return work_list(
        fr.subitems(spark, sf), fr.nation_campaigns(spark, sf), fr.control(spark, sf), fr.ORDERS_DAY, platform=None
    )


def extraction_lots(spark: SparkSession, sf: str) -> DataFrame:
    numbered = lots(nation_work(spark, sf))
    return numbered.select("account_id", "mode", "lot", F.concat_ws(",", "campaign_ids").alias("campaign_ids"))


def work_groups(spark: SparkSession, sf: str) -> DataFrame:
    return group_sizes(nation_work(spark, sf))


# --- pages ------------------------------------------------------------------------
def page_flatten(spark: SparkSession, sf: str) -> DataFrame:
    pages = fr.result_pages(spark, sf)
    rows = flatten_pages(pages, lot_outcomes(pages))
    return rows.select(
        "lot", "page", F.col("position").cast("bigint").alias("position"),
        F.try_variant_get("item", "$.id", "bigint").alias("id"),
        F.try_variant_get("item", "$.type", "string").alias("type"),
        F.try_variant_get("item", "$.props.k", "bigint").alias("k"),
    )


def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    return lot_outcomes(fr.result_pages(spark, sf))


# --- control tables -----------------------------------------------------------------
def outcome_intents(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("o_orderstatus") == "P"
    return table(spark, sf, "orders").select(
        text("o_orderkey").alias("campaign_id"), text("o_custkey").alias("account_id"),
        F.when(failed, fv.CAMPAIGN_FAILED).otherwise(fv.CAMPAIGN_EXTRACTED).alias("intent"),
    )


def control_upsert(spark: SparkSession, sf: str) -> DataFrame:
    source = with_stop_time(outcome_intents(spark, sf), fr.known_campaigns(spark, sf))
    rule = rules.extraction_outcome(dt.date(1999, 1, 1), dt.datetime(1999, 1, 1, 6))
    merged = merge(fr.control(spark, sf), source, rule)
    return merged.withColumn("ultima_extraccion", stamp("ultima_extraccion"))


ERROR_OUTPUT = ("proceso", "platform", "parent_id", "child_id", "entidad_id", "tipo_error", "mensaje_error", "intentos", "resuelto")
LEDGER_OUTPUT = ("gcs_path", "business_line", "entity_id", "fecha_archivo", "status", "error_mensaje")


def ledger_register(spark: SparkSession, sf: str) -> DataFrame:
    merged = merge(fr.ledger(spark, sf), fr.file_paths(spark, sf), rules.started_load(fr.LATE_TS))
    return merged.select(*LEDGER_OUTPUT, stamp("fecha_carga"), "action")


def ledger_finish(spark: SparkSession, sf: str) -> DataFrame:
    french = F.col("business_line") == "fr"
    ends = fr.file_paths(spark, sf).select(
        "gcs_path",
        F.when(french, fv.LEDGER_FAILED).otherwise(fv.LEDGER_DONE).alias("status"),
        F.when(french, F.concat(F.lit("bad file "), F.col("entity_id"))).alias("error"),
    )
    merged = merge(fr.ledger(spark, sf), ends, rules.finished_load())
    return merged.select(*LEDGER_OUTPUT, stamp("fecha_carga"), "action")


def load_gate(spark: SparkSession, sf: str) -> DataFrame:
    return not_yet_loaded(fr.file_paths(spark, sf), fr.ledger(spark, sf))


def account_status(spark: SparkSession, sf: str) -> DataFrame:
    """New statuses from suppliers that share a key with an account; the rest are unknown."""
    changes = table(spark, sf, "supplier").select(
        text("s_suppkey").alias("account_id"),
        F.when(F.col("s_acctbal") < 0, fv.ACCOUNT_FAILED).otherwise(fv.ACCOUNT_OK).alias("status"),
    )
    unknown = table(spark, sf, "supplier").select(
        F.col("s_name").alias("account_id"), F.lit(fv.ACCOUNT_OK).alias("status")
    )
    merged = merge(fr.accounts(spark, sf), changes.unionByName(unknown), rules.account_status(fr.ORDERS_TS))
    return merged.select("account_id", "activo", "extraction_status", stamp("ultima_extraccion"), "action")


# --- files, catalogue, dispatch -------------------------------------------------------
def files_of_day(spark: SparkSession, sf: str) -> DataFrame:
    day = dt.date(2024, 1, 9)
    listed = fr.file_paths(spark, sf).where(paths.part_day(paths.path_parts(F.col("gcs_path"))) == F.lit(day))
    path = F.replace(F.col("gcs_path"), F.lit("/"), F.lit("\\"))
    parts = paths.path_parts(path)
    return listed.select(
        paths.clean_path(path).alias("gcs_path"), paths.part_account(parts).alias("account_id"),
        paths.part(parts, 4).alias("kind"), paths.part(parts, 5).alias("source"),
        paths.part_day(parts).alias("fecha_archivo"),
    )


def active_platform_names(spark: SparkSession, sf: str) -> DataFrame:
    return active_platforms(fr.accounts(spark, sf))


def catalogue_scan(spark: SparkSession, sf: str) -> DataFrame:
    return active_accounts(fr.accounts(spark, sf))


def platform_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by language: two have a rule of their own, the others fail."""
    docs = table(spark, sf, "documents").select(text("doc_id").alias("doc_id"), F.upper("lang").alias("platform"), "text")
    by_language = {
        "en": lambda d: d.select("doc_id", "platform", F.length("text").cast("bigint").alias("size")),
        "Fr": lambda d: d.select("doc_id", "platform", F.size(F.split("text", " ")).cast("bigint").alias("size")),
    }
    def by_platform(name: str) -> DataFrame:
        mine, rule = docs.where(F.col("platform") == name), normaliser_for(name, by_language)
        return rule(mine) if rule else mine.select("doc_id", "platform", F.lit("no rule").alias("file_error"))

    names = sorted(r[0] for r in docs.select("platform").distinct().collect())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(by_platform, names))


# --- whole jobs -------------------------------------------------------------------------
def _land_metrics(lake: Lake, metrics: DataFrame, day: dt.date) -> None:
    land_items(fr.metric_items(metrics, day), lake.root)


def _one_account(spark: SparkSession, lake: Lake) -> None:
    """The catalogue entry that makes the platform's files eligible."""
    row = spark.range(1).select(F.lit("a").alias("account_id"), F.lit(fv.PLATFORM).alias("platform"))
    lake.accounts.append(row, fr.EARLY_TS)


def raw_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw insight text landed as files, one folder per event type and day, and read back."""
    lake = new_lake(spark)
    lines = fr.raw_insight_lines(spark, sf)
    kind = table(spark, sf, "events").select(text("event_id").alias("event_id"), "event_type")
    items = lines.select(F.parse_json("value").alias("item")).withColumn(
        "event_id", F.try_variant_get("item", "$.campaign_id", "string")
    )
    landed = items.join(kind, "event_id").select(
        F.lit(fv.PLATFORM).alias("source"), F.lit("insights").alias("tipo"), F.col("event_type").alias("id"),
        F.try_variant_get("item", "$.date_stop", "string").cast("date").alias("fecha"), "item",
    )
    land_items(landed, lake.root)
    back = read_items(spark, day_glob(lake.root, fv.PLATFORM, "insights", "*", LINES), INSIGHT_FIELDS, LINES)
    rows = good_rows(normalise_insights(back.withColumn("platform", F.lit(fv.PLATFORM))))
    return rows.select(*METRIC_COLUMNS, "fecha_archivo")


def insight_load(spark: SparkSession, sf: str) -> DataFrame:
    """The batch load of an early and a late pull of the daily metrics."""
    lake = new_lake(spark)
    _one_account(spark, lake)
    _land_metrics(lake, fr.early_metrics(spark, sf), fr.EARLY_PULL)
    load_insights(lake, fr.EARLY_PULL, fr.EARLY_TS, layout=LINES)
    _land_metrics(lake, fr.late_metrics(spark, sf), fr.LATE_PULL)
    load_insights(lake, fr.LATE_PULL, fr.LATE_TS, layout=LINES)
    load_insights(lake, fr.LATE_PULL, dt.datetime(2024, 1, 31, 12), layout=LINES)
    return lake.insights.read().select(*METRIC_COLUMNS, stamp("updated_at"))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same two pulls through the file stream; a third run finds nothing."""
    lake = new_lake(spark)
    checkpoint = scratch_path(spark, "stream-checkpoint")
    _land_metrics(lake, fr.early_metrics(spark, sf), fr.EARLY_PULL)
    stream_files(lake, checkpoint, fr.EARLY_TS, layout=LINES).awaitTermination()
    _land_metrics(lake, fr.late_metrics(spark, sf), fr.LATE_PULL)
    stream_files(lake, checkpoint, fr.LATE_TS, layout=LINES).awaitTermination()
    stream_files(lake, checkpoint, dt.datetime(2024, 1, 31, 12), layout=LINES).awaitTermination()
    return lake.insights.read().select(*METRIC_COLUMNS, stamp("updated_at"))


def campaign_load(spark: SparkSession, sf: str) -> DataFrame:
    """The batch load of raw campaigns, one account per order priority."""
    lake = new_lake(spark)
    _one_account(spark, lake)
    lines = fr.raw_campaign_lines(spark, sf)
    priority = table(spark, sf, "orders").select(text("o_orderkey").alias("id_text"), "o_orderpriority")
    items = lines.select(F.parse_json("value").alias("item")).withColumn(
        "id_text", F.try_variant_get("item", "$.id", "string")
    )
    land_items(
        items.join(priority, "id_text").select(
            F.lit(fv.PLATFORM).alias("source"), F.lit("campaigns").alias("tipo"),
            F.col("o_orderpriority").alias("id"), F.lit(fr.ORDERS_DAY).alias("fecha"), "item",
        ),
        lake.root,
    )
    load_campaigns(lake, fr.ORDERS_DAY, fr.ORDERS_TS, layout=LINES)
    return lake.campaigns.read().select(
        *CAMPAIGN_OUTPUT, *[stamp(c) for c in CAMPAIGN_TIMES], "platform"
    )


def array_load(spark: SparkSession, sf: str) -> DataFrame:
    """The batch load as insight_load, from one JSON array file per account and day."""
    lake = new_lake(spark)
    _one_account(spark, lake)
    land_arrays(fr.metric_items(fr.early_metrics(spark, sf), fr.EARLY_PULL), lake.root)
    load_insights(lake, fr.EARLY_PULL, fr.EARLY_TS)
    land_arrays(fr.metric_items(fr.late_metrics(spark, sf), fr.LATE_PULL), lake.root)
    load_insights(lake, fr.LATE_PULL, fr.LATE_TS)
    return lake.insights.read().select(*METRIC_COLUMNS, stamp("updated_at"))


def split_array_read(spark: SparkSession, sf: str) -> DataFrame:
    """The late pull landed as one account's array file, and that file read by byte ranges."""
    lake = new_lake(spark)
    items = fr.metric_items(fr.late_metrics(spark, sf), fr.LATE_PULL).withColumn("id", F.lit("all"))
    land_arrays(items, lake.root)
    files = [f"{lake.root}/raw/{fv.PLATFORM.lower()}/insights/all/{fr.LATE_PULL}/{fv.RAW_FILE_NAME}"]
    read = read_split_items(spark, files, INSIGHT_FIELDS, Staging(spark))
    rows = good_rows(normalise_insights(read.withColumn("platform", F.lit(fv.PLATFORM))))
    return rows.select(*METRIC_COLUMNS, "fecha_archivo")


def guarded_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A write with rows that lack a required column is refused whole; the table keeps the early rows."""
    lake = new_lake(spark)
    lake.insights.publish(cast_to(fr.early_silver(spark, sf), INSIGHTS))
    late = cast_to(fr.late_metrics(spark, sf).withColumn("updated_at", fr.instant_literal(fr.LATE_TS)), INSIGHTS)
    refused = []
    for column in INSIGHTS.required:
        torn = late.withColumn(column, F.when(F.col("impressions") > 1, F.col(column)))
        try:
            lake.insights.publish(torn)
        except PySparkException as error:
            if f"required column is NULL: {column}" not in str(error):
                raise
            refused.append(column)
    return lake.insights.read().select(*METRIC_COLUMNS, stamp("updated_at"), F.lit(",".join(refused)).alias("refused"))


def table_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written with the columns they name; the table's defaults fill in the others.

    Customers as accounts, and those in debt as entries of the error log.
    """
    lake = new_lake(spark)
    customers = table(spark, sf, "customer")
    lake.accounts.append(customers.select(text("c_custkey").alias("account_id"), F.col("c_mktsegment").alias("platform")), fr.EARLY_TS)
    debts = customers.where("c_acctbal < 0")
    lake.errors.append(debts.select(F.lit("balance").alias("proceso"), F.col("c_mktsegment").alias("platform"), text("c_custkey").alias("entidad_id")), fr.LATE_TS)
    none = F.lit(None)
    accounts = lake.accounts.read().select(
        F.lit("account").alias("kind"), F.col("account_id").alias("id"), "platform", "activo", stamp("created_at"),
        "extraction_status", none.cast("bigint").alias("intentos"), none.cast("boolean").alias("resuelto"), none.cast("boolean").alias("own_id"),
    )
    logged = lake.errors.read()
    ids = logged.groupBy("error_id").agg(F.count("*").alias("n"))
    errors = logged.join(ids, "error_id").select(
        F.lit("error"), "entidad_id", "platform", none.cast("boolean"), stamp("fecha_ejecucion"), none.cast("string"), "intentos", "resuelto",
        (F.col("n") == 1) & (F.length("error_id") == 36),
    )
    return accounts.union(errors)


def interrupted_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A writer that dies before its switch leaves the early rows; a later write of some days adds just those."""
    lake = new_lake(spark)
    late = cast_to(fr.late_metrics(spark, sf).withColumn("updated_at", fr.instant_literal(fr.LATE_TS)), INSIGHTS)
    lake.insights.publish(cast_to(fr.early_silver(spark, sf), INSIGHTS))
    lake.insights._stage(late)  # all that a writer has done when it dies here
    lake.insights.publish(late.where(F.col("date_information") >= F.lit(fr.EARLY_PULL)))
    return lake.insights.read().select(*METRIC_COLUMNS, stamp("updated_at"))


def gold_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Gold refreshed after each pull, from the days that silver has rewritten since."""
    lake = new_lake(spark)
    lake.insights.publish(cast_to(fr.early_silver(spark, sf), INSIGHTS))
    refresh_gold(lake, fr.EARLY_TS)
    commit(lake.insights, fr.late_metrics(spark, sf), rules.changed_insight(fr.LATE_TS))
    refresh_gold(lake, fr.LATE_TS)
    return lake.fact.read().select(*METRIC_COLUMNS, "row_hash", stamp("inserted_at"))


def _faulty_load(spark: SparkSession, sf: str) -> Lake:
    """The late pull loaded with faults: accounts of one kind hold no JSON, others a row without spend.

    Files of a platform that has no rule are there as well.
    """
    lake = new_lake(spark)
    _one_account(spark, lake)
    other = spark.range(1).select(F.lit("b").alias("account_id"), F.lit("Tiktok").alias("platform"))
    lake.accounts.append(other, fr.EARLY_TS)
    items = fr.metric_items(fr.late_metrics(spark, sf), fr.LATE_PULL)
    number = F.col("id").cast("int")
    spoilt = F.when(number % 5 == 1, F.parse_json(F.lit('"no object"'))).when(
        number % 5 == 2, F.parse_json(F.regexp_replace(F.to_json("item"), '"spend":"[^"]*"', '"spend":"much"'))
    )
    land_arrays(items.withColumn("item", F.coalesce(spoilt, "item")), lake.root)
    land_arrays(items.where(number % 5 == 3).withColumn("source", F.lit("Tiktok")), lake.root)
    load_insights(lake, fr.LATE_PULL, fr.LATE_TS)
    return lake


def failed_load(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after a load with faulty files."""
    return account_days(_faulty_load(spark, sf).ledger.read()).select(*LEDGER_OUTPUT)


def error_table(spark: SparkSession, sf: str) -> DataFrame:
    """The error table after a load with faulty files and the same load again."""
    lake = _faulty_load(spark, sf)
    load_insights(lake, fr.LATE_PULL, fr.LATE_TS)
    return lake.errors.read().select(*ERROR_OUTPUT)


def retried_load(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after the failed files have come right and a later run has retried them."""
    lake = _faulty_load(spark, sf)
    items = fr.metric_items(fr.late_metrics(spark, sf), fr.LATE_PULL)
    land_arrays(items.where(F.col("id").cast("int") % 5 == 1), lake.root)
    load_insights(lake, fr.LATE_PULL + dt.timedelta(days=1), fr.LATE_TS + dt.timedelta(days=1))
    return account_days(lake.ledger.read()).select(*LEDGER_OUTPUT)


def load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after the batch load of the late pull."""
    lake = new_lake(spark)
    _one_account(spark, lake)
    _land_metrics(lake, fr.late_metrics(spark, sf), fr.LATE_PULL)
    load_insights(lake, fr.LATE_PULL, fr.LATE_TS, layout=LINES)
    return account_days(lake.ledger.read()).select(*LEDGER_OUTPUT, stamp("fecha_carga"))


def extraction_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Plan the lots, collect their pages, record the outcome per campaign.

    Each campaign's page comes from its own order; a dear order poisons its lot.
    """
    lake = new_lake(spark)
    lake.subitems.publish(fr.subitems(spark, sf))
    lake.campaigns.publish(fr.nation_campaigns(spark, sf))
    lake.control.publish(fr.control(spark, sf))
    planned = plan_extraction(lake, fr.ORDERS_DAY)
    price = table(spark, sf, "orders").select(text("o_orderkey").alias("campaign_id"), "o_totalprice")
    body = F.when(F.col("o_totalprice") > 450000, F.lit('{"error":{}}')).otherwise(
        F.concat(F.lit('{"data":[{"campaign_id":"'), F.col("campaign_id"), F.lit('"}]}'))
    )
    pages = (
        planned.select("account_id", "mode", "lot", F.explode("campaign_ids").alias("campaign_id"))
        .join(price, "campaign_id")
        .select("account_id", "mode", "lot", F.col("campaign_id").cast("bigint").alias("page"), body.alias("body"))
    )
    collect_insights(lake, planned, pages, fr.ORDERS_DAY, fr.ORDERS_TS)
    return lake.control.read().withColumn("ultima_extraccion", stamp("ultima_extraccion"))


def account_run(spark: SparkSession, sf: str) -> DataFrame:
    """One account cycle: nations as accounts, their customers' orders as fetched pages.

    Urgent orders of two regions poison their nation.
    """
    lake = new_lake(spark)
    lake.accounts.append(fr.nation_accounts(spark, sf), fr.EARLY_TS)
    nations = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_nationkey", "n_regionkey")
    poisoned = (F.col("n_regionkey") < 2) & (F.col("o_orderpriority") == "1-URGENT")
    body = F.when(poisoned, F.lit('{"error":{"message":"limit"}}')).otherwise(
        F.concat(F.lit('{"data":[{"id":"'), text("o_orderkey"), F.lit('"}]}'))
    )
    pages = (
        table(spark, sf, "orders")
        .join(nations, F.col("o_custkey") == F.col("c_custkey"))
        .select(text("c_nationkey").alias("account_id"), F.col("o_orderkey").alias("page"), body.alias("body"))
    )
    account_cycle(lake, pages, dt.date(2001, 6, 1), dt.datetime(2001, 6, 1, 6))
    return lake.accounts.read().select(
        "account_id", "platform", "activo", "extraction_status", stamp("ultima_extraccion")
    )


QUERIES = {
    "insights_upsert": insights_upsert,
    "daily_rollup": daily_rollup,
    "row_hash": row_hash,
    "gold_upsert": gold_upsert,
    "gold_refresh": gold_refresh,
    "range_requests": range_requests,
    "campaigns_upsert": campaigns_upsert,
    "star_join": star_join,
    "dim_campaigns": dim_campaigns,
    "normalize_campaigns": normalize_campaigns,
    "normalize_insights": normalize_insights,
    "row_errors": row_errors,
    "error_log": error_log,
    "not_null_guard": not_null_guard,
    "first_action": first_action,
    "due_rule": due_rule,
    "extraction_worklist": extraction_worklist,
    "extraction_lots": extraction_lots,
    "work_groups": work_groups,
    "page_flatten": page_flatten,
    "run_counters": run_counters,
    "control_upsert": control_upsert,
    "ledger_register": ledger_register,
    "ledger_finish": ledger_finish,
    "load_gate": load_gate,
    "account_status": account_status,
    "files_of_day": files_of_day,
    "active_platforms": active_platform_names,
    "catalogue_scan": catalogue_scan,
    "platform_dispatch": platform_dispatch,
    "raw_roundtrip": raw_roundtrip,
    "insight_load": insight_load,
    "stream_upsert": stream_upsert,
    "campaign_load": campaign_load,
    "load_ledger": load_ledger,
    "array_load": array_load,
    "split_array_read": split_array_read,
    "guarded_publish": guarded_publish,
    "table_defaults": table_defaults,
    "interrupted_publish": interrupted_publish,
    "gold_increments": gold_increments,
    "failed_load": failed_load,
    "retried_load": retried_load,
    "error_table": error_table,
    "extraction_cycle": extraction_cycle,
    "account_run": account_run,
}
