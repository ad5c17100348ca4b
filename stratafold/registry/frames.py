"""The given tables in the roles of the library's own: events as daily metrics,
orders as campaigns, customers as accounts, documents as file paths.

Every frame covers its whole table. Where a role needs missing, null or bad
values, they follow from natural columns (priority, status, event type).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions import paths
from stratafold.functions.hashing import row_hash
from stratafold.functions.times import instant_literal
from stratafold.operators.normalise import HASHED
from stratafold.operators.worklist import daily_metrics

# An early pull of the daily metrics, and the final one.
EARLY_PULL, LATE_PULL = dt.date(2024, 1, 20), dt.date(2024, 1, 31)
EARLY_TS, LATE_TS = dt.datetime(2024, 1, 20, 6), dt.datetime(2024, 1, 31, 6)
# Purchases are attributed a week late: the early pull lacks those of its last week.
ATTRIBUTED_BEFORE = dt.date(2024, 1, 13)
ORDERS_DAY, ORDERS_TS = dt.date(2001, 1, 1), dt.datetime(2001, 1, 1, 6)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def instant(name: str) -> Column:
    """A zone-less timestamp of the given tables as a UTC instant."""
    return F.concat(F.col(name).cast("string"), F.lit("Z")).cast("timestamp")


def stamp(column: str) -> Column:
    """An instant as text, for results that other engines are to compare."""
    since = F.make_dt_interval(secs=F.unix_seconds(F.col(column)))
    return (F.lit("1970-01-01").cast("timestamp_ntz") + since).cast("string").alias(column)


# --- daily metrics ----------------------------------------------------------
def actions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.floor(F.col("user_id") / 10).cast("string").alias("account_id"),
        text("user_id").alias("campaign_id"),
        "ts",
        F.col("event_type").alias("action_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.lit(fv.PLATFORM).alias("platform"),
    )


def seen_early(events: DataFrame) -> DataFrame:
    ts = F.col("ts")
    unattributed = (F.col("action_type") == fv.PURCHASE) & (ts >= F.lit(ATTRIBUTED_BEFORE).cast("timestamp_ntz"))
    return events.where((ts < F.lit(EARLY_PULL).cast("timestamp_ntz")) & ~unattributed)


def hashed(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("row_hash", row_hash(metrics, HASHED))


def late_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return hashed(daily_metrics(actions(spark, sf)))


def early_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return hashed(daily_metrics(seen_early(actions(spark, sf))))


def early_silver(spark: SparkSession, sf: str) -> DataFrame:
    return early_metrics(spark, sf).withColumn("updated_at", instant_literal(EARLY_TS))


def metric_items(metrics: DataFrame, day: dt.date) -> DataFrame:
    """Daily metrics as raw items to be landed, one folder per account."""
    def listed(value: str) -> Column:
        return F.array(F.struct(F.lit(fv.PURCHASE).alias("action_type"), text(value).alias("value")))

    item = F.struct(
        "campaign_id",
        text("date_information").alias("date_stop"),
        text("impressions").alias("impressions"),
        F.col("clicks"),
        text("spend").alias("spend"),
        F.when(F.col("purchases") > 0, listed("purchases")).alias("actions"),
        F.when(F.col("purchases") > 0, listed("value_purchases")).alias("action_values"),
    )
    return metrics.select(
        F.col("platform").alias("source"), F.lit("insights").alias("tipo"), F.col("account_id").alias("id"),
        F.lit(day).alias("fecha"), F.parse_json(F.to_json(item)).alias("item"),
    )


# --- raw insight text with every kind of field state ---------------------------
def raw_insight_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON object per event; ``k`` of its props decides the field states."""
    k = F.get_json_object("props", "$.k").cast("int")
    impressions = (
        F.when(k < 20, F.concat(F.lit('"impressions":" '), k, F.lit(' ",')))
        .when(k < 40, F.concat(F.lit('"impressions":'), k, F.lit(".7,")))
        .when(k < 50, F.lit(""))
        .when(k < 55, F.lit('"impressions":null,'))
        .when(k < 60, F.concat(F.lit('"impressions":"'), k, F.lit('.5",')))
        .when(k < 65, F.lit('"impressions":"1_000",'))
        .otherwise(F.concat(F.lit('"impressions":'), k, F.lit(",")))
    )
    spend = (
        F.when(k < 90, F.concat(F.lit('"spend":"'), text("value"), F.lit('",')))
        .when(k < 95, F.lit(""))
        .otherwise(F.lit('"spend":"12d",'))
    )
    kind = F.col("event_type")
    listed = (
        F.when(
            kind == "purchase",
            F.concat(
                F.lit('"actions":[{"action_type":"view","value":"x"},{"action_type":"purchase","value":"'), k,
                F.lit('"},{"action_type":"purchase","value":"9"}],"action_values":[{"action_type":"purchase","value":'),
                k, F.lit(".25}],"),
            ),
        )
        .when(kind == "click", F.lit('"actions":[],'))
        .when(kind == "view", F.lit(""))
        .when(kind == "error", F.when(k >= 50, F.lit('"actions":null,')).otherwise(F.lit('"actions":[7],')))
        .otherwise(F.lit('"actions":[{"action_type":"purchase"},7],"action_values":"",'))
    )
    line = F.concat(
        F.lit("{"), impressions, spend, listed, F.lit('"clicks":true,"campaign_id":'), text("event_id"),
        F.lit(',"date_stop":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"}'),
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("raw/meta/insights/"), text("user_id"), F.lit("/2024-01-31/data.json")).alias("gcs_path"),
        text("user_id").alias("account_id"),
        F.lit(LATE_PULL).alias("fecha_archivo"),
        F.lit(fv.PLATFORM).alias("platform"),
        line.alias("value"),
    )


# --- campaigns ---------------------------------------------------------------
def raw_campaign_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON object per order; priority and status decide the field states."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    daily = (
        F.when(priority == "1-URGENT", F.concat(F.lit('"daily_budget":"'), cents, F.lit('",')))
        .when(priority == "2-HIGH", F.concat(F.lit('"daily_budget":'), cents, F.lit(",")))
        .when(priority == "3-MEDIUM", F.when(status == "P", F.lit('"daily_budget":"",')).otherwise(F.lit('"daily_budget":0,')))
        .when(priority == "4-NOT SPECIFIED", F.when(status == "P", F.lit("")).otherwise(F.lit('"daily_budget":null,')))
        .otherwise(F.when(status == "P", F.lit('"daily_budget":"abc",')).otherwise(F.lit('"daily_budget":"0",')))
    )
    flag = (
        F.when(status == "F", F.lit('"budget_rebalance_flag":true,'))
        .when(status == "O", F.lit('"budget_rebalance_flag":null,'))
        .otherwise(F.lit(""))
    )
    start = (
        F.when(priority == "1-URGENT", F.concat(F.lit('"start_time":"'), day, F.lit('T20:30:00-0600",')))
        .when(priority == "2-HIGH", F.concat(F.lit('"start_time":"'), day, F.lit('T01:00:00+05:30",')))
        .when(priority == "3-MEDIUM", F.concat(F.lit('"start_time":"'), day, F.lit('T12:00:00",')))
        .when(priority == "4-NOT SPECIFIED", F.lit('"start_time":"",'))
        .otherwise(F.when(status == "O", F.lit('"start_time":"soon",')).otherwise(F.lit("")))
    )
    line = F.concat(
        F.lit("{"), daily, flag, start, F.lit('"name":"Ö '), priority, F.lit('","objective":null,"status":"'), status,
        F.lit('","id":'), text("o_orderkey"), F.lit(',"updated_time":"'), day, F.lit('T00:00:00+0000"}'),
    )
    return table(spark, sf, "orders").select(
        F.concat(F.lit("raw/meta/campaigns/"), text("o_custkey"), F.lit("/2001-01-01/data.json")).alias("gcs_path"),
        text("o_custkey").alias("account_id"),
        F.lit(ORDERS_DAY).alias("fecha_archivo"),
        F.lit(fv.PLATFORM).alias("platform"),
        line.alias("value"),
    )


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as the silver campaign table."""
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        text("o_custkey").alias("account_id"),
        text("o_orderkey").alias("campaign_id"),
        F.concat(F.lit("Order "), text("o_orderkey")).alias("campaign_name"),
        F.col("o_orderstatus").alias("status"),
        priority.alias("objective"),
        (F.col("o_totalprice") > 200000).alias("budget_rebalance_flag"),
        F.col("o_totalprice").alias("daily_budget"),
        F.when(priority != "1-URGENT", F.col("o_totalprice")).alias("lifetime_budget"),
        instant("o_orderdate").alias("start_time"),
        F.when(priority != "5-LOW", instant("o_orderdate")).alias("stop_time"),
        instant("o_orderdate").alias("created_time"),
        F.when(priority != "5-LOW", instant("o_orderdate")).alias("updated_time"),
        F.when(priority == "4-NOT SPECIFIED", F.lit("TikTok")).otherwise(F.lit(fv.PLATFORM)).alias("platform"),
        instant_literal(dt.datetime(2000, 1, 1)).alias("loaded_at"),
    )


def known_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """The campaign table as of the start of 2000."""
    return campaigns(spark, sf).where(F.col("start_time") < instant_literal(dt.datetime(2000, 1, 1)))


def pulled_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """A later pull: campaigns since 1997, finished ones changed a day later, partial ones undated."""
    moved = (
        F.when(F.col("status") == "F", F.col("created_time") + F.expr("INTERVAL 24 HOURS"))
        .when(F.col("status") == "P", F.lit(None).cast("timestamp"))
        .otherwise(F.col("created_time"))
    )
    return (
        campaigns(spark, sf)
        .where(F.col("start_time") >= instant_literal(dt.datetime(1997, 1, 1)))
        .withColumn("updated_time", moved)
        .withColumn("campaign_name", F.concat(F.col("campaign_name"), F.lit(" (new)")))
        .withColumn("daily_budget", F.col("daily_budget") * 2)
        .withColumn("objective", F.lit("CHANGED"))
        .drop("loaded_at")
    )


def subitems(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(text("l_orderkey").alias("campaign_id"))


def control(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction control of the orders that are not open."""
    priority = F.col("o_orderpriority")
    status = (
        F.when(priority == "1-URGENT", fv.CAMPAIGN_COMPLETE)
        .when(priority == "2-HIGH", fv.CAMPAIGN_FAILED)
        .when(priority == "3-MEDIUM", fv.CAMPAIGN_EXTRACTED)
        .when(priority == "5-LOW", fv.CAMPAIGN_PENDING)
    )
    return table(spark, sf, "orders").where("o_orderstatus <> 'O'").select(
        text("o_orderkey").alias("campaign_id"),
        text("o_custkey").alias("account_id"),
        F.lit(fv.PLATFORM).alias("platform"),
        F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("last_insight_date"),
        status.alias("extraction_status"),
        instant("o_orderdate").alias("ultima_extraccion"),
    )


def nation_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as accounts; region and name decide when they were last extracted."""
    last = (
        F.when(F.col("n_regionkey") == 4, F.lit(dt.datetime(2001, 6, 1, 3)))
        .when(F.col("n_regionkey") == 3, F.lit(dt.datetime(2001, 5, 31, 3)))
        .when(F.col("n_regionkey") == 1, F.lit(dt.datetime(2001, 6, 1, 4)))
    )
    status = F.when(F.col("n_regionkey") == 4, fv.ACCOUNT_OK).when(F.col("n_regionkey") > 0, fv.ACCOUNT_FAILED)
    return table(spark, sf, "nation").select(
        text("n_nationkey").alias("account_id"), F.col("n_name").alias("account_name"),
        F.lit(fv.PLATFORM).alias("platform"), (F.col("n_regionkey") >= 0).alias("activo"),
        status.alias("extraction_status"), last.cast("timestamp").alias("ultima_extraccion"),
    )


def nation_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Campaigns with the customer's nation as their account: few, large groups."""
    nations = table(spark, sf, "customer").select(
        text("c_custkey").alias("account_id"), text("c_nationkey").alias("nation")
    )
    joined = campaigns(spark, sf).join(nations, "account_id")
    return joined.drop("account_id").withColumnRenamed("nation", "account_id")


# --- pages -------------------------------------------------------------------
def result_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One result page per event and one lot per user.

    Dear errors (a value above 150) poison their lot; a click names a next page, so a
    lot that ends with one is incomplete.
    """
    body = (
        F.when(
            (F.col("event_type") == "error") & (F.col("value") > 150),
            F.concat(F.lit('{"error":{"message":"code '), text("event_id"), F.lit('"}}')),
        )
        .when(F.col("event_type") == "view", F.lit('{"paging":{}}'))
        .otherwise(
            F.concat(
                F.lit('{"data":[{"id":'), text("event_id"), F.lit(',"type":"'), F.col("event_type"),
                F.lit('"},{"id":'), text("event_id"), F.lit(',"props":'), F.col("props"), F.lit("}]"),
                F.when(F.col("event_type") == "click", F.lit(',"paging":{"next":"more"}}')).otherwise(F.lit("}")),
            )
        )
    )
    return table(spark, sf, "events").select(
        text("user_id").alias("lot"), F.col("event_id").alias("page"), body.alias("body")
    )


# --- files and ledger ----------------------------------------------------------
def file_paths(spark: SparkSession, sf: str) -> DataFrame:
    """One raw file path per document; its length picks a day of January 2024."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("n_chars") % 31).cast("int"))
    return table(spark, sf, "documents").select(
        paths.raw_path(F.upper("source"), F.col("lang"), text("doc_id"), day).alias("gcs_path"),
        F.col("lang").alias("business_line"), text("doc_id").alias("entity_id"), day.alias("fecha_archivo"),
    )


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Entries for the documents that carry labels; the labels give the status."""
    labels = table(spark, sf, "labels").select(text("doc_id").alias("entity_id"), "quality", "toxic")
    status = (
        F.when(F.col("toxic") == 1, fv.LEDGER_FAILED)
        .when(F.col("quality") == 1, fv.LEDGER_DONE)
        .otherwise(fv.LEDGER_RUNNING)
    )
    return file_paths(spark, sf).join(labels, "entity_id").select(
        F.concat(F.lit("load-"), F.col("entity_id")).alias("load_id"),
        "gcs_path", "business_line", "entity_id", "fecha_archivo",
        status.alias("status"),
        instant_literal(EARLY_TS).alias("fecha_carga"),
        F.when(F.col("toxic") == 1, F.lit("old error")).alias("error_mensaje"),
    )


# --- accounts ----------------------------------------------------------------
def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as accounts; their last order is their last extraction."""
    last = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("last")
    )
    status = F.col("last.o_orderstatus")
    return (
        table(spark, sf, "customer")
        .join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            text("c_custkey").alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit("meta"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit(fv.PLATFORM))
            .otherwise(F.col("c_mktsegment")).alias("platform"),
            (F.col("c_acctbal") > 0).alias("activo"),
            F.when(status == "F", fv.ACCOUNT_OK).when(status == "O", fv.ACCOUNT_RUNNING)
            .when(status == "P", fv.ACCOUNT_FAILED).alias("extraction_status"),
            instant("last.o_orderdate").alias("ultima_extraccion"),
        )
    )
