"""What the plans look like: pruning, pushdown, join kinds, no Python in the path."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.operators.merge import merge
from stratafold.operators.worklist import lots, work_list
from stratafold.registry import frames, spark_queries
from stratafold.schemas import FACT, INSIGHTS
from stratafold.sources.listing import LINES
from stratafold.sources.raw_files import open_items
from stratafold.operators.normalise import normalise_insights
from stratafold.schemas import INSIGHT_FIELDS

SF = "/root/testdata/sf0.001"
TS = dt.datetime(2024, 1, 31, 6)
OPERATORS = [
    "insights_upsert", "campaigns_upsert", "gold_upsert", "control_upsert", "ledger_register", "ledger_finish", "load_gate",
    "account_status", "extraction_worklist", "extraction_lots", "page_flatten", "run_counters", "normalize_insights",
    "normalize_campaigns", "range_requests", "star_join", "daily_rollup", "row_hash", "due_rule", "first_action",
]


def plan_of(df, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as for tables too large to broadcast on their own."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_python_no_product(spark, no_broadcast, name):
    plan = plan_of(spark_queries.QUERIES[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoop", "CollectLimit", "BroadcastHashJoin"):
        assert bad not in plan, bad


def test_target_days_are_pruned(spark, lake):
    metrics = frames.late_metrics(spark, SF)
    commit(lake.insights, metrics, rules.changed_insight(TS))
    # the manifest names the folders of a day, so no other day is even listed
    def days_read(days):
        return {f.split("date_information=")[1][:10] for f in lake.insights.read(days).inputFiles()}

    assert days_read([dt.date(2024, 1, 3), dt.date(2024, 1, 4)]) == {"2024-01-03", "2024-01-04"}
    many = [dt.date(2024, 1, 3) + dt.timedelta(days=n) for n in range(1000)]
    known = {str(r[0]) for r in metrics.select("date_information").distinct().collect()}
    assert days_read(many) == {d for d in known if d >= "2024-01-03"}
    assert lake.insights.read([]).count() == 0


def test_compare_pass_reads_keys_and_hash_only(spark, lake, no_broadcast):
    """The pass that finds changed days leaves the metrics unread, on both sides."""
    metrics = frames.late_metrics(spark, SF)
    commit(lake.insights, metrics, rules.changed_insight(TS))
    path = lake.root + "/pulled"
    metrics.write.parquet(path)
    days = [dt.date(2024, 1, 3)]
    merged = merge(lake.insights.read(days), spark.read.parquet(path), rules.changed_fact(TS))
    plan = plan_of(merged.groupBy("date_information", "action").count())
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert len(schemas) == 2
    for schema in schemas:
        assert "row_hash" in schema and "campaign_id" in schema
        for metric in ("impressions", "spend", "value_purchases", "platform", "account_id"):
            assert metric not in schema


def test_small_source_does_not_shuffle_the_target(spark, lake, no_broadcast):
    metrics = frames.late_metrics(spark, SF)
    commit(lake.insights, metrics, rules.changed_insight(TS))
    path = lake.root + "/pulled"
    metrics.write.parquet(path)
    merged = merge(
        lake.insights.read(), spark.read.parquet(path), rules.changed_fact(TS), broadcast_source=True
    )
    plan = plan_of(merged, "simple")
    left = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "LeftOuter" in left and "Exchange hashpartitioning" not in left


def test_merge_shuffles_each_side_once(spark, lake, no_broadcast):
    """Deduplicating the source and joining share one exchange on the key."""
    path = lake.root + "/pulled"
    frames.late_metrics(spark, SF).write.parquet(path)
    merged = merge(lake.insights.read(), spark.read.parquet(path), rules.changed_insight(TS))
    plan = plan_of(merged, "simple")
    assert plan.count("Exchange hashpartitioning") == 2


def test_work_list_shares_its_partitioning(spark, no_broadcast):
    """Three joins and a distinct on the campaign, one exchange per input."""
    work = work_list(frames.subitems(spark, SF), frames.campaigns(spark, SF), frames.control(spark, SF), dt.date(2001, 1, 1))
    plan = plan_of(work, "simple")
    assert plan.count("Exchange hashpartitioning") == 3


def test_numbering_never_holds_a_whole_group(spark, no_broadcast):
    plan = plan_of(lots(spark_queries.nation_work(spark, SF)), "simple")
    windows = [line for line in plan.splitlines() if "row_number" in line and "Window [" in line]
    assert windows and all("part#" in line.split("row_number")[1] for line in windows)


def test_normalising_is_one_stage(spark):
    df = normalise_insights(open_items(frames.raw_insight_lines(spark, SF), INSIGHT_FIELDS, LINES))
    assert "Exchange" not in plan_of(df.where("row_error IS NULL"), "simple")


def test_column_pruning_and_pushdown(spark):
    plan = plan_of(frames.known_campaigns(spark, SF).select("campaign_id", "updated_time"))
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "o_totalprice" not in schema and "o_custkey" not in schema
    plan = plan_of(spark_queries.load_gate(spark, SF))
    assert "text" not in [line for line in plan.splitlines() if line.startswith("ReadSchema")][0]


def test_schemas_match_their_writers(spark, lake):
    for table in (lake.insights, lake.fact, lake.ledger, lake.campaigns):
        assert table.read().schema.names == table.spec.columns
    assert {f.name for f in FACT.schema if f.metadata.get("comment")} == set(FACT.columns)
    assert set(INSIGHTS.required) <= set(INSIGHTS.columns)
    assert lake.fact.read().where(F.lit(True)).count() == 0
