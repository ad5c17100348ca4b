"""Tables in hash buckets: an upsert reads and rewrites the buckets its keys fall into."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratafold.operators import commit as commit_module
from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.operators.merge import MergeRule
from stratafold.sources import tables
from stratafold.sources.tables import BUCKET, bucket_of

TS1, TS2 = dt.datetime(2026, 1, 10, 6), dt.datetime(2026, 1, 11, 6)
DAY = dt.date(2026, 1, 10)


def campaigns(spark, ids, updated=TS1, name="old"):
    rows = [("1", f"c{i}", name, updated) for i in ids]
    found = spark.createDataFrame(rows, "account_id string, campaign_id string, campaign_name string, updated_time timestamp")
    return found.selectExpr(
        "account_id", "campaign_id", "campaign_name", "'ACTIVE' AS status", "'SALES' AS objective", "false AS budget_rebalance_flag",
        "1.5D AS daily_budget", "CAST(NULL AS double) AS lifetime_budget", "updated_time AS start_time", "CAST(NULL AS timestamp) AS stop_time",
        "updated_time AS created_time", "updated_time", "'Meta' AS platform", "CAST(NULL AS timestamp) AS loaded_at",
    )


def buckets_read(table, df):
    return {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in df.inputFiles()}


@pytest.mark.parametrize("limit", [0, 200_000])
def test_one_changed_campaign_rewrites_one_bucket(spark, lake, monkeypatch, limit):
    monkeypatch.setattr(commit_module, "MAX_BROADCAST_ROWS", limit)
    table = lake.campaigns
    first = commit(table, campaigns(spark, range(200)), rules.newest_campaign(TS1))
    assert first.actions == {"insert": 200} and len(first.buckets) == tables.FIRST_BUCKETS
    before = table.manifest()
    source = campaigns(spark, [7], TS2, "new").unionByName(campaigns(spark, [8, 9]))
    asked = []
    read = type(table).read_buckets
    monkeypatch.setattr(type(table), "read_buckets", lambda self, b, m: asked.append(buckets_read(self, read(self, b, m))) or read(self, b, m))
    out = commit(table, source, rules.newest_campaign(TS2))
    place = {r[0]: r[1] for r in source.select("campaign_id", bucket_of(["campaign_id"], before.buckets)).collect()}
    # the comparing pass reads the buckets of the source's keys, the writing pass the changed one
    assert asked == [set(place.values()), {place["c7"]}]
    assert out.actions["update"] == 1 and out.actions["noop"] == 2 and out.buckets == (place["c7"],)
    after = table.manifest()
    assert {b for b in after.folders if after.folders[b] != before.folders[b]} == {str(place["c7"])}
    rows = table.read()
    assert rows.count() == 200 and rows.select("campaign_id").distinct().count() == 200
    assert [(r["campaign_id"], r["loaded_at"]) for r in rows.where("campaign_name = 'new'").collect()] == [("c7", TS2)]
    again = commit(table, campaigns(spark, range(200)), rules.newest_campaign(TS2))
    assert again.changed == 0 and table.manifest() == after


def test_control_rows_by_bucket(spark, lake):
    outcomes = lambda ids, intent: spark.createDataFrame([(f"c{i}", "1", intent, None) for i in ids], "campaign_id string, account_id string, intent string, stop_time timestamp")
    commit(lake.control, outcomes(range(100), "extraccion_hecha"), rules.extraction_outcome(DAY, TS1))
    out = commit(lake.control, outcomes([3, 500], "fallido"), rules.extraction_outcome(DAY, TS2))
    assert (out.actions["update"], out.actions["insert"]) == (1, 1) and len(out.buckets) <= 2
    stored = {r["campaign_id"]: r["extraction_status"] for r in lake.control.read().collect()}
    assert len(stored) == 101 and {k for k, v in stored.items() if v == "fallido"} == {"c3", "c500"}
    assert lake.control.manifest().rows == 101


def test_buckets_double_as_the_table_grows(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 20)
    table = lake.campaigns
    commit(table, campaigns(spark, range(100)), rules.newest_campaign(TS1))
    assert table.manifest().buckets == 16 and table.manifest().rows == 100
    commit(table, campaigns(spark, range(90, 1000)), rules.newest_campaign(TS1))
    grown = table.manifest()
    assert grown.buckets == 64 and grown.rows == 1000 and len(grown.folders) == 64
    assert sorted(int(r[0][1:]) for r in table.read().select("campaign_id").collect()) == list(range(1000))
    misplaced = table.spark.read.option("basePath", table._data).parquet(*[f"{table._data}/{f}" for listed in grown.folders.values() for f in listed])
    assert misplaced.where(F.col(BUCKET) != bucket_of(["campaign_id"], 64)).count() == 0
    out = commit(table, campaigns(spark, [5], TS2, "new"), rules.newest_campaign(TS2))
    assert len(out.buckets) == 1 and table.read().count() == 1000


def test_whole_table_published_and_emptied(spark, lake):
    table = lake.campaigns
    table.publish(campaigns(spark, range(50)))
    assert table.manifest().rows == 50 and table.read().count() == 50
    table.publish(campaigns(spark, range(3)))
    assert table.manifest().rows == 3 and table.read().count() == 3
    table.publish(campaigns(spark, []))
    assert table.manifest().rows == 0 and table.read().count() == 0
    assert commit(table, campaigns(spark, [1]), rules.newest_campaign(TS1)).actions == {"insert": 1}
    assert commit(table, campaigns(spark, []), rules.newest_campaign(TS1)).changed == 0


def test_rows_added_behind_the_merge(spark, lake):
    table = lake.campaigns
    commit(table, campaigns(spark, range(10)), rules.newest_campaign(TS1))
    table.append(campaigns(spark, range(10, 15)), TS1)
    assert table.manifest().rows == 15 and table.read().count() == 15
    assert commit(table, campaigns(spark, range(15), TS2, "new"), rules.newest_campaign(TS2)).actions == {"update": 15}
    table.vacuum(keep=1)
    assert table.read().where("campaign_name = 'new'").count() == 15


def test_of_two_writers_from_one_state_one_fails(spark, lake):
    table = lake.campaigns
    commit(table, campaigns(spark, range(10)), rules.newest_campaign(TS1))
    late = table.manifest()
    commit(table, campaigns(spark, [1], TS2, "new"), rules.newest_campaign(TS2))
    with pytest.raises(Exception, match="(?i)exist"):
        table.publish_buckets(campaigns(spark, [2]), late, 0)
    assert table.read().count() == 10


def test_a_key_without_the_bucket_column_is_an_error(spark, lake):
    with pytest.raises(ValueError, match="bucket columns"):
        commit(lake.campaigns, campaigns(spark, [1]), MergeRule(keys=("account_id",), update={}))
