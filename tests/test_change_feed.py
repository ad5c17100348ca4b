"""Gold takes in the rows that silver has changed, and reads no others."""

import datetime as dt

from pyspark.sql import functions as F

from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.plans.gold import fact_rows, refresh_gold
from stratafold.schemas import INSIGHTS
from stratafold.sources.tables import CHANGED, LakeTable

TS = [dt.datetime(2026, 1, d, 6) for d in range(10, 16)]
DAYS = [dt.date(2026, 1, d) for d in range(1, 4)]
COLUMNS = INSIGHTS.schema.simpleString()[7:-1].replace(":", " ").replace(",updated_at timestamp", "")


def insights(spark, changes=(), mark="new", days=DAYS, campaigns=50):
    rows = [
        ("1", f"c{c}", d, 10, 1, 1.5, 0, 0.0, "Meta", mark if (f"c{c}", d) in changes else "old") for c in range(campaigns) for d in days
    ]
    return spark.createDataFrame(rows, COLUMNS)


def keyed(df):
    return sorted((r["campaign_id"], r["date_information"], r["row_hash"]) for r in df.collect())


def test_rows_between_two_states(spark, lake):
    table = lake.insights
    commit(table, insights(spark), rules.changed_insight(TS[0]))
    assert len(keyed(table.changes_since(0, 1))) == 150
    commit(table, insights(spark, {("c1", DAYS[0]), ("c2", DAYS[1])}), rules.changed_insight(TS[1]))
    commit(table, insights(spark, {("c1", DAYS[0])}, "newer", days=DAYS[:1]), rules.changed_insight(TS[2]))
    assert keyed(table.changes_since(1, 2)) == [("c1", DAYS[0], "new"), ("c2", DAYS[1], "new")]
    assert keyed(table.changes_since(1, 3)) == [("c1", DAYS[0], "newer"), ("c2", DAYS[1], "new")]
    assert keyed(table.changes_since(3, 3)) == [] and table.read().count() == 150
    plan = table.changes_since(2, 3)._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert f"({CHANGED}#" in pruned and "= true" in pruned
    # rows of a whole write have all changed
    table.publish(insights(spark, days=DAYS[2:]).withColumn("updated_at", F.lit(TS[3])))
    assert len(keyed(table.changes_since(3, 4))) == 50
    table.vacuum(keep=1)
    assert table.changes_since(1, 4) is None and table.read().count() == 150


def test_gold_reads_changed_rows(spark, lake, monkeypatch):
    commit(lake.insights, insights(spark), rules.changed_insight(TS[0]))
    refresh_gold(lake, TS[0])
    commit(lake.insights, insights(spark, {("c1", DAYS[0])}), rules.changed_insight(TS[1]))
    commit(lake.insights, insights(spark, {("c1", DAYS[0]), ("c3", DAYS[0])}, days=DAYS[:1], campaigns=4), rules.changed_insight(TS[2]))
    read = LakeTable.read
    seen = []
    monkeypatch.setattr(LakeTable, "read", lambda self, *a, **o: seen.append(self.spec.name) or read(self, *a, **o))
    out = refresh_gold(lake, TS[2])
    assert INSIGHTS.name not in seen
    assert out.actions["update"] == 2 and out.days == (DAYS[0],)
    silver = {k[:2]: k[2] for k in keyed(fact_rows(read(lake.insights)))}
    assert {k[:2]: k[2] for k in keyed(read(lake.fact))} == silver
    assert refresh_gold(lake, TS[3]).changed == 0


def test_gold_takes_whole_days_when_a_state_is_gone(spark, lake):
    commit(lake.insights, insights(spark), rules.changed_insight(TS[0]))
    refresh_gold(lake, TS[0])
    for n in (1, 2, 3):
        commit(lake.insights, insights(spark, {(f"c{n}", DAYS[n - 1])}), rules.changed_insight(TS[n]))
    lake.insights.vacuum(keep=2)
    refresh_gold(lake, TS[4])
    assert keyed(lake.fact.read()) == keyed(lake.insights.read())
