"""Applying an upsert on disk: which partitions are rewritten, and what a death leaves."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratafold.operators import commit as commit_module
from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.schemas import ACCOUNTS, INSIGHTS

TS1, TS2 = dt.datetime(2026, 1, 10, 6), dt.datetime(2026, 1, 11, 6)
DAYS = [dt.date(2026, 1, d) for d in range(1, 6)]


def insights(spark, changes=(), days=DAYS, campaigns=20):
    """One row per campaign and day; ``changes`` holds (campaign, day) pairs with another hash."""
    data = [
        ("1", f"c{c}", d, 10, 1, 1.5, 0, 0.0, "Meta", "new" if (f"c{c}", d) in changes else "old")
        for c in range(campaigns) for d in days
    ]
    return spark.createDataFrame(data, INSIGHTS.schema.simpleString()[7:-1].replace(":", " ").replace(",updated_at timestamp", ""))


def files(lake, day):
    return lake.insights.manifest().folders[day.isoformat()]


@pytest.mark.parametrize("bound, limit", [("ROWS", 0), ("TEXT", 10), ("ROWS", 10_000)])
def test_only_changed_days_are_rewritten(spark, lake, monkeypatch, bound, limit):
    monkeypatch.setattr(commit_module, f"MAX_BROADCAST_{bound}", limit)
    assert commit_module.measure(insights(spark), "date_information").small == (limit > 10)
    first = commit(lake.insights, insights(spark), rules.changed_insight(TS1))
    assert first.actions == {"insert": 100} and first.days == tuple(DAYS)
    before = {d: files(lake, d) for d in DAYS}
    source = insights(spark, changes={("c1", DAYS[3]), ("c2", DAYS[3]), ("c1", DAYS[4])}, days=DAYS[2:])
    out = commit(lake.insights, source, rules.changed_insight(TS2))
    assert out.actions == {"update": 3, "noop": 57} and out.days == (DAYS[3], DAYS[4])
    assert [files(lake, d) == before[d] for d in DAYS] == [True, True, True, False, False]
    rows = lake.insights.read()
    assert rows.count() == 100 and rows.select("campaign_id", "date_information").distinct().count() == 100
    assert rows.where(F.col("updated_at") == F.lit(TS2)).count() == 3
    again = commit(lake.insights, source, rules.changed_insight(TS2))
    assert again.changed == 0 and again.days == ()


def test_any_number_of_days_is_exact(spark, lake):
    """407 scattered days of 460 are read and rewritten, and no others."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=n) for n in range(460)]
    table = lake.insights
    table.publish(insights(spark, days=days, campaigns=1).withColumn("updated_at", F.lit(TS1)).coalesce(1))
    asked = [d for n, d in enumerate(days) if n % 9 and n > 1]
    assert sorted(r[0] for r in table.read(asked).select("date_information").collect()) == asked
    out = commit(table, insights(spark, changes={("c0", d) for d in asked}, days=asked, campaigns=1), rules.changed_insight(TS2))
    assert out.days == tuple(asked) and out.actions == {"update": 407}
    assert table.read().count() == 460 and table.read().where("row_hash = 'new'").count() == 407


@pytest.mark.parametrize("compare", [True, False])
def test_a_row_without_a_day_is_an_error(spark, lake, compare):
    commit(lake.insights, insights(spark), rules.changed_insight(TS1))
    loose = insights(spark, campaigns=1).unionByName(insights(spark, campaigns=1).withColumn("date_information", F.lit(None).cast("date")))
    with pytest.raises(ValueError, match="5 source rows have no date_information"):
        commit(lake.insights, loose, rules.changed_insight(TS2), compare=compare)
    with pytest.raises(PySparkException, match="required column is NULL: date_information"):
        lake.insights.publish(loose.withColumn("updated_at", F.lit(TS1)))
    assert lake.insights.read().count() == 100


def test_empty_source(spark, lake):
    assert commit(lake.insights, insights(spark, campaigns=0), rules.changed_insight(TS1)).changed == 0


def test_required_columns_stop_the_write(spark, lake):
    commit(lake.insights, insights(spark), rules.changed_insight(TS1))
    bad = insights(spark, days=[dt.date(2026, 2, 1)]).withColumn("row_hash", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="required column is NULL: row_hash"):
        commit(lake.insights, bad, rules.changed_insight(TS2))
    assert lake.insights.read().count() == 100


class Death(Exception):
    pass


@pytest.mark.parametrize("name", ["insights", "control"])
def test_a_writer_that_dies_leaves_the_old_rows(spark, lake, monkeypatch, name):
    """Killed behind staging, before the switch: old rows whole, a repeat gives the new ones."""
    table = getattr(lake, name)
    if name == "insights":
        old = insights(spark).withColumn("updated_at", F.lit(TS1))
        new = insights(spark, changes={("c1", DAYS[1])}, days=DAYS[1:3]).withColumn("updated_at", F.lit(TS2))
    else:
        columns = "campaign_id string, account_id string, platform string, last_insight_date date, extraction_status string, ultima_extraccion timestamp"
        old = spark.createDataFrame([(f"c{i}", "1", "Meta", DAYS[0], "pendiente", TS1) for i in range(9)], columns)
        new = old.withColumn("extraction_status", F.lit("completo"))
    table.publish(old)
    before = sorted(table.read().collect(), key=repr)
    state = table.manifest()

    def die(*_):
        raise Death

    with monkeypatch.context() as patch:
        patch.setattr("stratafold.sources.tables.write_new_text", die)
        with pytest.raises(Death):
            table.publish(new)
    assert sorted(table.read().collect(), key=repr) == before and table.manifest() == state
    # what the dead writer staged is no part of a later write of other days, nor of the table
    if name == "insights":
        table.publish(insights(spark, changes={("c0", DAYS[4])}, days=DAYS[4:]).withColumn("updated_at", F.lit(TS2)))
        assert table.read().where("row_hash = 'new'").select("date_information").collect() == [(DAYS[4],)]
    table.publish(new)
    assert table.read().count() == len(before)
    assert table.read().where("row_hash = 'new'" if name == "insights" else "extraction_status = 'completo'").count() == (2 if name == "insights" else 9)


def test_readers_change_nothing_and_keep_their_state(spark, lake):
    table = lake.insights
    commit(table, insights(spark), rules.changed_insight(TS1))
    held = table.read()
    names = lambda: sorted(os.path.join(d, f) for d, _, fs in os.walk(table.path) for f in fs)
    before = names()
    assert held.count() == 100 and table.read(DAYS[:2]).count() == 40 and names() == before
    commit(table, insights(spark, changes={("c1", DAYS[0])}), rules.changed_insight(TS2))
    assert held.where("row_hash = 'new'").count() == 0 and held.count() == 100
    assert table.read().where("row_hash = 'new'").count() == 1
    table.vacuum(keep=1)
    assert table.read().count() == 100 and table.read().where("row_hash = 'new'").count() == 1


def test_of_two_writers_one_fails(spark, lake):
    table = lake.insights
    commit(table, insights(spark), rules.changed_insight(TS1))
    late = table.manifest()
    table.publish(insights(spark, days=DAYS[:1]).withColumn("updated_at", F.lit(TS2)))
    with pytest.raises(Exception, match="FileAlreadyExists"):
        table._switch(late, {}, None)
    assert table.read().count() == 100


def test_defaults(spark, lake):
    rows = spark.createDataFrame([("1", "Meta"), ("2", "Meta")], "account_id string, platform string")
    lake.accounts.append(rows, TS1)
    stored = lake.accounts.read().collect()
    assert all(r["activo"] is True and r["created_at"] == TS1 for r in stored)
    errors = spark.createDataFrame([("p", "meta")] * 3, "proceso string, platform string")
    lake.errors.append(errors, TS1)
    logged = lake.errors.read().collect()
    assert len({r["error_id"] for r in logged}) == 3 and all(len(r["error_id"]) == 36 for r in logged)
    assert all((r["intentos"], r["resuelto"], r["resuelto_at"]) == (1, False, None) for r in logged)


def test_account_status_changes_known_accounts_only(spark, lake):
    lake.accounts.append(spark.createDataFrame([("1", "Meta"), ("2", "Meta")], "account_id string, platform string"), TS1)
    changes = spark.createDataFrame([("2", "exitoso"), ("9", "exitoso")], "account_id string, status string")
    out = commit(lake.accounts, changes, rules.account_status(TS2))
    assert out.actions == {"keep": 1, "update": 1}
    stored = {r["account_id"]: r for r in lake.accounts.read().collect()}
    assert set(stored) == {"1", "2"} and set(ACCOUNTS.columns) == set(stored["1"].asDict())
    assert (stored["2"]["extraction_status"], stored["2"]["ultima_extraccion"]) == ("exitoso", TS2)


def test_create_replaces(spark, lake):
    commit(lake.insights, insights(spark), rules.changed_insight(TS1))
    assert lake.insights.create().read().count() == 100
    assert lake.insights.create(replace=True).read().count() == 0
