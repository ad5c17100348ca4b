"""State machines: account due rule, campaign lifecycle, load ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratafold.operators import rules
from stratafold.operators.commit import commit
from stratafold.operators.due import in_range, range_mode, with_due
from stratafold.operators.merge import merge
from stratafold.plans.extraction import record_outcomes

TODAY, TS = dt.date(2026, 1, 10), dt.datetime(2026, 1, 10, 6)
YESTERDAY, TOMORROW = dt.datetime(2026, 1, 9, 23, 59, 59), dt.datetime(2026, 1, 11)
THIS_MORNING = dt.datetime(2026, 1, 10)


@pytest.mark.parametrize(
    "last, status, due, reason",
    [
        (None, None, True, "primera_extraccion"),
        (None, "exitoso", True, "primera_extraccion"),
        (THIS_MORNING, "exitoso", False, "ya_completo_hoy"),
        (THIS_MORNING, "en_proceso", True, "reintento"),
        (THIS_MORNING, "fallido", True, "reintento"),
        (YESTERDAY, "exitoso", True, "extraccion_nueva"),
        (YESTERDAY, None, True, "extraccion_nueva"),
        (THIS_MORNING, None, False, "sin_cambios"),
        (THIS_MORNING, "otro", False, "sin_cambios"),
        (TOMORROW, "exitoso", False, "sin_cambios"),
    ],
)
def test_due_rule(spark, last, status, due, reason):
    df = spark.createDataFrame([(last, status)], "ultima_extraccion timestamp, extraction_status string")
    row = with_due(df, TODAY).first()
    assert (row["extraer"], row["motivo"]) == (due, reason)


def test_range(spark):
    days = [(TODAY - dt.timedelta(days=n),) for n in (-1, 0, 1, 13, 14, 15, 400)]
    df = spark.createDataFrame(days, "d date")
    recent = df.where(in_range(F.col("d"), F.lit("last_14d"), TODAY)).count()
    everything = df.where(in_range(F.col("d"), F.lit("maximum"), TODAY)).count()
    assert (recent, everything) == (3, 5)
    modes = spark.createDataFrame([(None,), (TODAY,)], "d date").select(range_mode(F.col("d")).alias("m"))
    assert [r["m"] for r in modes.collect()] == ["maximum", "last_14d"]


def stopped(days_ago):
    return None if days_ago is None else TS - dt.timedelta(days=days_ago)


@pytest.mark.parametrize(
    "intent, days_ago, status",
    [
        ("extraccion_hecha", 6, "extraccion_hecha"), ("extraccion_hecha", 7, "completo"), ("extraccion_hecha", 8, "completo"),
        ("extraccion_hecha", None, "extraccion_hecha"), ("fallido", 30, "fallido"), ("exito", 7, "completo"),
    ],
)
def test_lifecycle(spark, intent, days_ago, status):
    df = spark.createDataFrame([(intent, stopped(days_ago))], "intent string, stop_time timestamp")
    assert df.select(rules.lifecycle_status(F.col("intent"), F.col("stop_time"), TODAY)).first()[0] == status


def outcomes(spark, *rows):
    return spark.createDataFrame(rows, "campaign_id string, account_id string, intent string")


@pytest.mark.parametrize("keeps", [False, True])
def test_record_outcomes(spark, lake, keeps):
    campaign = {"account_id": "1", "campaign_id": "old", "stop_time": stopped(30)}
    lake.campaigns.append(spark.createDataFrame([campaign], "account_id string, campaign_id string, stop_time timestamp"), TS)
    first = outcomes(spark, ("old", "1", "extraccion_hecha"), ("new", "1", "extraccion_hecha"), ("bad", "1", "fallido"))
    record_outcomes(lake, first, TODAY, TS, failed_keeps_date=keeps)
    state = {r["campaign_id"]: r for r in lake.control.read().collect()}
    assert {k: r["extraction_status"] for k, r in state.items()} == {
        "old": "completo", "new": "extraccion_hecha", "bad": "fallido",
    }
    assert all(r["platform"] == "Meta" and r["account_id"] == "1" for r in state.values())
    assert state["bad"]["last_insight_date"] == (None if keeps else TODAY)
    later = TODAY + dt.timedelta(days=1)
    record_outcomes(lake, outcomes(spark, ("new", "2", "fallido")), later, TS, failed_keeps_date=keeps)
    state = {r["campaign_id"]: r for r in lake.control.read().collect()}
    assert len(state) == 3 and state["new"]["extraction_status"] == "fallido" and state["new"]["account_id"] == "1"
    assert state["new"]["last_insight_date"] == (TODAY if keeps else later)


def test_no_outcomes_is_no_work(spark, lake):
    empty = spark.createDataFrame([], "campaign_id string, account_id string, intent string")
    assert record_outcomes(lake, empty, TODAY, TS).changed == 0
    assert lake.control.read().count() == 0


def test_ledger(spark, lake):
    files = spark.createDataFrame(
        [(f"p{n}", "campaigns", "1", TODAY) for n in range(3)],
        "gcs_path string, business_line string, entity_id string, fecha_archivo date",
    )
    commit(lake.ledger, files, rules.started_load(TS))
    ends = spark.createDataFrame(
        [("p0", TODAY, "completado", None), ("p1", TODAY, "fallido", "boom"), ("p9", TODAY, "completado", None)],
        "gcs_path string, fecha_archivo date, status string, error string",
    )
    commit(lake.ledger, ends, rules.finished_load())
    state = {r["gcs_path"]: r for r in lake.ledger.read().collect()}
    assert {p: (r["status"], r["error_mensaje"]) for p, r in state.items()} == {
        "p0": ("completado", None), "p1": ("fallido", "boom"), "p2": ("en_proceso", None),
    }
    ids = {p: r["load_id"] for p, r in state.items()}
    # only files in progress can be finished
    out = commit(lake.ledger, ends, rules.finished_load())
    assert out.changed == 0
    # registering again restarts a file and clears its error
    commit(lake.ledger, files.where("gcs_path = 'p1'"), rules.started_load(TS))
    p1 = {r["gcs_path"]: r for r in lake.ledger.read().collect()}["p1"]
    assert (p1["status"], p1["error_mensaje"], p1["load_id"]) == ("en_proceso", None, ids["p1"])


def campaign(spark, updated, name, **more):
    row = {"account_id": "1", "campaign_id": "c", "campaign_name": name, "updated_time": updated, **more}
    schema = "account_id string, campaign_id string, campaign_name string, updated_time timestamp, objective string"
    return spark.createDataFrame([{"objective": None, **row}], schema)


def full(df):
    from stratafold.schemas import CAMPAIGNS
    from stratafold.sources.tables import with_defaults

    return with_defaults(df, CAMPAIGNS, TS)


@pytest.mark.parametrize(
    "old, new, action",
    [
        (None, None, "noop"), (None, TS, "update"), (TS, None, "noop"), (TS, TS, "noop"),
        (TS, TS + dt.timedelta(seconds=1), "update"), (TS, TS - dt.timedelta(seconds=1), "noop"),
        (None, dt.datetime(1970, 1, 1), "noop"),
    ],
)
def test_newest_campaign_wins(spark, old, new, action):
    merged = merge(
        full(campaign(spark, old, "old", objective="A")), full(campaign(spark, new, "new", objective="B")), rules.newest_campaign(TS)
    ).first()
    assert merged["action"] == action
    assert merged["campaign_name"] == ("new" if action == "update" else "old")
    assert merged["objective"] == "A" and merged["updated_time"] == old


def test_advance_version(spark):
    newer = TS + dt.timedelta(days=1)
    target, source = full(campaign(spark, TS, "old")), full(campaign(spark, newer, "new"))
    for advance, second in ((False, "update"), (True, "noop")):
        rule = rules.newest_campaign(TS, advance_version=advance)
        once = merge(target, source, rule).drop("action")
        assert merge(once, source, rule).first()["action"] == second
