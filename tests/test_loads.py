"""The whole loads over raw array files: isolation of faults, gate, retry, order."""

import datetime as dt

import pytest

from stratafold.operators.worklist import work_list
from stratafold.plans import silver_load
from stratafold.plans.accounts import account_cycle
from stratafold.plans.extraction import collect_insights, plan_extraction
from stratafold.plans.gold import fact_with_dimension, refresh_dimension, refresh_gold
from stratafold.plans.silver_load import load_campaigns, load_insights
from stratafold.sources.listing import LINES

DAY, TS = dt.date(2026, 1, 10), dt.datetime(2026, 1, 10, 6)
NEXT, NEXT_TS = dt.date(2026, 1, 11), dt.datetime(2026, 1, 11, 6)


@pytest.fixture
def accounts(spark, lake):
    def add(*platforms):
        rows = [(f"a{n}", f"Account {n}", p, True) for n, p in enumerate(platforms)]
        rows.append(("off", "Off", "Unused", False))
        lake.accounts.append(
            spark.createDataFrame(rows, "account_id string, account_name string, platform string, activo boolean"), TS
        )

    add("Meta")
    return add


def insight(campaign="c1", day="2026-01-05", **fields):
    return {"campaign_id": campaign, "date_stop": day, "impressions": "10", "clicks": "1", "spend": "1.5", **fields}


def ledger_of(lake):
    return {r["gcs_path"]: r for r in lake.ledger.read().collect()}


@pytest.mark.parametrize("listed", [10_000, 1])
def test_faults_stay_where_they_are(lake, accounts, put_raw, rows_of, monkeypatch, listed):
    """``listed=1``: files are named to the reader in several slices."""
    monkeypatch.setattr(silver_load, "FILES_AT_ONCE", listed)
    good = put_raw("insights", "1", DAY, [insight("c1"), insight("c2", spend=None), insight("c3")])
    broken = put_raw("insights", "2", DAY, '[{"campaign_id": "c4"')
    not_objects = put_raw("insights", "3", DAY, [insight("c5"), 7])
    no_key = put_raw("insights", "4", DAY, [insight("c6"), insight(None)])
    repeated = put_raw("insights", "5", DAY, [insight("c7"), insight("c7", clicks=9)])
    empty = put_raw("insights", "6", DAY, [])
    all_bad = put_raw("insights", "7", DAY, [insight("c8", impressions="x")])
    put_raw("insights", "8", NEXT, [insight("c9")])
    out = load_insights(lake, DAY, TS)
    assert out.files == {"completado": 3, "fallido": 4} and out.upsert.actions == {"insert": 2}
    assert [r["campaign_id"] for r in rows_of(lake.insights.read())] == ["c1", "c3"]
    ledger = ledger_of(lake)
    assert {p: r["status"] for p, r in ledger.items()} == {
        good: "completado", empty: "completado", all_bad: "completado",
        broken: "fallido", not_objects: "fallido", no_key: "fallido", repeated: "fallido",
    }
    assert ledger[good]["business_line"] == "Meta" and ledger[good]["entity_id"] == "1"
    assert ledger[good]["fecha_archivo"] == DAY and ledger[broken]["error_mensaje"]
    errors = lake.errors.read().collect()
    assert sorted((r["tipo_error"], r["parent_id"]) for r in errors) == [
        ("FileError", "2"), ("FileError", "3"), ("FileError", "4"), ("FileError", "5"), ("RowError", "1"), ("RowError", "7"),
    ]
    assert {r["proceso"] for r in errors} == {"upload_insights_meta"} and {r["platform"] for r in errors} == {"meta"}
    assert [r["child_id"] for r in errors if r["parent_id"] == "1"] == ["c2"]


def test_gate_and_retry(lake, accounts, put_raw, rows_of):
    good = put_raw("insights", "1", DAY, [insight("c1")])
    bad = put_raw("insights", "2", DAY, "not json")
    assert load_insights(lake, DAY, TS).files == {"completado": 1, "fallido": 1}
    # a loaded file is not read again, even when it was rewritten that day
    put_raw("insights", "1", DAY, [insight("c1", clicks="99")])
    assert load_insights(lake, DAY, TS).files == {"fallido": 1}
    assert [r["clicks"] for r in rows_of(lake.insights.read())] == [1]
    put_raw("insights", "2", DAY, [insight("c2")])
    # the next day retries the failed file and leaves the loaded one alone
    assert load_insights(lake, NEXT, NEXT_TS, same_day_only=True).files == {}
    put_raw("insights", "1", NEXT, [insight("c1", clicks="5")])
    out = load_insights(lake, NEXT, NEXT_TS)
    assert out.files == {"completado": 2} and out.upsert.actions == {"insert": 1, "update": 1}
    assert {r["campaign_id"]: r["clicks"] for r in rows_of(lake.insights.read())} == {"c1": 5, "c2": 1}
    assert {r["status"] for r in ledger_of(lake).values()} == {"completado"} and len(ledger_of(lake)) == 3
    assert good in ledger_of(lake) and bad in ledger_of(lake)
    assert load_insights(lake, NEXT, NEXT_TS).files == {}


def test_later_file_wins(lake, accounts, put_raw, rows_of):
    """Files of several days loaded at once end as if loaded one after the other."""
    put_raw("insights", "1", DAY, "broken")
    load_insights(lake, DAY, TS)
    put_raw("insights", "1", DAY, [insight("c1", clicks="2"), insight("c2", clicks="2")])
    put_raw("insights", "1", NEXT, [insight("c1", clicks="3")])
    load_insights(lake, NEXT, NEXT_TS)
    assert {r["campaign_id"]: r["clicks"] for r in rows_of(lake.insights.read())} == {"c1": 3, "c2": 2}


def test_platforms(lake, accounts, put_raw):
    accounts("Meta", "Tiktok")
    put_raw("insights", "1", DAY, [insight("c1")])
    put_raw("insights", "2", DAY, "never read", source="tiktok")
    put_raw("insights", "3", DAY, [insight("c3")], source="unused")
    assert load_insights(lake, DAY, TS).files == {"completado": 1, "fallido": 1}
    state = ledger_of(lake)["raw/tiktok/insights/2/2026-01-10/data.json"]
    assert (state["status"], state["business_line"]) == ("fallido", "Tiktok")
    assert "no normaliser" in state["error_mensaje"]


def test_a_load_that_dies_logs_once(lake, accounts, put_raw, monkeypatch):
    """Two deaths behind the error log, then a success: one row for one bad item; another day is another row."""
    put_raw("insights", "1", DAY, [insight("c1"), insight("c2", spend=None), insight("c2", spend=None)])
    put_raw("insights", "2", DAY, "broken")

    class Death(Exception):
        pass

    def die():
        raise Death

    for _ in range(2):
        with monkeypatch.context() as patch:
            patch.setattr(silver_load.rules, "finished_load", die)
            with pytest.raises(Death):
                load_insights(lake, DAY, TS)
    assert load_insights(lake, DAY, TS).files == {"completado": 1, "fallido": 1}
    errors = lake.errors.read()
    assert sorted(r["tipo_error"] for r in errors.collect()) == ["FileError", "RowError", "RowError"]
    assert load_insights(lake, NEXT, NEXT_TS).files == {"fallido": 1}
    assert errors.count() == 3 and lake.errors.read().where("tipo_error = 'FileError'").count() == 2
    assert lake.errors.read().select("error_id").distinct().count() == 4


def test_gold_after_a_death(lake, accounts, put_raw, monkeypatch):
    """A load that dies behind the silver commit, a rerun that finds nothing, and gold still gets the day."""
    put_raw("insights", "1", DAY, [insight("c0", day="2026-01-01")])
    load_insights(lake, DAY, TS)
    assert refresh_gold(lake, TS).actions == {"insert": 1}
    put_raw("insights", "1", NEXT, [insight("c1"), insight("c2", day="2026-01-06")])

    class Death(Exception):
        pass

    def die():
        raise Death

    with monkeypatch.context() as patch:
        patch.setattr(silver_load.rules, "finished_load", die)
        with pytest.raises(Death):
            load_insights(lake, NEXT, NEXT_TS)
    assert load_insights(lake, NEXT, NEXT_TS).upsert.changed == 0
    out = refresh_gold(lake, NEXT_TS)
    assert out.actions == {"insert": 2} and out.days == (dt.date(2026, 1, 5), dt.date(2026, 1, 6))
    assert lake.fact.read().count() == 3
    assert refresh_gold(lake, NEXT_TS).actions == {} and refresh_gold(lake, NEXT_TS, everything=True).actions == {"noop": 3}


def test_nothing_to_do(lake, accounts):
    assert load_insights(lake, DAY, TS).files == {} and load_campaigns(lake, DAY, TS).files == {}
    assert lake.ledger.read().count() == 0


def campaign(cid, updated, **fields):
    return {"id": cid, "name": cid.upper(), "status": "ACTIVE", "daily_budget": "1000", "updated_time": updated, **fields}


def test_campaigns(lake, accounts, put_raw):
    put_raw("campaigns", "1", DAY, [campaign("c1", "2026-01-01T00:00:00+0000"), campaign("c2", None), {"name": "no id"}])
    put_raw("campaigns", "2", DAY, [campaign("c3", "2026-01-01"), campaign("c4", "2026-01-01", budget_rebalance_flag="abc")])
    assert load_campaigns(lake, DAY, TS).files == {"completado": 1, "fallido": 1}
    put_raw(
        "campaigns", "1", NEXT,
        [campaign("c1", "2026-01-02T00:00:00+0000", status="PAUSED", objective="X"), campaign("c2", None, status="PAUSED")],
    )
    out = load_campaigns(lake, NEXT, NEXT_TS, same_day_only=True)
    assert out.upsert.actions == {"update": 1, "noop": 1}
    rows = {r["campaign_id"]: r for r in lake.campaigns.read().collect()}
    assert set(rows) == {"c1", "c2"}
    assert (rows["c1"]["status"], rows["c1"]["loaded_at"], rows["c1"]["objective"]) == ("PAUSED", NEXT_TS, None)
    assert rows["c1"]["updated_time"] == dt.datetime(2026, 1, 1) and rows["c2"]["status"] == "ACTIVE"
    assert rows["c1"]["daily_budget"] == 10.0 and rows["c1"]["account_id"] == "1"
    assert {r["business_line"] for r in ledger_of(lake).values()} == {"campaigns"}


def test_gold(lake, accounts, put_raw, rows_of):
    put_raw("campaigns", "1", DAY, [campaign("c1", None)])
    put_raw("insights", "1", DAY, [insight("c1", actions=[{"action_type": "purchase", "value": "3"}]), insight("c2")])
    load_campaigns(lake, DAY, TS)
    load_insights(lake, DAY, TS)
    assert refresh_gold(lake, TS).actions == {"insert": 2}
    put_raw("insights", "1", NEXT, [insight("c1", clicks="7"), insight("c1", day="2026-01-06")])
    days = load_insights(lake, NEXT, NEXT_TS).upsert.days
    assert days == (dt.date(2026, 1, 5), dt.date(2026, 1, 6))
    assert refresh_gold(lake, NEXT_TS, days).actions == {"noop": 1, "update": 1, "insert": 1}
    assert refresh_gold(lake, NEXT_TS).changed == 0
    facts = {(r["campaign_id"], r["date_information"].day): r for r in lake.fact.read().collect()}
    assert facts["c1", 5]["clicks"] == 7 and facts["c1", 5]["inserted_at"] == NEXT_TS
    assert facts["c2", 5]["inserted_at"] == TS and isinstance(facts["c2", 5]["purchases"], float)
    refresh_dimension(lake)
    named = fact_with_dimension(lake.fact.read(), lake.dim_campaigns.read())
    assert sorted((r["campaign_id"], r["campaign_name"]) for r in named.collect()) == [("c1", "C1"), ("c1", "C1"), ("c2", None)]


def page(lot, number, body):
    import json

    return (*lot, number, body if isinstance(body, str) else json.dumps(body))


def test_extraction_to_silver(spark, lake, accounts, rows_of):
    """Plan, collect pages, land, load: the landed lines go the same way as array files."""
    campaigns = [(str(a), f"c{a}-{n:02}", dt.datetime(2026, 1, 1), "Meta") for a in (1, 2) for n in range(12)]
    campaigns += [("1", "later", dt.datetime(2026, 2, 1), "Meta"), ("1", "other", dt.datetime(2026, 1, 1), "TikTok")]
    schema = "account_id string, campaign_id string, start_time timestamp, platform string"
    lake.campaigns.append(spark.createDataFrame(campaigns, schema), TS)
    subitems = [(c[1],) for c in campaigns for _ in range(3)] + [("unknown",)]
    lake.subitems.append(spark.createDataFrame(subitems, "campaign_id string"), TS)
    planned = plan_extraction(lake, DAY)
    lots = planned.collect()
    assert sorted(len(r["campaign_ids"]) for r in lots) == [2, 2, 10, 10] and {r["mode"] for r in lots} == {"maximum"}
    pages = []
    for r in lots:
        lot = (r["account_id"], r["mode"], r["lot"])
        if r["account_id"] == "2" and r["lot"] == 1:
            continue
        ids = r["campaign_ids"]
        first = {"data": [insight(i) for i in ids[:5]], "paging": {"next": "x"}}
        last = {"data": [insight(i) for i in ids[5:]]}
        if r["account_id"] == "1" and r["lot"] == 1:
            last = {"error": {"message": "limit reached"}}
        pages += [page(lot, 0, first), page(lot, 1, last)]
    frame = spark.createDataFrame(pages, "account_id string, mode string, lot bigint, page int, body string")
    collect_insights(lake, planned, frame, DAY, TS)
    state = {r["campaign_id"]: r["extraction_status"] for r in lake.control.read().collect()}
    done = {i for r in lots if r["lot"] == 0 for i in r["campaign_ids"]}
    assert state == {c[1]: "extraccion_hecha" if c[1] in done else "fallido" for c in campaigns[:24]}
    assert [(r["parent_id"], r["mensaje_error"]) for r in lake.errors.read().collect()] == [("1", "limit reached")]
    out = load_insights(lake, DAY, TS, layout=LINES)
    assert out.files == {"completado": 2} and out.upsert.actions == {"insert": 20}
    assert {r["campaign_id"] for r in rows_of(lake.insights.read())} == done
    work = work_list(lake.subitems.read(), lake.campaigns.read(), lake.control.read(), NEXT)
    assert {r["mode"] for r in work.collect()} == {"last_14d"} and work.count() == 24


def test_account_cycle(spark, lake):
    rows = [
        ("new", "Meta", True, None, None), ("done", "Meta", True, "exitoso", TS), ("again", "meta", True, "fallido", TS),
        ("empty", "Meta", True, None, None), ("bad", "Meta", True, None, None), ("off", "Meta", False, None, None),
        ("else", "Spotify", True, None, None),
    ]
    schema = "account_id string, platform string, activo boolean, extraction_status string, ultima_extraccion timestamp"
    lake.accounts.append(spark.createDataFrame(rows, schema), TS)
    pages = [
        page(("new",), 0, {"data": [campaign("c1", None)]}), page(("again",), 0, {"data": [campaign("c2", None)]}),
        page(("done",), 0, {"data": [campaign("c3", None)]}), page(("empty",), 0, {"data": []}),
        page(("bad",), 0, {"error": {}}), page(("off",), 0, {"data": [campaign("c4", None)]}),
    ]
    frame = spark.createDataFrame(pages, "account_id string, page int, body string")
    later = TS + dt.timedelta(hours=1)
    assert account_cycle(lake, frame, DAY, later) == {"exitoso": 2, "fallido": 2}
    state = {r["account_id"]: (r["extraction_status"], r["ultima_extraccion"]) for r in lake.accounts.read().collect()}
    assert state == {
        "new": ("exitoso", later), "again": ("exitoso", later), "empty": ("fallido", later), "bad": ("fallido", later),
        "done": ("exitoso", TS), "off": (None, None), "else": (None, None),
    }
    errors = {r["entidad_id"]: r["mensaje_error"] for r in lake.errors.read().collect()}
    assert set(errors) == {"empty", "bad"} and errors["bad"] == "Error desconocido"
    assert load_campaigns(lake, DAY, later, layout=LINES).files == {"completado": 2}
    assert {r["campaign_id"] for r in lake.campaigns.read().collect()} == {"c1", "c2"}
