"""Files of some days listed by tasks: what globbing finds, in one job."""

import datetime as dt
import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.plans import silver_load
from stratafold.plans.silver_load import load_insights
from stratafold.sources import listing
from stratafold.sources.listing import ARRAY, LAYOUTS, LINES, day_glob, list_days, list_files
from stratafold.sources.raw_files import land_items

DAYS = [dt.date(2026, 1, 10), dt.date(2026, 1, 11)]
TS = dt.datetime(2026, 1, 11, 6)


@pytest.fixture
def filled(spark, lake, put_raw):
    """Both layouts, two platforms, odd account names, and files that are none of the day's."""
    for day in (*DAYS, dt.date(2026, 1, 12)):
        for account in ("1", "a b", "é", "x=y", "50%"):
            put_raw("insights", account, str(day), [{"campaign_id": account}])
        put_raw("insights", "1", str(day), [{}], source="tiktok")
        put_raw("campaigns", "7", str(day), [{}])
    os.makedirs(f"{lake.root}/raw/meta/insights/empty")
    with open(f"{lake.root}/raw/meta/insights/1/{DAYS[0]}/other.json", "w") as f:
        f.write("[]")
    rows = [("Meta", "insights", a, d, i) for a in ("1", "a b", "q") for d in DAYS for i in range(3)]
    items = spark.createDataFrame(rows, "source string, tipo string, id string, fecha date, n int")
    land_items(items.select("source", "tipo", "id", "fecha", F.struct("n").alias("item")), lake.root)
    return lake


def globbed(spark, root, platforms, layouts):
    found = [
        list_files(spark, [day_glob(root, p, "insights", d, form) for d in DAYS]).withColumns({"platform": F.lit(p), "layout": F.lit(form)})
        for p in platforms for form in layouts
    ]
    return reduce(DataFrame.unionByName, found)


def rows(df):
    return sorted((r["gcs_path"], r["file_path"].removeprefix("file:"), r["account_id"], r["fecha_archivo"], r["file_bytes"], r["platform"], r["layout"]) for r in df.collect())


@pytest.mark.parametrize("layouts", [LAYOUTS, (ARRAY,), (LINES,)])
@pytest.mark.parametrize("prefix", ["", "file:"])
def test_the_same_files_as_by_globbing(spark, filled, layouts, prefix):
    found = list_days(spark, prefix + filled.root, "insights", ["Meta", "Tiktok"], DAYS, layouts)
    assert rows(found) == rows(globbed(spark, filled.root, ["Meta", "Tiktok"], layouts))
    counts = {(r["platform"], r["layout"]): r["count"] for r in found.groupBy("platform", "layout").count().collect()}
    assert counts.get(("Meta", ARRAY), 10) == 10 and counts.get(("Meta", LINES), 6) == 6


def test_other_stores_are_globbed(spark, filled, monkeypatch):
    want = rows(list_days(spark, filled.root, "insights", ["Meta"], DAYS))
    monkeypatch.setattr(listing, "LISTED_BY_TASKS", listing.re.compile("nothing"))
    assert rows(list_days(spark, filled.root, "insights", ["Meta"], DAYS)) == want and len(want) == 16


def test_nothing_to_list(spark, lake):
    for platforms, days in (([], DAYS), (["Meta"], []), (["Meta"], DAYS)):
        assert list_days(spark, lake.root, "insights", platforms, days).collect() == []


def test_the_driver_globs_nothing(spark, filled, monkeypatch):
    """However many platforms, days and accounts there are."""
    filled.accounts.append(spark.createDataFrame([("1", "Meta"), ("2", "Tiktok")], "account_id string, platform string"), TS)

    def none(*_):
        raise AssertionError("globbed on the driver")

    monkeypatch.setattr(listing, "glob_matches", none)
    out = load_insights(filled, DAYS[1], TS)
    assert sum(out.files.values()) == 5 + 1 + len(rows(silver_load.list_days(spark, filled.root, "insights", ["Meta"], [DAYS[1]], (LINES,))))
