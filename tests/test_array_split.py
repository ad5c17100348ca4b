"""A large array file read by byte ranges gives the rows and the faults of a whole read."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from stratafold.plans import silver_load
from stratafold.plans.lake import staging
from stratafold.plans.silver_load import load_insights
from stratafold.schemas import INSIGHT_FIELDS
from stratafold.sources import array_split
from stratafold.sources.array_split import read_split_items, segments
from stratafold.sources.raw_files import MALFORMED, read_items

FIELDS = {"id": "string", "note": "string", "actions": "string"}
DAY = dt.date(2026, 1, 10)


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 64 bytes, so that elements, strings and escapes lie across them."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


def both(spark, put_raw, lake, texts):
    files = []
    for number, text in enumerate(texts):
        put_raw("insights", f"a{number:02}", str(DAY), text)
        files.append(f"{lake.root}/raw/meta/insights/a{number:02}/{DAY}/data.json")
    whole = rows(read_items(spark, files, FIELDS))
    with staging(spark) as stage:
        return whole, rows(read_split_items(spark, files, FIELDS, stage))


def element(rng, n):
    strings = ["", "}", "{[", '"', "\\", '\\"}', "é}𝒳", "],[", "a\nb", "\\\\"]
    value = {"id": str(n), "note": "".join(rng.choice(strings) for _ in range(rng.randrange(6)))}
    if rng.random() < 0.5:
        value["actions"] = [{"t": rng.choice(strings), "deep": [{"x": [1, {}]}]} for _ in range(rng.randrange(4))]
    return value


def test_elements_of_any_shape(spark, lake, put_raw, small_ranges):
    rng = random.Random(5)
    arrays = [[element(rng, n) for n in range(size)] for size in (0, 1, 2, 40)]
    texts = [json.dumps(a, indent=i, ensure_ascii=e) for a, i, e in zip(arrays * 2, [None, 2, 0, 1] * 2, [True, False] * 4)]
    whole, split = both(spark, put_raw, lake, texts)
    assert split == whole and len(whole) == 2 * 43 + 2
    files = [f"{lake.root}/raw/meta/insights/a03/{DAY}/data.json"]
    assert segments(spark, files).select("block").distinct().count() > 10


def test_faults_are_those_of_a_whole_read(spark, lake, put_raw, small_ranges):
    texts = [
        "[]", " \n[ ]\n", "[1]", "[null]", '["x"]', "no json", '{"id":"1"}', '[{"id":"1"}', '[{"id":"1"', '[{"id":"1"},]', '[{"id":"1"},null]',
        '[{"id":"1"},5]', '[null,{"id":"1"}]', '[5,{"id":"1"}]', '[{"id":"1"} {"id":"2"}]', '[{"id":"1"},{"id":"2]', '[{"id":"1"}] x',
        '[{"id":"1"},{"id":"2"}}]', '\n[{"id":"}"}]', '[{"id":"1"},{},{"note":"\\\\"}]', '[{"id":"1"},[{"id":"2"}]]',
    ]
    whole, split = both(spark, put_raw, lake, texts)
    assert split == whole
    assert len({r["gcs_path"] for r in split}) == len(texts)


def test_an_element_too_large_fails_its_file(spark, lake, put_raw, monkeypatch):
    monkeypatch.setattr(array_split, "MAX_ELEMENT", 1000)
    texts = [json.dumps([{"id": "1"}, {"id": "2", "note": "x}" * 800}]), json.dumps([{"id": "3"}])]
    _, split = both(spark, put_raw, lake, texts)
    found = {(r["file_fault"], r["item"] and r["item"]["id"]) for r in split}
    assert found == {(None, "3"), (array_split.TOO_LARGE, None)}


def test_a_large_file_is_read_by_several_tasks(spark, lake, put_raw):
    size = 40_000
    put_raw("insights", "big", str(DAY), [{"id": str(n), "note": '{"' * 20, "actions": [{"a": n}]} for n in range(size)])
    files = [f"{lake.root}/raw/meta/insights/big/{DAY}/data.json"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        with staging(spark) as stage:
            assert segments(spark, files).rdd.getNumPartitions() >= 8
            found = read_split_items(spark, files, FIELDS, stage)
            assert found.count() == size and found.where("file_fault IS NOT NULL").count() == 0
            assert found.agg(F.countDistinct("item.id")).first()[0] == size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_loads_choose_by_size(spark, lake, put_raw, monkeypatch):
    """The same load whichever way its files are read; a torn large file fails alone."""
    row = lambda c: {"campaign_id": c, "date_stop": "2026-01-01", "impressions": "1", "spend": "1.5"}
    put_raw("insights", "1", str(DAY), [row(f"c{n}") for n in range(30)])
    put_raw("insights", "2", str(DAY), [row("d1")])
    put_raw("insights", "3", str(DAY), json.dumps([row(f"e{n}") for n in range(30)])[:-1])
    lake.accounts.append(spark.createDataFrame([("1", "Meta")], "account_id string, platform string"), dt.datetime(2026, 1, 10))
    monkeypatch.setattr(silver_load, "WHOLE_FILE_BYTES", 500)
    out = load_insights(lake, DAY, dt.datetime(2026, 1, 10, 6))
    assert out.files == {"completado": 2, "fallido": 1} and lake.insights.read().count() == 31
    (failed,) = lake.ledger.read().where("status = 'fallido'").collect()
    assert failed["error_mensaje"] == MALFORMED and "/3/" in failed["gcs_path"]
    assert set(INSIGHT_FIELDS) >= {"campaign_id"}
