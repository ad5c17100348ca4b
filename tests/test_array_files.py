"""Array files written by tasks: whole or absent, replaced by a rerun, no drafts left."""

import datetime as dt
import json
import os

import pytest
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratafold.sources import array_files
from stratafold.sources.array_files import _Draft, file_system, write_array_files
from stratafold.sources.raw_files import land_arrays

DAY = dt.date(2026, 1, 10)


def files(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if not name.endswith(".crc"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    found[os.path.relpath(os.path.join(folder, name), root)] = f.read()
    return found


def items(spark, accounts, per_account, text="x"):
    rows = [("Meta", "insights", a, DAY, i, text) for a in accounts for i in range(per_account)]
    df = spark.createDataFrame(rows, "source string, tipo string, id string, fecha date, n int, t string")
    return df.select("source", "tipo", "id", "fecha", F.struct("n", "t").alias("item"))


def test_one_file_per_account_and_day(spark, tmp_path):
    accounts = ["1", "a b", "é", "x=y", "50%"]
    land_arrays(items(spark, accounts, 40, 'quote " and \n line').repartition(7), str(tmp_path))
    got = files(tmp_path)
    assert set(got) == {f"raw/meta/insights/{a}/2026-01-10/data.json" for a in accounts}
    for text in got.values():
        assert sorted(e["n"] for e in json.loads(text)) == list(range(40))
        assert {e["t"] for e in json.loads(text)} == {'quote " and \n line'}


def test_a_rerun_replaces_and_other_files_stay(spark, tmp_path):
    land_arrays(items(spark, ["1", "2"], 3), f"file:{tmp_path}")
    land_arrays(items(spark, ["2", "3"], 1, "new"), str(tmp_path))
    got = {k.split("/")[3]: json.loads(v) for k, v in files(tmp_path).items()}
    assert [len(got[a]) for a in "123"] == [3, 1, 1] and got["2"][0]["t"] == "new"
    land_arrays(items(spark, [], 1), str(tmp_path))
    assert len(files(tmp_path)) == 3


def test_a_large_account_is_streamed_by_one_task(spark, tmp_path):
    rows = spark.range(300_000).select(F.lit("big/data.json").alias("path"), F.to_json(F.struct("id")).alias("value"))
    write_array_files(rows, str(tmp_path))
    assert len(json.loads(files(tmp_path)["big/data.json"])) == 300_000


def test_a_failed_job_leaves_whole_files_and_no_drafts(spark, tmp_path):
    good = spark.range(50).select(F.concat_ws("/", F.lit("a"), F.col("id") % 5).alias("path"), F.lit("{}").alias("value"))
    write_array_files(good, str(tmp_path))
    before = files(tmp_path)
    value = F.when(F.col("id") == 99, F.raise_error(F.lit("torn"))).otherwise(F.to_json(F.struct("id")))
    bad = spark.range(100).select(F.concat_ws("/", F.lit("a"), F.col("id") % 5).alias("path"), value.alias("value"))
    with pytest.raises(PySparkException, match="torn"):
        write_array_files(bad, str(tmp_path))
    after = files(tmp_path)
    assert set(after) == set(before) and not [n for n in os.listdir(tmp_path) if n.startswith("_")]
    assert all(isinstance(json.loads(text), list) for text in after.values())


def test_no_python_rename_loop_on_the_driver(spark, tmp_path, monkeypatch):
    """However many files, the driver touches the drafts' folder only."""
    seen = []
    monkeypatch.setattr(array_files.ArrayFileWriter, "_clear", lambda self: seen.append(self.drafts))
    write_array_files(spark.range(200).select(F.concat(F.lit("f"), "id").alias("path"), F.lit("1").alias("value")), str(tmp_path))
    assert len([k for k in files(tmp_path) if not k.startswith("_")]) == 200


def test_stores_without_a_replacing_rename(tmp_path):
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    store.create_dir("drafts")
    for text in (b"1", b"2"):
        draft = _Draft(store, "drafts", "a/data.json")
        draft.add(text)
        draft.add(b'"x"')
        draft.place()
    assert json.loads(files(tmp_path)["a/data.json"]) == [2, "x"] and os.listdir(tmp_path / "drafts") == []


@pytest.mark.parametrize("root", ["/a/b", "file:/a/b", "file:///a/b"])
def test_local_roots(root):
    store, path = file_system(root)
    assert isinstance(store, fs.LocalFileSystem) and path == "/a/b"


def test_a_store_that_tasks_do_not_know_is_an_error():
    with pytest.raises(Exception, match="(?i)unrecognized"):
        file_system("nosuchstore://x/y")
