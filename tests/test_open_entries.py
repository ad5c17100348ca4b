"""The ledger's open entries lie apart; the error log is read by the day; manifests are made once."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from stratafold import session
from stratafold.functions.times import utc_day
from stratafold.operators.error_log import account_errors, log_once
from stratafold.plans.silver_load import load_insights
from stratafold.session import list_names, read_text, write_new_text

D1, D2, D3 = (dt.date(2026, 1, d) for d in (10, 11, 12))


def at(day, hour=6):
    return dt.datetime(day.year, day.month, day.day, hour)


ROW = {"campaign_id": "c", "date_stop": "2026-01-01", "impressions": "1", "spend": "1.5"}


def test_a_load_reads_the_open_entries_only(spark, lake, put_raw, monkeypatch):
    lake.accounts.append(spark.createDataFrame([("1", "Meta")], "account_id string, platform string"), at(D1))
    for day in (D1, D2):
        for account in "12345":
            put_raw("insights", account, str(day), [{**ROW, "campaign_id": f"c{account}"}])
    put_raw("insights", "9", str(D1), "torn [")
    load_insights(lake, D1, at(D1))
    load_insights(lake, D2, at(D2))
    table = lake.ledger
    assert {r["entity_id"] for r in table.read_apart().collect()} == {"9"}
    assert set(table.manifest().apart) == {str(D1)} and table.read().count() == 11
    whole = {f for f in table.read().inputFiles()}
    assert not whole & set(table.read_apart().inputFiles())

    read_days = []
    read = type(table).read
    monkeypatch.setattr(type(table), "read", lambda self, days=None, **o: read_days.append((self.spec.name, days)) or read(self, days, **o))
    put_raw("insights", "9", str(D1), [ROW])
    load_insights(lake, D3, at(D3))
    asked = [days for name, days in read_days if name == table.spec.name]
    assert asked and all(days is not None for days in asked)
    assert table.read_apart().count() == 0 and read(table).where("status = 'completado'").count() == 11
    table.vacuum(keep=1)
    assert table.read_apart().count() == 0 and read(table).count() == 11


def test_open_entries_added_and_published(spark, lake):
    entries = lambda status, paths, day: spark.createDataFrame([(p, "b", "e", day, status) for p in paths], "gcs_path string, business_line string, entity_id string, fecha_archivo date, status string")
    lake.ledger.append(entries("fallido", ["a", "b"], D1), at(D1))
    lake.ledger.append(entries("completado", ["c"], D1).unionByName(entries(None, ["d"], D2)), at(D1))
    assert sorted(r["gcs_path"] for r in lake.ledger.read_apart().collect()) == ["a", "b", "d"]
    day = lake.ledger.read([D1]).withColumn("status", F.lit("completado"))
    lake.ledger.publish(day)
    assert [r["gcs_path"] for r in lake.ledger.read_apart().collect()] == ["d"]
    lake.ledger.mark({"x": 1})
    assert lake.ledger.read_apart().count() == 1


def errors(spark, n, reason="same"):
    rows = spark.range(n).select(F.lit("1").alias("account_id"), F.lit("Meta").alias("platform"), F.lit(reason).alias("why"), F.lit("f").alias("file"))
    return account_errors(rows, "p", "RowError", F.col("why"), file=F.col("file"))


def test_one_reason_is_numbered_in_parts(spark, lake, monkeypatch):
    monkeypatch.setattr("stratafold.operators.error_log.PART_ROWS", 100)
    log_once(lake.errors, errors(spark, 2500).unionByName(errors(spark, 3, "other")), at(D1))
    logged = lake.errors.read()
    assert logged.count() == 2503 and logged.select("error_id").distinct().count() == 2503
    log_once(lake.errors, errors(spark, 2600), at(D1, 9))
    assert lake.errors.read().count() == 2603
    log_once(lake.errors, errors(spark, 5), at(D2))
    assert lake.errors.read().count() == 2608


def test_a_million_equal_faults_over_all_tasks(spark, lake):
    log_once(lake.errors, errors(spark, 1_000_000), at(D1))
    files = lake.errors.read()
    assert files.count() == 1_000_000 and files.select("error_id").distinct().count() == 1_000_000
    assert lake.errors.read([D2]).count() == 0 and lake.errors.read([D1]).count() == 1_000_000


def test_the_log_is_read_by_the_day(spark, lake, monkeypatch):
    for day in (D1, D2):
        log_once(lake.errors, errors(spark, 2), at(day))
    asked = []
    read = type(lake.errors).read
    monkeypatch.setattr(type(lake.errors), "read", lambda self, days=None, **o: asked.append(days) or read(self, days, **o))
    log_once(lake.errors, errors(spark, 2), at(D2, 23))
    assert asked == [[D2]] and read(lake.errors).count() == 4
    assert all(str(D2) in f for f in read(lake.errors, [D2]).inputFiles())


def test_utc_day():
    assert utc_day(dt.datetime(2026, 1, 10, 23)) == D1
    assert utc_day(dt.datetime(2026, 1, 10, 23, tzinfo=dt.timezone(dt.timedelta(hours=-6)))) == D2


@pytest.mark.parametrize("how", ["link", "rename", "create"])
def test_of_writers_of_one_manifest_one_succeeds(spark, tmp_path, monkeypatch, how):
    """The three ways, on a disk where a plain rename would replace the first one's file."""
    path = f"{tmp_path}/000000000001.json"
    if how == "create":
        monkeypatch.setattr(session, "PUT_IF_ABSENT", ("file",))
    root = f"file:{path}" if how == "link" else path
    outcomes = []

    def write(n):
        try:
            write_new_text(spark, root, f"writer {n}" * 1000)
            outcomes.append(n)
        except Exception as error:  # noqa: BLE001
            assert "exist" in str(error).lower()

    if how == "link":
        threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    else:
        for n in range(3):
            write(n)
    assert len(outcomes) == 1 and read_text(spark, path) == f"writer {outcomes[0]}" * 1000
    assert [n for n in list_names(spark, str(tmp_path)) if not n.startswith(".")] == ["000000000001.json"]


def test_s3a_refuses_without_conditional_create(spark, tmp_path):
    """A store that does not know the option is an error, never an unguarded write."""
    fs, jpath = session._file_system(spark, f"{tmp_path}/x.json")
    with pytest.raises(Exception, match=session.S3A_CONDITIONAL.replace(".", r"\.")):
        session._create_absent(fs, jpath, bytearray(b"x"), "s3a")
    assert not session.path_exists(spark, f"{tmp_path}/x.json")
