"""Failed files come back in a stream of their own, without a batch run."""

import datetime as dt

from stratafold.plans.lake import Lake
from stratafold.plans.silver_load import campaign_load, load_insights
from stratafold.streaming.silver_stream import stream_files, stream_retries

DAY, TS = dt.date(2026, 1, 10), dt.datetime(2026, 1, 10, 6)
KEY = ("gcs_path", "status", "fecha_archivo", "business_line", "entity_id")


def insight(campaign):
    return {"campaign_id": campaign, "date_stop": "2026-01-05", "clicks": "1", "spend": "1.5"}


def batches(query):
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_stream_only_equals_batch_for_a_mended_file(spark, lake, put_raw, rows_of, tmp_path):
    new, again = str(tmp_path / "new"), str(tmp_path / "again")
    accounts = spark.createDataFrame([("a", "Meta")], "account_id string, platform string")
    lake.accounts.append(accounts, TS)
    for account in range(3):
        put_raw("insights", str(account), DAY, [insight(f"c{account}")])
    put_raw("insights", "8", DAY, "torn [")
    put_raw("insights", "9", DAY - dt.timedelta(days=1), "torn [")
    assert batches(stream_retries(lake, again, TS)) == 0, "an empty ledger offers nothing"
    stream_files(lake, new, TS).awaitTermination()
    assert lake.insights.read().count() == 3

    # still torn: offered, failed again, and offered by the next run
    put_raw("insights", "9", DAY - dt.timedelta(days=1), [insight("c9")])
    assert batches(stream_retries(lake, again, TS)) == 2
    assert {r["entity_id"]: r["status"] for r in lake.ledger.read().collect()} == {"0": "completado", "1": "completado", "2": "completado", "8": "fallido", "9": "completado"}
    put_raw("insights", "8", DAY, [insight("c8")])
    assert batches(stream_retries(lake, again, TS)) == 1
    assert lake.ledger.read_apart().count() == 0

    other = Lake(spark, lake.root + "/batch").create_tables()
    other.accounts.append(accounts, TS)
    (tmp_path / "batch" / "raw").symlink_to(tmp_path / "raw", target_is_directory=True)
    load_insights(other, DAY - dt.timedelta(days=1), TS)
    load_insights(other, DAY, TS)
    assert rows_of(other.insights.read()) == rows_of(lake.insights.read())
    assert rows_of(other.ledger.read(), *KEY) == rows_of(lake.ledger.read(), *KEY)

    # nothing open: the ledger stands still and so does the stream
    state = lake.ledger.manifest().number
    stream_retries(lake, again, TS).awaitTermination()
    assert batches(stream_retries(lake, again, TS)) == 0 and lake.ledger.manifest().number == state


def test_each_job_takes_its_own_files(spark, lake, put_raw, tmp_path):
    lake.accounts.append(spark.createDataFrame([("a", "Meta")], "account_id string, platform string"), TS)
    put_raw("insights", "1", DAY, "torn")
    load_insights(lake, DAY, TS)
    put_raw("insights", "1", DAY, [insight("c1")])
    stream_retries(lake, str(tmp_path / "campaigns"), TS, job=campaign_load()).awaitTermination()
    assert lake.insights.read().count() == 0
    stream_retries(lake, str(tmp_path / "insights"), TS).awaitTermination()
    assert lake.insights.read().count() == 1
