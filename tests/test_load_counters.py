"""Counters of a load: observed by the write, and one read of the rows for all files' outcomes."""

import datetime as dt

from pyspark.sql import functions as F

from stratafold.operators.ledger import file_outcomes, load_counters
from stratafold.plans.lake import staging
from stratafold.schemas import INSIGHTS

DAY = dt.date(2026, 1, 10)
ROW = (
    "gcs_path string, fecha_archivo date, account_id string, platform string, has_item boolean, row_error string, "
    "file_error string, campaign_id string, date_information date"
)


def row(file, campaign, day=5, error=None, fault=None, item=True):
    when = dt.date(2026, 1, day) if day else None
    return (file, DAY, "a", "Meta", item, error, fault, campaign, when)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_outcomes_of_files(spark, rows_of):
    rows = spark.createDataFrame(
        [
            row("good", "c1"), row("good", "c1", 6), row("good", "c2", error="spend: not a number"),
            row("good", "c1", 7, error="spend: not a number"),
            row("twice", "c1"), row("twice", "c1"), row("twice", "c3", 9),
            row("fault", "c1"), row("fault", None, fault="campaign_id: missing"),
            # equal keys of bad rows, and of no key at all, repeat nothing
            row("bad", "c1", error="x"), row("bad", "c1", error="x"), row("bad", None, None, error="x"),
            row("empty", None, None, item=False),
        ],
        ROW,
    )
    out = file_outcomes(rows, ("campaign_id", "date_information"), "date_information")
    found = {r["gcs_path"]: (r["n_good"], r["status"], r["error"], sorted(d.day for d in r["days"])) for r in rows_of(out)}
    assert found == {
        "good": (2, "completado", None, [5, 6]),
        "twice": (3, "fallido", "more than one row for a key", [5, 9]),
        "fault": (2, "fallido", "campaign_id: missing", [5]),
        "bad": (0, "completado", None, []),
        "empty": (0, "completado", None, []),
    }
    without_day = {r["gcs_path"]: r["days"] for r in rows_of(file_outcomes(rows, ("campaign_id",)))}
    assert set(map(tuple, without_day.values())) == {()}
    assert rows_of(file_outcomes(rows.limit(0), ("campaign_id",))) == []


def test_the_rows_are_read_once(spark):
    with staging(spark) as stage:
        rows = stage.write(spark.createDataFrame([row("f", "c1")], ROW), "rows")
        plan = plan_of(file_outcomes(rows, ("campaign_id", "date_information"), "date_information"))
        assert plan.count("Relation [") == 1 and "Join" not in plan


def test_counters_come_from_the_write(spark):
    wanted = {"rows": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0), "sum": F.sum("id")}
    frames = [spark.range(10), spark.range(10, 15), spark.range(0), spark.range(9).where("id > 20")]
    with staging(spark) as stage:
        table, counted = stage.write_counted(frames, "numbers", wanted)
        assert counted == {"rows": 15, "even": 8, "sum": 105} and table.count() == 15
        assert stage.write_counted([], "nothing", wanted) == (None, {"rows": 0, "even": 0, "sum": 0})


def test_counters_of_a_load(spark):
    missing = [f for f in INSIGHTS.schema.fields if f.name not in ("campaign_id", "date_information", "account_id", "platform")]
    rows = spark.createDataFrame([row("ab", "c1"), row("ab", "cé", error="x"), row("cd", "c", item=False)], ROW)
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing if f.name not in rows.columns])
    with staging(spark) as stage:
        _, counted = stage.write_counted([rows], "rows", load_counters(INSIGHTS.schema))
    # one good row: c1, a, Meta and its file's name
    assert counted == {"bad": 1, "text": 2 + 1 + 4 + 2}
