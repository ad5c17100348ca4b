"""Raw files to silver tables, for campaigns and for insights, each file once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.operators import rules
from stratafold.operators.casts import cast_to
from stratafold.operators.commit import Outcome, SourceSize, commit, source_days, text_size
from stratafold.operators.error_log import account_errors, log_once
from stratafold.operators.ledger import FILE_KEY, file_outcomes, load_counters, not_yet_loaded, unfinished
from stratafold.operators.merge import LATEST, MergeRule
from stratafold.operators.normalise import (
    Normaliser, bad_rows, fail_unsupported, good_rows, normalise_campaigns, normalise_insights, normaliser_for,
)
from stratafold.plans.lake import Lake, Staging, staging
from stratafold.schemas import CAMPAIGN_FIELDS, CAMPAIGNS, INSIGHT_FIELDS, INSIGHTS, TableSpec
from stratafold.sources.catalogue import active_platforms
from stratafold.sources.array_split import read_split_items
from stratafold.sources.listing import ARRAY, LAYOUTS, list_days
from stratafold.sources.raw_files import read_items

# Names of so many files at a time are given to the reader.
FILES_AT_ONCE = 10_000
# An array file beyond this size is read by several tasks, a smaller one whole by one.
WHOLE_FILE_BYTES = 64 * 1024 * 1024

# later files of one load win over earlier ones
FILE_ORDER = ("fecha_archivo", "gcs_path")


@dataclass(frozen=True)
class LoadJob:
    """What differs between the two loads."""

    kind: str
    fields: Mapping[str, str]
    normalisers: Mapping[str, Normaliser]
    spec: TableSpec
    keys: tuple[str, ...]
    stamp: str
    rule: Callable[[dt.datetime], MergeRule]
    process: str
    business_line: Column
    platform: str | None


def campaign_load() -> LoadJob:
    return LoadJob(
        kind="campaigns",
        fields=CAMPAIGN_FIELDS,
        normalisers={fv.PLATFORM: normalise_campaigns},
        spec=CAMPAIGNS,
        keys=("campaign_id",),
        stamp="loaded_at",
        rule=lambda run_ts: rules.newest_campaign(
            run_ts, on_duplicate=LATEST, order_by=("updated_time", *FILE_ORDER)
        ),
        process=fv.PROCESS_LOAD_CAMPAIGNS,
        business_line=F.lit("campaigns"),
        platform=fv.PLATFORM,
    )


def insight_load() -> LoadJob:
    return LoadJob(
        kind="insights",
        fields=INSIGHT_FIELDS,
        normalisers={fv.PLATFORM: normalise_insights},
        spec=INSIGHTS,
        keys=rules.INSIGHT_KEYS,
        stamp="updated_at",
        rule=lambda run_ts: rules.changed_insight(run_ts, on_duplicate=LATEST, order_by=FILE_ORDER),
        process=fv.PROCESS_LOAD_INSIGHTS,
        business_line=F.col("platform"),
        platform=None,
    )


@dataclass(frozen=True)
class LoadOutcome:
    """Files per final status and what the upsert did."""

    files: dict[str, int] = field(default_factory=dict)
    upsert: Outcome = Outcome()


def load_campaigns(lake: Lake, run_date: dt.date, run_ts: dt.datetime, **options) -> LoadOutcome:
    return load_files(lake, campaign_load(), run_date, run_ts, **options)


def load_insights(lake: Lake, run_date: dt.date, run_ts: dt.datetime, **options) -> LoadOutcome:
    return load_files(lake, insight_load(), run_date, run_ts, **options)


def listed_files(lake: Lake, job: LoadJob, days: Sequence[dt.date], layout: str | None = None) -> DataFrame:
    """The raw files of some days, of the active platforms and of one layout or both.

    The platforms' names are collected: a handful.
    """
    names = sorted((r[0] for r in active_platforms(lake.accounts.read(), job.platform).collect()), reverse=True)
    # spellings that differ in case share one folder
    platforms = sorted({name.lower(): name for name in names}.values())
    return list_days(lake.spark, lake.root, job.kind, platforms, days, [layout] if layout else LAYOUTS)


def due_files(
    lake: Lake, job: LoadJob, run_date: dt.date, *, layout: str | None = None, same_day_only: bool = False
) -> DataFrame:
    """Files of the run date not loaded yet, plus unfinished ones of earlier days, of one layout or both.

    The days to look at are collected: one value per day with an open file.
    """
    retries = unfinished(lake.ledger.read_apart(), job.kind, run_date)
    days = [run_date] if same_day_only else [*source_days(retries, "fecha_archivo"), run_date]
    files = listed_files(lake, job, days, layout)
    today = files.where(F.col("fecha_archivo") == F.lit(run_date))
    due = not_yet_loaded(today, lake.ledger.read([run_date]))
    if same_day_only:
        return due
    late = files.where(F.col("fecha_archivo") < F.lit(run_date))
    return due.unionByName(late.join(retries.select(*FILE_KEY), list(FILE_KEY), "left_semi"))


def load_files(
    lake: Lake,
    job: LoadJob,
    run_date: dt.date,
    run_ts: dt.datetime,
    *,
    layout: str | None = None,
    same_day_only: bool = False,
) -> LoadOutcome:
    """List, gate, read, normalise, upsert, log, and close the ledger entries.

    Files of both layouts are loaded unless one is named.
    """
    return load_due(lake, job, due_files(lake, job, run_date, layout=layout, same_day_only=same_day_only), run_ts)


def load_due(lake: Lake, job: LoadJob, due: DataFrame, run_ts: dt.datetime) -> LoadOutcome:
    """Load the listed files, whatever the ledger says of them."""
    with staging(lake.spark) as stage:
        return _apply(lake, job, _rows_of(lake, job, stage.write(due, "due"), stage), stage, run_ts)


def _rows_of(lake: Lake, job: LoadJob, due: DataFrame, stage: Staging) -> Iterator[DataFrame]:
    """Normalised rows of the due files; files without a normaliser are not read.

    Files are named to the reader in slices by a hash of their path, so that the
    driver holds one slice's names however many files there are. Large array files
    are slices of their own, read by byte ranges.
    """
    kinds = due.withColumn("large", (F.col("layout") == ARRAY) & (F.col("file_bytes") > WHOLE_FILE_BYTES))
    counts = {(r["platform"], r["layout"], r["large"]): r["count"] for r in kinds.groupBy("platform", "layout", "large").count().collect()}
    for (platform, layout, large), count in sorted(counts.items()):
        normalise = normaliser_for(platform, job.normalisers)
        own = (F.col("platform") == platform) & (F.col("layout") == layout) & (F.col("large") == F.lit(large))
        files = kinds.where(own).drop("layout", "large")
        if normalise is None:
            yield fail_unsupported(files, job.spec, job.stamp)
            continue
        slices = -(-count // FILES_AT_ONCE)
        for number in range(slices):
            mine = files.where(F.pmod(F.xxhash64("file_path"), F.lit(slices)) == number).select("file_path")
            names = sorted(r["file_path"] for r in mine.collect())
            if names:
                read = read_split_items(lake.spark, names, job.fields, stage) if large else read_items(lake.spark, names, job.fields, layout)
                yield normalise(read.withColumn("platform", F.lit(platform)))


def load_rows(lake: Lake, job: LoadJob, rows: DataFrame, counted: Mapping[str, int], run_ts: dt.datetime) -> LoadOutcome:
    """Written rows of any files, with their counters: those already loaded are left out.

    The rows are read once to see which files they are of, and not written again.
    A file in a folder whose day cannot be read has no place in the ledger; it is
    logged and left alone.
    """
    with staging(lake.spark) as stage:
        files = stage.write(file_outcomes(rows, job.keys, job.spec.partition), "files")
        homeless = files.where(F.col("fecha_archivo").isNull()).select("gcs_path", "account_id", "platform").distinct()
        if not homeless.isEmpty():
            reason = account_errors(homeless, job.process, "FileError", F.lit("the folder's day cannot be read"), file=F.col("gcs_path"))
            log_once(lake.errors, reason, run_ts)
        dated = files.where(F.col("fecha_archivo").isNotNull())
        outcomes = stage.write(not_yet_loaded(dated, lake.ledger.read(source_days(dated, "fecha_archivo"))), "outcomes")
        if outcomes.count() < files.count():
            # the counters of all rows are a bound of those that are left
            rows = rows.join(outcomes.select(*FILE_KEY), list(FILE_KEY), "left_semi")
        return _load(lake, job, rows, counted, outcomes, run_ts)


def _apply(lake: Lake, job: LoadJob, frames: Iterable[DataFrame], stage: Staging, run_ts: dt.datetime) -> LoadOutcome:
    """The rows are counted while they are written and read once for their files'
    outcomes; the upsert and the log read what is left to do for them.
    """
    rows, counted = stage.write_counted(frames, "rows", load_counters(job.spec.schema))
    if rows is None:
        return LoadOutcome()
    outcomes = stage.write(file_outcomes(rows, job.keys, job.spec.partition), "outcomes")
    return _load(lake, job, rows, counted, outcomes, run_ts)


def _load(
    lake: Lake, job: LoadJob, rows: DataFrame, counted: Mapping[str, int], outcomes: DataFrame, run_ts: dt.datetime
) -> LoadOutcome:
    """Data first, ledger last: a run that dies in between is simply repeated."""
    totals = outcomes.groupBy("fecha_archivo", "status").agg(
        F.count("*").alias("files"), F.sum("n_good").alias("good"), text_size(outcomes).alias("text")
    ).collect()
    if not totals:
        return LoadOutcome()
    files = {status: sum(r["files"] for r in totals if r["status"] == status) for status in {r["status"] for r in totals}}
    days = tuple(sorted({r["fecha_archivo"] for r in totals}))
    size = SourceSize(sum(files.values()), sum(r["text"] for r in totals), days)

    started = outcomes.select(
        "gcs_path", job.business_line.alias("business_line"), F.col("account_id").alias("entity_id"), "fecha_archivo"
    )
    commit(lake.ledger, started, rules.started_load(run_ts), compare=False, size=size)

    failed = outcomes.where(F.col("error").isNotNull())
    upsert = Outcome()
    loaded = sum(r["good"] for r in totals if r["status"] == fv.LEDGER_DONE)
    if loaded:
        loadable = good_rows(rows)
        if fv.LEDGER_FAILED in files:
            loadable = loadable.join(failed.select("gcs_path"), "gcs_path", "left_anti")
        source = cast_to(loadable, job.spec, job.stamp, extra=FILE_ORDER)
        # the text of failed files is counted too: a bound, on the safe side of a broadcast
        within = SourceSize(loaded, counted["text"], _loaded_days(outcomes))
        upsert = commit(lake.table(job.spec), source, job.rule(run_ts), size=within)

    if fv.LEDGER_FAILED in files or counted["bad"]:
        log_once(lake.errors, _errors(job, rows, failed), run_ts)
    finished = outcomes.select(*FILE_KEY, "status", "error")
    commit(lake.ledger, finished, rules.finished_load(), compare=False, size=size)
    return LoadOutcome(files, upsert)


def _loaded_days(outcomes: DataFrame) -> tuple[dt.date, ...]:
    """The days with a row to load: one value per day."""
    done = outcomes.where(F.col("status") == fv.LEDGER_DONE)
    return tuple(source_days(done.select(F.explode("days").alias("day")), "day"))


def _errors(job: LoadJob, rows: DataFrame, failed: DataFrame) -> DataFrame:
    file = F.col("gcs_path")
    per_file = account_errors(failed, job.process, "FileError", F.col("error"), file=file)
    per_row = account_errors(bad_rows(rows), job.process, "RowError", F.col("row_error"), F.col("item_id"), "item", file=file)
    return per_file.unionByName(per_row)
