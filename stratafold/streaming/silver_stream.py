"""The silver load as a file stream.

The stream's checkpoint offers each file once; every micro-batch goes through
the same gate, upsert and ledger as the batch load, so a replayed batch changes
nothing. A failed file is not offered again there; ``stream_retries`` is the stream
of those, whose offsets come from the ledger.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratafold import fixed_values as fv
from stratafold.functions.paths import part, path_parts
from stratafold.operators.commit import source_days
from stratafold.operators.ledger import FILE_KEY, load_counters
from stratafold.operators.normalise import normaliser_for
from stratafold.plans.lake import Lake, staging
from stratafold.plans.silver_load import LoadJob, insight_load, listed_files, load_due, load_rows
from stratafold.sources.listing import ARRAY, day_glob
from stratafold.sources.raw_files import read_items
from stratafold.streaming.ledger_source import FORMAT, FailedFiles


def stream_files(
    lake: Lake,
    checkpoint: str,
    run_ts: dt.datetime,
    *,
    job: LoadJob | None = None,
    platform: str = fv.PLATFORM,
    layout: str = ARRAY,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Load every raw file not seen before, in bounded batches, then stop."""
    job = job or insight_load()
    normalise = normaliser_for(platform, job.normalisers)
    if normalise is None:
        raise ValueError(f"no normaliser for platform {platform}")
    reader_glob = day_glob(lake.root, platform, job.kind, "*", layout)
    items = read_items(
        lake.spark, reader_glob, job.fields, layout, streaming=True, files_per_batch=files_per_batch
    ).withColumn("platform", F.lit(platform))

    def apply(batch: DataFrame, _batch_id: int) -> None:
        with staging(lake.spark) as stage:
            rows, counted = stage.write_counted([normalise(batch)], "stream-rows", load_counters(job.spec.schema))
            load_rows(lake, job, rows, counted, run_ts)

    return (
        items.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_retries(lake: Lake, checkpoint: str, run_ts: dt.datetime, *, job: LoadJob | None = None) -> StreamingQuery:
    """Load the files again that have failed, each once, then stop.

    Which they are the ledger says, so a mended file is loaded without a batch run;
    one that is still at fault fails again and is offered by the next run.
    """
    job = job or insight_load()
    lake.spark.dataSource.register(FailedFiles)
    failed = lake.spark.readStream.format(FORMAT).option("ledger", lake.ledger.path).load()
    mine = failed.where(part(path_parts(F.col("gcs_path")), 4) == job.kind)

    def apply(batch: DataFrame, _batch_id: int) -> None:
        with staging(lake.spark) as stage:
            keys = stage.write(batch.distinct(), "failed-files")
            days = source_days(keys, "fecha_archivo")
            if days:
                files = listed_files(lake, job, days)
                load_due(lake, job, files.join(keys, list(FILE_KEY), "left_semi"), run_ts)

    return (
        mine.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
