"""The load ledger: which files are still to be loaded, and how they ended."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratafold import fixed_values as fv
from stratafold.functions.paths import canonical_path, part, path_parts
from stratafold.operators.commit import text_bytes
from stratafold.operators.normalise import BAD, GOOD

FILE_KEY = ("gcs_path", "fecha_archivo")


def not_yet_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files without a completed ledger entry for their path and day."""
    done = ledger.where(F.col("status") == fv.LEDGER_DONE).select(*FILE_KEY)
    return files.join(done, list(FILE_KEY), "left_anti")


def unfinished(ledger: DataFrame, kind: str, before: dt.date) -> DataFrame:
    """Ledger entries of earlier days that never completed."""
    return ledger.where(
        (F.col("status") != fv.LEDGER_DONE)
        & (F.col("fecha_archivo") < F.lit(before))
        & (part(path_parts(F.col("gcs_path")), 4) == kind)
    )


def load_counters(schema: StructType) -> dict[str, Column]:
    """What a load counts of its rows while it writes them: bad rows, and the bytes of text of the good ones.

    ``schema``: the columns that good rows bring into a table.
    """
    width = text_bytes(schema) + F.octet_length("gcs_path")
    return {"bad": F.count_if(F.expr(BAD)), "text": F.sum(F.when(F.expr(GOOD), width))}


def file_outcomes(rows: DataFrame, keys: Sequence[str], day: str | None = None) -> DataFrame:
    """Per file: its good rows and their days in column ``day``, the error that fails it, its next status.

    A file with two good rows for one key fails, since its merge would be
    ambiguous; the other files go on. The rows are read once: rows of one key are
    counted where they lie, then keys are summed up by file. Rows without a good
    item share one empty key per file and shrink before the shuffle.
    """
    if day and day not in keys:
        raise ValueError(f"the key {keys} does not hold the day {day}")
    good = F.expr(GOOD)
    names = {k: f"key_{i}" for i, k in enumerate(keys)}
    per_file = (
        rows.select(
            *FILE_KEY, "account_id", "platform", "file_error", good.alias("good"),
            *[F.when(good, F.col(k)).alias(name) for k, name in names.items()],
        )
        .groupBy(*FILE_KEY, "account_id", "platform", *names.values())
        .agg(F.count_if("good").alias("n"), F.min("file_error").alias("file_error"))
        .groupBy(*FILE_KEY, "account_id", "platform")
        .agg(
            F.sum("n").alias("n_good"), F.max("n").alias("most"), F.min("file_error").alias("file_error"),
            F.collect_set(names[day] if day else F.lit(None).cast("date")).alias("days"),
        )
    )
    error = F.coalesce("file_error", F.when(F.col("most") > 1, F.lit("more than one row for a key")))
    return (
        per_file.withColumn("error", error)
        .withColumn("status", F.when(F.col("error").isNull(), fv.LEDGER_DONE).otherwise(fv.LEDGER_FAILED))
        .drop("file_error", "most")
    )


def account_days(ledger: DataFrame) -> DataFrame:
    """The ledger by account and day: complete once all of its files are, failed if any has."""
    named = ledger.withColumn("gcs_path", canonical_path(path_parts(F.col("gcs_path"))))
    done, failed = (F.col("status") == s for s in (fv.LEDGER_DONE, fv.LEDGER_FAILED))
    status = F.when(F.bool_and(done), fv.LEDGER_DONE).when(F.bool_or(failed), fv.LEDGER_FAILED).otherwise(F.min("status"))
    return named.groupBy("gcs_path", "business_line", "entity_id", "fecha_archivo").agg(
        status.alias("status"),
        F.max("fecha_carga").alias("fecha_carga"),
        F.min("error_mensaje").alias("error_mensaje"),
        F.count("*").alias("files"),
    )
