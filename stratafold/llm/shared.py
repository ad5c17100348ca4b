"""Helpers of the operators: column picking, staging, literals, integer text."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.session import delete_path, scratch_path

# Documents handed to Python at a time, so that a batch of long texts stays small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The document id, the whole text (null: empty) and further columns, nothing else."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *more)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark deletes the shuffle files of each query when it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


class Stages:
    """Intermediate tables in the shared folder, which survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, label: str) -> DataFrame:
        return self.at(df, label)[0]

    def at(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(self.spark, label)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        delete_path(self.spark, path)


def sorted_join(df: DataFrame) -> DataFrame:
    """Marks one side of a join as too large to broadcast.

    Spark sizes exploded rows as those they come from, and a written table by its
    compressed files, so either may be sent through the driver many times its size.
    """
    return df.hint("merge")


def literal_array(values: list[int], kind: str = "int") -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def encoded_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 of each text without decoding it first; a null is empty."""
    return (text or b"" for text in batch.column(name).cast(pa.binary()).to_pylist())
