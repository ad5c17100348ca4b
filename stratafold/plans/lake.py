"""The tables of one lake and the staging of intermediate results."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from stratafold import schemas
from stratafold.session import delete_path, scratch_path
from stratafold.sources.tables import LakeTable


@dataclass(frozen=True)
class Lake:
    """A root folder with the raw files and every table."""

    spark: SparkSession
    root: str

    def table(self, spec: schemas.TableSpec) -> LakeTable:
        return LakeTable(self.spark, self.root, spec)

    def create_tables(self) -> Lake:
        for spec in vars(schemas).values():
            if isinstance(spec, schemas.TableSpec):
                self.table(spec).create()
        return self

    @property
    def errors(self) -> LakeTable:
        return self.table(schemas.ERROR_LOG)

    @property
    def ledger(self) -> LakeTable:
        return self.table(schemas.LOAD_LEDGER)

    @property
    def accounts(self) -> LakeTable:
        return self.table(schemas.ACCOUNTS)

    @property
    def control(self) -> LakeTable:
        return self.table(schemas.EXTRACTION_CONTROL)

    @property
    def subitems(self) -> LakeTable:
        return self.table(schemas.SUBITEMS)

    @property
    def campaigns(self) -> LakeTable:
        return self.table(schemas.CAMPAIGNS)

    @property
    def insights(self) -> LakeTable:
        return self.table(schemas.INSIGHTS)

    @property
    def fact(self) -> LakeTable:
        return self.table(schemas.FACT)

    @property
    def dim_campaigns(self) -> LakeTable:
        return self.table(schemas.DIM_CAMPAIGNS)


class Staging:
    """Intermediate results written once to the shared scratch folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        return self.write_all([df], label)

    def write_all(self, frames: Iterable[DataFrame], label: str) -> DataFrame | None:
        """Frames of one schema as one table, one written after the other; None if there are none."""
        return self.write_counted(frames, label, {})[0]

    def write_counted(
        self, frames: Iterable[DataFrame], label: str, counters: Mapping[str, Column]
    ) -> tuple[DataFrame | None, dict[str, int]]:
        """The same table, and counters that the write itself has observed, summed over the frames.

        ``counters``: aggregates that add up, over all rows. They are taken above the last
        shuffle, where Spark counts every partition once however often a task is repeated.
        """
        path, schema = scratch_path(self.spark, label), None
        self.paths.append(path)
        totals = dict.fromkeys(counters, 0)
        for df in frames:
            schema = df.schema
            if not counters:
                df.write.mode("append").parquet(path)
                continue
            seen = Observation()
            df.observe(seen, *[c.alias(name) for name, c in counters.items()]).write.mode("append").parquet(path)
            totals = {name: n + (seen.get[name] or 0) for name, n in totals.items()}
        return (self.spark.read.schema(schema).parquet(path) if schema else None), totals

    def drop(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """Staged tables that are dropped afterwards, whatever happens."""
    staged = Staging(spark)
    try:
        yield staged
    finally:
        staged.drop()
