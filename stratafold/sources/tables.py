"""Parquet tables whose content is switched by a manifest.

Each write goes to a folder of its own below ``data`` and becomes part of the
table through a numbered manifest, which names the folders that make it up: one
list for the table, or one for each day or bucket. A bucket holds the rows whose
key has one hash modulo the number of buckets, which the manifest names and which
doubles as the table grows. A manifest is
put in place whole, which fails if that number has been taken. So a writer that dies leaves either the old table or the new one, a byte
is written once, and readers only read. Folders that no manifest names any more
stay until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafold.functions.times import instant_literal, utc_date
from stratafold.operators.guards import require_columns
from stratafold.schemas import DEFAULT_NOW, DEFAULT_UUID, TableSpec
from stratafold.session import delete_path, list_names, make_dirs, read_text, write_new_text

WHOLE = ""

# A table with buckets begins with so many; beyond so many rows in each they double.
FIRST_BUCKETS = 16
BUCKET_ROWS = 500_000
BUCKET = "lake_bucket"
DAY = "lake_day"
# Of a table with a feed, the rows that a write has changed lie in files of their own.
CHANGED = "lake_changed"


def bucket_of(keys: Iterable[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def with_defaults(df: DataFrame, spec: TableSpec, run_ts: dt.datetime) -> DataFrame:
    """Add the columns a source leaves out: their default, or NULL."""
    defaults = dict(spec.defaults)
    columns = []
    for field_ in spec.schema.fields:
        if field_.name in df.columns:
            column = F.col(field_.name)
        elif defaults.get(field_.name) == DEFAULT_UUID:
            column = F.expr("uuid()")
        elif defaults.get(field_.name) == DEFAULT_NOW:
            column = instant_literal(run_ts)
        else:
            column = F.lit(defaults.get(field_.name))
        columns.append(column.cast(field_.dataType).alias(field_.name, metadata=field_.metadata))
    return df.select(*columns)


def within_days(df: DataFrame, column: str, days: Iterable[dt.date] | None) -> DataFrame:
    """Rows of the given days, however many."""
    if days is None:
        return df
    days = sorted(set(days))
    return df.where(F.col(column).isin([F.lit(day) for day in days]) if days else F.lit(False))


def _joined(old: Mapping[str, list[str]], new: Mapping[str, list[str]]) -> dict[str, list[str]]:
    """Folders by day or bucket with further ones added."""
    return {**old, **{d: [*old.get(d, []), *f] for d, f in new.items()}}


@dataclass(frozen=True)
class Manifest:
    """The folders of a table by day or bucket (one entry for a table with neither), and marks.

    A mark is the number of another table's manifest that has been taken in. A table
    with buckets has their number and that of its rows; ``apart`` names the folders of
    the rows that are kept a second time.
    """

    number: int = 0
    folders: Mapping[str, list[str]] = field(default_factory=dict)
    marks: Mapping[str, int] = field(default_factory=dict)
    buckets: int = FIRST_BUCKETS
    rows: int = 0
    apart: Mapping[str, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class LakeTable:
    """A table of the lake: a specification and the folder that holds it."""

    spark: SparkSession
    root: str
    spec: TableSpec

    @property
    def path(self) -> str:
        return f"{self.root}/{self.spec.name}"

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifests"

    def create(self, *, replace: bool = False) -> LakeTable:
        if replace:
            delete_path(self.spark, self.path)
        make_dirs(self.spark, self._data)
        make_dirs(self.spark, self._manifests)
        return self

    def _numbers(self) -> list[int]:
        names = list_names(self.spark, self._manifests)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _manifest_path(self, number: int) -> str:
        return f"{self._manifests}/{number:012d}.json"

    def manifest(self, number: int | None = None) -> Manifest:
        """The current manifest, or the one of a number; an empty one where there is none."""
        known = self._numbers()
        number = (known[-1] if known else 0) if number is None else number
        if number not in known:
            return Manifest()
        stored = json.loads(read_text(self.spark, self._manifest_path(number)))
        return Manifest(number, stored["folders"], stored["marks"], stored.get("buckets", FIRST_BUCKETS), stored.get("rows", 0), stored.get("apart", {}))

    def read(self, days: Iterable[dt.date] | None = None, *, number: int | None = None) -> DataFrame:
        """The rows, or those of some days of a partitioned table, now or at a manifest's number."""
        folders = self.manifest(number).folders
        if days is None:
            chosen = [f for listed in folders.values() for f in listed]
        else:
            chosen = [f for day in sorted(set(days)) for f in folders.get(day.isoformat(), [])]
        return self._read(chosen)

    def read_buckets(self, buckets: Iterable[int], manifest: Manifest) -> DataFrame:
        """The rows of some buckets of a manifest's."""
        return self._read([f for b in sorted(set(buckets)) for f in manifest.folders.get(str(b), [])])

    def read_apart(self) -> DataFrame:
        """The rows that the specification keeps apart, and no others are read."""
        return self._read([f for listed in self.manifest().apart.values() for f in listed])

    def _read(self, chosen: list[str], *, changed: bool = False) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], self.spec.schema)
        reader = self.spark.read.schema(self.spec.schema).option("basePath", self._data)
        rows = reader.parquet(*[f"{self._data}/{f}" for f in chosen])
        return (rows.where(F.col(CHANGED) == "true") if changed else rows).select(*self.spec.columns)

    def days_changed_since(self, number: int) -> list[dt.date] | None:
        """The days whose folders differ from an earlier manifest's; None if that one is gone."""
        now, then = self.manifest(), self.manifest(number)
        if then.number != number:
            return None
        changed = {d for d in {*now.folders, *then.folders} if now.folders.get(d) != then.folders.get(d)}
        return sorted(dt.date.fromisoformat(d) for d in changed)

    def changes_since(self, number: int, until: int) -> DataFrame | None:
        """The rows that the writes after one manifest, up to another, have changed, as they are then.

        Only files of changed rows are read. None if a manifest between is gone.
        """
        known = set(self._numbers())
        if not set(range(max(number, 1), until + 1)) <= known:
            return None
        steps, before = [], self.manifest(number) if number else Manifest()
        for k in range(number + 1, until + 1):
            now = self.manifest(k)
            fresh = [f for d, listed in now.folders.items() for f in listed if f not in before.folders.get(d, [])]
            if fresh:
                steps.append(self._read(fresh, changed=True).withColumn("lake_step", F.lit(k)))
            before = now
        if not steps:
            return self._read([])
        if len(steps) == 1:
            return steps[0].drop("lake_step")
        # a row changed twice as the later write left it
        keys = list(self.spec.feed)
        others = [c for c in self.spec.columns if c not in keys]
        latest = reduce(DataFrame.unionByName, steps).groupBy(*keys).agg(F.max_by(F.struct(*others), "lake_step").alias("row"))
        return latest.select(*keys, "row.*").select(*self.spec.columns)

    def _split(self, df: DataFrame, buckets: int) -> DataFrame:
        """The rows with the column that says in which folder each lies."""
        if self.spec.buckets:
            return df.withColumn(BUCKET, bucket_of(self.spec.buckets, buckets))
        if self.spec.feed and CHANGED not in df.columns:
            df = df.withColumn(CHANGED, F.lit(True))
        return df.withColumn(DAY, utc_date(F.col(self.spec.day_of))) if self.spec.day_of else df

    @property
    def _folder(self) -> str | None:
        return BUCKET if self.spec.buckets else DAY if self.spec.day_of else self.spec.partition

    def _laid_out(self, df: DataFrame) -> DataFrame:
        """Even files: folders share or split tasks by size, rows lie in cluster order."""
        by = [self._folder] if self._folder else list(self.spec.cluster)
        even = df.hint("rebalance", *by) if by else df
        order = [*([self._folder] if self._folder else []), *([CHANGED] if self.spec.feed else []), *self.spec.cluster]
        return even.sortWithinPartitions(*order) if order else even

    def _stage(self, df: DataFrame, buckets: int = FIRST_BUCKETS) -> dict[str, list[str]]:
        """Write rows to a new folder; the folders by day or bucket, not yet part of the table."""
        version = f"version=v{uuid.uuid4().hex}"
        writer = self._laid_out(self._split(df, buckets)).write
        if self._folder is None:
            writer.parquet(f"{self._data}/{version}")
            return {WHOLE: [version]}
        writer.partitionBy(self._folder, *([CHANGED] if self.spec.feed else [])).parquet(f"{self._data}/{version}")
        prefix = f"{self._folder}="
        names = [n for n in list_names(self.spark, f"{self._data}/{version}") if n.startswith(prefix)]
        return {n.removeprefix(prefix): [f"{version}/{n}"] for n in names}

    def _stage_apart(self, staged: Mapping[str, list[str]]) -> dict[str, list[str]]:
        """Those of the staged rows that are kept a second time, in folders of their own."""
        if not self.spec.apart:
            return {}
        rows = self._read([f for listed in staged.values() for f in listed])
        return self._stage(rows.where(self.spec.apart))

    def _count(self, staged: Mapping[str, list[str]]) -> int:
        """Rows of staged folders, from the files' footers."""
        return self._read([f for listed in staged.values() for f in listed]).count()

    def _stage_grown(self, df: DataFrame, buckets: int) -> tuple[dict[str, list[str]], int, int]:
        """Stage a whole table; its folders, rows, and as many buckets as those rows need."""
        staged = self._stage(df, buckets)
        rows, needed = self._count(staged), buckets
        while rows > needed * BUCKET_ROWS:
            needed *= 2
        if needed > buckets:
            staged = self._stage(self._read([f for listed in staged.values() for f in listed]), needed)
        return staged, rows, needed

    def _switch(
        self,
        old: Manifest,
        folders: Mapping[str, list[str]],
        marks: Mapping[str, int] | None,
        *,
        buckets: int | None = None,
        rows: int | None = None,
        apart: Mapping[str, list[str]] | None = None,
    ) -> None:
        """Make the folders the table, unless another writer has been faster."""
        stored: dict[str, object] = {"folders": dict(folders), "marks": {**old.marks, **(marks or {})}}
        if self.spec.buckets:
            stored |= {"buckets": buckets or old.buckets, "rows": old.rows if rows is None else rows}
        if self.spec.apart:
            stored |= {"apart": dict(old.apart if apart is None else apart)}
        write_new_text(self.spark, self._manifest_path(old.number + 1), json.dumps(stored))

    def publish(self, df: DataFrame, *, marks: Mapping[str, int] | None = None) -> None:
        """Replace the table, or just the partitions found in ``df``.

        ``df`` may read this very table: its folders stay. Rows without a day of a
        partitioned table fail the write like any missing required column. For a table
        with a feed ``df`` may say which rows have changed; otherwise all have.
        """
        old = self.manifest()
        told = [CHANGED] if self.spec.feed and CHANGED in df.columns else []
        checked = self._checked(df.select(*self.spec.columns, *told))
        if self.spec.buckets:
            staged, rows, buckets = self._stage_grown(checked, old.buckets)
            return self._switch(old, staged, marks, buckets=buckets, rows=rows)
        staged = self._stage(checked)
        if not (self.spec.partition or self.spec.day_of):
            return self._switch(old, staged, marks)
        # a day written anew takes its rows kept apart with it
        apart = {d: f for d, f in old.apart.items() if d not in staged} | self._stage_apart(staged)
        self._switch(old, {**old.folders, **staged}, marks, apart=apart)

    def publish_buckets(self, df: DataFrame, old: Manifest, added: int, *, marks: Mapping[str, int] | None = None) -> None:
        """Replace the buckets found in ``df`` with its rows, ``added`` of them new to the table.

        ``df`` was made from the table at ``old``; of two writers from one state one fails.
        Buckets that have grown too large on average are split, all at once.
        """
        staged = {**old.folders, **self._stage(self._checked(df.select(*self.spec.columns)), old.buckets)}
        rows, buckets = old.rows + added, old.buckets
        if rows > buckets * BUCKET_ROWS:
            whole = self._read([f for listed in staged.values() for f in listed])
            staged, rows, buckets = self._stage_grown(whole, 2 * buckets)
        self._switch(old, staged, marks, buckets=buckets, rows=rows)

    def append(self, df: DataFrame, run_ts: dt.datetime) -> None:
        """Add rows, with the table's defaults for what they leave out."""
        old = self.manifest()
        staged = self._stage(self._checked(with_defaults(df, self.spec, run_ts)), old.buckets)
        rows = old.rows + self._count(staged) if self.spec.buckets else None
        self._switch(old, _joined(old.folders, staged), None, rows=rows, apart=_joined(old.apart, self._stage_apart(staged)))

    def mark(self, marks: Mapping[str, int]) -> None:
        """Note what has been taken in when that has changed no row."""
        old = self.manifest()
        if any(old.marks.get(k) != v for k, v in marks.items()):
            self._switch(old, old.folders, marks)

    def _checked(self, df: DataFrame) -> DataFrame:
        day = [self.spec.partition] if self.spec.partition and self.spec.partition not in self.spec.required else []
        return require_columns(df, [*self.spec.required, *day])

    def vacuum(self, keep: int = 2) -> None:
        """Delete manifests but the newest ``keep``, and folders that those do not name.

        For the table's only writer, when no reader holds an older state.
        """
        numbers = self._numbers()
        kept = [self.manifest(n) for n in numbers[-keep:]]
        named = {f.split("/")[0] for m in kept for listed in (*m.folders.values(), *m.apart.values()) for f in listed}
        for number in numbers[:-keep]:
            delete_path(self.spark, self._manifest_path(number))
        for name in list_names(self.spark, self._data):
            if name not in named:
                delete_path(self.spark, f"{self._data}/{name}")
