"""Applying a merge to a table on disk, as narrowly as the data allows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafold.operators.merge import INSERT, UPDATE, MergeRule, merge
from stratafold.sources.tables import BUCKET, CHANGED, LakeTable, bucket_of, within_days

# A measured source within both bounds is broadcast instead of shuffled.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_TEXT = 32 * 1024 * 1024


@dataclass(frozen=True)
class SourceSize:
    """Rows, bytes of text, and the days of a source: one value per day."""

    rows: int
    text: int
    days: tuple[dt.date, ...] = ()

    @property
    def small(self) -> bool:
        return self.rows <= MAX_BROADCAST_ROWS and self.text <= MAX_BROADCAST_TEXT


def text_size(source: DataFrame) -> Column:
    """Aggregate: bytes in all text columns. The other columns have a fixed width."""
    return F.coalesce(F.sum(text_bytes(source.schema)), F.lit(0)).cast("bigint")


def text_bytes(schema: T.StructType) -> Column:
    """Bytes in a row's text columns."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in texts], F.lit(0))


def measure(source: DataFrame, day: str | None) -> SourceSize:
    size = [F.count("*").alias("n"), text_size(source).alias("text")]
    counted = (source.groupBy(day).agg(*size) if day else source.agg(*size)).collect()
    homeless = sum(r["n"] for r in counted if day and r[day] is None)
    if homeless:
        raise ValueError(f"{homeless} source rows have no {day}")
    days = sorted(r[day] for r in counted) if day else ()
    return SourceSize(sum(r["n"] for r in counted), sum(r["text"] for r in counted), tuple(days))


@dataclass(frozen=True)
class Outcome:
    """Rows per action, where they were counted, and the days or buckets that were rewritten."""

    actions: dict[str, int] = field(default_factory=dict)
    days: tuple[dt.date, ...] = ()
    buckets: tuple[int, ...] = ()

    @property
    def changed(self) -> int:
        return self.actions.get(INSERT, 0) + self.actions.get(UPDATE, 0)


def commit(
    table: LakeTable,
    source: DataFrame,
    rule: MergeRule,
    *,
    compare: bool = True,
    size: SourceSize | None = None,
    marks: Mapping[str, int] | None = None,
) -> Outcome:
    """Merge ``source`` into ``table``.

    ``source`` is read more than once and should be a written table. It is
    measured first, unless the caller knows its ``size``. ``compare=False``
    leaves out the pass that counts the actions and finds what changed, for
    sources in which every row does. ``marks`` become part of the table with the
    rows, or alone if no row changes. A source row without a day of a partitioned
    table is an error. Of a table with buckets only those that hold a source row's key
    are read, so ``keep`` counts their rows alone.
    """
    size = size or measure(source, table.spec.partition)
    outcome = Outcome()
    if size.rows and table.spec.buckets:
        outcome = _commit_buckets(table, source, rule, size.small, marks)
    elif size.rows and table.spec.partition is None:
        outcome = _commit_whole(table, source, rule, size.small, compare, marks)
    elif size.rows:
        outcome = _commit_days(table, source, rule, size.small, compare, size.days, marks)
    if marks:
        table.mark(marks)
    return outcome


def _commit_whole(
    table: LakeTable, source: DataFrame, rule: MergeRule, small: bool, compare: bool, marks: Mapping[str, int] | None
) -> Outcome:
    merged = merge(table.read(), source, rule, broadcast_source=small)
    outcome = Outcome()
    if compare:
        counts = merged.groupBy("action").agg(F.count("*").alias("n")).collect()
        outcome = Outcome({r["action"]: r["n"] for r in counts})
    if outcome.changed or not compare:
        table.publish(merged.drop("action"), marks=marks)
    return outcome


def _commit_buckets(
    table: LakeTable, source: DataFrame, rule: MergeRule, small: bool, marks: Mapping[str, int] | None
) -> Outcome:
    """Rewrite only the buckets that hold an insert or an update.

    Needs no day in the key: the hash of the key says where its row can lie. The
    numbers of buckets go through the driver, one per some 500,000 rows of the table.
    """
    keys = table.spec.buckets
    if not set(keys) <= set(rule.keys):
        raise ValueError(f"the key {rule.keys} does not hold the bucket columns {keys}")
    state = table.manifest()
    place = bucket_of(keys, state.buckets)
    asked = [r[0] for r in source.select(place.alias(BUCKET)).distinct().collect()]
    compared = merge(table.read_buckets(asked, state), source, rule, broadcast_source=small)
    counts = compared.groupBy(place.alias(BUCKET), "action").agg(F.count("*").alias("n")).collect()
    actions: dict[str, int] = {}
    for r in counts:
        actions[r["action"]] = actions.get(r["action"], 0) + r["n"]
    touched = tuple(sorted({r[BUCKET] for r in counts if r["action"] in (UPDATE, INSERT)}))
    if touched:
        mine = source.where(place.isin(list(touched)))
        merged = merge(table.read_buckets(touched, state), mine, rule, broadcast_source=small)
        table.publish_buckets(merged.drop("action"), state, actions.get(INSERT, 0), marks=marks)
    return Outcome(actions, buckets=touched)


def source_days(source: DataFrame, column: str) -> list[dt.date]:
    """The days of a source: one value per day, whatever its size."""
    return sorted(r[0] for r in source.select(column).where(F.col(column).isNotNull()).distinct().collect())


def _commit_days(
    table: LakeTable,
    source: DataFrame,
    rule: MergeRule,
    small: bool,
    compare: bool,
    days: Sequence[dt.date],
    marks: Mapping[str, int] | None,
) -> Outcome:
    """Rewrite only the days that hold an insert or an update.

    A first pass over the keys and the compared columns of the source's days
    finds them; a second pass merges and writes just those. The key must hold
    the partition column or determine it.
    """
    day = table.spec.partition
    actions: dict[str, int] = {}
    touched = tuple(days)
    if compare:
        compared = merge(table.read(days), source, rule, broadcast_source=small)
        counts = compared.groupBy(day, "action").agg(F.count("*").alias("n")).collect()
        for r in counts:
            actions[r["action"]] = actions.get(r["action"], 0) + r["n"]
        touched = tuple(sorted({r[day] for r in counts if r["action"] in (UPDATE, INSERT)}))
    if touched:
        merged = merge(table.read(touched), within_days(source, day, touched), rule, broadcast_source=small)
        if table.spec.feed:
            merged = merged.withColumn(CHANGED, F.col("action").isin(UPDATE, INSERT))
        table.publish(merged.drop("action"), marks=marks)
    return Outcome(actions, touched)
