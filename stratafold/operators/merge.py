"""The keyed upsert every layer uses.

``merge`` compares a target with a source on a key and gives the whole new
target plus an ``action`` per row: ``keep`` (target only), ``noop`` (matched,
condition not met), ``update`` or ``insert``. Conditions and assignments name
the two sides ``t`` and ``s``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, NOOP, UPDATE, INSERT = "keep", "noop", "update", "insert"

# How several source rows with one key are handled.
ERROR, LATEST, UNIQUE = "error", "latest", "unique"


@dataclass(frozen=True)
class MergeRule:
    """Keys, the matched condition and the two assignments of an upsert.

    ``when``: SQL or Column; NULL counts as not met; ``None`` updates always.
    ``update`` / ``insert``: target column -> SQL or Column. Target columns not
    named keep their value on update and are NULL on insert; ``insert=None``
    leaves unmatched source rows out.
    ``on_duplicate``: ``error`` fails the job, ``latest`` takes the row that is
    last by ``order_by``, ``unique`` trusts the caller.
    """

    keys: tuple[str, ...]
    update: Mapping[str, str | Column]
    insert: Mapping[str, str | Column] | None = None
    when: str | Column | None = None
    on_duplicate: str = ERROR
    order_by: tuple[str, ...] = field(default=())


def same_name(columns: Sequence[str]) -> dict[str, str]:
    """Assign source columns to target columns of the same name."""
    return {c: f"s.{c}" for c in columns}


def _column(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def one_row_per_key(source: DataFrame, rule: MergeRule) -> DataFrame:
    """The source with the rule for duplicate keys applied.

    Both variants aggregate before the shuffle, so one key with very many rows
    is reduced where it lies.
    """
    if rule.on_duplicate == UNIQUE:
        return source
    others = [c for c in source.columns if c not in rule.keys]
    row = F.struct(*others)
    if rule.on_duplicate == LATEST:
        picked = source.groupBy(*rule.keys).agg(F.max_by(row, F.struct(*rule.order_by)).alias("row"))
    else:
        counted = source.groupBy(*rule.keys).agg(F.any_value(row).alias("row"), F.count("*").alias("n"))
        message = F.concat(
            F.lit("more than one source row for key "),
            F.concat_ws(", ", *[F.col(k).cast("string") for k in rule.keys]),
        )
        single = F.when(F.col("n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        picked = counted.where(single)
    return picked.select(*rule.keys, "row.*").select(*source.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    rule: MergeRule,
    *,
    null_keys: bool = False,
    broadcast_source: bool = False,
) -> DataFrame:
    """The new target with an ``action`` column.

    ``null_keys``: the inputs may hold NULL keys. Those match nothing, so they
    bypass the join (source rows are inserted, target rows kept) and cannot pile
    up in one task. ``broadcast_source``: the caller has counted the source and
    found it small; the target is then not shuffled at all.
    """
    keys = list(rule.keys)
    loose = []
    if null_keys:
        loose.append(_merged(target.where(_any_null(keys)), None, target.columns, rule))
        if rule.insert is not None:
            loose.append(_merged(None, source.where(_any_null(keys)), target.columns, rule))
        target, source = target.dropna(subset=keys), source.dropna(subset=keys)
    source = one_row_per_key(source, rule)
    if rule.insert is None:
        parts = [_merged(target, source, target.columns, rule, how="left", small=broadcast_source)]
    elif broadcast_source:
        known = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
        fresh = source.join(known, keys, "left_anti")
        parts = [
            _merged(target, source, target.columns, rule, how="left", small=True),
            _merged(None, fresh, target.columns, rule),
        ]
    else:
        parts = [_merged(target, source, target.columns, rule)]
    return reduce(DataFrame.unionByName, parts + loose)


def _merged(
    target: DataFrame | None,
    source: DataFrame | None,
    columns: Sequence[str],
    rule: MergeRule,
    how: str = "full_outer",
    small: bool = False,
) -> DataFrame:
    """One branch of the merge; a missing side means nothing there can match."""
    if source is None:
        return target.withColumn("action", F.lit(KEEP))

    def inserted(column: str) -> Column:
        return _column((rule.insert or {}).get(column, "NULL"))

    if target is None:
        values = [inserted(c).alias(c) for c in columns]
        return source.alias("s").select(*values, F.lit(INSERT).alias("action"))

    t = target.withColumn("in_target", F.lit(True)).alias("t")
    s = source.withColumn("in_source", F.lit(True)).alias("s")
    if small:
        s = F.broadcast(s)
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in rule.keys])
    met = F.lit(True) if rule.when is None else F.coalesce(_column(rule.when), F.lit(False))
    action = (
        F.when(F.col("s.in_source").isNull(), KEEP)
        .when(F.col("t.in_target").isNull(), INSERT)
        .when(met, UPDATE)
        .otherwise(NOOP)
    )

    def value(column: str) -> Column:
        current = F.col(f"t.{column}")
        chosen = F.when(F.col("action") == INSERT, inserted(column))
        if column in rule.update:
            chosen = chosen.when(F.col("action") == UPDATE, _column(rule.update[column]))
        return chosen.otherwise(current).alias(column)

    return t.join(s, on, how).withColumn("action", action).select(*[value(c) for c in columns], "action")
