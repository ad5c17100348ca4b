"""Numbering rows in order within groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafold.llm.shared import Stages, column

# Rows of a task are numbered below its partition's number.
LOCAL_BITS = 40

ADDED = (
    ("row", T.LongType(), pa.int64()),
    ("part", T.IntegerType(), pa.int32()),
    ("rank", T.LongType(), pa.int64()),
    ("before", T.LongType(), pa.int64()),
)


def numbered(rows: DataFrame, group: str, order: Sequence[str], stages: Stages, weight: str | None = None) -> DataFrame:
    """``rows`` with their place in their group, in ascending ``order`` (nulls first).

    Adds ``row`` (unique), ``rank`` (rows of the group before), ``before`` (the sum of
    ``weight`` over those), ``group_rows`` and ``group_weight``. ``group`` must not be
    null. Rows are dealt by range over group, order and their place in the input, so
    neither a large group nor a row repeated very often meets in one task; the
    ranges' sums give each its offset. ``rows`` should be a written table with none
    of the added names.
    """
    keys = [group, *order, "tie"]
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, t, _ in ADDED)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row, now, rank, before = part << LOCAL_BITS, None, 0, 0
        for batch in batches:
            ranks, sums = [], []
            weights = column(batch, weight) if weight else [0] * batch.num_rows
            for name, size in zip(column(batch, group), weights):
                if name != now:
                    now, rank, before = name, 0, 0
                ranks.append(rank)
                sums.append(before)
                rank += 1
                before += size
            found = [range(row, row + batch.num_rows), [part] * batch.num_rows, ranks, sums]
            row += batch.num_rows
            arrays = [pa.array(values, kind) for values, (_, _, kind) in zip(found, ADDED)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *(n for n, _, _ in ADDED)])

    local = stages.write(ranged.mapInArrow(counted, schema), "numbered")
    own = F.sum(weight) if weight else F.lit(0).cast("long")
    sums = local.groupBy("part", group).agg(F.count("*").alias("n"), own.alias("w"))
    earlier = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(group)
    offsets = sums.select(
        "part",
        group,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("weight_before"),
        F.sum("n").over(whole).alias("group_rows"),
        F.sum("w").over(whole).alias("group_weight"),
    )
    placed = local.join(offsets, ["part", group])
    return placed.withColumns(
        {"rank": F.col("rank") + F.col("rows_before"), "before": F.col("before") + F.col("weight_before")}
    ).drop("part", "rows_before", "weight_before")
