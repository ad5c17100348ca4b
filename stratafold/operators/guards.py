"""Checks that stop a write, since Parquet enforces none of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_column(required: Sequence[str]) -> Column:
    """Name of the first required column that is NULL in a row, or NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required], F.lit(None).cast("string"))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same rows; the job fails if a required column is NULL in any of them."""
    if not required:
        return df
    message = F.concat(F.lit("required column is NULL: "), missing_column(required))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def split_missing(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that can be written, and the others with the column at fault."""
    marked = df.withColumn("missing_column", missing_column(required))
    return (
        marked.where("missing_column IS NULL").drop("missing_column"),
        marked.where("missing_column IS NOT NULL"),
    )
