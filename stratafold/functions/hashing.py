"""The row hash that tells a corrected row from an unchanged one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "|"
NULL_MARK = "\\N"


def canonical_text(column: Column, data_type: T.DataType) -> Column:
    """Text that differs whenever the value does; NULL has a mark of its own."""
    if isinstance(data_type, T.StringType):
        text = F.replace(
            F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\" + SEPARATOR)
        )
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = (column + F.lit(0.0)).cast("string")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """MD5 over the named columns in name order, so that the caller's order is free."""
    types = {field.name: field.dataType for field in df.schema.fields}
    parts = [canonical_text(F.col(name), types[name]) for name in sorted(columns)]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
