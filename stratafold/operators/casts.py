"""Cast projections: a value that cannot be cast fails the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.schemas import TableSpec


def cast_to(df: DataFrame, spec: TableSpec, *left_out: str, extra: Sequence[str] = ()) -> DataFrame:
    """The table's columns in its types, without those filled while writing.

    ``extra`` columns are passed on as they are.
    """
    cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name not in left_out]
    return df.select(*cast, *extra)
