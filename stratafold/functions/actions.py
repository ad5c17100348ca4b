"""Reading the value of one action type out of an action list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.json_fields import Field, open_scalars, to_integer, to_number

ACTION_LIST = "array<struct<action_type:string,value:variant>>"


def first_value(items: Column, action_type: str = fv.PURCHASE) -> Column:
    """``value`` of the first struct with this ``action_type``; NULL without one."""
    match = F.get(F.filter(items, lambda x: x["action_type"] == action_type), F.lit(0))
    return match["value"]


def open_actions(df: DataFrame, fields: Sequence[str], item: str = "item", action_type: str = fv.PURCHASE) -> DataFrame:
    """Adds, per list field, where reading stops and the value found there.

    Reading stops at the first match, or at an element that is not an object
    (NULL after the cast); elements behind that are never looked at.
    """
    def stops_here(x: Column) -> Column:
        return x.isNull() | F.coalesce(x["action_type"] == action_type, F.lit(False))

    lists = df.withColumns(
        {
            f"stops_{f}": F.filter(F.try_variant_get(F.col(item)[f], "$", ACTION_LIST), stops_here)
            for f in fields
        }
    )
    # only a field that is no list is looked at as a whole
    shapes = lists.withColumns(
        {f"shape_{f}": F.when(F.col(f"stops_{f}").isNull(), F.to_json(F.col(item)[f])) for f in fields}
    )
    return open_scalars(shapes, {f: F.get(F.col(f"stops_{f}"), F.lit(0))["value"] for f in fields})


def first_action(field: Field, *, money: bool) -> tuple[Column, Column]:
    """Value of the first matching element, after ``open_actions``.

    No match, a missing list and a match without ``value`` all count as zero; a
    null list, an element that is not an object and an unreadable value are errors.
    """
    stops, shape = F.col(f"stops_{field.name}"), F.col(f"shape_{field.name}")
    zero = F.lit(0.0) if money else F.lit(0).cast("bigint")
    no_list = F.when(shape.isNull() | shape.isin('""', "{}"), zero)
    found = F.when(F.get(stops, F.lit(0)).isNull(), F.lit(None)).when(field.missing, zero)
    value = (
        F.when(stops.isNull(), no_list)
        .when(F.size(stops) == 0, zero)
        .otherwise(found.otherwise(to_number(field) if money else to_integer(field)))
    )
    return value, F.lit(False)
