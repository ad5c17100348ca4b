"""Paths of the raw layer: ``raw/{source}/{kind}/{account}/{day}/data.json``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratafold import fixed_values as fv


def raw_path(source: Column, kind: Column, account: Column, day: Column) -> Column:
    """The path of one account and day; the source is lower case in paths."""
    return F.concat_ws(
        "/", F.lit("raw"), F.lower(source), kind, account, F.date_format(day, "yyyy-MM-dd"), F.lit(fv.RAW_FILE_NAME)
    )


def clean_path(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def _decoded(text: Column) -> Column:
    """Percent escapes undone; a plus sign is just that."""
    plain = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), plain).otherwise(text)


def path_parts(path: Column) -> Column:
    return F.split(clean_path(path), "/")


def uri_parts(uri: Column) -> Column:
    """Parts of a path that comes as a URI, such as ``_metadata.file_path``."""
    return F.split(_decoded(uri), "/")


# what a part is called where folders carry ``name=`` prefixes, by position from the end
PART_NAMES = {5: "source", 4: "tipo", 3: "id", 2: "fecha"}


def part(parts: Column, from_end: int) -> Column:
    """A part counted from the end (1 is the file name), without its ``name=``.

    Where folders carry names, the account and the day may stand in either order.
    """
    prefix = PART_NAMES[from_end] + "="
    here = F.try_element_at(parts, F.lit(-from_end))
    named = lambda p: _decoded(F.substr(p, F.lit(len(prefix) + 1)))
    chosen = F.when(here.startswith(prefix), named(here))
    if from_end in (2, 3):
        other = F.try_element_at(parts, F.lit(from_end - 5))
        chosen = chosen.when(other.startswith(prefix), named(other))
    return chosen.otherwise(here)


def part_account(parts: Column) -> Column:
    return part(parts, 3)


def part_day(parts: Column) -> Column:
    return part(parts, 2).try_cast("date")


def file_key(parts: Column) -> Column:
    """The name of one file in the ledger, whichever layout it lies in."""
    return F.concat_ws("/", F.lit("raw"), *[part(parts, n) for n in (5, 4, 3, 2)], F.element_at(parts, -1))


def canonical_path(parts: Column) -> Column:
    """One name for an account and day, however many part files hold it."""
    return F.concat_ws("/", F.lit("raw"), *[part(parts, n) for n in (5, 4, 3, 2)], F.lit(fv.RAW_FILE_NAME))
