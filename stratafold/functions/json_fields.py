"""Reading JSON fields whose key may be missing, null or present.

Fields arrive as VARIANT columns: SQL NULL when the key is missing, a VARIANT
null when it holds JSON null. ``open_scalars`` turns each into a kind and a text
once; the readers below work on those two columns only, so a field is taken out
of its VARIANT a single time however many rules look at it.

Each reader returns ``(value, may_be_null)``: a NULL value is an error unless the
state of the field allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold import fixed_values as fv
from stratafold.functions.times import parse_instant

DIGITS = r"\d+(_\d+)*"
GROUPED_INTEGER = r"^[+-]?\d+(_\d+)+$"
DECIMAL_TEXT = (
    rf"^\s*[+-]?(({DIGITS})(\.({DIGITS})?)?|\.{DIGITS})([eE][+-]?{DIGITS})?\s*$"
    r"|^\s*[+-]?(?i:inf|infinity|nan)\s*$"
)
DAY_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"


@dataclass(frozen=True)
class Field:
    """A scalar field after ``open_scalars``."""

    name: str

    @property
    def kind(self) -> Column:
        """STRING, BOOLEAN, BIGINT, DECIMAL(..), VOID for null, NULL when missing, ..."""
        return F.col(f"kind_{self.name}")

    @property
    def text(self) -> Column:
        return F.col(f"text_{self.name}")

    @property
    def missing(self) -> Column:
        return self.kind.isNull()

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"


def open_scalars(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """Adds kind and text of each VARIANT column, named after the given keys."""
    columns = {}
    for name, variant in fields.items():
        columns[f"kind_{name}"] = F.schema_of_variant(variant)
        columns[f"text_{name}"] = variant.cast("string")
    return df.withColumns(columns)


def _bare(text: Column) -> Column:
    """Text without the white space around it that a number may have."""
    return F.btrim(text, F.lit(fv.WHITE_SPACE))


def _without_groups(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def to_integer(field: Field) -> Column:
    """Whole-number text, or a number cut to its whole part; NULL otherwise.

    A cast to a whole number that fails costs some hundred times one that
    succeeds, even as ``try_cast``, so only text made of digits is cast.
    """
    text = _bare(field.text)
    digits = (text != "") & (F.translate(text, "0123456789+-", "") == "")
    grouped = F.contains(text, F.lit("_")) & text.rlike(GROUPED_INTEGER)
    from_text = F.when(digits, text.try_cast("bigint")).when(grouped, _without_groups(text).try_cast("bigint"))
    return (
        F.when(field.is_text, from_text)
        .when(field.kind == "BIGINT", text.try_cast("bigint"))
        .when(field.kind == "BOOLEAN", (text == "true").cast("bigint"))
        .otherwise(text.try_cast("double").try_cast("bigint"))
    )


def to_number(field: Field) -> Column:
    """Decimal text or a number as a double; NULL otherwise.

    The JVM also reads a type suffix and hexadecimal digits as part of a number;
    only text that could hold those, or digit groups, is checked by pattern.
    """
    text = _bare(field.text)
    checked = F.when(text.rlike(DECIMAL_TEXT), _without_groups(text).try_cast("double"))
    unusual = F.lower(F.right(text, F.lit(1))).isin("d", "f") | (F.translate(text, "xX_", "") != text)
    return (
        F.when(field.is_text, F.when(unusual, checked).otherwise(text.try_cast("double")))
        .when(field.kind == "BOOLEAN", (text == "true").cast("double"))
        .otherwise(text.try_cast("double"))
    )


def is_falsy(field: Field) -> Column:
    """Missing, null, empty text, zero, false, empty list or empty object."""
    zero = F.coalesce(field.text.try_cast("double") == 0, F.lit(False))
    empty = F.when(field.is_text, field.text == "").otherwise(field.text.isin("false", "[]", "{}") | zero)
    return field.text.isNull() | empty


def integer_or_zero(field: Field) -> tuple[Column, Column]:
    return F.when(field.missing, F.lit(0).cast("bigint")).otherwise(to_integer(field)), F.lit(False)


def number_or_zero(field: Field) -> tuple[Column, Column]:
    return F.when(field.missing, F.lit(0.0)).otherwise(to_number(field)), F.lit(False)


def cents_or_null(field: Field, per_unit: int) -> tuple[Column, Column]:
    """An amount in cents as units; anything falsy is no amount."""
    falsy = is_falsy(field)
    return F.when(~falsy, to_number(field) / F.lit(float(per_unit))), falsy


def instant_or_null(field: Field) -> tuple[Column, Column]:
    return F.when(field.is_text, parse_instant(field.text)), is_falsy(field)


def flag_or_false(field: Field) -> tuple[Column, Column]:
    """False when missing, NULL when null; text must read true or false."""
    word = F.lower(F.trim(field.text))
    value = (
        F.when(field.missing, F.lit(False))
        .when(field.is_text | (field.kind == "BOOLEAN"), F.when(word.isin("true", "false"), word == "true"))
        .otherwise(field.text.try_cast("double") != 0)
    )
    return value, field.kind == "VOID"


def day_required(field: Field) -> tuple[Column, Column]:
    return F.when(field.text.rlike(DAY_TEXT), field.text.try_cast("date")), F.lit(False)


@dataclass(frozen=True)
class Rule:
    """How one output column is read: its source field, reader and complaint."""

    column: str
    field: str
    read: object
    complaint: str


def read_fields(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds each rule's column and, in a second step, its ``error_`` column.

    Two steps keep every value computed once: the errors only look at them.
    """
    values, allowed = {}, {}
    for rule in rules:
        value, may_be_null = rule.read(Field(rule.field))
        values[rule.column] = value
        allowed[f"null_ok_{rule.column}"] = may_be_null
    read = df.withColumns({**values, **allowed})
    return read.withColumns(
        {
            f"error_{r.column}": F.when(
                F.col(r.column).isNull() & ~F.col(f"null_ok_{r.column}"), F.lit(f"{r.field}: {r.complaint}")
            )
            for r in rules
        }
    )


def first_error(rules: Sequence[Rule]) -> Column:
    """The first complaint in rule order, NULL when there is none."""
    return F.coalesce(*[F.col(f"error_{r.column}") for r in rules], F.lit(None).cast("string"))
