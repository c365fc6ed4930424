"""What counts as a number, in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text forms accepted as numbers.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^[+-]?\d+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Double value of a number or numeric text, else null; never fails."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def finite(c: Column) -> Column:
    """The value where it is neither NaN nor infinite, else null."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_long(c: str | Column) -> Column:
    """64-bit value of whole-number text, else null; never fails."""
    text = _col(c).cast("string")
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


INTEGRAL = ("byte", "short", "integer", "long")  # fixed values: whole-number types
FLOATING = ("float", "double", "decimal")


def _type(df: DataFrame, c: Column) -> str:
    return df.select(c.alias("c")).schema["c"].dataType.typeName().split("(")[0]


def double_of(df: DataFrame, c: str | Column) -> Column:
    """``to_double`` that leaves columns alone which are numbers already."""
    column = _col(c)
    numeric = _type(df, column) in (*INTEGRAL, *FLOATING)
    return column.cast("double") if numeric else to_double(column)


def long_of(df: DataFrame, c: str | Column) -> Column:
    """``to_long`` that leaves whole-number columns alone."""
    column = _col(c)
    return column.cast("bigint") if _type(df, column) in INTEGRAL else to_long(column)


def is_blank(c: str | Column) -> Column:
    """True for null, empty and white-space text."""
    text = _col(c).cast("string")
    return F.coalesce(~text.rlike(r"\S"), F.lit(True))


def ordinal(c: str | Column, levels: list[str]) -> Column:
    """Position of a status name within its levels, as a double from 0."""
    names = F.array(*[F.lit(x) for x in levels])
    position = F.array_position(names, _col(c))
    return F.when(position > 0, (position - 1).cast("double"))


def used_percent(free: str | Column, total: str | Column) -> Column:
    """Share of ``total`` that is not free, in percent; null when total is 0."""
    return F.lit(100.0) * (F.lit(1.0) - F.try_divide(_col(free), _col(total)))


def state_percent(share: str | Column) -> Column:
    """Fraction to whole percent, cut toward zero, as a double; null gives 0."""
    return (F.lit(100) * F.coalesce(_col(share), F.lit(0.0))).cast("int").cast("double")
