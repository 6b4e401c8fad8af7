"""Row-wise cleaning of text-encoded values. Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """For double columns; unlike a condition on ``isnan`` this reads ``c`` once."""
    return F.nanvl(as_col(c), F.lit(None).cast("double"))


def to_number(c: str | Column) -> Column:
    """Text or number to double; anything unreadable (and NaN) to null."""
    return nan_to_null(as_col(c).try_cast("double"))


def money(c: str | Column) -> Column:
    """``"$1,234.00"`` to 1234.0."""
    return to_number(F.regexp_replace(as_col(c), "[$,]", ""))


def percent_number(c: str | Column) -> Column:
    """``"95%"`` to 95.0; every percent sign is removed."""
    return to_number(F.replace(as_col(c).cast("string"), F.lit("%"), F.lit("")))


def percent_fraction(c: str | Column) -> Column:
    """``"95%"`` to 0.95; only trailing percent signs are stripped, bad values give 0."""
    stripped = F.rtrim(as_col(c).cast("string"), F.lit("%"))
    return F.coalesce(to_number(stripped), F.lit(0.0)) / 100


def flag_tf(c: str | Column) -> Column:
    """t/f text to 1/0; other values are read as a number, or null."""
    s = as_col(c).cast("string")
    return F.when(s == "t", 1).when(s == "f", 0).otherwise(s.try_cast("int"))


def flag_any(c: str | Column) -> Column:
    """t/f, true/false and 1/0 to 1/0; everything else to 0."""
    s = F.lower(as_col(c).cast("string"))
    return F.when(s.isin("t", "true", "1", "1.0"), 1).otherwise(0)


def area_key(c: str | Column) -> Column:
    return F.trim(F.lower(as_col(c)))


def strip_area_code(c: str | Column) -> Column:
    """``"Camden 012A"`` to ``"camden"``."""
    return area_key(F.regexp_replace(as_col(c), r"\s\d+[A-Z]$", ""))


def date_or_null(c: str | Column) -> Column:
    return F.try_to_date(as_col(c).cast("string"))


def whole(c: str | Column) -> Column:
    """Round to the nearest whole number, as int."""
    return F.round(as_col(c), 0).cast("int")


def presence_flag(c: str | Column) -> Column:
    """1 where the text is present and not blank."""
    c = as_col(c)
    return F.when(c.isNull() | (F.trim(c) == ""), 0).otherwise(1)
