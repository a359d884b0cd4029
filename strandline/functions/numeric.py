"""Text to numbers under a contract: blank is null, anything else must be a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
WHOLE = 1e-12


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def to_double(text: Column) -> Column:
    """Null for blank and for unreadable text; suffixes and `nan`, which a plain cast takes, are unreadable."""
    clean = F.trim(text)
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def bad_double(text: Column) -> Column:
    return ~is_blank(text) & to_double(text).isNull()


def to_long(text: Column) -> Column:
    """Exact where the text is a plain integer; `1.0` and `1e3` are read as decimals; a fraction is no integer."""
    clean = F.trim(text)
    wide = F.when(clean.rlike(NUMBER), clean.try_cast("decimal(38,12)"))
    return F.when(clean.rlike(r"^[+-]?[0-9]+$"), clean.try_cast("bigint")).when(F.abs(wide - F.round(wide)) <= WHOLE, F.round(wide).try_cast("bigint"))


def bad_long(text: Column) -> Column:
    return ~is_blank(text) & to_long(text).isNull()
