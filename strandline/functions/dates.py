"""Dates as YYYYMMDD text: strict parsing, key generators on the driver and as columns."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMAT = "yyyyMMdd"


class DateError(ValueError):
    pass


def parse_day(text: str, label: str = "date") -> dt.date:
    """A real day in exactly eight ASCII digits, or DateError."""
    if not isinstance(text, str) or not re.fullmatch(r"[0-9]{8}", text):
        raise DateError(f"{label}: {text!r} is not YYYYMMDD")
    try:
        return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))
    except ValueError as e:
        raise DateError(f"{label}: {text!r} is no day") from e


def day_text(day: dt.date) -> str:
    return f"{day:%Y%m%d}".zfill(8)


def strict_day(text: Column) -> Column:
    """The date, or null for anything but eight digits that name a real day."""
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, FORMAT))


def as_text(day: Column) -> Column:
    return F.date_format(day, FORMAT)


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def is_historical(period: Column, as_of: str, grace_days: int = 120) -> Column:
    return F.coalesce(strict_day(period) <= F.date_sub(F.lit(as_of).cast("date"), grace_days), F.lit(False))


def quarter_ends(start: dt.date, end: dt.date) -> list[str]:
    """Ends of quarters within the closed range."""
    firsts = (dt.date(y, m, 1) for y in range(start.year, end.year + 2) for m in (1, 4, 7, 10))
    return [day_text(d) for d in (f - dt.timedelta(days=1) for f in firsts) if start <= d <= end]


def year_ranges(start: dt.date, end: dt.date) -> list[tuple[str, str, str]]:
    """(year, first, last) with both clipped to the closed range."""
    return [(f"{y:04d}", day_text(max(start, dt.date(y, 1, 1))), day_text(min(end, dt.date(y, 12, 31)))) for y in range(start.year, end.year + 1) if start <= end]


def calendar_days(start: dt.date, end: dt.date) -> list[str]:
    return [day_text(start + dt.timedelta(days=i)) for i in range((end - start).days + 1)]


def quarter_end_keys(spark: SparkSession, start: str, end: str) -> DataFrame:
    months = F.explode(F.expr(f"sequence(trunc(DATE'{start}', 'quarter'), DATE'{end}', interval 3 months)")).alias("d")
    return spark.range(1).select(months).select(quarter_end(F.col("d")).alias("d")).where(f"d between DATE'{start}' and DATE'{end}'").select(as_text(F.col("d")).alias("p"))


def calendar_keys(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.expr(f"sequence(DATE'{start}', DATE'{end}')")).alias("d")).select(as_text(F.col("d")).alias("p"))


def year_range_keys(spark: SparkSession, start: str, end: str) -> DataFrame:
    years = spark.range(1).select(F.explode(F.expr(f"sequence(year(DATE'{start}'), year(DATE'{end}'))")).alias("y"))
    lo, hi = F.greatest(F.make_date("y", F.lit(1), F.lit(1)), F.lit(start).cast("date")), F.least(F.make_date("y", F.lit(12), F.lit(31)), F.lit(end).cast("date"))
    return years.select(F.col("y").cast("string").alias("yr"), as_text(lo).alias("lo"), as_text(hi).alias("hi"))
