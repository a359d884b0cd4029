"""Partition slices, their validation, replacement of a date window, and the overwrite guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_TYPES = tuple(range(1, 13))


def inside(column: str, start: str, end: str) -> Column:
    """A date text within a closed window; null is outside."""
    return F.coalesce(F.col(column).between(start, end), F.lit(False))


def key_violations(df: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose key column is null or another value."""
    return df.where(~F.col(column).eqNullSafe(F.lit(key)))


def window_violations(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.where(~inside(column, start, end))


def tag_violations(df: DataFrame, column: str, wanted: object) -> DataFrame:
    """Rows that do not carry the tag that was asked for."""
    return df.where(~F.col(column).eqNullSafe(F.lit(wanted)))


def statement_union(df: DataFrame, tag: str, types: tuple[int, ...] = REPORT_TYPES) -> DataFrame:
    """Rows of the sub-queries 1..12 in one scan."""
    return df.where(F.col(tag).isin(*types))


def statement_stats(df: DataFrame, tag: str, types: tuple[int, ...] = REPORT_TYPES) -> DataFrame:
    """rt, n: rows of each sub-query, zero where there are none."""
    counted = statement_union(df, tag, types).groupBy(F.col(tag).cast("int").alias("rt")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, types))).alias("rt"))
    return every.join(counted, "rt", "left").select("rt", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def replace_window(old: DataFrame, new: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Old rows outside the window (null dates stay) and all new rows, distinct."""
    return old.where(~inside(column, start, end)).unionByName(new).distinct()


def guard_verdict(old_rows: Column, new_rows: Column) -> Column:
    """refuse: nothing where something was, or under half of the distinct rows. Half passes."""
    return F.when((old_rows > 0) & (new_rows == 0), "refuse").when(new_rows < 0.5 * old_rows, "refuse").otherwise("pass")


def may_overwrite(old_rows: int, new_rows: int, allow_shrink: bool = False) -> bool:
    return allow_shrink or old_rows == 0 or (new_rows > 0 and 2 * new_rows >= old_rows)


def discover_periods(df: DataFrame, date_column: str, period_column: str, start: str, end: str, least: str) -> DataFrame:
    """Distinct periods with a change announced in the window, not before the archive's start."""
    return df.where(inside(date_column, start, end)).where(F.col(period_column) >= least).select(F.col(period_column).alias("p")).distinct()
