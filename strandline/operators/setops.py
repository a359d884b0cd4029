"""Whole-row set and multiset algebra. A row is identified by all its columns; null equals null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_shape(a: DataFrame, b: DataFrame) -> bool:
    """Names, order and types all count."""
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]


def whole_row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def signed_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row with its number in a and in b: one shuffle, reduced on the map side."""
    tagged = a.withColumns({"__a": F.lit(1), "__b": F.lit(0)}).unionByName(b.withColumns({"__a": F.lit(0), "__b": F.lit(1)}))
    return tagged.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))


def set_difference(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(added, removed) distinct rows. If the shape differs, everything is removed and added."""
    if not same_shape(old, new):
        return new.distinct(), old.distinct()
    both = signed_counts(old, new)
    return both.where("__a = 0").drop("__a", "__b"), both.where("__b = 0").drop("__a", "__b")


def set_diff_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """side, n: distinct rows added and removed, one row for each side, also of none."""
    if same_shape(old, new):
        totals = signed_counts(old, new).agg(F.count_if(F.col("__a") == 0).alias("added"), F.count_if(F.col("__b") == 0).alias("removed"))
    else:
        totals = new.distinct().agg(F.count(F.lit(1)).alias("added")).unionByName(old.distinct().agg(F.count(F.lit(1)).alias("removed")), allowMissingColumns=True).agg(F.max("added").alias("added"), F.max("removed").alias("removed"))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("n")) for s in ("added", "removed")])
    return totals.select(F.explode(sides).alias("x")).select("x.side", "x.n")


def change_summary(old: DataFrame, new: DataFrame) -> DataFrame:
    """old_rows, new_rows, old_duplicate_rows, new_duplicate_rows, added, removed in one pass."""
    one = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return signed_counts(old, new).agg(
        one("__a").alias("old_rows"),
        one("__b").alias("new_rows"),
        one(F.greatest(F.col("__a") - 1, F.lit(0))).alias("old_duplicate_rows"),
        one(F.greatest(F.col("__b") - 1, F.lit(0))).alias("new_duplicate_rows"),
        F.count_if(F.col("__a") == 0).alias("added"),
        F.count_if(F.col("__b") == 0).alias("removed"),
    )


def multiset_difference(source: DataFrame, copy: DataFrame) -> DataFrame:
    """missing_rows and extra_rows of a copy, with multiplicity."""
    gap = F.col("__a") - F.col("__b")
    one = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))), F.lit(0)).cast("bigint")
    return signed_counts(source, copy).agg(one(gap).alias("missing_rows"), one(-gap).alias("extra_rows"))


def duplicate_excess(df: DataFrame) -> DataFrame:
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("x"))


def null_counts(df: DataFrame, code: str) -> DataFrame:
    """Nulls by column ('' is not null) and the exact number of distinct codes."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns], F.count_distinct(F.col(code)).alias("instruments"))


def intersect_count(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b).agg(F.count(F.lit(1)).alias("n"))


def examples(df: DataFrame, n: int = 5) -> list:
    """The first distinct rows in order, for messages."""
    return [tuple(r) for r in df.distinct().orderBy(*[F.col(f"`{c}`") for c in df.columns]).limit(n).collect()]
