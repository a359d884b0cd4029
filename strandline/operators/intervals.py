"""Membership intervals with closed ends: overlap, conflicting claims, reviewed cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(begin: Column, end: Column, start: str, stop: str) -> Column:
    """Begin null or not after `stop`, and end null, '' or not before `start`."""
    from_ok = begin.isNull() | (begin <= stop)
    to_ok = end.isNull() | (end == "") | (end >= start)
    return F.coalesce(from_ok, F.lit(False)) & F.coalesce(to_ok, F.lit(False))


def multiple_current(df: DataFrame, code: str, flag: str, yes: str = "Y") -> DataFrame:
    """Codes with more than one current row."""
    return df.where(F.col(flag) == yes).groupBy(code).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def conflicts(df: DataFrame, code: str, begin: str, end: str, flag: str, columns: list[str], start: str, stop: str) -> DataFrame:
    """code, st, en, n_tied, differs: elementary segments on which the latest claims tie and disagree.

    begin and end are dates; a null end is open; rows without begin, and codes with one row, take no
    part. Intervals are clipped to [start, stop]. On a segment the rows of the latest (begin, flag)
    win; if several do and differ in one of `columns` (null counts as a value), that is a conflict.
    Adjacent segments are not merged.
    """
    low, high = F.lit(start).cast("date"), F.lit(stop).cast("date")
    rows = df.where(F.col(begin).isNotNull()).select(
        F.col(code).alias("code"), F.col(begin).alias("key"), F.col(flag).alias("flag"), F.struct(*columns).alias("claim"), F.greatest(F.col(begin), low).alias("b"), F.least(F.coalesce(F.col(end), high), high).alias("e")
    ).where("b <= e")
    cuts = rows.select("code", F.explode(F.array(F.col("b"), F.date_add("e", 1))).alias("p")).distinct()
    segments = cuts.withColumn("nxt", F.lead("p").over(Window.partitionBy("code").orderBy("p"))).where("nxt is not null").select("code", F.col("p").alias("st"), F.date_sub("nxt", 1).alias("en"))
    active = segments.join(rows, "code").where("b <= st and en <= e").withColumn("rank", F.struct("key", "flag"))
    # A running maximum over the rows of a segment, so that the losers are never gathered.
    top = active.groupBy("code", "st", "en").agg(F.max("rank").alias("rank"))
    winners = active.join(top, ["code", "st", "en", "rank"]).groupBy("code", "st", "en").agg(F.collect_list("claim").alias("claims"))
    tied = winners.where("size(claims) > 1")
    differ = [_differs(name) for name in columns]
    found = tied.select("code", "st", "en", F.size("claims").cast("bigint").alias("n_tied"), F.concat_ws(",", *differ).alias("differs"))
    return found.where("n_tied > 1 and differs <> ''")


def _differs(name: str) -> Column:
    return F.when(F.size(F.array_distinct(F.transform("claims", lambda x: F.struct(x[name])))) > 1, F.lit(name))


def case_matches(df: DataFrame, cases: DataFrame, blank_as_null: str) -> DataFrame:
    """Rows equal to a reviewed case on all its columns; for the match only, '' in one column equals null."""
    clean = lambda side, c: F.when(F.col(f"{side}.{c}") == "", None).otherwise(F.col(f"{side}.{c}")) if c == blank_as_null else F.col(f"{side}.{c}")
    on = [clean("d", c).eqNullSafe(clean("k", c)) for c in cases.columns]
    condition = on[0]
    for more in on[1:]:
        condition = condition & more
    return df.alias("d").join(F.broadcast(cases.alias("k")), condition, "left_semi")


def case_status(good: Column, bad: Column, other: Column) -> Column:
    """What may be done about a case, from its numbers of good, bad and other rows."""
    return F.when(good + bad + other == 0, "not_present").when((good != 1) | (bad > 1) | (other > 0), "requires_review").when(bad == 1, "remove").otherwise("already_clean")
