"""Overlapping pagination over a table, and what it reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordinal import with_ordinal


def page_count(rows: int, limit: int, overlap: int) -> int:
    """Pages until the first one that is shorter than the limit."""
    step = limit - overlap
    return max(0, -(-(rows - (limit - 1)) // step)) + 1


def pages(df: DataFrame, key: str, limit: int, overlap: int) -> DataFrame:
    """df with page (from 0) and ordinal; rows in an overlap appear on each of their pages."""
    step = limit - overlap
    numbered = with_ordinal(df, key)
    last = page_count(df.count(), limit, overlap) - 1
    first = F.greatest(F.lit(0), F.floor((F.col("ordinal") - limit) / step) + 1)
    return numbered.withColumn("page", F.explode(F.sequence(first.cast("int"), F.least(F.lit(last), F.floor(F.col("ordinal") / step)).cast("int"))))


def page_statistics(paged: DataFrame, columns: list[str]) -> DataFrame:
    """pages, raw, uniq, cross_page_duplicates, removed."""
    by_page = paged.groupBy("page", *columns).agg(F.count(F.lit(1)).alias("n"))
    by_row = by_page.groupBy(*columns).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("on_pages"), F.max("page").alias("last"))
    total = by_row.agg(F.sum("n").cast("bigint").alias("raw"), F.count(F.lit(1)).alias("uniq"), F.sum("on_pages").cast("bigint").alias("page_uniq"), (F.max("last") + 1).cast("bigint").alias("pages"))
    return total.select("pages", "raw", "uniq", (F.col("page_uniq") - F.col("uniq")).alias("cross_page_duplicates"), (F.col("raw") - F.col("uniq")).alias("removed"))


def page_fingerprints(paged: DataFrame, columns: list[str]) -> DataFrame:
    """page, n, fp: a digest of the page's rows in order, so a page seen twice shows and a reordered one does not."""
    row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]))
    rows = paged.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("ordinal", row.alias("h")))).alias("rows"))
    return rows.select("page", F.size("rows").cast("bigint").alias("n"), F.sha2(F.array_join("rows.h", ","), 256).alias("fp"))


def repeated_pages(fingerprints: DataFrame) -> DataFrame:
    seen = F.count(F.lit(1)).over(Window.partitionBy("fp"))
    return fingerprints.where("n > 0").withColumn("times", seen).where("times > 1")
