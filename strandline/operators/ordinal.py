"""Row numbers over a whole table without one task that sorts it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 1_000_000


def with_ordinal(df: DataFrame, key: str, name: str = "ordinal", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """df with its row number from 0 in the order of `key`, a number column without nulls or repeats.

    Rows are dealt to ranges of the key (percentiles), counted, and numbered inside each range; only
    the counts, one for each bucket, come to the driver.
    """
    n = df.count()
    parts = max(1, -(-n // bucket_rows))
    if parts == 1:
        bucket = F.lit(0)
    else:
        bounds = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 20 * parts).alias("b")).first()["b"]
        bucket = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b < F.col(key)))
    dealt = df.withColumn("__bucket", bucket)
    counts = sorted((r["__bucket"], r["count"]) for r in dealt.groupBy("__bucket").count().collect())
    before, offsets = 0, []
    for b, c in counts:
        offsets += [F.lit(b), F.lit(before)]
        before += c
    offset = F.create_map(*offsets)[F.col("__bucket")] if offsets else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("__bucket").orderBy(key))
    return dealt.withColumn(name, (offset + rank - 1).cast("bigint")).drop("__bucket")
