"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

Every source s gets a mean repetition rate r_s = total * weight_s / (sum of weights * documents of s).
Every document draws its count from a Poisson distribution with that mean, by inversion of a uniform
number hashed from (seed, id): the count is the number of k with P(X <= k) <= u. It is repeated that
often and all copies are shuffled by a hash of (seed, id, copy), dealt over all partitions and sorted
inside them. Rerun or recomputed tasks give the same rows, since nothing is drawn at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import unit_hash

#: A mean above PIECE is drawn as a sum of independent equal pieces; TERMS cover a piece's whole range at 52 bits.
PIECE, TERMS = 16.0, 100
#: More sources than this are joined by a shuffle; below it their table (under 1 KB a row) is broadcast.
BROADCAST_SOURCES = 20_000


def source_rates(docs: DataFrame, weights: dict[str, float] | None, temperature: float, total: float | None) -> DataFrame:
    """source, rate, pieces, cdf. Without weights a source weighs its number of documents to the power of `temperature`."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]) if weights else F.lit(None).cast("map<string,double>")
        counts = counts.withColumn("weight", F.coalesce(given[F.col("source")], F.lit(0.0)))
    sums = counts.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    all_weights, size = float(sums["w"] or 0.0), float(sums["n"] or 0) if total is None else float(total)
    rate = (F.lit(size) * F.col("weight") / F.lit(all_weights) / F.col("n")) if all_weights > 0 else F.lit(0.0)
    rated = counts.select("source", rate.alias("rate")).withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int"))
    mean = F.col("rate") / F.col("pieces")
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("cdf"))
    grow = lambda acc, k: F.struct((acc["p"] * F.col("mean") / k).alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * F.col("mean") / k)).alias("cdf"))
    return rated.withColumn("mean", mean).withColumn("cdf", F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, grow)["cdf"]).select("source", "rate", "pieces", "cdf")


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, total: float | None = None, seed: str = "mix-1") -> DataFrame:
    """All columns of docs, with `copy` (from 1) and `shuffle_key` (the global order) appended.

    docs needs doc_id and source. A null source is a source of its own; a source without a given
    weight weighs 0 and goes. Rows with equal ids (or null ids) draw the same count, so repeats stay
    repeats. `total` is the expected number of rows (default: as many as come in). Texts are only
    carried. An empty table gives an empty one. A column of docs that is named copy or shuffle_key is
    replaced.
    """
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rates = source_rates(docs, weights, temperature, total)
    if docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    rates = rates.select(F.col("source").alias("__source"), F.col("pieces").alias("__pieces"), F.col("cdf").alias("__cdf"))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    joined = docs.select(*[F.col(f"`{c}`") for c in names]).join(rates, F.col("source").eqNullSafe(F.col("__source")))
    draw = lambda acc, j: acc + F.size(F.filter("__cdf", lambda c: c <= unit_hash(F.lit(seed), ident, j.cast("string"))))
    single = F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    many = F.aggregate(F.sequence(F.lit(1), F.col("__pieces") - 1), F.col("__one"), draw)
    counted = joined.withColumn("__u", unit_hash(F.lit(seed), ident, F.lit("0"))).withColumn("__one", single)
    counted = counted.withColumn("__n", F.when(F.col("__pieces") == 1, F.col("__one")).otherwise(many)).where("__n > 0")
    copies = counted.select(*[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    keyed = copies.withColumn("shuffle_key", unit_hash(F.lit(f"{seed}-order"), ident, F.col("copy").cast("string")))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")


#: DuckDB SQL for mix_sources(documents) with the defaults.
ORACLE_SQL = f"""
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, pow(CAST(n AS DOUBLE), 0.5) AS weight FROM n),
r AS (SELECT source, CAST((SELECT sum(n) FROM n) AS DOUBLE) * weight / (SELECT sum(weight) FROM w) / n AS rate FROM w),
p AS (SELECT source, CAST(greatest(1, ceil(rate / {PIECE})) AS INTEGER) AS pieces, rate / greatest(1, ceil(rate / {PIECE})) AS mean FROM r),
c AS (SELECT source, pieces, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS cdf FROM p
  UNION ALL SELECT source, pieces, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM c WHERE k < {TERMS}),
u AS (SELECT d.*, CAST('0x' || substr(md5('mix-1|' || d.doc_id || '|' || j.j), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source, generate_series(0, 10000) j(j) WHERE j.j < p.pieces),
t AS (SELECT u.doc_id, CAST(count(*) AS INTEGER) AS copies FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.cdf <= u.u GROUP BY u.doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(g.i AS INTEGER) AS copy,
  CAST('0x' || substr(md5('mix-1-order|' || d.doc_id || '|' || g.i), 1, 13) AS BIGINT) / 4503599627370496.0 AS shuffle_key
FROM documents d JOIN t USING (doc_id), generate_series(1, 100000) g(i) WHERE g.i <= t.copies
"""
