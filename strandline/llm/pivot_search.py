"""Exact top-k inner product search with a pivot-distance index.

Each vector is keyed by its nearest pivot p and its distance r to it; the keys of a pivot are cut into
sorted annuli. For a query q, |d(q, p) - r| is at most d(q, x) (triangle inequality), and
q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2, so an annulus [lo, hi] with largest squared norm m holds no score
above (|q|^2 + m - gap^2) / 2, where gap is the distance from d(q, p) to [lo, hi]. A query first gets the
k-th score over the sample that the pivots come from, and is sent to the annuli that can still reach
it. There it expands over slices sorted by r, nearest first, and stops at the bound. The number of
pivots grows with the square root of the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Pivots and annuli are fitted on at most SAMPLE vectors; every vector is indexed and every bound is exact.
SAMPLE, FEW_PIVOTS, MOST_PIVOTS, ANNULI, SLICE, BLOCK = 4096, 16, 512, 8, 512, 16_384
LONGS = np.iinfo(np.int64)


def quantised(table: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, q, times, row: floor(scale * x) of each component (beyond a long: the nearest long).

    Vectors null or with null or non-finite parts take no part. Equal rows come at most k + 1 times, since
    no answer needs more; the first of them stands for the others too (times). `row` tells rows apart.
    """
    x = F.col(f"`{vector_col}`")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = table.where(x.isNotNull()).where(F.coalesce(sound, F.lit(False)))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    counted = kept.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), q.alias("q")).groupBy("vec_id", "q").agg(F.count(F.lit(1)).alias("n"))
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k + 1)).cast("int")))
    each = counted.select("vec_id", "q", "n", copies.alias("copy"))
    times = F.when((F.col("copy") == 1) & (F.col("n") > k + 1), F.col("n") - k).otherwise(F.lit(1).cast("bigint"))
    return each.select("vec_id", "q", times.alias("times"), F.xxhash64("vec_id", "q", "copy").alias("row"))


def choose_pivots(sample: list[np.ndarray], count: int) -> dict[int, np.ndarray]:
    """By length of vector: pivots from a few rounds of k-means on the sample, first centres farthest apart."""
    out = {}
    for size in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == size], np.float64)
        centres = [x.mean(axis=0)]
        gap = ((x - centres[0]) ** 2).sum(axis=1)
        while len(centres) < min(count, len(x)) and gap.max() > 0:
            centres.append(x[int(gap.argmax())])
            gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(axis=1))
        c = np.array(centres)
        for _ in range(8):
            near = distances(x, c).argmin(axis=1)
            c = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        out[size] = c
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * x @ c.T, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows: in doubles where they hold them, else in Python's integers; beyond a long the nearest long."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, LONGS.min, LONGS.max).astype(np.int64)


def best_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores, ties to the smaller id (null ids, as the largest long, last)."""
    return np.lexsort((ids, -scores))[:k]


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row whose id is divisible by `every`, against all other rows.

    Scores are exact integers (beyond a long: the nearest long); ties go to the smaller id, null ids
    last; fewer than k candidates give fewer rows. Every row but the query's own is a candidate: rows
    that share an id, also the query's, each count, and rows without an id too. Of rows that share an id
    divisible by `every` each is a query and has its own ranks. Vectors are compared with those of
    their own length. Broken vectors (see quantised) take no part; an empty table gives an empty one.
    Other columns are ignored.
    """
    spark = table.sparkSession
    vectors = materialise(quantised(table, k, id_col, vector_col, scale), "topk-vectors")
    total = vectors.count()
    sample = vectors.select("row", "q").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    ids = np.array([r["row"] for r in sample], np.int64)
    rows = [np.array(r["q"], np.int64) for r in sample]
    pivots = choose_pivots(rows, min(MOST_PIVOTS, max(FEW_PIVOTS, int(total**0.5) // 4)))
    cuts: dict[int, list[np.ndarray]] = {}
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size, centres in pivots.items():
        mine = np.array([len(v) == size for v in rows])
        x = np.array([v for v in rows if len(v) == size], np.int64)
        gap = distances(x.astype(np.float64), centres)
        near = gap.argmin(axis=1)
        cuts[size] = [np.unique(np.quantile(gap[near == p, p], np.linspace(0, 1, ANNULI + 1)[1:-1])) if (near == p).any() else np.empty(0) for p in range(len(centres))]
        seeds[size] = (ids[mine], x)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The index: size of vector, pivot, annulus, distance, squared norm, the vector as bytes."""
        for batch in batches:
            found = []
            for q in batch.column(3):
                v = q.values.to_numpy(zero_copy_only=False).astype(np.int64)
                centres = pivots.get(len(v))
                norm = float((v.astype(np.float64) ** 2).sum())
                if centres is None:  # no such vector in the sample: the origin is their pivot
                    found.append((len(v), -1, 0, norm**0.5, norm, v.tobytes()))
                    continue
                gap = np.sqrt(((centres - v) ** 2).sum(axis=1))
                p = int(gap.argmin())
                found.append((len(v), p, int(np.searchsorted(cuts[len(v)][p], gap[p])), float(gap[p]), norm, v.tobytes()))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + [pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], ["row", "vec_id", "times", "size", "pivot", "annulus", "r", "norm", "v"])

    index = materialise(vectors.select("row", "vec_id", "times", "q").mapInArrow(key, "row bigint, vec_id bigint, times bigint, size int, pivot int, annulus int, r double, norm double, v binary"), "topk-index")
    # One row for each annulus: at most MOST_PIVOTS * ANNULI for each length of vector.
    at = ["size", "pivot", "annulus"]
    rings = index.groupBy(*at).agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n"))
    rings = [tuple(r) for r in rings.orderBy(*at).collect()]
    parts = [-(-r[6] // BLOCK) for r in rings]
    of_size = {size: np.array([i for i, r in enumerate(rings) if r[0] == size]) for size in {r[0] for r in rings}}
    place, low, high, most = (np.array([r[i] for r in rings]) for i in (1, 3, 4, 5))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to every block that can hold one of its k best, with its bound and its distance to the pivot."""
        for batch in batches:
            out = []
            for row, size, norm, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                q = np.frombuffer(raw, np.int64)
                bound = LONGS.min
                mine = of_size[size]
                d = np.full(len(mine), norm**0.5)
                if size in seeds:
                    others = seeds[size][0] != row
                    scores = np.sort(products(q[None, :], seeds[size][1][others])[0])
                    bound = int(scores[-k]) if len(scores) >= k else bound
                    reach = distances(q[None, :].astype(np.float64), pivots[size])[0]
                    d = np.where(place[mine] < 0, d, reach[np.maximum(place[mine], 0)])
                can = upper(norm, most[mine], d, low[mine], high[mine]) >= bound
                for i, gap in zip(mine[can].tolist(), d[can].tolist()):
                    out += [(i << 32 | part, 1, row, None, gap, norm, raw, bound) for part in range(parts[i])]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in out], t) for i, t in enumerate(kinds)], ["block", "kind", "row", "vec_id", "r", "norm", "v", "bound"])

    schema = "block bigint, kind int, row bigint, vec_id bigint, r double, norm double, v binary, bound bigint"
    asked = index.where(F.col("vec_id") % every == 0)
    queries = asked.select("row", "size", "norm", "v").mapInArrow(send, schema)
    numbers = spark.createDataFrame([(*r[:3], i, n) for i, (r, n) in enumerate(zip(rings, parts))], "size int, pivot int, annulus int, ring bigint, parts bigint")
    data = index.join(F.broadcast(numbers), at)
    data = data.select((F.shiftleft("ring", 32) + F.pmod(F.xxhash64("row"), "parts")).alias("block"), F.lit(0).alias("kind"), "row", "vec_id", "r", "norm", "v", F.lit(0).cast("bigint").alias("bound"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come block by block, the block's vectors before its queries; queries stream."""
        block, held, ready = None, [], None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            out = [np.empty(0, np.int64)] * 3
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)]):
                if lo == hi:
                    continue
                piece = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, held, ready = blocks[lo], [], None
                if kinds[lo] == 0:
                    held.append(piece)
                    continue
                if ready is None and held:
                    ready, held = loaded(pa.Table.from_batches(held)), []
                if ready is not None:
                    found = search(ready, loaded(pa.Table.from_batches([piece])), k)
                    out = [np.concatenate((a, b)) for a, b in zip(out, found)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["row", "vec_id", "score"])

    blocks = max(len(rings), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = data.unionByName(queries).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(expand, "row bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    asked = asked.select("row", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("one"))
    return best.join(asked, "row").select("query_id", "rank", F.when(F.col("vec_id") != LONGS.max, F.col("vec_id")).alias("vec_id"), "score")


def upper(q_norm, norm, d, lo, hi):
    """No score of the annulus is above this; margins cover the rounding of distances and norms."""
    gap = np.maximum(0.0, np.maximum(lo - d, d - hi))
    gap = np.maximum(0.0, gap - 1e-6 * (1 + d + hi))
    return (q_norm + norm) * (0.5 + 1e-9) - gap * gap / 2 + 1


def loaded(t: pa.Table) -> tuple:
    raw = t["v"].to_pylist()
    ids = t["vec_id"].fill_null(LONGS.max)
    return t["row"].to_numpy(), ids.to_numpy(), t["r"].to_numpy(), t["norm"].to_numpy(), np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), -1), t["bound"].to_numpy()


def search(data: tuple, queries: tuple, k: int) -> list[np.ndarray]:
    """(row of the query, vec_id, score) of the k best of a block for each query."""
    rows, ids, r, norm, x, _ = data
    q_rows, _, q_d, q_norm, q, bound = queries
    by = np.argsort(r, kind="stable")
    rows, ids, r, norm, x = rows[by], ids[by], r[by], norm[by], x[by]
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q_rows)
    bound = bound.copy()
    slices = [(a, min(a + SLICE, len(ids))) for a in range(0, len(ids), SLICE)]
    middle = float(np.median(q_d))
    for a, b in sorted(slices, key=lambda s: max(r[s[0]] - middle, middle - r[s[1] - 1])):
        can = np.flatnonzero(upper(q_norm, norm[a:b].max(), q_d, r[a], r[b - 1]) >= bound)
        if not len(can):
            continue
        scores = products(q[can], x[a:b])
        for row, i in zip(scores, can.tolist()):
            at = np.flatnonzero((row >= bound[i]) & (rows[a:b] != q_rows[i]))
            if len(at):
                both_ids, both = np.concatenate((best[i][0], ids[a:b][at])), np.concatenate((best[i][1], row[at]))
                top = best_rows(both_ids, both, k)
                best[i] = (both_ids[top], both[top])
                if len(top) == k:
                    bound[i] = max(bound[i], int(both[top[-1]]))
    sizes = [len(b[0]) for b in best]
    return [np.repeat(q_rows, sizes), np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])]


#: DuckDB SQL for top_k(embeddings) with the defaults.
ORACLE_SQL = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT a.r AS r, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
