"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, modulo two primes, H[i] = sum of (c_j + 1) * B^j over j < i. Two spans
of equal length are equal (but for collisions of about 2**-62) if their differences of H agree after
a shift by a power of B, whatever the spans; so the longest common extension of two positions, forwards
or backwards, is found by binary search. The fingerprint is the length and the hash of the whole text.
The likeness of two texts is the share of the longer one that spans of the other cover: the common
beginning, the common end, and between them, from left to right, the longest common extensions around
equal blocks (the hashes of all spans of BLOCK code points against those of the other's blocks).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

PRIME = (1 << 31) - 1
BASES = (1_047_296_809, 786_433_001)
#: Input bytes for each range of ids; there are no more than MOST_RANGES, as their bounds go by the driver.
RANGE_BYTES, MOST_RANGES = 8 << 20, 8192
#: Code points of a block; a common span of 2 * BLOCK - 1 holds a whole one wherever it lies.
BLOCK = 16


def fold(x: np.ndarray) -> np.ndarray:
    """Modulo the Mersenne prime 2**31 - 1, for values under 2**62."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    x[x == PRIME] = 0
    return x


class Powers:
    """Powers of the bases, doubled in number when a longer text comes."""

    def __init__(self) -> None:
        self.of = np.ones((2, 1), np.int64)

    top = 0

    def reach(self, n: int) -> None:
        """Powers up to n, and top at least n."""
        self.up_to(n)
        self.top = self.of.shape[1] - 1

    def up_to(self, n: int) -> np.ndarray:
        while self.of.shape[1] <= n:
            size = self.of.shape[1]
            step = [pow(b, size, PRIME) for b in BASES]
            self.of = np.concatenate((self.of, np.stack([fold(row * s) for row, s in zip(self.of, step)])), axis=1)
        return self.of


POWERS = Powers()


class PrefixHashes:
    """The prefix array of a text of code points."""

    def __init__(self, codes: np.ndarray, kept: np.ndarray | None = None):
        """kept: the prefix array of the first code points, if another text has them already."""
        n, done = len(codes), 0 if kept is None else kept.shape[1] - 1
        power = POWERS.up_to(n)
        self.n, self.h = n, np.zeros((2, n + 1), np.int64)
        value = codes[done:].astype(np.int64) + 1
        for k in (0, 1):
            start = 0
            if kept is not None:
                self.h[k, : done + 1] = kept[k]
                start = int(kept[k, done])
            self.h[k, done + 1 :] = fold(np.cumsum(fold(value * power[k, done:n])) + start)

    @classmethod
    def of(cls, text: str) -> PrefixHashes:
        return cls(code_points(text))

    def same(self, i: int, other: PrefixHashes, j: int, length: int) -> bool:
        """Whether self[i : i + length] and other[j : j + length] are equal."""
        power = POWERS.of
        for k in (0, 1):
            a = int(self.h[k, i + length] - self.h[k, i]) * int(power[k, max(j - i, 0)])
            b = int(other.h[k, j + length] - other.h[k, j]) * int(power[k, max(i - j, 0)])
            if (a - b) % PRIME:
                return False
        return True

    def extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common extension forwards from positions i and j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i, other, j, mid) else (low, mid - 1)
        return low

    def extension_back(self, i: int, other: PrefixHashes, j: int) -> int:
        """Length of the longest common extension backwards from (before) positions i and j."""
        low, high = 0, min(i, j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i - mid, other, j - mid, mid) else (low, mid - 1)
        return low

    def fingerprint(self) -> str:
        return f"{self.n:08x}{int(self.h[0, -1]):08x}{int(self.h[1, -1]):08x}"

    def spans(self, at: np.ndarray, length: int) -> np.ndarray:
        """The hashes of the spans of that length from the given places, both bases in one number, freed of the place."""
        power = POWERS.of
        out = np.zeros(len(at), np.uint64)
        for k in (0, 1):
            value = self.h[k, at + length] - self.h[k, at]
            value[value < 0] += PRIME
            # Times B ** (n - place): every span as if it stood at the same place, whatever the text.
            out = (out << np.uint64(31)) | fold(value * power[k, POWERS.top - at]).astype(np.uint64)
        return out

    def likeness(self, other: PrefixHashes) -> float:
        """Share of the longer text that spans of the shorter cover, and no more of them than it has; two empty texts: 1."""
        longer, shorter = (self, other) if (self.n, self.fingerprint()) >= (other.n, other.fingerprint()) else (other, self)
        if longer.n == 0:
            return 1.0
        head = longer.extension(0, shorter, 0)
        tail = min(longer.extension_back(longer.n, shorter, shorter.n), shorter.n - head)
        covered, begin, end = head + tail, head, longer.n - tail
        if end - begin >= BLOCK and shorter.n >= BLOCK and covered < shorter.n:
            POWERS.reach(longer.n)
            blocks = np.arange(0, shorter.n - BLOCK + 1, BLOCK)
            known = shorter.spans(blocks, BLOCK)
            order = np.argsort(known, kind="stable")
            places = np.arange(begin, end - BLOCK + 1)
            asked = longer.spans(places, BLOCK)
            found = np.minimum(np.searchsorted(known[order], asked), len(known) - 1)
            hits = np.flatnonzero(known[order][found] == asked)
            k = 0
            while k < len(hits):
                i, j = begin + int(hits[k]), int(blocks[order[found[hits[k]]]])
                back = min(longer.extension_back(i, shorter, j), i - (begin if k == 0 else last))
                last = min(end, i + longer.extension(i, shorter, j))
                covered += last - i + back
                k = int(np.searchsorted(hits, max(last, i + 1) - begin))
        return min(covered, shorter.n) / longer.n


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def compare_one(text: str, own: PrefixHashes, after: str, following: PrefixHashes) -> tuple:
    third = own.n // 3
    kept = own.n - third
    edited = text[:kept] + after[:third]
    other = PrefixHashes(code_points(edited), own.h[:, : kept + 1])
    return (own.n, hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own.fingerprint(), other.fingerprint(), own.likeness(other), own.likeness(following))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one after it in descending id, after the last the first; rows with equal
    ids follow in the order of a hash of their texts, null ids come last. Null texts count as empty. A
    single row is its own next one. Repeated rows stay. An empty table gives an empty one. Other columns are
    ignored. Texts are shuffled once: dealt to ranges of ids whose bounds are percentiles over all ids (an
    id, or the lack of one, that fills several ranges is split by the hash), and the first row of each range
    is dealt to its predecessor too. Within a range, rows stream in order, two at a time.
    """
    from pyspark.ml.feature import Bucketizer  # a binary search over the bounds, in the JVM; not needed on executors

    none = -1.7e308  # below every id
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    keyed = keyed.withColumns({"key": F.coalesce(F.col("doc_id").cast("double"), F.lit(none)), "h": F.xxhash64("text")})
    parts = min(MOST_RANGES, max(1, math.ceil(text_bytes(docs, text_col) / RANGE_BYTES)))
    found: list[float] = []
    if parts > 1:
        found = keyed.agg(F.percentile_approx("key", [k / parts for k in range(1, parts)], 20 * parts).alias("b")).first()["b"] or []
    many = {b: n for b, n in Counter(found).items() if n > 1 and abs(b) < 2.0**53 or b == none and n > 1}
    bounds = sorted({float(b) for b in found} | {math.nextafter(b, math.inf) for b in many})
    if bounds:
        cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="key", outputCol="bucket")
        keyed = cut.transform(keyed)
        split = F.create_map(*[F.lit(x) for b, n in many.items() for x in (b, n + 1)])[F.col("key")] if many else F.lit(None).cast("int")
        share = F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * split).cast("int")
        # Ranges in the order of rows: buckets from the highest, and in a split one from the least hash.
        most = max([n + 1 for n in many.values()], default=1)
        keyed = keyed.withColumn("range", ((F.lit(len(bounds)) - F.col("bucket").cast("int")) * (most + 1) + F.least(F.coalesce(share, F.lit(0)), F.lit(most))).cast("int"))
    else:
        keyed = keyed.withColumn("range", F.lit(0))
    # One row for each range: its first, wanted as the tail of the range before it (of the last, for the first).
    order = F.struct((-F.col("key")).alias("down"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("id"), F.col("h").alias("h"))
    tops = sorted(tuple(r) for r in keyed.groupBy("range").agg(F.min(order).alias("o")).select("range", "o.id", "o.h").collect())
    numbers = {r[0]: i for i, r in enumerate(tops)}
    goes = [(i, ~top, h, (i - 1) % len(tops)) for i, (_, top, h) in enumerate(tops)] or [(0, 0, 0, 0)]
    if bounds:
        given = F.broadcast(docs.sparkSession.createDataFrame(list(numbers.items()) or [(0, 0)], "range int, own int"))
        keyed = keyed.join(given, "range")
    else:
        keyed = keyed.withColumn("own", F.lit(0))
    wanted = F.broadcast(docs.sparkSession.createDataFrame(goes, "of int, top bigint, top_h bigint, also int"))
    dealt = keyed.join(wanted, (F.col("own") == F.col("of")) & (F.coalesce("doc_id", F.lit(0)) == F.col("top")) & (F.col("h") == F.col("top_h")), "left")
    both = F.array(F.struct(F.col("own").alias("to"), F.lit(0).alias("tail")), F.struct(F.col("also").alias("to"), F.lit(1).alias("tail")))
    dealt = dealt.select("doc_id", "text", "key", "h", F.explode(both).alias("x")).where("x.to is not null").select("doc_id", "text", "key", "h", "x.to", "x.tail")
    dealt = dealt.repartitionById(max(1, len(tops)), F.col("to")).sortWithinPartitions("to", "tail", F.col("key").desc(), F.col("doc_id").desc_nulls_last(), "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, False  # held: the row that waits for its next one
        for batch in batches:
            out = []
            for doc_id, text, tail in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist()):
                if done:
                    continue
                own = PrefixHashes.of(text)
                if held:
                    out.append((held[0], *compare_one(held[1], held[2], text, own)))
                held, done = (doc_id, text, own), tail == 1
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
