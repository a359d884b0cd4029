"""SimHash near-duplicate groups by the generalised pigeonhole principle.

1. Every text gets a fingerprint of 64 or 128 bits (Arrow batches, one pass over the texts); only id and
   fingerprint go on, and from there only distinct fingerprints.
2. Bits that correlate over all distinct fingerprints are grouped into the same partition. Thresholds
   t_i with sum(t_i + 1) = d + 1 are allotted to the partitions by dynamic programming on estimated
   candidate counts, over several numbers of partitions: two fingerprints within d bits agree within
   t_i bits on some partition i. A partition with t_i = -1 is not probed.
3. A probe at threshold t sends a fingerprint to the keys within ceil(t/2) bits of its partition value;
   as both sides do so, they meet in a bucket. Probes are dealt by key and sorted, so buckets stream by;
   each is verified on all bits, many small ones at once. Where a similarity is the goal, a bucket is also
   sorted by the number of distinct shingles, and only pairs whose numbers allow that similarity are looked at.
   Rows that already hang together with all that they have yet to meet are passed over.
4. A bucket emits a spanning forest of its links (at most one link a member), never all pairs. A
   bucket over `bucket_limit` members is split: for small d by the plain pigeonhole on the bits not
   used so far, else into blocks that meet two by two; so no bucket is truncated and no task gets an
   unbounded one.
5. Links become groups by distributed contraction (graph.py).
6. keep_one, whose distance is too wide for partitions (the pairs that meet in them grow with the square of
   the table), has its own pigeonhole: of two sets of shingles with the similarity, each sorted in one order,
   the first ones meet (see leading_shingles). These are its buckets; 3 to 5 hold for them too. It verifies
   on the shingles themselves before a row goes (see there).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, frugal, materialise
from .graph import connected_components

#: Relative cost of writing one probe row and of verifying one candidate pair.
PROBE_COST, PAIR_COST = 100.0, 1.0
#: Fewer fingerprints are planned for as if they were so many: the plan, and what a row costs, do not jump as a table grows.
PLANNED = 1 << 20
#: Up to this distance a bucket that is too large is split by further partitions.
NARROW = 3
#: Rows that are verified at once, and links that are held before they are reduced to a forest.
ROWS_AT_ONCE, LINKS_AT_ONCE = 1 << 17, 1 << 20
#: Distinct texts of a group that one task compares with leaders of the group, and texts that may become leaders in one round.
GROUP_SPLIT, LEADERS = 4096, 1024
#: Shingles that the leaders of one round hold together, if they are more than one.
LEADING = 1 << 20
#: Texts of which the frequent shingles are told, how many of these texts have one at least, and the most that are told.
#: They only order the shingles: what is found does not depend on them, only the sizes of buckets do.
COUNTED, FREQUENT, TOLD = 1 << 14, 3, 1 << 18


def shingle_hashes(text: str | None, width: int, bits: int = 64) -> np.ndarray:
    """(n, bits / 8) bytes: XXH64 (or XXH128; seed 42) of every run of `width` words, repeats included; A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    digest = xxhash.xxh64_digest if bits == 64 else xxhash.xxh128_digest
    if len(words) < width:
        return np.frombuffer(digest(b" ".join(words), 42) if words else b"", np.uint8).reshape(-1, bits // 8)
    line = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(words) - width] + 1))
    found = b"".join([digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())])
    return np.frombuffer(found, np.uint8).reshape(-1, bits // 8)


def fingerprint(hashes: np.ndarray) -> bytes:
    """A bit is 1 if it is set in over half of the hashes; no hashes: zero."""
    counts = np.zeros(hashes.shape[1] * 8, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def parts_of(bits: int) -> list[str]:
    """The columns that hold a fingerprint, 64 bits each, signed; bit 0 is the highest of the first."""
    return [f"f{i}" for i in range(bits // 64)]


def fingerprints(docs: DataFrame, width: int = 3, bits: int = 64, id_col: str = "doc_id", text_col: str = "text", with_shingles: bool = False) -> DataFrame:
    """(doc_id, text_hash, f0 ..): null and empty texts have zero. with_shingles: also the distinct shingles, as hashes of 32 bits, their number and a set of 64 bits that they fall on."""
    names = parts_of(bits)
    out = ["doc_id", "text_hash", *names] + ["shingles", "size", "sig"] * with_shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, sets = [], []
            for t in batch.column(1):
                hashes = shingle_hashes(t.as_py(), width, bits)
                raw.append(fingerprint(hashes))
                if with_shingles:
                    sets.append(np.unique(np.ascontiguousarray(hashes[:, :4]).view(np.int32).ravel()))
            found = np.frombuffer(b"".join(raw), ">i8").reshape(-1, len(names)).astype(np.int64)
            columns = [batch.column(0), batch.column(2), *(pa.array(found[:, i]) for i in range(len(names)))]
            if with_shingles:
                sizes = np.array([len(x) for x in sets], np.int32)
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                marks = np.array([np.bitwise_or.reduce(np.uint64(1) << (x & 63).astype(np.uint64)) if len(x) else np.uint64(0) for x in sets], np.uint64)
                columns += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets))), pa.array(sizes), pa.array(marks.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, " + ", ".join(f"{c} bigint" for c in names) + ", shingles array<int>, size int, sig bigint" * with_shingles
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.xxhash64(f"`{text_col}`")).mapInArrow(frugal(run), schema)


def bit_statistics(distinct: DataFrame, bits: int) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each pair of bits is set, over all of them."""
    names = parts_of(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((bits, bits), np.float64)
        for batch in batches:
            values = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))], axis=1).astype(">i8")
            ones = np.unpackbits(values.view(np.uint8).reshape(-1, bits // 8), axis=1).astype(np.float32)
            total, both = total + len(ones), both + ones.T @ ones
        rows = np.concatenate(([total], both.ravel())).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array(rows)], ["i", "n"])

    sums = {r["i"]: r["n"] for r in distinct.select(*names).mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    counts = np.array([sums.get(i, 0) for i in range(bits * bits + 1)], np.float64)
    return int(counts[0]), counts[1:].reshape(bits, bits)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy groups of equal size: each starts at the free bit with the strongest tie and takes in the
    bits most correlated with what it has. Bit 0 is the highest. Ties go to the lower bit."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    phi = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(phi, 0)
    free, groups = list(range(len(both))), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (phi[b, free].max(), -b))]
        while len(group) < size:
            rest = [b for b in free if b not in group]
            group.append(max(rest, key=lambda b: (phi[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def meetings(n: int, both: np.ndarray, group: list[int], radius: int) -> float:
    """In how many buckets of a group two fingerprints meet on average, each sent to all keys within `radius`; from the bits' rates."""
    w = len(group)
    most = min(2 * radius, w)
    chance = np.zeros(most + 2)  # of 0, 1, .. differing bits
    chance[0] = 1.0
    for b in group:
        p = both[b, b] / max(n, 1)
        differ = 2 * p * (1 - p)
        chance[1:] = chance[1:] * (1 - differ) + chance[:-1] * differ
        chance[0] *= 1 - differ
    # Keys within radius of both: i of the x differing bits flipped, and j of the others.
    common = [sum(comb(x, i) * comb(w - x, j) for i in range(x + 1) for j in range(min(radius - i, radius - x + i, w - x) + 1)) for x in range(most + 1)]
    return float(np.dot(chance[: most + 1], common))


def plan_partitions(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)]: the cheapest allotment over 1 .. distance + 1 partitions, for PLANNED fingerprints or more.

    An empty table, too, has costs, so that no plan has more probes than could be listed.
    """
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    both = both * (max(n, PLANNED) / max(n, 1))
    n = max(n, PLANNED)
    for parts in range(1, distance + 2):
        groups = group_bits(n, both, parts)
        table = {0: (0.0, [])}  # sum of (threshold + 1) so far -> cost, thresholds
        for group in groups:
            price = [PROBE_COST * n * sum(comb(len(group), r) for r in range(radius + 1)) + PAIR_COST * n * n / 2 * meetings(n, both, group, radius) for radius in range((distance + 1) // 2 + 1)]
            grown: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, distance - used + 1):
                    more = 0.0 if t < 0 else price[(t + 1) // 2]
                    if (at := used + t + 1) not in grown or cost + more < grown[at][0]:
                        grown[at] = (cost + more, [*chosen, t])
            table = grown
        cost, chosen = table[distance + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def masks(bits: int, chosen) -> list[int]:
    """The signed 64-bit masks of a set of bits."""
    out = [0] * (bits // 64)
    for b in chosen:
        out[b // 64] |= 1 << (63 - b % 64)
    return [m - (1 << 64) if m >> 63 else m for m in out]


def distance_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # As unsigned numbers: of a negative one, numpy counts the bits of its absolute value.
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=-1, dtype=np.int16)


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the least one that the links (a, b) reach."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def forest(key: np.ndarray, values: np.ndarray, size: np.ndarray | None, distance: int, ratio: float, sig: np.ndarray | None = None) -> np.ndarray:
    """(n, 2) indexes: a spanning forest of the links among the members of each bucket.

    Rows are sorted by key, and with a ratio by size. Each row is compared with the next, the next but
    one and so on, all rows in one step, while there is a further member (of a size that fits: of two
    sets of a similarity of at least `ratio` the smaller has at least `ratio` times the other's size).
    sig: sets of 64 bits that the members' sets fall on; they differ in no more bits than the sets in
    members, which is at most (1 - ratio) / (1 + ratio) of both sizes. That tells short texts apart.
    """
    n = len(key)
    if not n:
        return np.empty((0, 2), np.int64)
    bucket = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
    if size is None:
        stop = np.searchsorted(bucket, bucket, "right")
    else:
        stop = np.searchsorted((bucket << 32) + size, (bucket << 32) + np.floor(size / ratio + 1e-9).astype(np.int64), "right")
    left, held_a, held_b, held = np.arange(n), [], [], 0
    links_a = links_b = np.empty(0, np.int64)
    step = 0
    while True:
        step += 1
        left = left[left + step < stop[left]]
        if held and (not len(left) or held > LINKS_AT_ONCE or step & (step - 1) == 0):
            root = roots_of(n, np.concatenate([links_a, *held_a]), np.concatenate([links_b, *held_b]))
            links_b = np.flatnonzero(root != np.arange(n))
            links_a, held_a, held_b, held = root[links_b], [], [], 0
            # A row that already hangs together with all that it has yet to meet adds nothing.
            ends = np.append(np.flatnonzero(root[1:] != root[:-1]) + 1, n)
            left = left[stop[left] > ends[np.searchsorted(ends, left, "right")]]
        if not len(left):
            return np.stack((links_a, links_b), axis=1)
        near = left[distance_between(values[left], values[left + step]) <= distance]
        if sig is not None:
            apart = np.bitwise_count((sig[near] ^ sig[near + step]).view(np.uint64))
            near = near[apart <= (1 - ratio) / (1 + ratio) * (size[near] + size[near + step]) + 1e-9]
        if len(near):
            held_a.append(near)
            held_b.append(near + step)
            held += len(near)


def probe_keys(k: int, group: list[int], radius: int, bits: int) -> Column:
    """array<struct<part, key>>: partition k's value with up to `radius` of its bits flipped, hashed."""
    names, mask = parts_of(bits), masks(bits, group)
    flips = [masks(bits, c) for r in range(radius + 1) for c in combinations(group, r)]
    patterns = F.array(*[F.struct(*[F.lit(m).alias(f"x{i}") for i, m in enumerate(f)]) for f in flips])
    value = lambda x: [F.col(c).bitwiseXOR(x[f"x{i}"]).bitwiseAND(F.lit(mask[i])) for i, c in enumerate(names)]
    return F.transform(patterns, lambda x: F.struct(F.lit(k).alias("part"), F.xxhash64(F.lit(k), *value(x)).alias("key")))


def links(distinct: DataFrame, bits: int, distance: int, bucket_limit: int = 8192) -> DataFrame:
    """(a, b): node numbers (see node) of links that connect whatever lies within `distance` bits."""
    names = parts_of(bits)
    n, both = bit_statistics(distinct, bits)
    plan = plan_partitions(n, both, distance)
    entries = [probe_keys(k, group, (t + 1) // 2, bits) for k, (group, t) in enumerate(plan)]
    probes = distinct.select(*names, F.explode(F.concat(*entries)).alias("p")).select(*names, "p.part", "p.key")
    used = {k: set(group) for k, (group, _) in enumerate(plan)}
    out: DataFrame | None = None
    while True:
        found, hot = cold_links(probes, bits, distance, bucket_limit)
        out = found if out is None else out.unionByName(found)
        if hot is None:
            return out
        left = {k: sorted(set(range(bits)) - group) for k, group in used.items()}
        if distance > NARROW:
            return out.unionByName(block_links(probes, hot, bits, distance, bucket_limit))
        if all(len(group) <= 2 * distance + 2 for group in left.values()):  # no more than a few members differ
            return out.unionByName(verified(probes.join(hot, "key", "left_semi"), bits, distance))
        split, nxt = {}, {}
        for k, group in left.items():
            split[k] = []
            for piece in np.array_split(np.array(group, int), distance + 1):
                nxt[len(nxt)] = used[k] | set(piece.tolist())
                split[k].append((len(nxt) - 1, masks(bits, piece.tolist())))
        pieces = F.create_map(*[x for k, v in split.items() for x in (F.lit(k), F.array(*[F.struct(F.lit(i).alias("part"), *[F.lit(w).alias(f"m{j}") for j, w in enumerate(m)]) for i, m in v]))])
        hotter = probes.join(hot, "key", "left_semi").select(*names, "key", F.explode(pieces[F.col("part")]).alias("p"))
        key_ = F.xxhash64("key", "p.part", *[F.col(c).bitwiseAND(F.col(f"p.m{i}")) for i, c in enumerate(parts_of(bits))])
        probes = hotter.select(*names, "p.part", key_.alias("key"))
        used = nxt


def cold_links(probes: DataFrame, bits: int, distance: int, bucket_limit: int, ratio: float = 0.0) -> tuple[DataFrame, DataFrame | None]:
    """Links within the buckets of up to bucket_limit members, and (key, n) of the larger ones; None if there are none."""
    hot = materialise(probes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit), "simhash-hot")
    if hot.isEmpty():
        return verified(probes, bits, distance, ratio), None
    return verified(probes.join(hot, "key", "left_anti"), bits, distance, ratio), hot


def block_links(probes: DataFrame, hot: DataFrame, bits: int, distance: int, bucket_limit: int, ratio: float = 0.0) -> DataFrame:
    """Links within the hot buckets: blocks of each meet two by two."""
    names = parts_of(bits) + ["size", "sig"] * (ratio > 0)
    blocks = F.ceil(F.col("n") * 2 / bucket_limit).cast("int")
    mine = F.pmod(F.xxhash64(*names), blocks.cast("bigint")).cast("int")
    met = probes.join(hot, "key").withColumn("mine", mine).select(*names, "key", "mine", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    met = met.select(*names, F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"))
    return verified(met, bits, distance, ratio)


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles that stand in many texts, the most frequent one last; from COUNTED texts, chosen by hash."""
    one_in = max(1, texts.count() // COUNTED)
    some = texts.where(F.pmod("text_hash", F.lit(one_in)) == 0).select(F.explode("shingles").alias("s"))
    counts = some.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    return counts.orderBy(F.desc("n"), "s").limit(TOLD).select("s").toArrow().column(0).to_numpy()[::-1].astype(np.int32)


def first_in_order(flat: np.ndarray, counts: np.ndarray, frequent: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, index into flat) of the first shingles of each set: n - ceil(similarity * n) + 1 of n.

    The order is: those not in frequent by hash (as they stand in flat), then those in it, as they stand there.
    """
    wanted = np.minimum(counts - np.ceil(similarity * counts - 1e-9).astype(np.int64) + 1, counts)
    row = np.repeat(np.arange(len(counts)), counts)
    level = np.full(len(flat), -1)
    if len(frequent):
        order = np.argsort(frequent)
        at = order[np.minimum(np.searchsorted(frequent, flat, sorter=order), len(order) - 1)]
        level = np.where(frequent[at] == flat, at, -1)
    rare, usual = np.flatnonzero(level < 0), np.flatnonzero(level >= 0)
    usual = usual[np.lexsort((level[usual], row[usual]))]
    rares = np.bincount(row[rare], minlength=len(counts))
    nth = lambda at, n: np.arange(len(at)) - (np.cumsum(n) - n)[row[at]]
    rare = rare[nth(rare, rares) < wanted[row[rare]]]
    usual = usual[nth(usual, counts - rares) + rares[row[usual]] < wanted[row[usual]]]
    chosen = np.concatenate((rare, usual))
    return row[chosen], chosen


def leading_shingles(texts: DataFrame, names: list[str], similarity: float) -> DataFrame:
    """(names .., key): a row for each of the first shingles of each text.

    Two sets of a and b members, a <= b, of at least that Jaccard similarity share s or more of either, s the
    larger of similarity * a and similarity * b. So of a members sorted in any one order the first a - s + 1,
    and of b the first b - s + 1, hold one in common: the first that they share. Frequent shingles come last in the
    order, so that a bucket holds few texts unless they have little else.
    """
    frequent = frequent_shingles(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            flat = lists.flatten().to_numpy()
            row, chosen = first_in_order(flat, np.diff(lists.offsets.to_numpy()).astype(np.int64), frequent, similarity)
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(own) for i in range(len(names))), pa.array(flat[chosen])], [*names, "key"])

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names)
    return texts.select(*names, "shingles").mapInArrow(frugal(run, 256), f"{kinds}, key int")


def shingle_links(probes: DataFrame, bits: int, distance: int, similarity: float, bucket_limit: int = 8192) -> DataFrame:
    """(a, b) as links() has them, from leading_shingles(): they connect all texts of that similarity that lie within `distance` bits."""
    probes = probes.withColumn("key", F.col("key").cast("bigint"))
    found, hot = cold_links(probes, bits, distance, bucket_limit, similarity)
    return found if hot is None else found.unionByName(block_links(probes, hot, bits, distance, bucket_limit, similarity))


def node(names: list[str], prefix: str = "") -> Column:
    """The number of a fingerprint (and size): itself if it is one of 64 bits alone, else a hash."""
    return F.col(prefix + names[0]) if len(names) == 1 else F.xxhash64(*[F.col(prefix + c) for c in names])


def verified(probes: DataFrame, bits: int, distance: int, ratio: float = 0.0) -> DataFrame:
    """Links within the buckets of equal keys; with a ratio, probes have columns size and sig too, and only pairs that these allow are linked. Buckets stream by in the order of their keys; a task holds ROWS_AT_ONCE rows and one bucket."""
    names, sized = parts_of(bits), ratio > 0
    every = names + ["size", "sig"] * sized
    ends = [f"{side}{c}" for side in "ab" for c in every]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # (rows, 1 + parts + size and sig)
        rows = 0

        def linked(block: np.ndarray) -> pa.RecordBatch:
            a, b = forest(block[:, 0], np.ascontiguousarray(block[:, 1 : 1 + len(names)]), block[:, -2] if sized else None, distance, ratio, np.ascontiguousarray(block[:, -1]) if sized else None).T
            return pa.RecordBatch.from_arrays([pa.array(block[side, 1 + i]) for side in (a, b) for i in range(len(every))], ends)

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1 + len(every))], axis=1))
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                block = np.concatenate(held)
                cut = int(np.searchsorted(block[:, 0], block[-1, 0]))  # the last bucket may go on
                if cut:
                    yield linked(block[:cut])
                held, rows = [block[cut:].copy()], len(block) - cut
        if rows:
            yield linked(np.concatenate(held))

    dealt = probes.select("key", *every).repartition("key").sortWithinPartitions("key", *(["size"] if sized else []))
    pairs = dealt.mapInArrow(frugal(run, 1 << 16), ", ".join(f"{c} bigint" for c in ends))
    cast = pairs.withColumns({f"{side}size": F.col(f"{side}size").cast("int") for side in "ab"}) if sized else pairs
    return cast.select(node(every, "a").alias("a"), node(every, "b").alias("b"))


def grouped(docs: DataFrame, width: int, bits: int, distance: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, node, f0 ..) by row, and (node, root, component_id) by distinct fingerprint."""
    names = parts_of(bits)
    prints = materialise(fingerprints(docs, width, bits, id_col, text_col).withColumn("node", node(names)), "simhash-fp")
    nodes = materialise(prints.groupBy("node", *names).agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = connected_components(links(nodes.select(*names), bits, distance), "simhash")
    rooted = nodes.select("node", "least").join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, materialise(rooted.join(named, "root").select("node", "component_id").distinct(), "simhash-groups")


def near_duplicate_groups(docs: DataFrame, width: int = 3, distance: int = 2, bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex digits), component_id: the smallest id that links can reach.

    One row for each input row: repeated rows stay and are linked. Null and empty texts share the
    fingerprint zero and so one group. A null id stays null and is never a group's name; a group of
    null ids only has a null name. An empty table gives an empty one. Other columns are ignored.
    """
    prints, groups = grouped(docs, width, bits, distance, id_col, text_col)
    hexed = F.concat(*[F.lower(F.lpad(F.hex(c), 16, "0")) for c in parts_of(bits)]).alias("fingerprint")
    return prints.join(groups, "node").select("doc_id", hexed, "component_id")


class ShingleIndex:
    """Sets of shingles, to be compared with further ones."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray):
        order = np.argsort(flat, kind="stable")
        self.values, self.owners, self.counts = flat[order], np.repeat(np.arange(len(counts)), counts)[order], counts

    def alike(self, shingles: np.ndarray, similarity: float) -> np.ndarray:
        """Of which sets the Jaccard similarity to these shingles is at least that; two empty ones are alike."""
        low = np.searchsorted(self.values, shingles)
        n = np.searchsorted(self.values, shingles, "right") - low
        met = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.owners[met], minlength=len(self.counts))
        return both >= similarity * (self.counts + len(shingles) - both) - 1e-9


def sets_of(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets, and the number of each."""
    return lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def lead(ranked: DataFrame, similarity: float) -> DataFrame:
    """(root, text, shingles) of each group's texts, taken in order of `first`, that are not alike to one taken before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []  # texts and shingles of one group, which LEADERS and LEADING bound

        def taken() -> pa.RecordBatch:
            sets = [x for _, x in held]
            index = ShingleIndex(np.concatenate(sets), np.array([len(x) for x in sets]))
            chosen: list[int] = []
            for i, x in enumerate(sets):
                if not chosen or not index.alike(x, similarity)[chosen].any():
                    chosen.append(i)
            ends = pa.array(np.cumsum([0, *(len(sets[i]) for i in chosen)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([sets[i] for i in chosen])))
            return pa.RecordBatch.from_arrays([pa.array([at] * len(chosen), pa.int64()), pa.array([held[i][0] for i in chosen], pa.int64()), lists], ["root", "text", "shingles"])

        for batch in batches:
            flat, counts = sets_of(batch.column(2))
            for root, text, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.split(flat, np.cumsum(counts)[:-1])):
                if root != at and held:
                    yield taken()
                    held = []
                at = root
                held.append((text, x))
        if held:
            yield taken()

    dealt = ranked.repartition("root").sortWithinPartitions("root", "first").select("root", "first.text", "shingles")
    return dealt.mapInArrow(frugal(run, 256), "root bigint, text bigint, shingles array<int>")


def meet(left: DataFrame, led: DataFrame, similarity: float) -> DataFrame:
    """left without its leaders, and shingles null where a text is alike to a leader of its group: these go. led has a row for each part of a group."""
    member = left.select("root", "salt", F.lit(1).alias("member"), F.col("first.text").alias("text"), "first", "shingles")
    leader = led.select("root", "salt", F.lit(0).alias("member"), "text", F.lit(None).cast(left.schema["first"].dataType).alias("first"), "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index, names = None, [], None, set()
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            ends = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(ends, ends[1:]):
                part, (root, salt, is_member) = batch.slice(a, b - a), keys[a].tolist()
                if at != (root, salt):
                    at, held, index, names = (root, salt), [], None, set()
                flat, counts = sets_of(part.column(5))
                texts = part.column(3).to_pylist()
                if not is_member:
                    held.append((flat, counts))
                    names.update(texts)
                    continue
                if index is None:
                    index = ShingleIndex(*(np.concatenate(x) for x in zip(*held)))
                sets = np.split(flat, np.cumsum(counts)[:-1])
                rest = [i for i, t in enumerate(texts) if t not in names]
                stays = pa.array([None if index.alike(sets[i], similarity).any() else i for i in rest], pa.int64())
                own = part.take(pa.array(rest, pa.int64()))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(4), part.column(5).take(stays)], ["root", "salt", "first", "shingles"])

    dealt = leader.unionByName(member).repartition("root", "salt").sortWithinPartitions("root", "salt", "member")
    return dealt.mapInArrow(frugal(run, 256), f"root bigint, salt bigint, first {left.schema['first'].dataType.simpleString()}, shingles array<int>")


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8, distance: int = 40, bits: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that are near duplicates of a row that stays; all columns stay.

    Candidates are the groups of texts that are linked by a shingle among their first ones (see
    leading_shingles: all pairs of that similarity have one), by fingerprints (128 bits over five-word shingles)
    of at most `distance` differing bits, and by numbers of distinct shingles, and the 64 bits that these fall on,
    that allow the similarity. The pairs looked at grow with the texts that share a rare shingle, not with the square of the table.
    Within a group the text of the least id (in a tie, or where ids are null, of the least hash) leads:
    it stays, and every text whose set of shingles has a Jaccard similarity of at least `similarity` to
    the leader's goes; of what is left the least id leads next, until nothing is left. So a row goes
    only if a row that stays is that similar to it (hashes of 32 bits, all of them, compared), and no two
    texts of a group that stay are. Up to LEADERS texts of LEADING shingles lead in one round; a large group is split, and
    each part meets copies of the leaders.

    Of equal texts one row stays, that of the least id. Null and empty texts (no shingles) are alike;
    a null text and an empty one count as two texts with one set. Null ids and ids that repeat with unlike texts
    are as good as others. Repeated rows leave one. An empty table gives an empty one. Pairs of that similarity whose
    fingerprints differ in more bits are not found: see the README for the measured recall.
    """
    names = [*parts_of(bits), "size", "sig"]
    prints = fingerprints(docs, width, bits, id_col, text_col, with_shingles=True).withColumn("node", node(names))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("text"))
    # One row for each distinct text, reduced before the shuffle: copies, however many, go no further.
    texts = prints.groupBy("text_hash", "node", *names).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"), F.first("shingles").alias("shingles"))
    texts = materialise(texts, "simhash-texts")
    probes = materialise(leading_shingles(texts, names, similarity), "simhash-probes")
    found = connected_components(shingle_links(probes, bits, distance, similarity), "simhash")
    discard(probes)
    placed = texts.select("node").join(found, "node", "left").select(F.coalesce("root", "node").alias("root"))
    sizes = materialise(placed.groupBy("root").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "simhash-sizes")
    salt = F.pmod(F.xxhash64("text_hash"), F.ceil(F.col("k") / GROUP_SPLIT).cast("bigint"))
    many = texts.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")).join(sizes, "root")
    left = opened = materialise(many.select("root", salt.alias("salt"), "first", "shingles"), "simhash-open")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        # The first few of each group in order; of these, one by one, those that are not like one taken before.
        in_order = Window.partitionBy("root").orderBy("first")
        ranked = left.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= LEADERS)
        ranked = ranked.withColumn("held", F.sum(F.size("shingles")).over(in_order)).where((F.col("held") <= LEADING) | (F.col("rank") == 1))
        salts = left.select("root", "salt").distinct()
        led = lead(ranked, similarity).join(salts, "root")
        met = materialise(meet(left, led, similarity), "simhash-met")
        rounds.append(met)
        left = met.where("shingles is not null")
    kept = texts.select("text_hash", "first", "n")
    if rounds:
        gone = reduce(DataFrame.unionByName, [met.where("shingles is null").select(F.col("first.text").alias("text_hash")) for met in rounds])
        kept = kept.join(gone, "text_hash", "left_anti")
    kept = materialise(kept.select(F.col("first.id").alias("__id"), F.col("text_hash").alias("__text"), "n"), "simhash-kept")
    discard(texts, found, sizes, opened, *rounds)
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(f"`{text_col}`") == F.col("__text"))
    stay = docs.join(kept.where("n = 1").select("__id", "__text"), same, "left_semi")
    copied = kept.where("n > 1").select("__id", "__text")
    if copied.isEmpty():
        return stay
    # Of equal texts under one id, too, a single row.
    repeats = docs.join(copied, same, "left_semi").withColumn("__text", F.xxhash64(f"`{text_col}`")).dropDuplicates([id_col, "__text"]).drop("__text")
    return stay.unionByName(repeats)
