"""Toxic spans and document scores by a linear-chain conditional random field.

Training, on a bounded hash sample of labelled rows: words that appear in far more toxic than clean
documents (counted once for each group of near copies) label the tokens of toxic documents; a CRF over
the two tags with word, prefix, suffix and shape features learns them by the exact gradient of its
likelihood; a logistic curve maps the marginals of whole documents to the chance of their label.
Scoring, on every whole text: forward-backward marginals by token, aggregated to a score, and the
character offsets of tokens whose toxic marginal is at least one half.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal

TOKEN = re.compile(r"\w+")
BUCKETS, SEGMENT, SLICE_CHARS, SLICE_TOKENS = 1 << 16, 128, 1 << 20, 1 << 17
#: Bounds of training, in whole labelled rows of each class: those that are looked at, and those of them that the CRF itself sees.
CLASS_ROWS, CRF_ROWS, STEPS = 1500, 400, 30


def features(word: str) -> list[int]:
    low = word.lower()
    shape = "9" if any(c.isdigit() for c in low) else "A" if word.isupper() else "a"
    return [zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS for f in (f"w={low}", f"p={low[:4]}", f"s={low[-4:]}", f"h={shape}")]


def markers(word: str) -> list[str]:
    """What can mark a (lower-case) word as toxic: itself, or how it begins."""
    return [word, *(f"{word[:k]}-" for k in range(4, min(8, len(word))))]


def marginals(odds: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many documents laid end to end.

    odds: log potential of tag 1 against tag 0 for each token; first: whether a document begins
    there; start (2), step (2 x 2): log potentials. Returns the marginal of tag 1 for each token, the
    expected counts of tag pairs and the log partition sum. The chain is cut into segments that run side
    by side; what a segment does to a vector is a 2 x 2 matrix, and those are chained first.
    """
    n = len(odds)
    if n == 0:
        return np.empty(0), np.zeros((2, 2)), 0.0
    cols = -(-n // SEGMENT)
    pad = cols * SEGMENT - n
    lay = lambda x, fill: np.ascontiguousarray(np.concatenate((x, np.full(pad, fill, x.dtype))).reshape(cols, SEGMENT).T)
    top = lay(np.maximum(odds, 0.0), 0.0)
    o1, o0 = np.exp(lay(odds, 0.0) - top), np.exp(-top)
    new = lay(first, True)
    s, a = np.exp(start), np.exp(step)
    # The matrix of token t: m[i][j], from tag i to tag j.
    m = [[np.where(new, s[j], a[i, j]) * (o1 if j else o0) for j in (0, 1)] for i in (0, 1)]
    p = [[np.ones(cols), np.zeros(cols)], [np.zeros(cols), np.ones(cols)]]
    for t in range(SEGMENT):
        p = [[p[i][0] * m[0][j][t] + p[i][1] * m[1][j][t] for j in (0, 1)] for i in (0, 1)]
        size = p[0][0] + p[0][1] + p[1][0] + p[1][1]
        p = [[x / size for x in row] for row in p]
    (p00, p01), (p10, p11) = [[x.tolist() for x in row] for row in p]
    enter, leave = np.empty((2, cols)), np.empty((2, cols))
    x, y = 1.0, 0.0  # before the first token; a document begins there, so any vector will do
    for c in range(cols):
        enter[0, c], enter[1, c] = x, y
        x, y = x * p00[c] + y * p10[c], x * p01[c] + y * p11[c]
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for c in range(cols - 1, -1, -1):
        leave[0, c], leave[1, c] = x, y
        x, y = p00[c] * x + p01[c] * y, p10[c] * x + p11[c] * y
        x, y = x / (x + y), y / (x + y)
    forward, log_z = np.empty((2, SEGMENT, cols)), 0.0
    f0, f1 = enter
    before = np.empty((2, SEGMENT, cols))
    for t in range(SEGMENT):
        before[0, t], before[1, t] = f0, f1
        g0, g1 = f0 * m[0][0][t] + f1 * m[1][0][t], f0 * m[0][1][t] + f1 * m[1][1][t]
        size = g0 + g1
        log_z += float(np.log(size).sum())
        f0, f1 = g0 / size, g1 / size
        forward[0, t], forward[1, t] = f0, f1
    toxic, pairs = np.empty((SEGMENT, cols)), np.zeros((2, 2))
    b0, b1 = leave
    real = ~new
    for t in range(SEGMENT - 1, -1, -1):
        joint0, joint1 = forward[0, t] * b0, forward[1, t] * b1
        toxic[t] = joint1 / (joint0 + joint1)
        e = [[before[i, t] * m[i][j][t] * (b1 if j else b0) for j in (0, 1)] for i in (0, 1)]
        size = e[0][0] + e[0][1] + e[1][0] + e[1][1]
        for i in (0, 1):
            for j in (0, 1):
                pairs[i, j] += float((e[i][j] / size)[real[t]].sum())
        c0, c1 = m[0][0][t] * b0 + m[0][1][t] * b1, m[1][0][t] * b0 + m[1][1][t] * b1
        size = c0 + c1
        b0, b1 = c0 / size, c1 / size
    log_z += float(top.T.ravel()[:n].sum()) - pad * float(np.log(s[0] + s[1]))
    return toxic.T.ravel()[:n], pairs, log_z


def copy_groups(texts: list[set[str]], alike: float = 0.25) -> list[int]:
    """A number for each text, equal for texts that share a quarter of their rarer words, directly or by others."""
    n = len(texts)
    spread = Counter(w for words in texts for w in words)
    rare = {w: k for k, w in enumerate(w for w, c in spread.items() if c <= max(2, 0.05 * n))}
    own = [[rare[w] for w in words if w in rare] for words in texts]
    holders: list[list[int]] = [[] for _ in rare]
    for i, words in enumerate(own):
        for k in words:
            holders[k].append(i)
    size = np.array([len(words) for words in own])
    group = np.arange(n)
    for i, words in enumerate(own):
        common = np.bincount(np.fromiter((j for k in words for j in holders[k]), np.int64), minlength=n)
        near = np.flatnonzero((common > 0) & (common >= alike * (size + size[i] - common)))
        if len(near) > 1:
            group[np.isin(group, group[near])] = group[near].min()
    return group.tolist()


class ToxicModel:
    """weights of the hashed features, start and step potentials, the curve of the score, the words that labelled tokens."""

    def __init__(self, weights: np.ndarray, start: np.ndarray, step: np.ndarray, curve: np.ndarray, words: list[str]):
        self.weights, self.start, self.step, self.curve, self.words = weights, start, step, curve, words

    def document_features(self, odds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals by token; by document: 1, the largest marginal, logarithms of 1 + their sum and of 1 + their sum in a hundred tokens."""
        ends = np.cumsum(sizes)
        first = np.zeros(len(odds), bool)
        begin = ends - sizes
        first[begin[sizes > 0]] = True
        toxic, _, _ = marginals(odds, first, self.start, self.step)
        out = np.zeros((len(sizes), 4))
        out[:, 0] = 1
        if len(toxic):
            some = sizes > 0
            out[some, 1] = np.maximum.reduceat(toxic, begin[some])
            sums = np.add.reduceat(toxic, begin[some])
            out[some, 2] = np.log1p(sums)
            out[some, 3] = np.log1p(100 * sums / sizes[some])
        return toxic, out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


class Odds(dict):
    """Log odds by word, filled as words come; bounded."""

    def __init__(self, weights: np.ndarray, most: int = 200_000):
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        value = float(np.clip(sum(float(self.weights[f]) for f in features(word)), -30, 30))
        if len(word) <= 64:
            self[word] = value
        return value


def slices(sizes: np.ndarray, most: int = SLICE_TOKENS) -> Iterator[tuple[int, int]]:
    """Runs of documents, from and to, of at most `most` tokens together or of one document."""
    begin, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if len(sizes):
        yield begin, len(sizes)


def fit(texts: list[str], toxic: list[int], share: float) -> ToxicModel:
    """share: that of toxic rows among all labelled ones; the sample itself holds as many of each class as there are."""
    blank = lambda curve: ToxicModel(np.zeros(BUCKETS), np.zeros(2), np.zeros((2, 2)), np.array(curve), [])
    y = np.array(toxic, int)
    if not len(y) or y.min() == y.max():
        return blank([30.0 if len(y) and y[0] else -30.0, 0.0, 0.0, 0.0])
    # Texts are held as numbers of words from here on, and what is not is built a document or a slice at a time.
    vocabulary: dict[str, int] = {}
    raw = [np.fromiter((vocabulary.setdefault(m[0], len(vocabulary)) for m in TOKEN.finditer(t)), np.int32) for t in texts]
    own = [np.unique(r) for r in raw]
    low = [w.lower() for w in vocabulary]
    marks: dict[str, int] = {}
    marks_of = [[marks.setdefault(m, len(marks)) for m in markers(w)] for w in low]
    marks_in = lambda rows: list({m for i in rows for w in own[i].tolist() for m in marks_of[w]})
    counts, sizes = np.zeros((2, len(marks)), np.int64), [0, 0]
    for i in np.flatnonzero(y == 0).tolist():
        sizes[0] += 1
        counts[0, marks_in([i])] += 1
    by_group: dict[int, list[int]] = {}
    bad = np.flatnonzero(y == 1).tolist()
    for i, g in zip(bad, copy_groups([{low[w] for w in own[i].tolist()} for i in bad])):
        by_group.setdefault(g, []).append(i)
    sizes[1] = len(by_group)
    for rows in by_group.values():
        counts[1, marks_in(rows)] += 1
    # Log-likelihood ratio of a word's share in either class, against chance over all words tried.
    def ratio(c1: int, c0: int) -> float:
        share_all = (c1 + c0) / (sizes[0] + sizes[1])
        part = lambda k, n: k * np.log(k / n / share_all) if k else 0.0
        return 2 * float(part(c1, sizes[1]) + part(c0, sizes[0]))

    limit = 2 * np.log(max(2, np.count_nonzero(counts[1]))) + 4
    tried = ((m, *counts[:, k].tolist()) for m, k in marks.items())
    marked = sorted(m for m, c0, c1 in tried if c1 >= 3 and c1 / sizes[1] >= 3 * (c0 + 1) / (sizes[0] + 1) and ratio(c1, c0) >= limit)
    if not marked:
        return blank([float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), 0.0, 0.0, 0.0])
    known = set(marked)
    words = list(vocabulary)
    marks_toxic = np.array([not known.isdisjoint(markers(w)) for w in low])
    chosen = [*np.flatnonzero(y == 1)[:CRF_ROWS].tolist(), *np.flatnonzero(y == 0)[:CRF_ROWS].tolist()]
    chosen = [i for i in chosen if len(raw[i])]
    lengths = np.array([len(raw[i]) for i in chosen])
    tags = np.concatenate([marks_toxic[raw[i]] & (y[i] == 1) for i in chosen]).astype(np.float64)
    used, ids = np.unique(np.concatenate([raw[i] for i in chosen]), return_inverse=True)
    ends = np.cumsum(lengths)
    first = np.zeros(len(ids), bool)
    first[ends - lengths] = True
    runs = [slice(int(ends[a] - lengths[a]), int(ends[b - 1])) for a, b in slices(lengths)]
    of = np.array([features(words[w]) for w in used.tolist()], np.int64)
    weights, start, step = np.zeros(BUCKETS), np.zeros(2), np.zeros((2, 2))
    gold = np.bincount(of.ravel(), np.repeat(np.bincount(ids, tags, len(of)), of.shape[1]), BUCKETS)
    gold_pairs = np.zeros((2, 2))
    follows = np.flatnonzero(~first)
    np.add.at(gold_pairs, (tags[follows - 1].astype(int), tags[follows].astype(int)), 1)
    gold_start = np.array([(tags[first] == 0).sum(), (tags[first] == 1).sum()], float)
    seen = [np.zeros_like(v) for v in (weights, step, start)]
    total = len(ids)
    for _ in range(STEPS):
        odds = np.clip(weights[of].sum(axis=1), -30, 30)
        by_word, pairs, at_start = np.zeros(len(of)), np.zeros((2, 2)), np.zeros(2)
        for run in runs:
            p, some, _ = marginals(odds[ids[run]], first[run], start, step)
            by_word += np.bincount(ids[run], p, len(of))
            pairs += some
            at_start += [(1 - p[first[run]]).sum(), p[first[run]].sum()]
        expected = np.bincount(of.ravel(), np.repeat(by_word, of.shape[1]), BUCKETS)
        slopes = (gold - expected - 1e-2 * weights, gold_pairs - pairs - 1e-2 * step, gold_start - at_start - 1e-2 * start)
        for value, slope, past in zip((weights, step, start), slopes, seen):  # AdaGrad
            past += (slope / total) ** 2
            value += 0.7 * (slope / total) / np.sqrt(past + 1e-16)
    model = ToxicModel(weights, start, step, np.zeros(4), marked)
    cache = Odds(weights)
    odds = np.array([cache[w] for w in words])
    sizes_of = np.array([len(r) for r in raw])
    x = np.concatenate([model.document_features(odds[np.concatenate(raw[a:b])], sizes_of[a:b])[1] for a, b in slices(sizes_of)])
    sample = y.mean()
    weight = np.where(y == 1, share / sample, (1 - share) / (1 - sample))
    curve = np.zeros(4)
    for _ in range(30):  # Newton
        z = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (y - z)) - 1e-2 * curve
        bend = (x * (weight * z * (1 - z))[:, None]).T @ x + 1e-2 * np.eye(4)
        curve = curve + np.clip(np.linalg.solve(bend, slope), -4, 4)
    model.curve = curve
    return model


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, class_rows: int = CLASS_ROWS) -> ToxicModel:
    """Fit on the whole texts of at most class_rows labelled rows of each class, chosen by hashed id; the CRF itself sees CRF_ROWS of either.

    may_learn: a condition on doc_id. Null labels and ids are left out; of several labels of an id
    the largest counts; of several texts of an id the least.
    """
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    ids = [tuple(r) for kind in (0, 1) for r in known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(class_rows).collect()]
    if not ids:
        return fit([], [], 0.0)
    wanted = F.broadcast(docs.sparkSession.createDataFrame(ids, "doc_id bigint, toxic int"))
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text).join(wanted, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], counts.get(1, 0) / max(1, sum(counts.values())))


def score_documents(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns of keep, score, spans (begin, end in characters, toxic marginal).

    Every whole text is scored; null, empty and wordless texts get the score of a document without
    toxic tokens and no spans. Repeated rows stay; an empty table gives an empty one.
    """
    schema = docs.select(*keep).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "score double, spans array<struct<begin: int, end: int, p: double>>"])
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Odds(model.weights)
        look = cache.__getitem__
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            scores, spans, at = [], [], 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                    chars += len(texts[end])
                    end += 1
                parts = []
                for t in texts[at:end]:
                    words = TOKEN.findall(t)
                    parts.append(np.fromiter(map(look, words), np.float64, len(words)))
                sizes = np.array([len(p) for p in parts])
                toxic, x = model.document_features(np.concatenate(parts), sizes)
                scores.append(model.score(x))
                begins = np.cumsum(sizes) - sizes
                for i, text in enumerate(texts[at:end]):
                    if x[i, 1] < 0.5:
                        spans.append([])
                        continue
                    mine = toxic[begins[i] : begins[i] + sizes[i]].tolist()
                    spans.append([{"begin": m.start(), "end": m.end(), "p": p} for m, p in zip(TOKEN.finditer(text), mine) if p >= 0.5])
                at = end
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(np.concatenate(scores) if scores else np.empty(0)), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "score", "spans"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col)).mapInArrow(frugal(run), out)
