"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text is cut into windows of WINDOW bytes, which cover all of it; each direction starts every window
from zero. Every position gets a distribution over the languages from the two states there, and a
document the mean of its positions'. Trained by backpropagation through time on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal

WINDOW, HIDDEN, LANES = 64, 8, 1024
#: Bounds of training: whole texts of each language (by hash), steps, windows a step.
LANG_ROWS, STEPS, BATCH = 600, 260, 256
LETTER = regex.compile(r"\p{L}")


class ByteGru:
    """table: (2, 256, 3H) what a byte adds to the gates z, r and the candidate; u: (2, H, 3H); v: (2H, C); c: (C)."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, h = langs, hidden
        self.p = {
            "table": rng.normal(0, 0.5, (2, 256, 3 * h)).astype(np.float32),
            "u": rng.normal(0, h**-0.5, (2, h, 3 * h)).astype(np.float32),
            "v": rng.normal(0, h**-0.5, (2 * h, len(langs))).astype(np.float32),
            "c": np.zeros(len(langs), np.float32),
        }

    def states(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """x: (L, B) bytes -> (2, L, B, H): the state of either direction after it has read that position.

        Squashing is x / (1 + |x|) throughout, which costs a fraction of tanh; a gate is half of 1 + that.
        """
        table, u = self.p["table"], self.p["u"]
        size, lanes = x.shape
        h = u.shape[1]
        out = np.empty((2, size, lanes, h), u.dtype)
        state = np.zeros((2, lanes, h), u.dtype)
        inner, seen, low = np.empty((2, lanes, 3 * h), u.dtype), np.empty((2, lanes, 3 * h), u.dtype), np.empty((2, lanes, 2 * h), u.dtype)
        for t in range(size):
            np.take(table[0], x[t], axis=0, out=seen[0], mode="clip")
            np.take(table[1], x[size - 1 - t], axis=0, out=seen[1], mode="clip")
            np.matmul(state, u, out=inner)
            gates = seen[..., : 2 * h] + inner[..., : 2 * h]
            np.abs(gates, out=low)
            low += 1
            gates /= low
            gates += 1
            gates *= 0.5
            z, r = gates[..., :h], gates[..., h:]
            new = r * inner[..., 2 * h :]
            new += seen[..., 2 * h :]
            small = low[..., :h]
            np.abs(new, out=small)
            small += 1
            new /= small
            if trace is not None:
                trace.append((state, gates, new, inner[..., 2 * h :].copy()))
            state = state - new
            state *= z
            state += new
            out[0, t], out[1, size - 1 - t] = state[0], state[1]
        return out

    def positions(self, states: np.ndarray) -> np.ndarray:
        """(C, L, B): the distribution over languages at each position."""
        h = states.shape[3]
        p = self.p["v"][:h].T @ states[0].reshape(-1, h).T
        p += self.p["v"][h:].T @ states[1].reshape(-1, h).T
        p += self.p["c"][:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p.reshape(-1, *states.shape[1:3])

    def slopes(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients. x: (L, B) bytes; y: (B) languages; weight: (L, B), zero on padding."""
        trace: list = []
        states = self.states(x, trace)
        p = self.positions(states)
        size, lanes = x.shape
        u, h = self.p["u"], self.p["u"].shape[1]
        loss = float(-(np.log(p[y, :, np.arange(lanes)].T + 1e-9) * weight).sum())
        d = p.copy()
        d[y, :, np.arange(lanes)] -= 1
        d *= weight
        flat = d.reshape(d.shape[0], -1)
        g = {"v": np.concatenate([states[k].reshape(-1, h).T @ flat.T for k in (0, 1)]), "c": flat.sum(axis=1), "u": np.zeros_like(u), "table": np.zeros_like(self.p["table"])}
        back = [(flat.T @ self.p["v"][k * h : (k + 1) * h].T).reshape(size, lanes, h) for k in (0, 1)]
        carry = np.zeros((2, lanes, h), u.dtype)
        for t in range(size - 1, -1, -1):
            before, gates, new, inner = trace[t]
            carry = carry + np.stack((back[0][t], back[1][size - 1 - t]))
            z, r = gates[..., :h], gates[..., h:]
            bend = 0.5 * (1 - np.abs(2 * gates - 1)) ** 2
            d_new = carry * (1 - z) * (1 - np.abs(new)) ** 2
            d_z = carry * (before - new) * bend[..., :h]
            d_r = d_new * inner * bend[..., h:]
            into = np.concatenate((d_z, d_r, d_new), axis=2)  # what reaches the bytes' table
            rec = np.concatenate((d_z, d_r, d_new * r), axis=2)  # what reaches u
            np.add.at(g["table"][0], x[t], into[0])
            np.add.at(g["table"][1], x[size - 1 - t], into[1])
            g["u"] += np.matmul(before.transpose(0, 2, 1), rec)
            carry = carry * z + np.matmul(rec, u.transpose(0, 2, 1))
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 11) -> None:
        """Adam over batches with as many windows of each language; x: (N, L), weight: (N, L)."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        of = [o for o in of if len(o)]
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        for n in range(1, steps + 1):
            at = np.concatenate([rng.choice(o, max(1, batch // len(of))) for o in of])
            w = weight[at].T.astype(np.float32)
            _, g = self.slopes(np.ascontiguousarray(x[at].T), y[at], w / w.sum())
            rate = 0.02 * (1 - 0.9 * n / steps)
            for k, slope in g.items():
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.01 * (slope * slope - square[k])
                self.p[k] -= (rate * (mean[k] / (1 - 0.9**n)) / (np.sqrt(square[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)

    def documents(self, raw: list[bytes]) -> np.ndarray:
        """Mean distribution of the positions of each text (zeros for no bytes)."""
        sizes = np.array([len(b) for b in raw], np.int64)
        windows = -(-sizes // WINDOW)
        x = np.full(int(windows.sum()) * WINDOW, 32, np.uint8)
        begin = (np.cumsum(windows) - windows) * WINDOW
        for b, at in zip(raw, begin.tolist()):
            x[at : at + len(b)] = np.frombuffer(b, np.uint8)
        x = x.reshape(-1, WINDOW)
        fill = np.full(len(x), WINDOW, np.int64)
        fill[np.cumsum(windows)[windows > 0] - 1] -= (windows * WINDOW - sizes)[windows > 0]
        sums = np.zeros((len(x), len(self.langs)))
        inside = np.arange(WINDOW)[:, None]
        for at in range(0, len(x), LANES):
            part = np.ascontiguousarray(x[at : at + LANES].T)
            p = self.positions(self.states(part))
            short = fill[at : at + LANES]
            if (short < WINDOW).any():
                p *= inside < short[None, :]
            sums[at : at + LANES] = p.sum(axis=1).T
        out = np.zeros((len(raw), len(self.langs)))
        some = windows > 0
        if some.any():
            out[some] = np.add.reduceat(sums, (np.cumsum(windows) - windows)[some], axis=0) / sizes[some][:, None]
        return out


def train(docs: DataFrame, may_learn: Column | None = None, rows: int = LANG_ROWS, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> ByteGru:
    """Fit on the `rows` distinct texts of each language whose hashes are least, each as a whole.

    Null languages, texts and ids are left out. The languages are those with rows to learn from, in
    alphabetical order.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where("lang is not null and doc_id is not null")
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return ByteGru([])
    # Few texts are sorted: those whose hashes fall under twice the share of them that is wanted.
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 2 * rows / max(n, 1) + 1e-3 * (n < 10_000)))])[F.col("lang")]
    place = (F.col("h") / F.lit(2.0**64)) + 0.5
    few = known.where("text is not null").where((place < share) | (share >= 1.0)).dropDuplicates(["lang", "h"])
    least = Window.partitionBy("lang").orderBy("h")
    found = few.withColumn("k", F.row_number().over(least)).where(F.col("k") <= rows).select("lang", "text").collect()
    found.sort(key=lambda r: (r["lang"], r["text"]))
    x, y, w = [], [], []
    for r in found:
        raw = np.frombuffer(r["text"].encode("utf-8", "replace"), np.uint8)
        lanes = -(-len(raw) // WINDOW)
        if lanes:
            x.append(np.concatenate((raw, np.full(lanes * WINDOW - len(raw), 32, np.uint8))).reshape(lanes, WINDOW))
            y.append(np.full(lanes, langs.index(r["lang"])))
            w.append((np.arange(lanes * WINDOW) < len(raw)).reshape(lanes, WINDOW))
    model = ByteGru(langs)
    if x and len(langs) > 1:
        model.fit(np.concatenate(x), np.concatenate(y), np.concatenate(w))
    return model


def identify(docs: DataFrame, model: ByteGru, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns of keep, lang_pred, score (the pooled probability of lang_pred), probabilities by language.

    `und` with score 0 if the text is null or has no letter, or if nothing was learned. Repeated
    rows stay; an empty table gives an empty one. Whole texts count, whatever their length.
    """
    schema = docs.select(*keep).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            useful = [i for i, t in enumerate(texts) if t and model.langs and LETTER.search(t)]
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            if useful:
                p = model.documents([texts[i].encode("utf-8", "replace") for i in useful])
                for i, row in zip(useful, p):
                    k = int(row.argmax())
                    langs[i], scores[i] = model.langs[k], min(1.0, float(row[k]))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col)).mapInArrow(frugal(run), out)
