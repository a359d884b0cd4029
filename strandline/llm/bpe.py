"""Byte-level BPE encoding and decoding by a traversal of a trie of distinct words.

The distinct words of a batch form a trie of bytes; sorted, they are its depth-first walk, as each goes on
from the node where it parts from the one before. The walk gives every node
the last token of the encoding of the prefix that it stands for. That token is the only vocabulary
entry t ending there whose join with the last token of the remaining prefix is stable, that is, whose
two tokens BPE leaves as they are. The entries that end at a node, longest first, are the output of an
Aho-Corasick automaton over the vocabulary. A word's ids are read off by stepping back from its node, so the
encoding of a prefix that many words share is computed once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal

#: Fixed: the word pattern of the public byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Bytes of two neighbours in order that are compared for a common prefix, and steps of the automaton that are held.
COMPARED, STEPS = 16, 400_000
#: Texts of the first 0x250 code points, without the controls 0x1C-0x1F, take the faster library.
WESTERN = re.compile("[\\x00-\\x1b\\x20-\\u024f]*")


def western_pattern() -> str:
    """WORD_PATTERN for such texts, with the classes written out for Python's own library."""
    members = lambda p: "".join(re.escape(c) for c in map(chr, range(0x250)) if regex.match(p, c))
    letters, numbers, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file, inverted: character -> byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieEncoder:
    """Encoder and decoder for a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str, cache_words: int = 120_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_alphabet()
        raw = lambda s: bytes(byte[c] for c in s)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.token = {i: raw(s) for s, i in spec["model"]["vocab"].items() if s not in special}
        self.token |= {i: s.encode() for s, i in special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.rank = {(ids[raw(a)], ids[raw(b)]): (r, ids[raw(a + b)]) for r, (a, b) in enumerate(merges)}
        self.single = [ids[bytes([b])] for b in range(256)]
        # For each entry the spines at its two ends: (part, rank of the merge that ends its life there), outermost last.
        never = 1 << 62
        made, self.left, self.right = {}, {}, {}
        for i in self.single:
            made[i], self.left[i], self.right[i] = -1, [(i, -1, never)], [(i, -1, never)]
        good = set(self.single)
        for (x, y), (r, whole) in sorted(self.rank.items(), key=lambda m: m[1][0]):
            if whole in made or x not in good or y not in good or self._crosses(x, y, top=False):
                continue
            made[whole] = r
            good.add(whole)
            grown = lambda spine: [*spine[:-1], (spine[-1][0], spine[-1][1], r), (whole, r, never)]  # noqa: B023, E731
            self.left[whole], self.right[whole] = grown(self.left[x]), grown(self.right[y])
        # Only entries that BPE itself builds can end a prefix.
        self.ids = {b: i for b, i in ids.items() if i in good}
        # The automaton: child[state << 8 | byte] -> state, the state of the longest proper suffix, and the entries
        # (length, id) that end in a state, longest first.
        self.child: dict[int, int] = {}
        own: list[int] = [-1]
        for entry, i in self.ids.items():
            state = 0
            for b in entry:
                nxt = self.child.get(state << 8 | b)
                if nxt is None:
                    nxt = self.child[state << 8 | b] = len(own)
                    own.append(-1)
                state = nxt
            own[state] = i
        self.suffix = [0] * len(own)
        self.entries: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        level = [(0, b, self.child[b]) for b in range(256)]
        below: dict[int, list[tuple[int, int, int]]] = {}
        for key, state in self.child.items():
            below.setdefault(key >> 8, []).append((key >> 8, key & 255, state))
        depth = 1
        while level:
            for parent, b, state in level:
                if parent:
                    self.suffix[state] = self._after(self.suffix[parent], b)
                ends = self.entries[self.suffix[state]]
                self.entries[state] = ((depth, own[state]), *ends) if own[state] >= 0 else ends
            level = [x for _, _, state in level for x in below.get(state, ())]
            depth += 1
        # What walks meet of it: byte -> the next of these, -1 -> the entries, -2 -> the state.
        self.met: dict[int, dict] = {}
        self.steps = 0
        self.shown = {i: str(i) for i in self.token}
        self.size = {i: len(b) for i, b in self.token.items()}
        self.stable: dict[int, dict[int, bool]] = {}  # left -> right -> whether the two stay as they are
        self.pairs = 0
        self.words: dict[str, str] = {}
        self.odd: dict[str, str] = {}  # words whose decoded form is another string
        self.cache_words = cache_words
        self.pattern = regex.compile(WORD_PATTERN)
        self.western = re.compile(western_pattern())
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None

    def _crosses(self, left: int, right: int, top: bool = True) -> bool:
        """Whether BPE over the bytes of two entries merges across their border.

        A part x at the end of the left entry lives from the merge that makes it to the one that
        takes it up, and so does a part y at the start of the right one; in a vocabulary learned in
        rank order both times are ranks. If the two live at once and their merge comes before either
        is taken up, it happens. At equal rank the leftmost merge is first. top=False leaves out the
        merge of the two whole entries.
        """
        rank = self.rank
        for x, born_x, gone_x in self.right[left]:
            for y, born_y, gone_y in self.left[right]:
                found = rank.get((x, y))
                if found is not None and born_x < gone_y and born_y < gone_x and found[0] < gone_x and found[0] <= gone_y:
                    if top or x != left or y != right:
                        return True
        return False

    def _is_stable(self, left: int, right: int) -> bool:
        if self.pairs > 250_000:
            self.stable.clear()
            self.pairs = 0
        self.pairs += 1
        known = self.stable.setdefault(left, {})[right] = not self._crosses(left, right)
        return known

    def _after(self, state: int, b: int) -> int:
        """The state after one more byte: the longest suffix of what was read that begins an entry."""
        while (nxt := self.child.get(state << 8 | b)) is None:
            state = self.suffix[state]  # in state 0 every byte has a child
        return nxt

    def _node(self, state: int) -> dict:
        found = self.met.get(state)
        if found is None:
            found = self.met[state] = {-1: self.entries[state], -2: state}
        return found

    def _step(self, node: dict, b: int) -> dict:
        if self.steps >= STEPS:
            self.met.clear()
            self.steps = 0
        self.steps += 1
        nxt = node[b] = self._node(self._after(node[-2], b))
        return nxt

    def encode_words(self, words: set[str]) -> None:
        """Give every word of the set its ids, by one walk over their trie."""
        coded = sorted((word.encode("utf-8", "surrogatepass"), word) for word in words)
        # How many bytes each has in common with the one before, or fewer.
        heads = np.array([code[:COMPARED] for code, _ in coded], f"S{COMPARED}").view(np.uint8).reshape(-1, COMPARED)
        alike = np.logical_and.accumulate(heads[1:] == heads[:-1], axis=1).sum(axis=1)
        sizes = np.array([len(code) for code, _ in coded])
        common = [0, *np.minimum(alike, np.minimum(sizes[1:], sizes[:-1])).tolist()]
        # Of the prefix of each length: its last token, what is known of that on the left of others, and the automaton's node.
        last, beside, nodes = [-1], [{}], [self._node(0)]
        stable, token, shown, size = self.stable, self.token, self.shown, self.size
        for (code, word), depth in zip(coded, common):
            del last[depth + 1 :], beside[depth + 1 :], nodes[depth + 1 :]
            node = nodes[depth]
            for b in code[depth:]:
                depth += 1
                node = node.get(b) or self._step(node, b)
                for length, t in node[-1]:
                    if length == depth:
                        break
                    known = beside[depth - length].get(t)
                    if known if known is not None else self._is_stable(last[depth - length], t):
                        break
                last.append(t)
                beside.append(stable.get(t) or stable.setdefault(t, {}))
                nodes.append(node)
            out = []
            while depth:
                t = last[depth]
                out.append(t)
                depth -= size[t]
            out.reverse()
            self.words[word] = ",".join([shown[t] for t in out])
            if (decoded := b"".join([token[t] for t in out]).decode("utf-8", "replace")) != word:
                self.odd[word] = decoded

    def encode_many(self, texts: list[str]) -> list[tuple[str, str]]:
        """Per text: its ids as decimals joined by commas, and the text decoded from them."""
        split, new = [], set()
        if len(self.words) > self.cache_words:
            self.words.clear()
            self.odd.clear()
        known = self.words
        for text in texts:
            pieces = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
            find = self.western if all(p.isascii() or WESTERN.fullmatch(p) for p in pieces) else self.pattern
            parts = [(p, None) if p in self.special and i % 2 else (p, find.findall(p)) for i, p in enumerate(pieces)]
            for _, words in parts:
                if words:
                    new |= set(words).difference(known)
            split.append(parts)
        if new:
            self.encode_words(new)
        out = []
        for parts in split:
            ids, back = [], []
            for piece, words in parts:
                if words is None:
                    ids.append(str(self.special[piece]))
                    back.append(piece)
                elif words:
                    ids.append(",".join(map(known.__getitem__, words)))
                    back.append("".join(words) if not self.odd else "".join(self.odd.get(w, w) for w in words))
            out.append((",".join(ids), "".join(back)))
        return out


@functools.lru_cache(maxsize=2)
def encoder_for(path: str) -> TrieEncoder:
    """One encoder for each Python worker; its word cache is bounded."""
    return TrieEncoder(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """Per row: the columns of keep, n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids.

    A null text counts as empty: no ids, digests of the empty string. Rows are never merged or
    dropped; repeated rows give repeated results; an empty table gives an empty one. Other columns,
    whatever their names, are ignored. The path must exist on every executor.
    """
    fields = [*keep, text]
    schema = docs.select(*keep).schema
    out_types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "n_tokens bigint, ids_sha256 string, decoded_sha256 string"] + ["token_ids array<int>"] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer_path)
        for batch in batches:
            coded = encoder.encode_many([t or "" for t in batch.column(len(keep)).to_pylist()])
            columns = [batch.column(i) for i in range(len(keep))]
            columns.append(pa.array([i.count(",") + 1 if i else 0 for i, _ in coded], pa.int64()))
            columns.append(pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _ in coded], pa.string()))
            columns.append(pa.array([hashlib.sha256(d.encode("utf-8", "replace")).hexdigest() for _, d in coded], pa.string()))
            if with_ids:
                columns.append(pa.array([list(map(int, i.split(","))) if i else [] for i, _ in coded], pa.list_(pa.int32())))
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*[F.col(f"`{c}`") for c in fields]).mapInArrow(frugal(run, 512), out_types)
