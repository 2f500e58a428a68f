"""Token counts of byte-level BPE by rank-synchronous merging of ragged numpy arrays.

A text is cut at spaces that follow a non-space: no pre-token spans such a cut and none depends on what lies before it,
so each piece is counted once and remembered. The pieces not yet known are split into pre-tokens; all their bytes lie in
one ragged array, and in every round each sequence merges all occurrences of its lowest-ranked pair at once, until no
sequence has a pair with a rank. What is left of a sequence is its number of tokens. Added tokens that the vocabulary
file lists (its special strings) are cut out of a text first and count as one, the library's default.

Defined results: a null text is empty and has no tokens; rows are counted one by one, so repeats and ties don't matter;
an empty table gives an empty result; only the id and the text are read; a text of any length is counted whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_arrow, slices

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: The pattern of the vocabulary's pre-tokenizer; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a worker remembers; beyond it starts anew.
REMEMBERED = 400_000
_CUT = re.compile(r"(?<=\S)(?= )")
#: Text with a space that begins it or follows white space is cut by the rule; the rest at every space.
_ODD = re.compile(r"(?:\A|\s) ")


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 stays, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Counts tokens under one vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        self.first = np.zeros(256, np.int64)
        for letter, b in byte_letters().items():
            self.first[b] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.n_rank = len(pairs)
        self._table(left << 32 | right)
        special = [t["content"] for t in file["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = regex.compile(PATTERN)
        self.bare: dict[str, int] = {}
        self.spaced: dict[str, int] = {}

    def _table(self, keys: np.ndarray) -> None:
        """Open addressing, filled and probed for all keys at once."""
        bits = int(np.ceil(np.log2(max(len(keys), 1)))) + 2
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys, self.ranks = np.full(self.size, -1, np.int64), np.full(self.size, len(keys), np.int64)
        todo, rank, slot = keys, np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = todo[free]
            won = self.keys[slot] == todo
            self.ranks[slot[won]] = rank[won]
            todo, rank, slot = todo[~won], rank[~won], (slot[~won] + 1) % self.size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], self.n_rank)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while open_.size:
            slot[open_] = (slot[open_] + 1) % self.size
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return out

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols of each byte sequence that survive all merges."""
        n = len(sequences)
        sizes = np.fromiter(map(len, sequences), np.int64, n)
        counts = sizes.copy()
        symbol = self.first[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(n), sizes)
        while len(symbol) > 1:
            same = owner[1:] == owner[:-1]
            rank = np.full(len(symbol), self.n_rank, np.int64)
            rank[:-1][same] = self.rank(symbol[:-1][same] << 32 | symbol[1:][same])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            low = np.minimum.reduceat(rank, starts)
            reach = np.diff(np.append(starts, len(symbol)))
            live = np.repeat(low < self.n_rank, reach)
            symbol, owner, rank, target = symbol[live], owner[live], rank[live], np.repeat(low, reach)[live]
            if not len(symbol):
                break
            at = np.flatnonzero(rank == target)
            # a pair that overlaps the merged one before it waits: in a run of neighbours every other one merges
            run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
            place = np.arange(len(at)) - np.flatnonzero(np.concatenate([[True], np.diff(run) != 0]))[run]
            at = at[place % 2 == 0]
            symbol[at] = self.made[rank[at]]
            gone = np.zeros(len(symbol), bool)
            gone[at + 1] = True
            counts -= np.bincount(owner[at], minlength=n)
            symbol, owner = symbol[~gone], owner[~gone]
        return counts

    def learn(self, pieces: list[str], lead: str, known: dict[str, int]) -> None:
        """Count pieces that aren't known yet, each behind ``lead``: unique pre-tokens are merged once."""
        parts = [[t.encode() for t in self.split.findall(lead + p)] for p in pieces]
        unique = list(dict.fromkeys(t for x in parts for t in x))
        counts = dict(zip(unique, self.count(unique).tolist(), strict=True)) if unique else {}
        known.update((p, sum(counts[t] for t in x)) for p, x in zip(pieces, parts, strict=True))

    def tokens(self, texts: list[str]) -> list[int]:
        """Tokens of each text; ``bare`` pieces begin a run, ``spaced`` ones stood behind one space, which is left out."""
        if len(self.spaced) > REMEMBERED:
            self.spaced.clear()
        if len(self.bare) > REMEMBERED:
            self.bare.clear()
        bare, spaced, extra = [], [], []
        for t in texts:
            plain = self.special.split(t) if self.special else [t]
            extra.append(len(plain) - 1)
            x, y = [], []
            for p in plain:
                if _ODD.search(p) is None:
                    first, *rest = p.split(" ")
                    x.append(first)
                    y += rest
                else:
                    for q in _CUT.split(p):
                        (y if q[0] == " " else x).append(q.removeprefix(" "))
            bare.append(x)
            spaced.append(y)
        for lead, lists, known in (("", bare, self.bare), (" ", spaced, self.spaced)):
            if todo := {p for x in lists for p in x if p not in known}:
                self.learn(sorted(todo), lead, known)
        return [n + sum(map(self.bare.__getitem__, x)) + sum(map(self.spaced.__getitem__, y)) for n, x, y in zip(extra, bare, spaced, strict=True)]


@lru_cache(maxsize=4)
def merger(path: str) -> Merger:
    return Merger(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path or default_path())
        for b in slices(batches, 64):
            texts = [x or "" for x in b.column(1).to_pylist()]
            n = m.tokens(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return map_arrow(docs.select("doc_id", text), work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
