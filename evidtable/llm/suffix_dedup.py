"""Removal of long repeated byte strings with a sparse suffix array and deep-shallow sorting.

Only suffixes at anchors are sorted: an anchor is the position of the smallest hash of a ``GRAM``-byte string among
``LENGTH - GRAM + 1`` neighbours (the last of equal ones), so equal strings of ``LENGTH`` bytes have an anchor at the
same place, and no repeat is missed. Anchors whose string occurs once in the corpus are dropped. The others meet by
their hash with the bytes around them; equal surroundings are counted once, before the shuffle too. Of what is left in
a group, the suffixes and the reversed prefixes are sorted by deep-shallow sorting: multikey quicksort to
``SHALLOW`` bytes, blind tries for the groups that agree further. The longest common prefixes of both orders tell which
``LENGTH``-byte strings that hold the anchor occur elsewhere. Comparisons are on bytes; hashes only bring together.

A hash that stands at too many places (``HOT_SHARE``) is not sorted in one task: ``peel`` takes one member of its group as pivot,
settles what every member shares with it, and deals the rest anew by the first byte in which a member leaves the pivot,
to the left and to the right (the quicksort's partition, as a shuffle), until groups are small.

Words take the same way: a text is also read as one 4-byte number for each word, and strings of ``WORDS`` words that
also start elsewhere give ``n_passage_words``. A passage of so many short words has fewer than ``LENGTH`` bytes; it is
counted and not removed.

Defined results: a null text is empty; a document shorter than ``LENGTH`` bytes loses nothing; each row of repeated
documents loses what the copies share, whatever its id; an empty table gives an empty result; other columns are not
read. A long text is worked through in blocks; what its shared anchors hold is in proportion to its own size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, stage

LENGTH = 400
GRAM = 128
WORDS = 50
WORD_GRAM = 16
SHALLOW = 32
#: A hash with more than one in HOT_SHARE of all places of shared hashes is dealt by ``peel``, but none with up to HOT_LEAST, and any with
#: more than HOT_MOST places (so many surroundings are some 8 MB): a bound on a task's share and on its memory, whatever the size.
HOT_SHARE, HOT_LEAST, HOT_MOST = 200, 512, 8192
#: Surroundings that a task remembers as already sent; beyond, it forgets them and sends some again.
REMEMBERED = 100_000
#: Groups of at most so many different surroundings are compared by pairs; larger ones by class at each shift.
PAIRED = 24
_BLOCK = 1 << 22
#: Units of texts that are hashed side by side.
_BESIDE = 1 << 18


class Scale(NamedTuple):
    """What is compared: strings of ``length`` units of ``unit`` bytes that hold an anchor of ``gram`` units."""

    kind: int
    unit: int
    length: int
    gram: int

    @property
    def size(self) -> int:
        return self.length * self.unit

    @property
    def reach(self) -> int:
        return (self.length - self.gram) * self.unit


SCALES = (Scale(0, 1, LENGTH, GRAM), Scale(1, 4, WORDS, WORD_GRAM))
_BASE = 0x9E3779B97F4A7C15 | 1


# ---- sorting


def common_prefix(a: bytes, b: bytes, skip: int = 0) -> int:
    n = min(len(a), len(b))
    x, y = a[skip:n], b[skip:n]
    if x == y:
        return n
    return n - (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length().__add__(7) // 8


def _blind_trie(strings: list[bytes], group: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of a group whose strings agree to ``depth``, and each one's common prefix with the one before it."""
    root: list = [len(strings[group[0]]), None, [group[0]]]  # a leaf: length, no branches, its strings

    def letter(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    for i in group[1:]:
        s, node = strings[i], root
        while node[1] is not None:  # blind: branch letters only
            node = node[1].get(letter(s, node[0])) or next(iter(node[1].values()))
        at = common_prefix(s, strings[node[2][0]], depth)
        if at == len(s) == len(strings[node[2][0]]):
            node[2].append(i)
            continue
        parent, node = None, root
        while node[1] is not None and node[0] < at:
            parent, node = node, node[1][letter(s, node[0])]
        leaf = [len(s), None, [i]]
        if node[1] is not None and node[0] == at:
            node[1][letter(s, at)] = leaf
            continue
        some = node
        while some[1] is not None:
            some = next(iter(some[1].values()))
        fork = [at, {letter(strings[some[2][0]], at): node, letter(s, at): leaf}, None]
        if parent is None:
            root = fork
        else:
            parent[1][letter(s, parent[0])] = fork
    order: list[int] = []
    lcp: list[int] = []
    stack = [(root, depth)]
    while stack:
        node, before = stack.pop()
        if node[1] is None:
            order += node[2]
            lcp += [before] + [node[0]] * (len(node[2]) - 1)
        else:
            kids = [node[1][c] for c in sorted(node[1])]
            stack += [(k, node[0]) for k in reversed(kids[1:])] + [(kids[0], before)]
    return order, lcp


def deep_shallow_sort(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Sorted order of ``strings``, which agree to ``depth``; the common prefix of each with the one before it (0 for the first)."""
    if len(strings) == 2:  # one comparison
        return [0, 1] if strings[0] <= strings[1] else [1, 0], [0, common_prefix(strings[0], strings[1], depth)]
    order: list[int] = []
    stack = [(list(range(len(strings))), depth)]
    limit = depth + shallow
    lcp: list[int] = []
    while stack:
        group, at = stack.pop()
        if len(group) == 1:
            part, own = group, [at]
        elif at >= limit:
            part, own = _blind_trie(strings, group, at)
        else:  # multikey quicksort, eight bytes as one letter
            keys = [strings[i][at : at + 8] for i in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            less = [i for i, k in zip(group, keys, strict=True) if k < pivot]
            same = [i for i, k in zip(group, keys, strict=True) if k == pivot]
            more = [i for i, k in zip(group, keys, strict=True) if k > pivot]
            stack += [(g, d) for g, d in ((more, at), (same, at + 8 if len(pivot) == 8 else at), (less, at)) if g and (g is not same or len(pivot) == 8)]
            if len(pivot) < 8 and same:  # strings that end here are equal
                if less:
                    stack.insert(len(stack) - 1, (same, limit))
                else:
                    stack.append((same, limit))
            continue
        if order:
            own[0] = common_prefix(strings[order[-1]], strings[part[0]], depth)
        else:
            own[0] = 0
        order += part
        lcp += own
    return order, lcp


# ---- anchors


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = _BLOCK + LENGTH + 1
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, np.uint64)
        up[0] = 1
        down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def _hashes(units: np.ndarray, scale: Scale) -> np.ndarray:
    """Hash of every string of ``scale.gram`` units, the same wherever the string stands; its lowest bit is the kind."""
    up, down = _powers()
    n, gram = len(units), scale.gram
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[gram:] - total[:-gram]) * down[: n - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return (h & ~np.uint64(1)) | np.uint64(scale.kind)


def units_of(data: bytes, scale: Scale) -> np.ndarray:
    """A text as bytes, or as one number for each run of other than ASCII white space."""
    if scale.unit == 1:
        return np.frombuffer(data, np.uint8)
    words = data.split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def _picked(every: np.ndarray, scale: Scale, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted positions of the anchors of the windows at ``starts`` (all without it), and their hashes."""
    width = scale.length - scale.gram + 1
    h = _hashes(every, scale)
    n = len(h)
    key = (h & np.uint64(0xFFFFFFFFFF000000)) | (np.uint64(0xFFFFFF) - np.arange(n, dtype=np.uint64))
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = key
    grid = full.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    low = low if starts is None else low[starts]
    low = low[np.concatenate([[True], low[1:] != low[:-1]])]
    p = np.unique((np.uint64(0xFFFFFF) - (low & np.uint64(0xFFFFFF))).astype(np.int64))
    return p, h[p].view(np.int64)


def anchors(every: np.ndarray, scale: Scale = SCALES[0]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in units) and hashes of the anchors of a text's units, block by block."""
    if len(every) < scale.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pos, hashes = [], []
    for at in range(0, len(every) - scale.length + 1, _BLOCK):
        p, h = _picked(every[at : at + _BLOCK + scale.length - 1], scale)
        pos.append(p + at)
        hashes.append(h)
    p, first = np.unique(np.concatenate(pos), return_index=True)
    return p, np.concatenate(hashes)[first]


def all_anchors(texts: list[np.ndarray], scale: Scale) -> list[tuple[np.ndarray, np.ndarray]]:
    """``anchors`` of each of many texts; short ones lie side by side in one array, and only windows inside a text count."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    held: list[int] = []
    size = 0

    def close() -> None:
        if not held:
            return
        sizes = np.array([len(texts[i]) for i in held])
        begin = np.concatenate([[0], np.cumsum(sizes)])
        windows = sizes - scale.length + 1
        shift = np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
        p, h = _picked(np.concatenate([texts[i] for i in held]), scale, np.arange(windows.sum()) + shift)
        cut = np.searchsorted(p, begin)
        for k, i in enumerate(held):
            out[i] = p[cut[k] : cut[k + 1]] - begin[k], h[cut[k] : cut[k + 1]]
        held.clear()

    for i, units in enumerate(texts):
        if len(units) > _BESIDE:
            out[i] = anchors(units, scale)
        elif len(units) >= scale.length:
            if size + len(units) > _BESIDE:
                close()
                size = 0
            held.append(i)
            size += len(units)
    close()
    return out


# ---- groups


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(z) - 1) for a, z in zip(edge[::2], edge[1::2], strict=True)]


def _aligned(spans: list[tuple[int, int]], scale: Scale) -> list[tuple[int, int]]:
    """Ranges of shifts that begin and end with a unit."""
    if scale.unit == 1:
        return spans
    cut = [(-(-a // scale.unit) * scale.unit, z // scale.unit * scale.unit) for a, z in spans]
    return [(a, z) for a, z in cut if a <= z]


def repeated_shifts(lefts: list[bytes], rights: list[bytes], scale: Scale = SCALES[0]) -> list[list[tuple[int, int]]]:
    """For each of several different surroundings (reversed left, right) the shifts d, as ranges, at which the
    ``scale.size`` bytes that begin d bytes before the anchor are also in another."""
    g, size = len(lefts), scale.size
    order_l, lcp_l = deep_shallow_sort(lefts)
    order_r, lcp_r = deep_shallow_sort(rights)
    if g == 2:
        left, right = lcp_l[1], lcp_r[1]
        own = _aligned([(max(0, size - right), left)], scale) if right + left >= size and size - right <= left else []
        return [own, own]
    if g <= PAIRED:
        low_l, low_r = ([[0] * g for _ in range(g)] for _ in range(2))
        for low, order, lcp in ((low_l, order_l, lcp_l), (low_r, order_r, lcp_r)):
            for i in range(g - 1):
                least, own = 1 << 30, order[i]
                for k in range(i + 1, g):
                    least = min(least, lcp[k])
                    low[own][order[k]] = low[order[k]][own] = least
        out = []
        for i in range(g):
            near = [(max(0, size - r), x + 1) for k, (x, r) in enumerate(zip(low_l[i], low_r[i], strict=True)) if k != i and x + r >= size]
            out.append(_aligned([(a, z - 1) for a, z in _merged(near)], scale))
        return out
    size_l, size_r = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    order_l, order_r, lcp_l, lcp_r = map(np.array, (order_l, order_r, lcp_l, lcp_r))
    flags = np.zeros((g, scale.reach + 1), bool)
    of_l, of_r = np.empty(g, np.int64), np.empty(g, np.int64)
    for d in range(0, scale.reach + 1, scale.unit):
        of_l[order_l] = np.cumsum(lcp_l < d)
        of_r[order_r] = np.cumsum(lcp_r < size - d)
        use = np.flatnonzero((size_l >= d) & (size_r >= size - d))
        key = of_l[use] * (g + 1) + of_r[use]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        flags[use, d] = counts[inverse] > 1
    if scale.unit > 1:
        return [[(int(d), int(d)) for d in np.flatnonzero(f)] for f in flags]
    return [_ranges(f) for f in flags]


def _group(rows: list[tuple], scale: Scale) -> list[tuple[bytes, int, int]]:
    """Repeated spans (text, start, end), in bytes of the units, from the anchors (text, position, left, right) of one key."""
    classes: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
    for text, pos, left, right in set(rows):
        classes.setdefault((left, right), []).append((text, pos))
    out = []
    for (left, right), members in classes.items():
        if len(members) > 1 and len(left) + len(right) >= scale.size:
            out += [(t, p - len(left), p + len(right)) for t, p in members]
    if len(classes) > 1:
        keys = list(classes)
        for k, found in zip(keys, repeated_shifts([a for a, _ in keys], [b for _, b in keys], scale), strict=True):
            out += [(t, p - z, p - a + scale.size) for a, z in found for t, p in classes[k]]
    return out


# ---- the distributed plan


def _text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _digest() -> Column:
    return F.unhex(F.substring(F.sha2(_text(), 256), 1, 32))


def _all_anchors(docs: DataFrame) -> DataFrame:
    """doc_id, digest, n_bytes, n_words, sha256, hashes (different ones, of bytes and of words), again (each further occurrence)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            every = [(x.as_py() or "").encode() for x in b.column(1)]
            units = [[units_of(data, scale) for data in every] for scale in SCALES]
            found = [all_anchors(u, scale) for u, scale in zip(units, SCALES, strict=True)]
            size, words, sha = list(map(len, every)), list(map(len, units[1])), [hashlib.sha256(data).hexdigest() for data in every]
            once, again = [], []
            for (_, own), (_, other) in zip(*found, strict=True):
                h = np.sort(np.concatenate([own, other]))
                new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
                once.append(h[new])
                again.append(h[~new])
            longs = pa.list_(pa.int64())
            digest = pa.array([bytes.fromhex(s[:32]) for s in sha], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), digest, pa.array(size, pa.int64()), pa.array(words, pa.int64()), pa.array(sha), pa.array(once, longs), pa.array(again, longs)],
                names=["doc_id", "digest", "n_bytes", "n_words", "sha256", "hashes", "again"],
            )

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, digest binary, n_bytes long, n_words long, sha256 string, hashes array<long>, again array<long>")


_ROW = {"h": pa.int64(), "digest": pa.binary(), "pos": pa.int64(), "left": pa.binary(), "right": pa.binary(), "until": pa.int64()}
_ROW_SCHEMA = "h long, digest binary, pos long, left binary, right binary, until long"


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def _known(kind: int, digest: bytes, start: int, stop: int) -> tuple:
    """A span that needs no meeting: dealt by the text and the place, so that no key has many."""
    key = hashlib.blake2b(b"%b:%d:%d" % (digest, start, stop), digest_size=8).digest()
    return int.from_bytes(key, "big", signed=True) & ~1 | kind, digest, start, None, None, stop


def _surroundings(texts: DataFrame, wanted: str) -> DataFrame:
    """Rows with a hash: an anchor's surroundings (pos, left, right), each only once in a task; or a span known as repeated (pos, until)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        for b in slices(batches, 64):
            out: list[tuple] = []
            known: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
            digests, every = b.column(0).to_pylist(), [(x.as_py() or "").encode() for x in b.column(1)]
            use = [np.array(x.as_py(), np.int64) for x in b.column(2)]
            for scale in SCALES:
                own = [x[x & 1 == scale.kind] for x in use]
                units = [units_of(data, scale) if len(x) else np.zeros(0, np.uint8) for data, x in zip(every, own, strict=True)]
                for digest, whole, ask, u, (pos, h) in zip(digests, every, own, units, all_anchors(units, scale), strict=True):
                    if not len(ask):
                        continue
                    data = whole if scale.unit == 1 else u.astype("<u4").tobytes()
                    at = np.isin(h, ask)
                    for p, k in zip((pos[at] * scale.unit).tolist(), h[at].tolist(), strict=True):
                        left, right = data[max(0, p - scale.reach) : p], data[p : p + scale.size]
                        name = hashlib.blake2b(b"%d:%d:" % (scale.kind, len(left)) + left + right, digest_size=16).digest()
                        first = seen.get(name)
                        if first is None:
                            seen[name] = [digest, p, False]
                            out.append((k, digest, p, left[::-1], right, None))
                        elif (first[0], first[1]) != (digest, p) and len(left) + len(right) >= scale.size:
                            known.setdefault((scale.kind, digest), []).append((p - len(left), p + len(right)))
                            if not first[2]:
                                first[2] = True
                                known.setdefault((scale.kind, first[0]), []).append((first[1] - len(left), first[1] + len(right)))
            out += [_known(kind, digest, a, z) for (kind, digest), found in known.items() for a, z in _merged(found)]
            if len(seen) > REMEMBERED:
                seen.clear()
            if out:
                yield _batch(out, _ROW)

    return map_arrow(texts.select("digest", "text", wanted), work, _ROW_SCHEMA)


_SPAN = {"digest": pa.binary(), "kind": pa.int32(), "start": pa.int64(), "stop": pa.int64()}
_SPAN_SCHEMA = "digest binary, kind int, start long, stop long"


def _spans(met: DataFrame) -> DataFrame:
    """digest, kind, start, stop: repeated spans, from rows sorted by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, [], []

        def close() -> None:
            if len(group) > 1:
                scale = SCALES[now & 1]
                out.extend((t, scale.kind, a, z) for t, a, z in _group(group, scale))

        for b in slices(batches):
            for h, digest, pos, left, right, until in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
                if until is not None:
                    out.append((digest, h & 1, pos, until))
                    continue
                if h != now:
                    close()
                    now, group = h, []
                group.append((digest, pos, left, right))
            if len(out) > 10_000:
                yield _batch(out, _SPAN)
                out.clear()
        close()
        if out:
            yield _batch(out, _SPAN)

    return map_arrow(met, work, _SPAN_SCHEMA)


def _dealt(key: int, side: bytes, prefix: bytes) -> int:
    name = hashlib.blake2b(key.to_bytes(8, "big", signed=True) + side + prefix, digest_size=8).digest()
    return int.from_bytes(name, "big", signed=True) & ~1 | (key & 1)


def _against_pivots(rows: DataFrame) -> DataFrame:
    """Rows (h, digest, pos, left, right, lo, hi, pivot) with their group's pivot: spans shared with it (until), and what is left to find, under new keys.

    lo and hi bound the shifts not settled yet. A shift beyond the bytes that a row shares with the pivot to the left is
    shared only with rows that share those and one more; likewise to the right. So no link is lost.
    """
    kinds = _ROW | {"lo": pa.int64(), "hi": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple] = set()
        for b in slices(batches):
            out: list[tuple] = []
            for h, digest, pos, left, right, lo, hi, pivot in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (digest, pos) == (pivot["digest"], pivot["pos"]):
                    continue
                scale = SCALES[h & 1]
                a, z = common_prefix(left, pivot["left"]), common_prefix(right, pivot["right"])
                for first, last in _aligned([(max(lo, scale.size - z), min(hi, a))], scale) if scale.size - z <= a else []:
                    if first <= last:
                        out.append((*_known(scale.kind, digest, pos - last, pos - first + scale.size), None, None))
                        span = _known(scale.kind, pivot["digest"], pivot["pos"] - last, pivot["pos"] - first + scale.size)
                        if span not in told:
                            told.add(span)
                            out.append((*span, None, None))
                if a < min(len(left), hi):
                    out.append((_dealt(h, b"l", left[: a + 1]), digest, pos, left, right, None, max(lo, a + 1), hi))
                if z < len(right) and scale.size - z - 1 >= lo:
                    out.append((_dealt(h, b"r", right[: z + 1]), digest, pos, left, right, None, lo, min(hi, scale.size - z - 1)))
            if len(told) > REMEMBERED:
                told.clear()
            if out:
                yield _batch(out, kinds)

    return map_arrow(rows, work, _ROW_SCHEMA + ", lo long, hi long")


def peel(rows: DataFrame, hot: int) -> list[DataFrame]:
    """Surroundings in groups of any size as staged tables of ``_ROW``: groups of at most ``hot`` rows, and known spans."""
    columns = list(_ROW)
    size = F.when(F.col("h").bitwiseAND(F.lit(1)) == 0, F.lit(SCALES[0].size)).otherwise(F.lit(SCALES[1].size)).cast("long")
    now = stage(rows.select("*", F.greatest(F.lit(0), size - F.length("right")).alias("lo"), F.length("left").cast("long").alias("hi")), "hot0")
    out = [now.where("until is not null").select(columns)]
    now = now.where("until is null")
    for n in range(1, 2 * LENGTH + 1):
        sizes = now.groupBy("h").agg(F.count("*").alias("n"), F.min_by(F.struct("digest", "pos", "left", "right"), F.struct(F.xxhash64("h", "digest", "pos"), "digest", "pos")).alias("pivot"))
        large = stage(sizes.where(F.col("n") > hot).select("h", "pivot"), f"pivots{n}")
        out.append(now.join(sizes.where((F.col("n") > 1) & (F.col("n") <= hot)).select("h"), "h").select(columns))
        if large.isEmpty():
            return out
        met = now.join(large, "h").select("h", "digest", "pos", "left", "right", "lo", "hi", "pivot")
        now = stage(_against_pivots(met), f"hot{n}")
        out.append(now.where("until is not null").select(columns))
        now = now.where("until is null")
    raise RuntimeError("groups did not settle")


def _cut(texts: DataFrame) -> DataFrame:
    """digest, n_removed, n_spans, kept_sha256 (of the text without its repeated bytes), n_passage_words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            removed, spans, sha, words = [], [], [], []
            found = b.column(2)
            kinds, starts, stops = (found.flatten().field(c).to_pylist() for c in ("kind", "start", "stop"))
            ends = np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            for text, lo, hi in zip(b.column(1), [0, *ends], ends, strict=False):
                data, at, rest = (text.as_py() or "").encode(), 0, []
                by_kind: tuple[list, list] = [], []
                for k, a, z in zip(kinds[lo:hi], starts[lo:hi], stops[lo:hi], strict=True):
                    by_kind[k].append((a, z))
                cut = _merged(by_kind[0])
                for a, z in cut:
                    rest.append(data[at:a])
                    at = z
                rest.append(data[at:])
                removed.append(sum(z - a for a, z in cut))
                spans.append(len(cut))
                sha.append(hashlib.sha256(b"".join(rest)).hexdigest())
                words.append(sum(z - a for a, z in _merged(by_kind[1])) // SCALES[1].unit)
            columns = [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["digest", "n_removed", "n_spans", "kept_sha256", "n_passage_words"])

    return map_arrow(texts, work, "digest binary, n_removed long, n_spans long, kept_sha256 string, n_passage_words long")


def repeated(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staged tables: every row with its digest; each different text with its copies; texts that share something; their repeated spans."""
    rows = stage(_all_anchors(docs), "anchors")
    texts = stage(rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.first("hashes").alias("hashes"), F.first("again").alias("again")), "texts")
    once = texts.select(F.explode("hashes").alias("h"), F.lit(1).alias("n")).union(texts.select(F.explode("again").alias("h"), F.lit(1).alias("n")))
    shared = stage(once.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "shared")
    hot = min(HOT_MOST, max(HOT_LEAST, (shared.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE))
    shared = shared.select("h", (F.col("n") > hot).alias("hot"))
    met = texts.select("digest", "first_id", F.explode("hashes").alias("h")).join(shared, "h")
    wanted = met.groupBy("digest", "first_id").agg(F.collect_list(F.when(~F.col("hot"), F.col("h"))).alias("wanted"), F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot"))
    own = docs.select("doc_id", "text", _digest().alias("digest")).withColumnRenamed("digest", "d")
    on = (F.col("d") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    sharing = stage(own.join(wanted, on).select("digest", "text", "wanted", "hot"), "sharing")
    met = _surroundings(sharing.where(F.size("wanted") > 0), "wanted")
    if not shared.where("hot").isEmpty():
        for part in peel(_surroundings(sharing.where(F.size("hot") > 0), "hot"), hot):
            met = met.union(part)
    met = met.repartition("h").sortWithinPartitions("h")
    spans = stage(_spans(met).groupBy("digest").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("spans")), "spans")
    return rows, texts, sharing, spans


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words of every row."""
    rows, texts, sharing, spans = repeated(docs)
    cut = _cut(sharing.select("digest", "text").join(spans, "digest")).dropDuplicates(["digest"])
    # one staged row for each text: its copies, however many, meet it in a join of plain scans, which a hot text can be split in
    each = stage(texts.select("digest", "copies").join(cut, "digest", "left"), "cut")
    found = rows.select("doc_id", "digest", "n_bytes", "n_words", "sha256").join(each, "digest")

    def pick(all_gone: Column, none: Column, name: str, whole: Column) -> Column:
        return F.when((F.col("copies") > 1) & whole, all_gone).otherwise(F.coalesce(F.col(name), none)).alias(name)

    zero, whole = F.lit(0).cast("long"), F.col("n_bytes") >= LENGTH
    return found.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), zero, "n_removed", whole), pick(F.lit(1).cast("long"), zero, "n_spans", whole),
        pick(F.sha2(F.lit(""), 256), F.col("sha256"), "kept_sha256", whole), pick(F.col("n_words"), zero, "n_passage_words", F.col("n_words") >= WORDS),
    )
