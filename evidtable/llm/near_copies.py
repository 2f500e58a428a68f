"""Near copies by the Jaccard similarity of word shingles: MinHash bands for candidates, exact sets for the verdict.

A text's sketch is ``BANDS`` keys, each of ``ROWS`` minima over the hashes of its shingles. Two texts of similarity s share a key
with probability 1 - (1 - s ** ROWS) ** BANDS: 0.9999 at 0.8, and 0.02 at 0.3. Texts with equal shingle sets are one. Keys
shared make candidate groups (each text is linked to the first of a key: as many rows as texts, not pairs), and inside
a group every text is compared by its whole set with those that its cluster reached, over an inverted index of the
texts still apart, so that only real links join and the group's clusters are the components of all pairs at or above
the similarity.

A group of more than ``BIG`` texts isn't held in one task. It is dealt into chunks; in each round ``PIVOTS`` of its texts go
to all its chunks and are compared with every text there, until each text outside the group's largest cluster has been
a pivot: then only pairs inside one cluster are left out. A chunk gives a spanning forest of what it found, and a
round only adds what joins clusters of earlier ones, so links are fewer than texts however many pivots a text is near to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, min_labels, slices, stage

BANDS = 32
ROWS = 6
#: The similarity from which texts are near copies, as a fraction.
SIMILAR = (4, 5)
_rng = np.random.default_rng(42)
_FLIP, _ODD, _MIX = (_rng.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) for _ in range(3))
_ODD |= np.uint64(1)
_MIX |= np.uint64(1)
#: A long text is sketched by so many shingles at once.
STEP = 4096
#: Texts of a group that one task compares; texts of a larger group that meet all others at once.
BIG = 2000
PIVOTS = 512


def sketch(shingles: np.ndarray) -> list[int]:
    """The band keys of a set of shingle hashes; none of an empty set."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), STEP):
        part = shingles[None, at : at + STEP] ^ _FLIP[:, None]
        part *= _ODD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least * _MIX).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()


def digest(shingles: np.ndarray) -> bytes:
    """Equal for equal sets (sorted hashes)."""
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def near_roots(sets: list[np.ndarray], similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """For each set the index of its cluster's first member; clusters are the components of all pairs at or above ``similar``."""
    a, b = similar
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    root = np.arange(len(sets))
    apart = np.ones(len(sets), bool)
    held = np.zeros(0, np.int64)  # the sets in the index, of which some are no longer apart
    first = -1
    frontier: list[int] = []
    while True:
        if not frontier:
            rest = np.flatnonzero(apart[first + 1 :])
            if not rest.size:
                return root
            first += 1 + int(rest[0])
            apart[first] = False
            frontier = [first]
        left = int(apart.sum())
        if not left:
            return root
        if left * 2 < len(held) or not len(held):
            held = np.flatnonzero(apart)
            hashes = np.concatenate([sets[i] for i in held])
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], np.repeat(np.arange(len(held)), size[held])[order]
        x = frontier.pop()
        lo, hi = np.searchsorted(hashes, sets[x], "left"), np.searchsorted(hashes, sets[x], "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
        both = np.bincount(owner[at], minlength=len(held))
        near = held[(a + b) * both >= a * (size[x] + size[held])]
        near = near[apart[near]]
        apart[near] = False
        root[near] = first
        frontier += near.tolist()


def links(texts: DataFrame, sketches: DataFrame, more: DataFrame, shingles_of: Callable[[str | None], np.ndarray], similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Spanning links (a, b) of near copies. ``texts``: id, text; ``sketches``: id, bands, of different sets; ``more``: further candidates (a, b)."""
    keys = stage(sketches.select(F.explode("bands").alias("key"), "id"), "keys")
    shared = keys.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key", "a")
    groups = stage(min_labels(keys.join(shared, "key").where("id <> a").select("a", F.col("id").alias("b")).unionByName(more)).withColumnRenamed("node", "id"), "candidates")
    sizes = groups.groupBy("label").agg(F.count("*").alias("n"))
    big = stage(sizes.where(F.col("n") > BIG), "big")
    out = stage(_within(texts.join(groups, "id").join(big, "label", "left_anti").select("label", "id", "text"), shingles_of, similar), "near")
    return out if big.isEmpty() else out.unionByName(_by_pivots(texts.join(groups, "id").join(big, "label").select("label", "n", "id", "text"), shingles_of, similar))


def _within(met: DataFrame, shingles_of: Callable[[str | None], np.ndarray], similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) of whole groups (label, id, text) of bounded size, each in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, ids, sets = None, [], []

        def made() -> pa.RecordBatch:
            root = near_roots(sets, similar)
            i = np.flatnonzero(root != np.arange(len(root)))
            own = np.array(ids, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(own[root[i]]), pa.array(own[i])], names=["a", "b"])

        for batch in slices(batches):
            for k, i, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != label and ids:
                    yield made()
                    ids, sets = [], []
                label = k
                ids.append(i)
                sets.append(shingles_of(x))
        if ids:
            yield made()

    return map_arrow(met.repartition("label").sortWithinPartitions("label", "id"), work, "a long, b long")


def _against(met: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links (a: pivot, b) from rows (label, chunk, member, id, shingles: bytes), a chunk's pivots before its members.

    Of all links in a chunk a spanning forest: a link between texts that earlier ones join already is left out.
    """
    a, b = similar

    def top(root: dict[int, int], i: int) -> int:
        while (up := root.setdefault(i, i)) != i:
            root[i] = i = root[up]
        return i

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, hashes, owner, size, fresh, root = None, [], [], [], [], False, {}
        for batch in slices(batches):
            out_a, out_b = [], []
            for label, chunk, member, i, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, "<u8")
                if (label, chunk) != now:
                    now, ids, hashes, owner, fresh, root = (label, chunk), [], [], [], False, {}
                if not member:
                    hashes.append(own)
                    ids.append(i)
                    continue
                if not fresh:
                    size = np.array([len(x) for x in hashes])
                    owner = np.repeat(np.arange(len(ids)), size)
                    every = np.concatenate(hashes)
                    order = np.argsort(every, kind="stable")
                    every, owner, fresh = every[order], owner[order], True
                lo, hi = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
                both = np.bincount(owner[at], minlength=len(ids))
                own_top = top(root, i)
                for k in np.flatnonzero((a + b) * both >= a * (size + len(own))):
                    pivot = top(root, ids[k])
                    if pivot != own_top:
                        root[own_top] = pivot
                        own_top = pivot
                        out_a.append(ids[k])
                        out_b.append(i)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return map_arrow(met.select("label", "chunk", "member", "id", "shingles"), work, "a long, b long")


def _by_pivots(met: DataFrame, shingles_of: Callable[[str | None], np.ndarray], similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) of groups (label, n, id, text) of any size, with the same components as all pairs."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [shingles_of(x.as_py()).astype("<u8").tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw, pa.binary())], names=["label", "n", "id", "shingles"])

    every = stage(map_arrow(met, sets, "label long, n long, id long, shingles binary"), "members")
    chunk = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.col("n") / BIG).cast("long"))
    members = every.select("label", chunk.alias("chunk"), F.lit(True).alias("member"), "id", "shingles")
    chunks = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.col("n") / BIG).cast("long") - 1))
    clusters, done = every.select("label", "id", F.col("id").alias("cluster")), None  # a cluster is named by its first
    left = every.select("label", "id")  # texts outside their group's largest cluster that haven't been a pivot
    for n in range(1 << 20):
        first = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
        chosen = stage(left.withColumn("k", first).where(F.col("k") <= PIVOTS).select("label", "id"), f"pivots{n}")
        if chosen.isEmpty():
            return clusters.where("id <> cluster").select(F.col("cluster").alias("a"), F.col("id").alias("b"))
        # only groups that still have pivots are read again
        pivots = every.join(chosen, ["label", "id"]).select("label", chunks.alias("chunk"), F.lit(False).alias("member"), "id", "shingles")
        against = pivots.unionByName(members.join(chosen.select("label").distinct(), "label")).repartition("label", "chunk").sortWithinPartitions("label", "chunk", "member", "id")
        made = stage(_against(against, similar), f"found{n}")
        if done is not None:  # only what joins clusters: what earlier rounds have joined isn't labelled again
            a, b = (clusters.select(F.col("id").alias(x), F.col("cluster").alias(f"of_{x}")) for x in "ab")
            made = made.join(a, "a").join(b, "b").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        merged = min_labels(made).select(F.col("node").alias("cluster"), F.col("label").alias("into"))
        clusters = stage(clusters.join(merged, "cluster", "left").select("label", "id", F.coalesce("into", "cluster").alias("cluster")), f"clusters{n}")
        largest = clusters.groupBy("label", "cluster").agg(F.count("*").alias("k")).groupBy("label").agg(F.max_by("cluster", F.struct("k", "cluster")).alias("cluster"))
        done = chosen if done is None else done.unionByName(chosen)
        left = stage(clusters.join(largest, ["label", "cluster"], "left_anti").join(done, ["label", "id"], "left_anti").select("label", "id"), f"left{n}")
    raise RuntimeError("groups did not settle")
