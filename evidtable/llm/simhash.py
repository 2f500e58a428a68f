"""SimHash near-duplicates by vantage-point trees.

A fingerprint pair within ``RADIUS`` bits of each other agrees wholly in at least ``EQUAL`` of ``BLOCKS`` bit blocks.
So there is a tree for each choice of ``EQUAL`` blocks, whose upper levels measure Hamming distance on those blocks
only: the triangle bound at radius 0 prunes every branch but one, and the upper levels end in shards that don't overlap
(a shard is the set of fingerprints with the same bits there), whatever the number of rows. Inside a shard a vantage point orders the
fingerprints by full Hamming distance; a query only meets those whose distance to the vantage point differs from its own by at most
the radius (the triangle bound), which spans the boundary between near and far. A shard gives a spanning set of exact
links, not all pairs. Only distinct fingerprints enter, so exact copies, however many, are one row.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; a row with a null doc_id
gets its fingerprint, a null component_id and links nothing; repeated rows are each returned; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_copies
from .common import keep_columns, map_arrow, min_labels, slices, stage

SEED = 42
SHINGLE = 4
#: Words of a shingle where near copies are told by similarity.
NEAR_SHINGLE = 5
RADIUS = 4
BLOCKS = 6
EQUAL = BLOCKS - RADIUS
#: Shards of at most so many fingerprints are compared by shifting the sorted rows; larger ones by vantage distance.
SMALL_SHARD = 24
FRONTIER = 512


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The XXH64 values of a text's word shingles, repeats among them."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    k = min(shingle, len(words))
    return np.fromiter((xxhash.xxh64_intdigest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[k - 1 :], strict=False)), np.uint64, len(words) - k + 1)


def _majority(h: np.ndarray) -> int:
    if not len(h):
        return 0
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None) -> int:
    """The 64 majority bits of the XXH64 values of a text's word shingles."""
    return _majority(shingle_hashes(text))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(x.as_py()) for x in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, fp long")


def _masks() -> list[int]:
    edges = np.linspace(0, 64, BLOCKS + 1).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, EQUAL)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shard_links(fps: np.ndarray) -> np.ndarray:
    """For each fingerprint of a shard the index of its component's first member, by search from a vantage point."""
    d = np.bitwise_count(fps ^ fps[0]).astype(np.int16)
    order = np.argsort(d, kind="stable")
    f, d = fps[order], d[order]
    root = np.arange(len(f))
    left = np.arange(len(f))
    while left.size > 1:
        first, left = left[0], left[1:]
        frontier = np.array([first])
        while frontier.size and left.size:
            now, frontier = frontier[:FRONTIER], frontier[FRONTIER:]
            lo = np.searchsorted(d[left], d[now].min() - RADIUS, "left")
            hi = np.searchsorted(d[left], d[now].max() + RADIUS, "right")
            near = left[lo:hi]
            if near.size:
                hit = np.zeros(near.size, bool)
                for at in range(0, near.size, 1 << 14):
                    part = near[at : at + (1 << 14)]
                    hit[at : at + part.size] = (np.bitwise_count(f[now][:, None] ^ f[part][None, :]) <= RADIUS).any(axis=0)
                root[near[hit]] = first
                left = np.concatenate([left[:lo], near[~hit], left[hi:]])
                frontier = np.concatenate([frontier, near[hit]])
    out = np.empty(len(f), np.int64)
    out[order] = order[root]
    return out


def _first_reached(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows the first row that the pairs (x, y) join it to."""
    root = np.arange(n)
    while True:
        was, low = root.copy(), np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if np.array_equal(root, was):
            return root


def _links(tree: np.ndarray, shard: np.ndarray, fps: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by (tree, shard); whole shards only."""
    new = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1])]))
    sizes = np.diff(np.append(new, len(shard)))
    size_of = np.repeat(sizes, sizes)
    group = np.repeat(np.arange(len(new)), sizes)
    none = np.zeros(0, np.int64)
    a, b, x, y = [], [], [none], [none]
    small = size_of <= SMALL_SHARD
    for lag in range(1, min(SMALL_SHARD, int(sizes.max(initial=1)))):
        i = np.flatnonzero(small[:-lag] & (group[:-lag] == group[lag:]) & (size_of[:-lag] > lag))
        if not i.size:
            continue
        i = i[np.bitwise_count(fps[i] ^ fps[i + lag]) <= RADIUS]
        x.append(i)
        y.append(i + lag)
    root = _first_reached(np.concatenate(x), np.concatenate(y), len(ids))
    i = np.flatnonzero(root != np.arange(len(ids)))
    a.append(ids[root[i]])
    b.append(ids[i])
    for s, n in zip(new[sizes > SMALL_SHARD], sizes[sizes > SMALL_SHARD], strict=False):
        root = shard_links(fps[s : s + n])
        i = np.flatnonzero(root != np.arange(n))
        a.append(ids[s + root[i]])
        b.append(ids[s + i])
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame) -> DataFrame:
    """Spanning links (a, b: ids) among rows (fp, id) of distinct fingerprints: the same components as all pairs within RADIUS."""
    fp = F.col("fp")
    shards = F.array(*[F.struct(F.lit(i).alias("tree"), fp.bitwiseAND(F.lit(_signed(m))).alias("shard")) for i, m in enumerate(_masks())])
    placed = distinct.select(F.explode(shards).alias("s"), "fp", "id").select("s.tree", "s.shard", "fp", "id")
    # sorted to the last column: a task that runs again after a lost executor makes the same links
    placed = placed.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for last, batch in _with_last(batches):
            now = [] if batch is None else [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            now = [np.concatenate(x) for x in zip(held, now, strict=True)] if held and now else now or held
            if not now or not len(now[0]):
                continue
            n = len(now[0])
            if not last:  # the last shard may go on in the next batch
                n = int(np.flatnonzero((now[1] == now[1][-1]) & (now[0] == now[0][-1]))[0])
            held = [x[n:] for x in now]
            if n:
                a, b = _links(now[0][:n], now[1][:n], now[2][:n].view(np.uint64), now[3][:n])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return map_arrow(placed, work, "a long, b long")


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for b in batches:
        yield False, b
    yield True, None


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable) for every row of ``docs``; doc_id of any type that sorts."""
    fps = stage(fingerprints(docs), "fingerprints")
    distinct = stage(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = min_labels(links(distinct.select("fp", F.col("fp").alias("id"))))
    placed = stage(distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "placed")
    least = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    of = stage(placed.join(least, "label").select("fp", "component_id"), "classes")
    # a left join: a fingerprint that only rows without an id have is of no class
    return fps.join(of, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def sketched(texts: DataFrame, shingle: int) -> DataFrame:
    """id, fp, digest and bands (of the set of shingles) of every row of ``texts`` (id, text), by one hashing of its shingles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp, digests, bands = [], [], []
            for x in b.column(1):
                h = shingle_hashes(x.as_py(), shingle)
                own = np.unique(h)
                fp.append(_signed(_majority(h)))
                digests.append(near_copies.digest(own))
                bands.append(near_copies.sketch(own))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "fp", "digest", "bands"])

    return map_arrow(texts, work, "id long, fp long, digest binary, bands array<long>")


def keep_first(docs: DataFrame, shingle: int = NEAR_SHINGLE, similar: tuple[int, int] = near_copies.SIMILAR) -> DataFrame:
    """The row with the smallest doc_id (nulls last) of each group of near copies; rows are told apart by a number of their own, not by doc_id.

    Groups are the components of all pairs whose sets of ``shingle``-word shingles have a Jaccard similarity of
    ``similar`` at least. Fingerprints of these shingles within RADIUS bits and MinHash bands give the candidates, the
    whole sets the verdict.
    """
    rows = stage(keep_columns(docs).withColumn("id", F.monotonically_increasing_id()), "rows")
    texts = rows.select("id", F.col("row.text").alias("text"))
    sketches = stage(sketched(texts, shingle), "sketches")
    sets = stage(sketches.groupBy("digest").agg(F.min("id").alias("id"), F.min_by("fp", "id").alias("fp"), F.min_by("bands", "id").alias("bands")), "sets")
    same = sketches.select("digest", F.col("id").alias("b")).join(sets.select("digest", F.col("id").alias("a")), "digest").where("a <> b").select("a", "b")
    marked = stage(sets.groupBy("fp").agg(F.min("id").alias("first")), "marked")
    alike = sets.select("id", "fp").join(marked, "fp").where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    marks = links(marked.select("fp", F.col("first").alias("id"))).unionByName(alike)
    near = near_copies.links(texts, sets.select("id", "bands"), marks, lambda x: np.unique(shingle_hashes(x, shingle)), similar)
    labels = stage(min_labels(same.unionByName(near)).join(rows.select(F.col("id").alias("node"), F.col("row.doc_id").alias("doc_id")), "node"), "groups")
    kept = labels.groupBy("label").agg(F.min_by("node", F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("node"))
    gone = stage(labels.join(kept, ["label", "node"], "left_anti").select(F.col("node").alias("id")), "gone")
    # the ids that go grow with the input: merged, never broadcast
    return rows.join(gone.hint("merge"), "id", "left_anti").select("row.*")
