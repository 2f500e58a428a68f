"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings of all training words, once for any test set: documents are grouped into small index
shards, and a shard holds, for each term (its XXH64), the sorted positions of the term (documents lie one behind the
other with a gap that no phrase bridges). ``search`` orders the terms of each test window by their frequency over the
whole corpus, shifts the postings of its rarest term by the term's offset, and intersects them with the shifted postings
of the next rarest terms, all windows at once. Equal positions are exact phrase matches; positions within a slop are
proximity matches (each term within ``SLOP`` of its place, so every exact match is one too). Only test vocabulary and
windows go to the executors, in blocks of at most ``BLOCK_CHARS`` characters of test text; each further block searches
the same index, and hits are merged by (shard, place), which every row has of its own.

Defined results: a null or wordless document has no words and is clean; a null or wordless test text has no window; the
windows of a test row with a null id count as hits and contaminate, but it has no id to report, so it isn't among the
items; test rows that repeat an id are one item; repeated documents and null ids each get their own row; an empty test
table leaves every document clean; a long text fills a shard by itself; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_columns, map_arrow, slices, stage

WINDOW = 10
SLOP = 2
BLOCK_CHARS = 8_000_000
SHARD_BYTES = 1 << 21
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters a-z and characters beyond ASCII, as UTF-8."""
    return (text or "").encode().translate(_FOLD).split()


def term(word: bytes) -> int:
    """A word's name in the index."""
    return xxhash.xxh64_intdigest(word)


class Queries:
    """Test windows of a block: term numbers, and for each window its terms with offsets; item None has no id."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.terms: dict[bytes, int] = {}
        self.items: list[str | None] = []
        number: dict[str | None, int] = {}
        rows, owner = [], []
        for item, text in items:
            w = [self.terms.setdefault(x, len(self.terms)) for x in words(text)]
            if not w:
                continue
            i = number.setdefault(item, len(number))
            size = min(window, len(w))
            for at in range(len(w) - size + 1):
                rows.append(w[at : at + size])
                owner.append(i)
        self.items = list(number)
        self.length = np.fromiter(map(len, rows), np.int64, len(rows))
        self.owner = np.array(owner, np.int64)
        self.grid = np.full((len(rows), window), -1, np.int64)
        for i, r in enumerate(rows):
            self.grid[i, : len(r)] = r
        self.width = window
        names = np.fromiter(map(term, self.terms), np.uint64, len(self.terms))
        self.number = np.argsort(names, kind="stable")
        self.names = names[self.number]

    def found_in(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in sorted ``names`` of a shard that this block asks for, and the numbers of their terms."""
        if not len(self.names) or not len(names):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(names, self.names), len(names) - 1)
        own = names[at] == self.names
        return at[own], self.number[own]

    def rank(self, frequency: np.ndarray) -> None:
        """Offsets of each window's terms from the rarest on, and the windows by their rarest term."""
        f = np.where(self.grid >= 0, frequency[self.grid], np.iinfo(np.int64).max)
        self.order = np.argsort(f, axis=1, kind="stable")
        rarest = self.grid[np.arange(len(self.grid)), self.order[:, 0]] if len(self.grid) else np.zeros(0, np.int64)
        self.by_term = np.argsort(rarest, kind="stable")
        self.term_of = rarest[self.by_term]


def build_index(docs: DataFrame, window: int = WINDOW, slop: int = SLOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each shard: shard, doc_ids, n_words, terms (sorted little-endian uint64), counts (int32), postings (int32, term by term)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    gap = window + slop + 1

    def made(ids: list, texts: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        sizes = [len(w) for w in texts]
        t = np.fromiter((number.setdefault(x, len(number)) for w in texts for x in w), np.int64, sum(sizes))
        starts = np.concatenate([[0], np.cumsum(np.array(sizes[:-1], np.int64) + gap)]) if sizes else np.zeros(0, np.int64)
        p = np.arange(len(t)) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64), sizes)
        names = np.fromiter(map(term, number), np.uint64, len(number))
        order = np.argsort(names, kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        t = place[t]
        counts = np.bincount(t, minlength=len(names))
        row = ids, sizes, names[order].astype("<u8").tobytes(), counts.astype("<i4").tobytes(), p[np.argsort(t, kind="stable")].astype("<i4").tobytes()
        types = pa.list_(kind), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array([x], y) for x, y in zip(row, types, strict=True)], names=["doc_ids", "n_words", "terms", "counts", "postings"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, of = [], [], 0, None
        for b in slices(batches):
            of = b.column(0).type
            for i, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = x.as_py() or ""
                ids.append(i)
                texts.append(words(text))
                held += len(text)
                if held >= shard_bytes:
                    yield made(ids, texts, of)
                    ids, texts, held = [], [], 0
        if ids:
            yield made(ids, texts, of)

    found = map_arrow(docs.select("doc_id", "text"), work, f"doc_ids array<{kind}>, n_words array<long>, terms binary, counts binary, postings binary")
    return found.withColumn("shard", F.monotonically_increasing_id())


def frequencies(index: DataFrame, queries: Queries) -> np.ndarray:
    """How often each test term occurs in the corpus; at most as many rows as a block of test text has words."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.names), np.int64)
        for b in batches:
            for names, counts in zip(b.column(0), b.column(1), strict=True):
                at, own = shared.value.found_in(np.frombuffer(names.as_buffer(), "<u8"))
                total[own] += np.frombuffer(counts.as_buffer(), "<i4")[at]
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["term", "n"])

    out = np.zeros(len(queries.names), np.int64)
    for r in map_arrow(index.select("terms", "counts"), work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def matches(q: Queries, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, start, place of its rarest term) of every window whose rarest term stands at its place and the others within ``slop`` of theirs; 0: exact phrases."""
    none = np.zeros(0, np.int64)
    if not len(terms) or not len(q.grid):
        return none, none, none
    base = int(postings.max()) + q.width + slop + 2
    keys = np.repeat(terms, counts) * base + postings  # sorted: term by term, positions rising
    first = np.searchsorted(q.term_of, terms, "left")
    last = np.searchsorted(q.term_of, terms, "right")
    n = last - first  # windows whose rarest term this is
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    use = np.flatnonzero(n)
    found_w, found_s = [], []
    for t in use:
        w = q.by_term[first[t] : last[t]]
        p = postings[begins[t] : begins[t] + counts[t]].astype(np.int64)
        off = q.order[w, 0]
        starts = (p[None, :] - off[:, None]).ravel()
        w = np.repeat(w, len(p))
        for k in range(1, q.width):
            at = q.order[w, k]
            term = q.grid[w, at]
            open_ = term >= 0
            lo = starts + at - slop
            key = term * base + np.maximum(lo, 0)
            i = np.searchsorted(keys, key)
            got = keys[np.minimum(i, len(keys) - 1)]
            ok = ~open_ | ((i < len(keys)) & (got >= key) & (got <= term * base + starts + at + slop) & (starts + at + slop >= 0))
            w, starts = w[ok], starts[ok]
            if not len(w):
                break
        found_w.append(w)
        found_s.append(starts)
    if not found_w:
        return none, none, none
    w, starts = np.concatenate(found_w), np.concatenate(found_s)
    return w, starts, starts + q.order[w, 0]


def search(index: DataFrame, queries: Queries, slop: int = SLOP) -> DataFrame:
    """shard, place, doc_id, n_words, spans (array of start, end in words: exact matches merged), items, near_items (sorted ids), for every document of the index."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast(queries)
    gap = queries.width + SLOP + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for b in batches:
            for r in range(b.num_rows):
                shard, ids, sizes = b.column(0)[r].as_py(), b.column(1)[r].values, np.array(b.column(2)[r].as_py(), np.int64)
                names, every, places = (np.frombuffer(b.column(c)[r].as_buffer(), t) for c, t in ((3, "<u8"), (4, "<i4"), (5, "<i4")))
                begin = np.concatenate([[0], np.cumsum(every, dtype=np.int64)])
                at, terms = q.found_in(names)
                order = np.argsort(terms)
                at, terms = at[order], terms[order]
                counts = every[at].astype(np.int64)
                take = np.repeat(begin[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64), counts) + np.arange(counts.sum()) if len(at) else at
                postings = places[take].astype(np.int64)
                start = np.concatenate([[0], np.cumsum(sizes + gap)])
                w, s, _ = matches(q, terms, counts, postings, 0)
                wn, _, rarest = matches(q, terms, counts, postings, slop) if slop else (w, s, s)
                spans: list[list] = [[] for _ in sizes]
                items: list[set] = [set() for _ in sizes]
                near: list[set] = [set() for _ in sizes]
                order = np.argsort(s, kind="stable")
                owner = np.searchsorted(start, s, "right") - 1
                for i in order:
                    d = int(owner[i])
                    a = int(s[i] - start[d])
                    z = a + int(q.length[w[i]])
                    items[d].add(int(q.owner[w[i]]))
                    if spans[d] and a <= spans[d][-1][1]:
                        spans[d][-1][1] = max(z, spans[d][-1][1])
                    else:
                        spans[d].append([a, z])
                for d, i in set(zip((np.searchsorted(start, rarest, "right") - 1).tolist(), q.owner[wn].tolist(), strict=True)):
                    near[d].add(i)
                struct = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                told = lambda x: sorted(q.items[i] for i in x if q.items[i] is not None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(sizes), pa.int64()), pa.array(range(len(sizes)), pa.int64()), ids, pa.array(sizes), pa.array([[{"start": a, "end": z} for a, z in x] for x in spans], struct),
                        pa.array([told(x) for x in items], pa.list_(pa.string())), pa.array([told(x) for x in near], pa.list_(pa.string())),
                    ],
                    names=["shard", "place", "doc_id", "n_words", "spans", "items", "near_items"],
                )

    columns = index.select("shard", "doc_ids", "n_words", "terms", "counts", "postings")
    return map_arrow(columns, work, f"shard long, place long, doc_id {kind}, n_words long, spans array<struct<start:long,end:long>>, items array<string>, near_items array<string>")


def blocks(benchmark: DataFrame, chars: int | None = None) -> Iterator[list[tuple[str | None, str]]]:
    """Test items in blocks of bounded size, streamed from the cluster one partition at a time."""
    chars = BLOCK_CHARS if chars is None else chars
    held, size = [], 0
    for r in benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator():
        held.append((r["i"], r["text"]))
        size += len(r["text"])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _merged_spans(every: Column) -> Column:
    """Sorted spans, those that touch as one."""
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    longer = lambda acc, x: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], x["end"]).alias("end"))))
    return F.aggregate(every, F.array().cast("array<struct<start:long,end:long>>"), lambda acc, x: F.when((F.size(acc) > 0) & (last(acc)["end"] >= x["start"]), longer(acc, x)).otherwise(F.concat(acc, F.array(x))))


def contamination(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """doc_id, n_words, spans, items, near_items of every row of ``docs``, over all test items."""
    index = stage(build_index(docs), "index")
    found = []
    for part in blocks(benchmark):
        q = Queries(part)
        q.rank(frequencies(index, q))
        found.append(search(index, q, slop))
    if not found:
        q = Queries([])
        q.rank(np.zeros(0, np.int64))
        found.append(search(index, q, 0))
    columns = ("doc_id", "n_words", "spans", "items", "near_items")
    if len(found) == 1:
        return found[0].select(*columns)
    hits = [stage(f.where("size(spans) > 0 or size(near_items) > 0").select("shard", "place", "spans", "items", "near_items"), "hits") for f in found]
    for more in hits[1:]:
        hits[0] = hits[0].union(more)
    ids = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    merged = hits[0].groupBy("shard", "place").agg(_merged_spans(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"), ids("items"), ids("near_items"))
    every = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("place", "d")).select("shard", F.col("place").cast("long").alias("place"), "d.*")
    kinds = dict(found[0].dtypes)
    held = [F.coalesce(F.col(c), F.array().cast(kinds[c])).alias(c) for c in columns[2:]]
    return every.join(merged, ["shard", "place"], "left").select(F.col("doc_ids").alias("doc_id"), "n_words", *held)


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a phrase of ``benchmark``. Rows are judged by their text alone, whatever their id."""
    name = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    found = contamination(docs.select(name.alias("doc_id"), "text"), benchmark, 0)
    bad = stage(found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_text")).distinct(), "contaminated")
    packed = keep_columns(docs).withColumn("_text", F.unhex(F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256)))
    return packed.join(bad, "_text", "left_anti").select("row.*")
