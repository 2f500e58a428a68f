"""Personal data by fixed patterns and bootstrapped contextual extraction.

Base entities (email, ip, card, phone), each as a whole, and values behind cue words are the seeds. Every seed and every
identifier-like string makes edges of a pattern-instance graph, counted by task and summed by Spark: one to each of its
patterns, which are the three and the five lexical tokens before it and the two on either side of it (a word among
them, digits as one sign). Rounds of scoring follow: a pattern's score is the mean score of its different instances, an instance's the best of its
patterns, seeds stay at one. Patterns with a high score and enough different instances are accepted, however many and
whatever their share of the table, and what stands behind them is found as kind ``id`` unless a base span covers some
of it. Up to ``SHARED_PATTERNS`` of those that find something go to the executors; more are joined.

Defined results: a null text is empty and has no spans; spans are in code points of the whole text, end exclusive;
repeated rows and ties are found each; an empty table gives an empty result; other columns are not read by ``detect``
and pass unchanged through ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import keep_columns, map_arrow, slices, stage

KINDS = ("email", "ip", "card", "phone", "id")
#: Words that say that an identifier follows, behind ``=`` or ``:``; seeds besides the base entities.
CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "key", "ssn", "passport", "account", "iban", "licence", "license_no", "session")
MIN_INSTANCES = 3
MIN_SCORE = 0.75
ROUNDS = 3
MIN_IDENTIFIER = 8
#: More patterns than these are not sent to every executor but joined with the places they could stand before.
SHARED_PATTERNS = 100_000
#: A pattern looks at so many characters before and behind an identifier.
REACH = 64
_PLACES = StructType([StructField("places", ArrayType(StructType([StructField("s", LongType()), StructField("e", LongType()), StructField("p", ArrayType(StringType()))])))])
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORDY = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its first digit fails from any later one: the look-behind changes no match
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_LEX = re.compile(r"\w+|[^\w\s]")
_CUE = re.compile(rf"(?:^|\s)(?:{'|'.join(CUES)}) [=:](?: [\"'])?$")
_LETTER = re.compile(r"[^\W\d_]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:
        s = at
        while s > done and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            done = m.end()
            out.append((s, 0, done))
        at = text.find("@", max(at + 1, done))
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdecimal() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def identifiers(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of word characters and hyphens with a digit, of MIN_IDENTIFIER characters at least."""
    done = 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        s, e = m.start(), m.end()
        while s > done and text[s - 1] in _WORDY:
            s -= 1
        while e < len(text) and text[e] in _WORDY:
            e += 1
        done = e
        if e - s >= MIN_IDENTIFIER:
            yield s, e


def patterns(text: str, start: int, end: int) -> list[str]:
    """The contexts of a span, different ones: three and five lexical tokens before it, two on either side."""
    before = [_DIGITS.sub("0", x) for x in _LEX.findall(text[max(0, start - REACH) : start].lower())[-5:]]
    behind = [_DIGITS.sub("0", x) for x in _LEX.findall(text[end : end + REACH].lower())[:2]]
    made = (" ".join(before[-3:]), " ".join(before), f"{' '.join(before[-2:])} _ {' '.join(behind)}")
    return [x for x in dict.fromkeys(made) if _LETTER.search(x)]


def cued(text: str, start: int) -> bool:
    """Whether a cue word with = or : stands before a place."""
    return bool(_CUE.search(" ".join(_LEX.findall(text[max(0, start - REACH) : start].lower())[-3:])))


def _covered(base: list[tuple[int, int, int]], s: int, e: int) -> bool:
    return any(a < e and s < z for a, _, z in base)


def edges(docs: DataFrame) -> DataFrame:
    """pattern, instance, n, seed, free (not covered by a base span, somewhere): the graph, summed over tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        seeds: set = set()
        free: set = set()

        def made() -> pa.RecordBatch:
            keys = list(seen)
            batch = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64()), pa.array([k in seeds for k in keys]), pa.array([k in free for k in keys])], names=["pattern", "instance", "n", "seed", "free"])
            seen.clear()
            seeds.clear()
            free.clear()
            return batch

        for b in slices(batches):
            for x in b.column(1):
                text = x.as_py() or ""
                base = base_spans(text)
                whole = {(s, e) for s, _, e in base}
                starts = {s for s, _ in whole}
                # an identifier that begins a base span is that span's own occurrence
                for s, e in [*whole, *(x for x in identifiers(text) if x[0] not in starts)]:
                    instance = hashlib.blake2b(text[s:e].encode(), digest_size=12).hexdigest()
                    keys = [(p, instance) for p in patterns(text, s, e)]
                    seen.update(keys)
                    if (s, e) in whole or cued(text, s) or any(a <= s and e <= z for a, _, z in base):
                        seeds.update(keys)
                    if not _covered(base, s, e):
                        free.update(keys)
            if len(seen) > 50_000:
                yield made()
        if seen:
            yield made()

    found = map_arrow(docs.select("doc_id", "text"), work, "pattern string, instance string, n long, seed boolean, free boolean")
    return found.groupBy("pattern", "instance").agg(F.sum("n").alias("n"), F.max("seed").alias("seed"), F.max("free").alias("free"))


def accepted_patterns(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, finds (whether something stands behind it that no base span covers) of every accepted pattern."""
    graph = stage(edges(docs), "graph")
    wide = stage(graph.groupBy("pattern").agg(F.count("*").alias("k"), F.max("free").alias("finds")).where(F.col("k") >= MIN_INSTANCES), "wide")
    fixed = graph.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("fixed"))
    linked = stage(graph.join(wide.select("pattern"), "pattern", "left_semi").select("pattern", "instance").join(fixed, "instance"), "linked")
    patterns = stage(linked.groupBy("pattern").agg(F.avg("fixed").alias("p")), "patterns0")
    for n in range(1, rounds):
        scores = stage(linked.join(patterns, "pattern").groupBy("instance").agg(F.max(F.greatest("fixed", "p")).alias("score")), f"scores{n}")
        patterns = stage(linked.join(scores, "instance").groupBy("pattern").agg(F.avg("score").alias("p")), f"patterns{n}")
    return stage(patterns.where(F.col("p") >= MIN_SCORE).join(wide, "pattern").select("pattern", "finds"), "accepted")


def learn_patterns(docs: DataFrame, rounds: int = ROUNDS) -> list[str]:
    """Every accepted pattern, as a list: for tables whose patterns fit the driver."""
    return sorted(r["pattern"] for r in accepted_patterns(docs, rounds).select("pattern").collect())


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, list[str]]]:
    """(start, end, patterns) of the identifiers that no base span covers."""
    return [(s, e, patterns(text, s, e)) for s, e in identifiers(text) if not _covered(base, s, e)]


def all_spans(text: str, accepted: frozenset[str]) -> list[tuple[int, int, int]]:
    """Base and discovered spans (start, kind number, end), sorted."""
    base = base_spans(text)
    return sorted(base + [(s, 4, e) for s, e, own in candidates(text, base) if not accepted.isdisjoint(own)]) if accepted else base


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _with_spans(docs: DataFrame, accepted: list[str] | None, made: Callable[[pa.RecordBatch, list], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``made`` of every slice of ``docs`` and its rows' spans, by the patterns given or learnt from all of ``docs``."""
    at = docs.columns.index("text")
    if accepted is None:
        useful = accepted_patterns(docs).where("finds").select("pattern")
        if useful.count() > SHARED_PATTERNS:
            return _joined(docs, useful, made, schema)
        accepted = [r["pattern"] for r in useful.collect()]
    known = docs.sparkSession.sparkContext.broadcast(frozenset(accepted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield made(b, [all_spans(x.as_py() or "", known.value) for x in b.column(at)])

    return map_arrow(docs, work, schema)


def _joined(docs: DataFrame, patterns: DataFrame, made: Callable[[pa.RecordBatch, list], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``_with_spans`` by a join: rows without a candidate need no pattern; the others are staged with a row number."""
    at = docs.columns.index("text")

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            base = [base_spans(x.as_py() or "") for x in b.column(at)]
            own = [i for i, (x, s) in enumerate(zip(b.column(at), base, strict=True)) if not candidates(x.as_py() or "", s)]
            yield made(b.take(pa.array(own, pa.int64())), [base[i] for i in own])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("p", pa.list_(pa.string()))]))
        for b in slices(batches):
            places = [candidates(x, base_spans(x)) for x in (x.as_py() or "" for x in b.column(1))]
            own = pa.array([i for i, x in enumerate(places) if x], pa.int64())
            told = pa.array([[{"s": s, "e": e, "p": p} for s, e, p in x] for x in places if x], kind)
            yield pa.RecordBatch.from_arrays([b.column(0).take(own), told], names=["row", "places"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = pa.RecordBatch.from_arrays(b.columns[:-1], schema=pa.schema(list(b.schema)[:-1]))
            found = [[(x["s"], 4, x["e"]) for x in own or []] for own in b.column(b.num_columns - 1).to_pylist()]
            yield made(rows, [sorted(base_spans(x.as_py() or "") + own) for x, own in zip(rows.column(at), found, strict=True)])

    packed = keep_columns(docs)
    open_ = map_arrow(packed.select("row", F.col("row.text").alias("text")), placed, StructType([*packed.schema.fields, *_PLACES.fields]))
    open_ = stage(open_.withColumn("number", F.monotonically_increasing_id()), "places")
    each = open_.select("number", F.explode("places").alias("x")).select("number", F.explode("x.p").alias("pattern"), F.struct("x.s", "x.e").alias("span"))
    found = each.join(patterns, "pattern").groupBy("number").agg(F.collect_set("span").alias("_id_spans"))
    told = open_.join(found, "number", "left").select("row.*", "_id_spans")
    return map_arrow(docs, plain, schema).unionAll(map_arrow(told, merged, schema))


def detect(docs: DataFrame, accepted: list[str] | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id, n_spans (of all kinds) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def made(b: pa.RecordBatch, every: list) -> pa.RecordBatch:
        rows = []
        for spans in every:
            n = Counter(k for _, k, _ in spans)
            base = _told([s for s in spans if s[1] < 4])
            rows.append((n[0], n[1], n[2], n[3], hashlib.sha256(base.encode()).hexdigest(), _told(spans), n[4], len(spans)))
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2)]
        return pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_id", "n_spans"])

    return _with_spans(docs.select("doc_id", "text"), accepted, made, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_id long, n_spans long")


def _replaced(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    if text is None:
        return None
    out, at, end = [], 0, 0
    for s, k, e in spans:
        if s >= end:
            out += (text[at:s] if s > at else "", f"[{KINDS[k].upper()}]")
        end = max(end, e)
        at = end
    return "".join(out) + text[at:]


def redacted(text: str | None, accepted: frozenset[str]) -> str | None:
    """The text with every span as ``[KIND]``; of overlapping spans the first, as far as all of them reach."""
    return _replaced(text, all_spans(text or "", accepted))


def redact(docs: DataFrame, accepted: list[str] | None = None) -> DataFrame:
    """``docs`` with redacted texts, all columns kept."""
    at = docs.columns.index("text")

    def made(b: pa.RecordBatch, every: list) -> pa.RecordBatch:
        cols = list(b.columns)
        cols[at] = pa.array([_replaced(x, s) for x, s in zip(b.column(at).to_pylist(), every, strict=True)], b.schema.types[at])
        return pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return _with_spans(docs, accepted, made, docs.schema)
