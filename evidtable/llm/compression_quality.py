"""Quality by compression: zstandard dictionaries of good and bad text, and a calibrated score.

One dictionary is built from labelled good texts and one from bad ones. A text is compressed with both, in pieces of
``PIECE`` bytes, so that the dictionary and not the text's own past explains a piece. The score is a logistic function
of the normalised difference of the two compressed sizes and of the smaller size for each byte, fitted on labelled
rows that neither dictionary has seen. Only the fit uses a sample: at most ``MAX_DOCS`` rows of each label, of texts of
at most ``MAX_BYTES``; the rows with the smallest hash of their id. In the fit a row weighs as much as all labelled rows
of its label have in common with the sample, so that the score doesn't move with how many rows the sample holds. Every
row is scored over its whole text.

Defined results: rows whose crc32 of the id as text leaves 2 modulo 4 are held out, never learned from; a null id
counts as empty text there; a null or empty text has size difference and size 0 and gets the score of that; labels
other than 0 and 1, null ids and ids with both labels are not learned from; repeated rows of an id are learned from
once. Samples that fit a dictionary whole are one as they are. A label with fewer than three texts gives them both to
its dictionary and to the fit; without texts of both labels every score is (good + 1) / (all + 2) of the labelled rows,
0.5 without any. Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

MAX_DOCS = 1500
MAX_BYTES = 32_768
DICTIONARY = 65_536
LEVEL = 3
PIECE = 1024
THRESHOLD = 0.7


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def sizes(text: bytes, dictionary: bytes) -> int:
    c = _compressor(dictionary)
    return sum(len(c.compress(text[at : at + PIECE])) for at in range(0, len(text), PIECE))


def features(text: str | None, good: bytes, bad: bytes) -> tuple[float, float]:
    data = (text or "").encode()
    if not data:
        return 0.0, 0.0
    a, b = sizes(data, good), sizes(data, bad)
    return (b - a) / max(a, b), float(np.log(max(min(a, b), 1) / len(data)))


class Model:
    """Dictionaries and the calibration; small and fixed in size, whatever the input. Without weights ``prior`` is every score."""

    def __init__(self, good: bytes = b"", bad: bytes = b"", weights: tuple[float, ...] = (), prior: float = 0.5) -> None:
        self.good, self.bad, self.weights, self.prior = good, bad, weights, prior

    def score(self, text: str | None) -> float:
        if not self.weights:
            return self.prior
        z = float(np.dot(self.weights, _row(features(text, self.good, self.bad))))
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _row(x: tuple[float, float]) -> np.ndarray:
    return np.array([1.0, x[0] * 10, x[1], x[1] * x[1]])


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01, steps: int = 60) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def dictionary_of(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """All of the texts if they fit, else what training picks; from too few or too odd texts to train on, an equal share of each."""
    if sum(map(len, texts)) <= size:
        return b"".join(texts)
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(t[: max(1, size // len(texts))] for t in texts)[:size]


def fit(docs: DataFrame, labels: DataFrame, max_docs: int | None = None) -> Model:
    """A model from a bounded sample of labelled rows that aren't held out."""
    max_docs = MAX_DOCS if max_docs is None else max_docs
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).where("q = most")
    usable = usable.where(fold() != 2)
    total = {q: 0 for q in (0, 1)} | {r["q"]: r["n"] for r in usable.groupBy("q").agg(F.count("*").alias("n")).collect()}
    texts: dict[int, list[bytes]] = {}
    for q in (0, 1):
        ids = usable.where(F.col("q") == q).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
        rows = docs.select("doc_id", "text").where((F.octet_length("text") > 0) & (F.octet_length("text") <= MAX_BYTES)).join(F.broadcast(ids), "doc_id")
        # of rows that repeat an id the least text, whatever the partitions
        texts[q] = [r["text"].encode() for r in sorted(rows.groupBy("doc_id").agg(F.min("text").alias("text")).collect(), key=lambda r: r["doc_id"])]
    if not all(texts.values()):
        return Model(prior=(total[1] + 1) / (total[0] + total[1] + 2))
    learn = {q: [t for i, t in enumerate(x) if i % 3 or len(x) < 3] for q, x in texts.items()}
    judge = {q: [t for i, t in enumerate(x) if i % 3 == 0 or len(x) < 3] for q, x in texts.items()}
    good, bad = dictionary_of(learn[1]), dictionary_of(learn[0])
    x = np.array([_row(features(t.decode(), good, bad)) for q in (0, 1) for t in judge[q]])
    y = np.array([q for q in (0, 1) for _ in judge[q]], float)
    share = {q: total[q] / len(judge[q]) / (total[0] + total[1]) * len(y) for q in (0, 1)}
    return Model(good, bad, calibrate(x, y, np.array([share[q] for q in y.astype(int)])))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.good, model.bad, model.weights, model.prior))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for b in slices(batches):
            s = [m.score(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return map_arrow(docs.select("doc_id", (fold() == 2).alias("held_out"), "text"), work, f"doc_id {kind}, held_out boolean, score double, predicted int")
