"""Best-fit packing of token pieces into fixed-length sequences, online and in bounded space.

Documents are tokenized with an end id behind each; only longer ones are cut, into full pieces and a rest. A full piece
is a sequence of its own. The rests stream through packers, one per shuffle partition, that hold a fixed number of open
bins in a bitset keyed by free space: a rest goes to the open bin with the least room that takes it; where none does, a
new bin opens, and if the packer then holds too many, the fullest closes. What is still open at the end of a packer's
stream, besides bins that are full enough, is streamed through fewer packers once more, so that the tails of many
partitions fill each other up. A packer keeps its open bins only, never its partition.

Defined results: a null or empty text is one piece of length 1 (its end id); repeated rows are packed each; a null
doc_id is packed like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, stage
from .token_counts import byte_letters

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 1
OPEN_BINS = 256
#: Bins of the first round that are at least this full stay as they are.
FULL_ENOUGH = 0.995
#: So many packers of the first round share one of the second.
SHARED_BY = 16
#: Runs and words (some 200 bytes each) of a generation; a worker remembers two, and what is asked for passes into the younger.
REMEMBERED = 450_000
_LETTERS = {b: c for c, b in byte_letters().items()}
_ENDS = ".,!?;:#$%&*|)"


class Known(dict):
    """Ids of runs of non-space, filled as they are asked for.

    A run of letters with ASCII punctuation behind it is two pre-tokens at least, cut between the letters and the rest,
    and case doesn't count: most new runs are a known word with another end.
    """

    def __init__(self, tokenizer: object, old: Known | None = None) -> None:
        super().__init__({"": b""})
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = dict(old or {})  # what the generation before knew
        self.old_words: dict[str, bytes] = old.words if old else {}

    def _ids(self, run: str) -> bytes:
        ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word_ids(self, low: str) -> bytes:
        """Ids of one lower-case word of composed letters: the normalizer leaves it and the pre-tokenizer only maps its bytes."""
        ids = [t.id for t in self.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(_LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, run: str) -> bytes:
        if (ids := self.old.get(run)) is not None:
            self[run] = ids
            return ids
        word = run.rstrip(_ENDS)
        low = word.lower()
        if low.isalpha() and max(low) < "\u0250":
            ids = self.words.get(low)
            if ids is None:
                ids = self.words[low] = self.old_words.get(low) or self._word_ids(low)
            if len(word) < len(run):
                ids += self[run[len(word) :]]
        else:
            ids = self._ids(run)
        self[run] = ids
        return ids


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes; remembers the ids of runs of non-space.

    Every white-space run is dropped by the vocabulary's pre-tokenizer and separates tokens, and its normalizer works on
    single characters and combining sequences, none of which spans a space or line feed: runs can be encoded one by one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Known(self.tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) + len(self.known.words) > REMEMBERED:
            self.known = Known(self.tokenizer, self.known)
        get = self.known.__getitem__
        return [b"".join(map(get, t.replace("\n", " ").split(" "))) for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path or default_path())
        for b in slices(batches, 64):
            owner, piece, start, size, crc = [], [], [], [], []
            for i, ids in enumerate(enc.encode([x or "" for x in b.column(1).to_pylist()])):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    owner.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Packer:
    """Bounded-space online best fit: ``put`` gives the closed bin, if any, as a list of items."""

    def __init__(self, length: int, open_bins: int) -> None:
        self.length, self.open_bins = length, open_bins
        self.bits = 0
        self.free: dict[int, list[list]] = {}  # free space -> bins, each a list of (item, size)
        self.n = 0

    def _take(self, room: int) -> list:
        bins = self.free[room]
        found = bins.pop()
        if not bins:
            del self.free[room]
            self.bits &= ~(1 << room)
        self.n -= 1
        return found

    def put(self, item: object, size: int) -> list | None:
        fit = self.bits >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            found = self._take(room)
        else:
            room, found = self.length, []
        found.append((item, size))
        room -= size
        if room == 0:
            return found
        self.free.setdefault(room, []).append(found)
        self.bits |= 1 << room
        self.n += 1
        if self.n > self.open_bins:  # the fullest closes
            return self._take((self.bits & -self.bits).bit_length() - 1)
        return None

    def rest(self) -> Iterator[list]:
        while self.bits:
            yield self._take((self.bits & -self.bits).bit_length() - 1)


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def _pack(rests: DataFrame, part: str, length: int, open_bins: int, again: bool) -> DataFrame:
    """Rows of ``rests`` placed: COLUMNS, part, bin, offset, settled. ``part`` numbers the packers; rows arrive sorted by it."""
    kinds = {f.name: f.dataType.simpleString() for f in rests.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in COLUMNS) + ", part long, bin long, offset long, settled boolean"
    enough = FULL_ENOUGH * length if again else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, packer, now, bins = [*COLUMNS, "part"], Packer(length, open_bins), None, 0
        out: list[tuple] = []
        kind = None

        def close(found: list, ended: bool) -> None:
            nonlocal bins
            at, settled = 0, not ended or sum(n for _, n in found) >= enough
            for row, n in found:
                out.append((*row, bins, at, settled))
                at += n
            bins += 1

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kind, strict=True)], names=[*names, "bin", "offset", "settled"])
            out.clear()
            return made

        for b in batches:
            kind = [*b.schema.types[: len(names)], pa.int64(), pa.int64(), pa.bool_()]
            for row in zip(*[b.column(i).to_pylist() for i in range(len(names))], strict=True):
                if row[-1] != now:
                    for found in packer.rest():
                        close(found, True)
                    now, bins = row[-1], 0
                if (found := packer.put(row, row[3])) is not None:
                    close(found, False)
                if len(out) > 20_000:
                    yield flush()
        for found in packer.rest():
            close(found, True)
        if out:
            yield flush()

    placed = rests.select(*COLUMNS, F.expr(part).cast("long").alias("part")).repartition("part")
    mixed = placed.sortWithinPartitions("part", F.xxhash64("doc_id", "ids_crc32"), "doc_id", "piece", "ids_crc32")
    return map_arrow(mixed, work, schema)


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece in its place."""
    packers = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    all_pieces = stage(pieces(docs, path, length), "pieces")
    # three kinds of numbers that never meet: full pieces from 2, first round from 0, second round from 1 (mod 3)
    full = all_pieces.where(F.col("length") == length).select(*COLUMNS, (F.lit(3) * F.monotonically_increasing_id() + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = stage(_pack(all_pieces.where(F.col("length") < length), f"pmod(xxhash64(doc_id, ids_crc32), {packers})", length, open_bins, True), "packed")
    second = _pack(first.where("not settled"), f"part div {SHARED_BY}", length, open_bins, False)

    def numbered(df: DataFrame, k: int) -> DataFrame:
        return df.select(*COLUMNS, (F.lit(3) * (F.col("part") * (1 << 38) + F.col("bin")) + k).alias("sequence_id"), "offset")

    return full.union(numbered(first.where("settled"), 0)).union(numbered(second, 1))
