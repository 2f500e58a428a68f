"""Misread names: candidates by confusable characters, accepted where a table of known names has one.

Candidates are a table: the fixed confusions meet the places of a name that they could have spoilt, each edit a row with
a path (kind of edit, path of the text it starts from, rule, place) by which rows sort. Nothing runs per row in Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_pair

#: What is read, what was printed, in the order of trial; rules for a lone l and for stereo letters.
CONFUSIONS = (("I", "l"), ("l", "I"), ("l", "1"), ("1", "l"), ("O", "0"), ("0", "O"), ("rn", "m"), ("m", "rn"), ("ii", "n"), ("]", "l"), ("|", "l"), ("–", "-"), ("—", "-"))
LONE_L = ((r"l(?=H[-\]])", "1"), (r"(?<b>[-(\[,]\s*)l(?=\s*[,)\]-])", "${b}1"))
STEREO = ((r"\((?:7\?|l\?|R\?)\)", "(R)"), (r"\(5\)", "(S)"))
DEPTH = 2
MOST = 200
_EDIT = "struct<text:string,edit:string,kind:int,rule:int,place:int>"


def _edit(text: Column, told: Column, kind: int, rule: int, place: Column) -> Column:
    return F.struct(text.alias("text"), told.alias("edit"), F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), place.cast("int").alias("place")).cast(_EDIT)


def _whole(text: Column) -> Column:
    """Edits of kind 0: a rule undone wherever it applies."""
    swaps = [_edit(F.replace(text, F.lit(a), F.lit(b)), F.lit(f"{a} → {b} everywhere"), 0, i, F.lit(0)) for i, (a, b) in enumerate(CONFUSIONS)]
    contexts = [(LONE_L, "lone l → 1"), (STEREO, "stereo letter")]
    mended = [_edit(reduce(lambda t, r: F.regexp_replace(t, *r), rules, text), F.lit(told), 0, len(CONFUSIONS) + i, F.lit(0)) for i, (rules, told) in enumerate(contexts)]
    return F.array(*swaps, *mended)


def _single(text: Column) -> Column:
    """Edits of kind 1: a confusion undone at one place."""

    def rule(i: int, a: str, b: str) -> Column:
        spots = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda p: F.substring(text, p, F.lit(len(a))) == a)
        mend = lambda p: F.concat(F.substring(text, F.lit(1), p - 1), F.lit(b), F.substring(text, p + len(a), F.length(text)))
        return F.transform(spots, lambda p: _edit(mend(p), F.concat(F.lit(f"{a} → {b} at "), p.cast("string")), 1, i, p))

    return F.concat(*[rule(i, a, b) for i, (a, b) in enumerate(CONFUSIONS)])


def next_candidates(bases: DataFrame) -> DataFrame:
    """seed, text, path, edits, whole: what one more edit makes of ``bases`` (the same columns), each different text once, by its least path.

    ``whole``: made by edits of kind 0 alone; only such texts take another of that kind.
    """
    edits = F.concat(F.when(F.col("whole"), _whole(F.col("text"))).otherwise(F.array().cast(f"array<{_EDIT}>")), _single(F.col("text")))
    made = bases.select("seed", "path", "edits", "whole", F.explode(edits).alias("e"))
    path = F.concat(F.array(F.col("e.kind")), "path", F.array(F.col("e.rule"), F.col("e.place")))
    made = made.select("seed", F.col("e.text").alias("text"), path.alias("path"), F.concat("edits", F.array(F.col("e.edit"))).alias("edits"), (F.col("whole") & (F.col("e.kind") == 0)).alias("whole"))
    return made.where("text <> seed").groupBy("seed", "text").agg(F.min("path").alias("path"), F.min_by("edits", "path").alias("edits"), F.min_by("whole", "path").alias("whole"))


def candidates(seeds: DataFrame, depth: int = DEPTH, most: int = MOST) -> DataFrame:
    """seed, depth, n, text, edits: the ``most`` first candidates of each of ``seeds`` (seed), fewer edits first, then by path."""
    bases = seeds.select("seed", F.col("seed").alias("text"), F.array().cast("array<int>").alias("path"), F.array().cast("array<string>").alias("edits"), F.lit(True).alias("whole"))
    every = None
    for level in range(1, depth + 1):
        bases = next_candidates(bases)
        if every is not None:
            bases = bases.join(every.select("seed", "text"), ["seed", "text"], "left_anti")
        made = bases.withColumn("depth", F.lit(level))
        every = made if every is None else every.unionByName(made)
    n = F.row_number().over(Window.partitionBy("seed").orderBy("depth", "path"))
    return every.withColumn("n", n).where(F.col("n") <= most).select("seed", "depth", "n", "text", "edits")


def repair(names: DataFrame, known: DataFrame, ident: str, name: str, depth: int = DEPTH) -> DataFrame:
    """``ident``, repaired, note, value, depth of every name; nulls where nothing known was reached in the MOST first candidates.

    ``known``: name, value. A list of enantiomers stands for its first member. Only names that fewer edits don't settle
    get more; each number of edits is one join of the whole pool, and the first candidate in order wins. Null and
    repeated names are kept.
    """
    dictionary = known.where("name IS NOT NULL").groupBy(F.col("name").alias("text")).agg(F.min("value").alias("value"))
    pair = split_pair(F.coalesce(name, F.lit("")))
    asked = names.select(ident, F.coalesce(pair["first"], F.lit("")).alias("seed"), pair["n"].alias("_m"))
    seeds = asked.select("seed").distinct()
    settled = seeds.join(dictionary, F.col("seed") == F.col("text")).select("seed", F.col("seed").alias("repaired"), F.array().cast("array<string>").alias("edits"), "value", F.lit(0).alias("depth"))
    for level in range(1, depth + 1):
        open_ = seeds.join(settled, "seed", "left_anti")
        hit = candidates(open_, level).where(F.col("depth") == level).join(dictionary, "text")
        best = hit.groupBy("seed").agg(F.min_by(F.struct(F.col("text").alias("repaired"), "edits", "value"), "n").alias("b"))
        settled = settled.unionByName(best.select("seed", "b.*", F.lit(level).alias("depth")))
    first = F.when(F.col("depth").isNotNull() & (F.col("_m") > 1), F.array(F.concat(F.lit("first of "), "_m"))).otherwise(F.array().cast("array<string>"))
    note = F.nullif(F.array_join(F.concat(first, F.coalesce("edits", F.array().cast("array<string>"))), "; "), F.lit(""))
    return asked.join(settled, "seed", "left").select(ident, "repaired", note.alias("note"), "value", "depth")
