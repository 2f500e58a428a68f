"""What text recognition tells of a page or cell, as expressions; and what pixels tell, behind Arrow.

Pixels come as rows of bytes (0 black) with their width and height, whatever decoded them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import let
from ..operators.pages import classify, inherit_kind, reconcile

#: Insets and thresholds in pixels and shares.
CELL_INSET, DARK, BLANK_DARK, KERNEL_SHARE, KERNEL_LEAST, PEAK, GAP = 8, 128, 20, 12, 30, 0.4, 8


def words(tsv: Column, dx: Column, dy: Column, least_conf: float = 0.0) -> Column:
    """array of struct(text, conf, x0, y0, x1, y1, line_num) of a word table as tab-separated text with a header row.

    Boxes are moved by (dx, dy) back to the page; rows that are short, blank, unsure or not numbers where they should be
    are left out; lines are numbered through, in the order in which their (block, paragraph, line) first comes.
    """
    rows = F.split(tsv, r"\r?\n")
    head = F.split(F.element_at(rows, 1), "\t")

    def read(p: Column) -> Column:
        said = F.filter(F.transform(F.slice(p["rows"], 2, 1 << 30), lambda r: F.split(r, "\t")), lambda c: F.size(c) >= F.size(p["head"]))
        named = F.transform(said, lambda c: F.map_from_arrays(p["head"], F.slice(c, 1, F.size(p["head"]))))
        number = lambda m, k: F.try_element_at(m, F.lit(k)).try_cast("int")
        made = F.transform(
            named,
            lambda m: F.struct(
                F.trim(F.try_element_at(m, F.lit("text"))).alias("text"), F.try_element_at(m, F.lit("conf")).try_cast("double").alias("conf"), (dx + number(m, "left")).alias("x0"), (dy + number(m, "top")).alias("y0"),
                (dx + number(m, "left") + number(m, "width")).alias("x1"), (dy + number(m, "top") + number(m, "height")).alias("y1"),
                F.struct(number(m, "block_num").alias("b"), number(m, "par_num").alias("p"), number(m, "line_num").alias("l")).alias("key"),
            ),
        )
        whole = lambda w: (w["text"] != "") & (w["conf"] >= least_conf) & w["x1"].isNotNull() & w["y1"].isNotNull() & w["key"]["b"].isNotNull() & w["key"]["p"].isNotNull() & w["key"]["l"].isNotNull()
        return let(F.filter(made, whole), placed)

    def placed(kept: Column) -> Column:
        order = F.array_distinct(F.transform(kept, lambda w: w["key"]))
        return F.transform(kept, lambda w: F.struct(w["text"].alias("text"), w["conf"].alias("conf"), *[w[c].alias(c) for c in ("x0", "y0", "x1", "y1")], F.array_position(order, w["key"]).cast("int").alias("line_num")))

    return let(F.struct(rows.alias("rows"), head.alias("head")), read)


def number(isolated: Column, inset: Column) -> Column:
    """The number of a cell out of several readings (arrays of text): the longest run of digits, of such one of the isolated glyphs, of such the most frequent, of such the first; null without digits."""
    digits = lambda c: F.flatten(F.transform(c, lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit("([0-9]+)"), 1)))

    def best(p: Column) -> Column:
        ranked = F.transform(p["every"], lambda v, i: F.struct(F.length(v).alias("n"), F.array_contains(p["own"], v).alias("own"), F.size(F.filter(p["every"], lambda x: x == v)).alias("k"), (-i).alias("i"), v.alias("v")))
        return F.array_max(ranked)["v"].try_cast("int")

    return let(F.struct(digits(isolated).alias("own"), F.concat(digits(isolated), digits(inset)).alias("every")), best)


def _image(raw: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(int(height), int(width))


def otsu(gray: np.ndarray) -> int:
    """The threshold that separates dark from light best."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    below, mass = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = below * above * (mass / below - (mass[-1] - mass) / above) ** 2
    return int(np.nanargmax(np.where(np.isfinite(spread), spread, -1)))


def long_runs(ink: np.ndarray, least: int) -> np.ndarray:
    """The ink of each row that lies in a run of at least ``least`` pixels."""
    edge = np.zeros((ink.shape[0], ink.shape[1] + 2), np.int8)
    edge[:, 1:-1] = ink
    step = np.diff(edge, axis=1)
    y, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    keep = end - begin >= least
    out = np.zeros((ink.shape[0], ink.shape[1] + 1), np.int32)
    np.add.at(out, (y[keep], begin[keep]), 1)
    np.add.at(out, (y[keep], end[keep]), -1)
    return np.cumsum(out, axis=1)[:, :-1] > 0


def rulings_of(gray: np.ndarray) -> tuple[list[int], list[int]]:
    """(horizontal, vertical) ruling positions: long runs of ink, projected; rows above a share of the highest, near ones as one at their truncated mean."""
    if not gray.size:
        return [], []
    ink = gray <= otsu(gray) if gray.min() < gray.max() else np.zeros(gray.shape, bool)

    def lines(dark: np.ndarray) -> list[int]:
        sums = long_runs(dark, max(KERNEL_LEAST, dark.shape[1] // KERNEL_SHARE)).sum(axis=1)
        hits = np.flatnonzero(sums > PEAK * sums.max()) if sums.max() > 0 else np.zeros(0, int)
        groups = np.split(hits, np.flatnonzero(np.diff(hits) > GAP) + 1) if hits.size else []
        return [int(g.mean()) for g in groups]

    return lines(ink), lines(np.ascontiguousarray(ink.T))


@F.pandas_udf(T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("ys", "xs")]))
def rulings(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([rulings_of(_image(*x)) if x[0] is not None else ([], []) for x in zip(pixels, width, height, strict=True)], columns=["ys", "xs"])


def inset(box: Column, margin: int = CELL_INSET) -> Column:
    """A box drawn in by ``margin``, unless nothing would be left."""
    small = (box["x1"] - box["x0"] <= 2 * margin) | (box["y1"] - box["y0"] <= 2 * margin)
    shift = lambda c, by: F.when(small, box[c]).otherwise(box[c] + by).alias(c)
    return F.struct(shift("x0", margin), shift("y0", margin), shift("x1", -margin), shift("y1", -margin))


@F.pandas_udf(T.LongType())
def _dark(pixels: pd.Series, width: pd.Series, height: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    return pd.Series([int((_image(p, w, h)[max(0, b) : max(0, d), max(0, a) : max(0, c)] < DARK).sum()) for p, w, h, a, b, c, d in zip(pixels, width, height, x0, y0, x1, y1, strict=True)])


def dark_pixels(pixels: Column, width: Column, height: Column, box: Column) -> Column:
    return _dark(pixels, width, height, *[box[c].cast("int") for c in ("x0", "y0", "x1", "y1")])


def is_blank(pixels: Column, width: Column, height: Column, box: Column) -> Column:
    """Whether a cell, drawn in from its rulings, has hardly any ink; a cell without area is blank."""
    inner = inset(box)
    return (inner["x1"] <= inner["x0"]) | (inner["y1"] <= inner["y0"]) | (dark_pixels(pixels, width, height, inner) < BLANK_DARK)


def ink_share(pixels: Column, width: Column, height: Column, box: Column) -> Column:
    area = (box["x1"] - box["x0"]) * (box["y1"] - box["y0"])
    return F.when(area > 0, dark_pixels(pixels, width, height, box) / area).otherwise(F.lit(0.0))


def column_text(readings: Column, rows: int = 3) -> Column:
    """The first cells of a column, a line each, to tell what it holds; missing cells are left out."""
    return F.array_join(F.array_compact(F.slice(readings, 1, rows)), "\n")


def looks_ruled(n_rows: Column, n_cols: Column) -> Column:
    """Whether a grid is worth a closer look, whichever way the page is turned."""
    return (F.greatest(n_rows, n_cols) >= 2) & (n_rows + n_cols >= 3)


def wants_second_opinion(completeness: Column, n_rows: Column) -> Column:
    return (completeness < 1.0) | (n_rows < 2)


def table_pages(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """Pages with a table, with chosen rulings, kind and whether the kind is inherited.

    Pages: doc, page, a_xs, a_ys, b_xs, b_ys, expected_rows, texts, widths. Pages whose grid isn't worth a look are left
    out before anything is compared; a page without a kind of its own takes that of the page before it.
    """
    count = lambda c: F.greatest(F.size(F.coalesce(c, F.array().cast("array<int>"))) - 1, F.lit(0))
    probed = pages.where(looks_ruled(count("a_ys"), count("a_xs")) | looks_ruled(count("b_ys"), count("b_xs")))
    told = classify(reconcile(probed).withColumn("n_rows", count("ys")), [doc, page])
    return inherit_kind(told, doc, page, "kind", F.lit(True)).where("kind IS NOT NULL")
