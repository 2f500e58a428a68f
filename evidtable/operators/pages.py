"""Pages with a grid: what a column is, what a page is, which pages go on, which of two grids to take.

A page's cells are bounded by its rulings, so grids are compared inside one row and no cell is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import let
from .lexicon import NUMBER_HEADER, match_headers
from .tables import merge_edges

NAME_LETTERS = 3
NARROW = 0.25
AGREEMENT = 0.9
IOU = 0.5
#: Words of a column header.
HEADER_WORDS = (
    "compound", "cmpd", "cpd", "example", "structure", "name", "number", "no", "id", "entry", "assay", "activity", "target", "induction", "inhibition", "level", "bin", "result", "data", "ec50", "ic50", "dc50", "ki", "kd",
    "dmax", "potency", "conc", "concentration", "units", "nm", "um", "µm", "hbf", "wiz", "zbtb7a", "hibit", "procedure", "synthesis", "coupling",
)


def reads_chemical(text: Column) -> Column:
    """A run of eight letters and a locant: a systematic name, not prose."""
    return text.isNotNull() & F.lower(text).rlike("[a-z]{8,}") & text.rlike(r"[0-9]\s*[-,(]|[-(]\s*[0-9]")


def is_header(cells: Column) -> Column:
    """A row of cells that names columns: less than half bare numbers or letters, at least half with words, one of them a header's."""
    full = F.filter(F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit("")))), lambda c: c != "")
    bare = F.size(F.filter(full, lambda c: c.rlike("^[^0-9A-Za-z]*(?:[0-9]{1,4}|[A-Za-z])[^0-9A-Za-z]*$")))
    wordy = F.size(F.filter(full, lambda c: c.rlike("[A-Za-z]{3,}|[A-Za-z]{2,}[0-9]")))
    words = F.flatten(F.transform(full, lambda c: F.regexp_extract_all(F.lower(c), F.lit("([a-zµ0-9]+)"), 1)))
    return (F.size(full) > 0) & (bare * 2 < F.size(full)) & (wordy * 2 >= F.size(full)) & F.arrays_overlap(words, F.array(*map(F.lit, HEADER_WORDS)))


def first_line(text: Column) -> Column:
    return F.coalesce(F.trim(F.try_element_at(F.filter(F.split(text, "\r?\n"), lambda x: F.trim(x) != ""), F.lit(1))), F.lit(""))


def column_roles(texts: Column, widths: Column) -> Column:
    """name, structure, number or unknown of each column: the name by long lower-case words, the widest of the others if there are three, the narrowest of the rest."""
    likeness = lambda t: F.aggregate(F.filter(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit("([A-Za-z]{4,})"), 1), lambda w: w.rlike("^[a-z]+$")), F.lit(0), lambda n, w: n + F.length(w))
    cols = F.transform(F.arrays_zip(texts.alias("t"), widths.alias("w")), lambda x, i: F.struct(i.alias("i"), x["w"].cast("double").alias("w"), F.coalesce(x["t"], F.lit("")).alias("t"), likeness(x["t"]).alias("n")))

    def named(cs: Column) -> Column:
        best = F.array_max(F.transform(cs, lambda c: F.struct(c["n"], (-c["i"]).alias("i"))))
        at = F.when(best["n"] >= NAME_LETTERS, -best["i"])
        return let(F.struct(cs.alias("cs"), at.alias("name")), drawn)

    def without(cs: Column, at: Column) -> Column:
        return F.filter(cs, lambda c: ~c["i"].eqNullSafe(at))

    def drawn(s: Column) -> Column:
        widest = F.array_max(F.transform(without(s["cs"], s["name"]), lambda c: F.struct(c["w"], (-c["i"]).alias("i"))))
        return let(F.struct(s["cs"].alias("cs"), s["name"].alias("name"), F.when(F.size(s["cs"]) >= 3, -widest["i"]).alias("drawing")), told)

    def told(s: Column) -> Column:
        left = without(without(s["cs"], s["name"]), s["drawing"])
        narrowest = F.array_min(F.transform(left, lambda c: F.struct(c["w"], c["i"])))["i"]
        total = F.aggregate(s["cs"], F.lit(0.0), lambda a, c: a + c["w"])
        digits = lambda c: F.regexp_count(c["t"], F.lit(r"\p{Nd}"))
        numeric = lambda c: (digits(c) > 0) & (digits(c) >= F.regexp_count(c["t"], F.lit(r"\p{L}")))
        sole = (F.size(s["cs"]) < 3) & (F.size(left) == 1)
        return F.transform(
            s["cs"],
            lambda c: F.when(c["i"] == s["name"], "name").when(c["i"] == s["drawing"], "structure").when(sole & ~((c["w"] < NARROW * total) | numeric(c)), "structure").when(c["i"] == narrowest, "number").otherwise("unknown"),
        )

    return F.when(F.size(cols) > 0, let(cols, named))


def classify(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``pages`` (keys, n_rows, texts, widths) with kind: activity_table before compound_table, else null. Each different header line is matched once."""
    lines = pages.select(*keys, F.explode("texts").alias("_t")).select(*keys, first_line(F.col("_t")).alias("_line")).where("_line <> ''")
    # a flag and no filter: the optimizer would carry a filter's expression, all aliases long, through every step as a constraint
    known = match_headers(lines.select("_line").distinct(), "_line").select("_line", F.col("match").isNotNull().alias("_known"))
    assay = lines.join(known, "_line").groupBy(*keys).agg(F.bool_or("_known").alias("_assay"))
    number = F.exists("texts", lambda t: F.coalesce(t.rlike(NUMBER_HEADER), F.lit(False)))
    roles = column_roles(F.col("texts"), F.col("widths"))
    out = pages.join(assay, keys, "left").withColumn("_roles", roles)
    name = F.try_element_at("texts", F.array_position("_roles", "name").cast("int"))
    has_name = F.array_contains("_roles", "name")
    kind = F.when((F.col("n_rows") < 1) | (F.size("widths") < 2), F.lit(None)).when(number & F.coalesce("_assay", F.lit(False)), "activity_table").when(F.array_contains("_roles", "structure") & F.when(has_name, reads_chemical(name)), "compound_table")
    return out.withColumn("kind", kind).drop("_assay", "_roles")


def inherit_kind(pages: DataFrame, doc: str, page: str, kind: str, goes_on: Column) -> DataFrame:
    """A page without a kind takes that of the page before it where ``goes_on`` holds, and hands it on; ``inherited`` tells which did."""
    w = Window.partitionBy(doc).orderBy(page)
    linked = F.col(kind).isNull() & F.coalesce(goes_on & (F.col(page) == F.lag(page).over(w) + 1), F.lit(False))
    runs = pages.withColumn("_run", F.sum(F.when(linked, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    head = F.first(kind).over(Window.partitionBy(doc, "_run").orderBy(page))
    return runs.withColumn("_head", head).withColumns({"inherited": F.col(kind).isNull() & F.col("_head").isNotNull(), kind: F.coalesce(kind, "_head")}).drop("_run", "_head")


def cells(xs: Column, ys: Column, least: int = 2) -> Column:
    """array of struct(x0, y0, x1, y1) between rulings; bands under ``least`` pixels are none."""
    bands = lambda c: F.filter(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.struct(F.element_at(c, i).alias("a"), F.element_at(c, i + 1).alias("z"))), lambda b: b["z"] - b["a"] >= least)
    grid = F.flatten(F.transform(bands(ys), lambda y: F.transform(bands(xs), lambda x: F.struct(x["a"].alias("x0"), y["a"].alias("y0"), x["z"].alias("x1"), y["z"].alias("y1")))))
    return F.when((F.size(xs) > 1) & (F.size(ys) > 1), grid).otherwise(F.array().cast("array<struct<x0:int,y0:int,x1:int,y1:int>>"))


def overlap(a: Column, b: Column) -> Column:
    side = lambda lo, hi: F.greatest(F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]), F.lit(0))
    area = lambda c: (c["x1"] - c["x0"]) * (c["y1"] - c["y0"])
    both = side("x0", "x1") * side("y0", "y1")
    return both / (area(a) + area(b) - both)


def reconcile(pages: DataFrame, merge_rows: bool = True) -> DataFrame:
    """``pages`` (a_xs, a_ys, b_xs, b_ys: arrays of int, null where a detector has no grid; expected_rows) with chosen, xs, ys, agreement, disagreement, n_a, n_b.

    One grid alone is taken and is no disagreement; none gives nulls. Where a has fewer columns, but two at least, its
    columns are taken with the rows of both; else the grid nearer to the expected rows, then the one with more cells, then a.
    """
    out = pages.withColumns({"_a": cells(F.col("a_xs"), F.col("a_ys")), "_b": cells(F.col("b_xs"), F.col("b_ys"))})
    n = lambda c: F.greatest(F.size(c) - 1, F.lit(0))
    out = out.withColumns({"n_a": F.size("_a"), "n_b": F.size("_b"), "_ra": n("a_ys"), "_ca": n("a_xs"), "_rb": n("b_ys"), "_cb": n("b_xs")})
    met = F.size(F.filter("_a", lambda p: F.exists("_b", lambda q: overlap(p, q) >= IOU)))
    share = F.coalesce(F.try_divide(met, F.greatest("n_a", "n_b")), F.lit(0.0))
    has_a, has_b = F.col("a_xs").isNotNull() & F.col("a_ys").isNotNull(), F.col("b_xs").isNotNull() & F.col("b_ys").isNotNull()
    out = out.withColumn("agreement", F.when(has_a & has_b, share))
    off = lambda r: F.abs(F.col(r) - F.col("expected_rows"))
    chosen = F.when(~has_a & ~has_b, F.lit(None)).when(~has_b, "a").when(~has_a, "b")
    if merge_rows:
        chosen = chosen.when((F.col("_ca") >= 2) & (F.col("_ca") < F.col("_cb")), "merged")
    chosen = chosen.when(off("_ra") < off("_rb"), "a").when(off("_ra") > off("_rb"), "b").when(F.col("n_b") > F.col("n_a"), "b").otherwise("a")
    out = out.withColumn("chosen", chosen)
    differs = (F.col("_ra") != F.col("_rb")) | (F.col("_ca") != F.col("_cb")) | (F.col("agreement") < AGREEMENT)
    return out.withColumns({
        "xs": F.when(F.col("chosen") == "b", F.col("b_xs")).otherwise(F.col("a_xs")), "disagreement": has_a & has_b & F.coalesce(differs, F.lit(False)),
        "ys": F.when(F.col("chosen") == "b", F.col("b_ys")).when(F.col("chosen") == "merged", merge_edges(F.concat("a_ys", "b_ys"))).otherwise(F.col("a_ys")),
    }).drop("_a", "_b", "_ra", "_rb", "_ca", "_cb")
