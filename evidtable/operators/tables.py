"""Sequence checks, page stitching, grids, dedupe, pivots: order is a column, every step is a window or a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import interval_text, rounded_interval


def accept_increasing(df: DataFrame, doc: str, seq: str, number: str) -> DataFrame:
    """``accepted``: the number is above all before it. Refused numbers never exceed the last accepted, so a running maximum is enough."""
    before = F.max(number).over(Window.partitionBy(doc).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("accepted", F.col(number).isNotNull() & (before.isNull() | (F.col(number) > before)))


def sequence_anomalies(df: DataFrame, doc: str, seq: str, number: str) -> DataFrame:
    """(doc, kind, number, until): unreadable, duplicate, order break; a gap from ``number`` to ``until``, both missing, between two neighbours."""
    known = df.where(F.col(number).isNotNull())
    unreadable = df.where(F.col(number).isNull()).select(doc, F.lit("unreadable").alias("kind"), F.lit(None).cast("long").alias("number"))
    duplicate = known.groupBy(doc, number).count().where("count > 1").select(doc, F.lit("duplicate").alias("kind"), F.col(number).cast("long").alias("number"))
    last = F.lag(number).over(Window.partitionBy(doc).orderBy(seq))
    breaks = known.withColumn("_p", last).where(F.col(number) < F.col("_p")).select(doc, F.lit("order").alias("kind"), F.col(number).cast("long").alias("number"))
    # gaps lie between neighbours of the sorted distinct numbers; a misread number makes one row, however far it lies
    nxt = F.lead("_n").over(Window.partitionBy(doc).orderBy("_n"))
    gaps = known.select(doc, F.col(number).cast("long").alias("_n")).distinct().withColumn("_x", nxt).where("_x > _n + 1")
    missing = gaps.select(doc, F.lit("gap").alias("kind"), (F.col("_n") + 1).alias("number"), (F.col("_x") - 1).alias("until"))
    return unreadable.unionByName(duplicate).unionByName(breaks).withColumn("until", F.lit(None).cast("long")).unionByName(missing)


def sessions(df: DataFrame, doc: str, order: Sequence[str], linked: Column, name: str = "table_id") -> DataFrame:
    """Rows numbered by session: a row that isn't ``linked`` to the one before begins a new one. ``linked`` may use lag over (doc, order)."""
    w = Window.partitionBy(doc).orderBy(*order)
    return df.withColumn("_new", F.when(F.coalesce(linked, F.lit(False)), 0).otherwise(1)).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def stitch_pages(pages: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Pages (doc, page_no, has_header, xs, width) with table_id, uncertain and deviation: a page goes on with the one before it if it is next, has no header and its columns match.

    Uncertain: it goes on by more than half the tolerance, or is a table of its own by less than twice the tolerance.
    """
    w = Window.partitionBy("doc").orderBy("page_no")
    dev = column_deviation(F.lag("xs").over(w), F.lag("width").over(w), F.col("xs"), F.col("width"))
    measured = pages.withColumns({"deviation": dev, "_next": (F.col("page_no") == F.lag("page_no").over(w) + 1) & ~F.col("has_header")})
    out = sessions(measured, "doc", ["page_no"], F.col("_next") & (F.col("deviation") <= tolerance))
    near = F.col("_next") & (F.col("deviation") > tolerance / 2) & (F.col("deviation") <= 2 * tolerance)
    return out.withColumn("uncertain", F.coalesce(near, F.lit(False))).drop("_next")


def stitched_rows(pages: DataFrame, tolerance: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, table_id, row_no, page_no, header, texts) of stitched tables, and anomalies (doc, table_id, page_no, kind, deviation).

    Pages as for ``stitch_pages`` with ``rows`` (array of arrays of text). A table's header is its first page's first
    row if that is one, else empty; a header row is no data row, and pages that go on give all their rows.
    """
    placed = stitch_pages(pages, tolerance)
    first = F.row_number().over(Window.partitionBy("doc", "table_id").orderBy("page_no")) == 1
    placed = placed.withColumn("_head", F.when(first & F.col("has_header"), F.try_element_at("rows", F.lit(1))))
    header = F.coalesce(F.max("_head").over(Window.partitionBy("doc", "table_id")), F.array().cast("array<string>"))
    placed = placed.withColumns({"header": header, "_data": F.when(F.col("_head").isNotNull(), F.slice("rows", 2, 1 << 30)).otherwise(F.col("rows"))})
    rows = placed.select("doc", "table_id", "page_no", "header", F.posexplode("_data").alias("_at", "texts"))
    place = F.row_number().over(Window.partitionBy("doc", "table_id").orderBy("page_no", "_at"))
    notes = placed.where("uncertain").select("doc", "table_id", "page_no", F.lit("table_stitch_uncertain").alias("kind"), "deviation")
    return rows.withColumn("row_no", place).drop("_at"), notes


def column_deviation(xs: Column, width: Column, other: Column, other_width: Column) -> Column:
    """Largest difference of relative column edges; infinite where counts differ or a side is empty."""
    ok = (F.size(xs) == F.size(other)) & (F.size(xs) > 0) & (width > 0) & (other_width > 0)
    return F.when(ok, F.array_max(F.zip_with(xs, other, lambda a, b: F.abs(a / width - b / other_width)))).otherwise(F.lit(float("inf")))


def group_positions(df: DataFrame, keys: Sequence[str], position: str, gap: int = 8) -> DataFrame:
    """Positions grouped where neighbours are at most ``gap`` apart; a group's coordinate is its truncated mean."""
    w = Window.partitionBy(*keys).orderBy(position)
    starts = F.when(F.col(position) - F.lag(position).over(w) <= gap, 0).otherwise(1)
    marked = df.withColumn("_s", starts).withColumn("_g", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_g").agg(F.floor(F.avg(position)).cast("long").alias("coordinate"), F.count("*").alias("n")).drop("_g")


def merge_edges(edges: Column, gap: int = 8, least_band: int = 0) -> Column:
    """Sorted edges folded: one at most ``gap`` from the last kept moves it to their midpoint; then only those at least ``least_band`` from the last kept stay."""
    none = F.array().cast("array<int>")
    last = lambda acc: F.try_element_at(acc, F.lit(-1))
    whole = lambda x: x.cast("int")
    near = lambda acc, x: F.coalesce(x - last(acc) <= gap, F.lit(False))
    moved = lambda acc, x: F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(whole(F.floor((last(acc) + x) / 2))))
    merged = F.aggregate(F.array_sort(edges), none, lambda acc, x: F.when(near(acc, x), moved(acc, x)).otherwise(F.concat(acc, F.array(whole(x)))))
    if not least_band:
        return merged
    return F.aggregate(merged, none, lambda acc, x: F.when(F.coalesce(x - last(acc) < least_band, F.lit(False)), acc).otherwise(F.concat(acc, F.array(x))))


def box_rulings(boxes: Column, low: str, high: str, limit: Column, gap: int = 8) -> Column:
    """Rulings along one axis of detected boxes: ends clamped to the page, rounded, empty bands left out, near ends merged."""
    end = lambda b, k: F.bround(F.least(F.greatest(b[k].cast("double"), F.lit(0.0)), limit.cast("double"))).cast("int")
    bands = F.filter(F.transform(boxes, lambda b: F.struct(end(b, low).alias("a"), end(b, high).alias("z"))), lambda s: s["z"] > s["a"])
    return merge_edges(F.flatten(F.transform(bands, lambda s: F.array(s["a"], s["z"]))), gap)


def grid_shape(xs: Column, ys: Column, n_cells: Column) -> Column:
    """struct(n_rows, n_cols, widths, heights, completeness): the share of the lattice that has a cell, 0 without a lattice."""
    count = lambda c: F.greatest(F.size(c) - 1, F.lit(0))
    steps = lambda c: F.zip_with(F.slice(c, 1, count(c)), F.slice(c, 2, count(c)), lambda a, b: b - a)
    lattice = count(xs) * count(ys)
    return F.struct(count(ys).alias("n_rows"), count(xs).alias("n_cols"), steps(xs).alias("widths"), steps(ys).alias("heights"), F.when(lattice > 0, n_cells / lattice).otherwise(F.lit(0.0)).alias("completeness"))


def grid_cells(grids: DataFrame, least: int = 2) -> DataFrame:
    """Cells (row, col, x0, y0, x1, y1) between the rulings xs and ys; bands under ``least`` pixels are none."""
    bands = lambda c: F.filter(F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("z"))), lambda s: s["z"] - s["a"] >= least)
    keep = [c for c in grids.columns if c not in ("xs", "ys")]
    rows = grids.select(*keep, "xs", F.posexplode(bands(F.col("ys"))).alias("row", "y"))
    return rows.select(*keep, "row", "y", F.posexplode(bands(F.col("xs"))).alias("col", "x")).select(*keep, "row", "col", F.col("x.a").alias("x0"), F.col("y.a").alias("y0"), F.col("x.z").alias("x1"), F.col("y.z").alias("y1"))


def iou(a: str, b: str) -> Column:
    """Intersection over union of the boxes ``a`` and ``b`` (structs x0, y0, x1, y1); 0 for a degenerate one."""
    side = lambda lo, hi: F.greatest(F.least(F.col(f"{a}.{hi}"), F.col(f"{b}.{hi}")) - F.greatest(F.col(f"{a}.{lo}"), F.col(f"{b}.{lo}")), F.lit(0))
    area = lambda x: F.greatest(F.col(f"{x}.x1") - F.col(f"{x}.x0"), F.lit(0)) * F.greatest(F.col(f"{x}.y1") - F.col(f"{x}.y0"), F.lit(0))
    inter = side("x0", "x1") * side("y0", "y1")
    return F.when((area(a) > 0) & (area(b) > 0), inter / (area(a) + area(b) - inter)).otherwise(F.lit(0.0))


def agreeing(left: DataFrame, right: DataFrame, keys: Sequence[str], a: str, b: str, least: float) -> DataFrame:
    """Pairs of rows of one key whose boxes ``a`` and ``b`` (structs x0, y0, x1, y1) have an IoU of ``least`` (above 0) or more.

    In either direction the sides p and q of such a pair share at least ``least / (1 + least)`` of p + q: neither is shorter
    than ``least`` times the other, and their middles are at most ``(p + q) * (1 - least) / (1 + least) / 2`` apart. So a
    left box lies in one cell, by the octaves of its sides and by its middle in tiles of a quarter octave, and a right box
    meets the cells within these bounds only.
    """
    t = least * (1 - 1e-9)  # wider than rounding

    def solid(df: DataFrame, box: str) -> DataFrame:
        return df.where((F.col(f"{box}.x1") > F.col(f"{box}.x0")) & (F.col(f"{box}.y1") > F.col(f"{box}.y0")))

    side = lambda box, c: (F.col(f"{box}.{c}1") - F.col(f"{box}.{c}0")).cast("double")
    middle = lambda box, c: (F.col(f"{box}.{c}1") + F.col(f"{box}.{c}0")).cast("double") / 2
    octave = lambda p: F.floor(F.log2(p)).cast("int")
    tile = lambda at, level: F.floor(at / F.pow(F.lit(2.0), level - 2))
    one, many = solid(left, a), solid(right, b)
    for c in "xy":
        one = one.withColumn(f"_l{c}", octave(side(a, c))).withColumn(f"_t{c}", tile(middle(a, c), F.col(f"_l{c}")))
        p, at, level = side(b, c), middle(b, c), F.col(f"_l{c}")
        far = (F.least(F.pow(F.lit(2.0), level + 1), p / t) + p) * ((1 - t) / (1 + t) / 2)
        many = many.withColumn(f"_l{c}", F.explode(F.sequence(octave(p * t), octave(p / t)))).withColumn(f"_t{c}", F.explode(F.sequence(tile(at - far, level), tile(at + far, level))))
    met = one.join(many.hint("merge"), [*keys, "_lx", "_ly", "_tx", "_ty"])
    return met.where(iou(a, b) >= least).drop("_lx", "_ly", "_tx", "_ty")


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], a: str, b: str, tile: int = 64) -> DataFrame:
    """Pairs of rows of one key whose boxes ``a`` and ``b`` (structs x0, y0, x1, y1) share area.

    Boxes meet in the tiles they lie on, not page by page, and a pair counts in the first tile that both have.
    """

    def tiled(df: DataFrame, box: str) -> DataFrame:
        span = lambda lo, hi: F.sequence(F.floor(F.col(f"{box}.{lo}") / tile), F.floor((F.col(f"{box}.{hi}") - 1) / tile))
        solid = df.where((F.col(f"{box}.x1") > F.col(f"{box}.x0")) & (F.col(f"{box}.y1") > F.col(f"{box}.y0")))
        return solid.withColumn("_tx", F.explode(span("x0", "x1"))).withColumn("_ty", F.explode(span("y0", "y1")))

    first = lambda c, t: F.col(t) == F.floor(F.greatest(F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) / tile)
    met = tiled(left, a).join(tiled(right, b), [*keys, "_tx", "_ty"])
    return met.where(first("x0", "_tx") & first("y0", "_ty") & (iou(a, b) > 0)).drop("_tx", "_ty")


def dedupe_numbered(rows: DataFrame, keys: Sequence[str], text: str, seq: str) -> DataFrame:
    """One row per key: the longest text (ties: the earliest), first sequence number, how many there were."""
    best = F.max_by(F.col(text), F.struct(F.length(text), -F.col(seq)))
    return rows.groupBy(*keys).agg(best.alias(text), F.min(seq).alias(seq), F.count("*").alias("n_merged"))


def merged_rows(rows: DataFrame, keys: Sequence[str], name: str, crop: str, provenance: str, seq: str) -> DataFrame:
    """One row per key, rows of a key merged in order: the longer name stays (ties: the earlier), its crop or else the other's, its provenance (an array) before the other's."""
    ordered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.coalesce(name, F.lit("")).alias("n"), F.col(crop).alias("c"), F.col(provenance).alias("p")))).alias("_r"))

    def merge(acc: Column, r: Column) -> Column:
        keep = F.length(acc["n"]) >= F.length(r["n"])
        pick = lambda a, b: F.struct(acc["s"].alias("s"), a["n"].alias("n"), F.coalesce(a["c"], b["c"]).alias("c"), F.concat(a["p"], b["p"]).alias("p"))
        return F.when(keep, pick(acc, r)).otherwise(pick(r, acc))

    one = ordered.select(*keys, F.aggregate(F.slice("_r", 2, 1 << 30), F.element_at("_r", 1), merge).alias("m"), F.size("_r").alias("n_merged"))
    return one.select(*keys, F.col("m.s").alias(seq), F.col("m.n").alias(name), F.col("m.c").alias(crop), F.col("m.p").alias(provenance), "n_merged")


def duplicate_groups(rows: DataFrame, key: str, ident: str) -> DataFrame:
    """Ids that share a key with another: (key, ident, n); none is dropped."""
    n = F.count("*").over(Window.partitionBy(key))
    return rows.where(F.col(key).isNotNull()).select(key, ident, n.alias("n")).where("n > 1")


def wide(rows: DataFrame, entity: str, column: str, value: str, seq: str, columns: Sequence[str], interval: str | None = None) -> DataFrame:
    """One row per entity, a column for each of the listed headers, the last value of each, blank where there is none; beside each, if asked, a column (nM) with its interval."""
    said = [F.max_by(F.coalesce(value, F.lit("")), seq).alias("v")] + ([F.max_by(F.coalesce(interval, F.lit("")), seq).alias("i")] if interval else [])
    out = rows.groupBy(entity).pivot(column, list(columns)).agg(*said)
    if interval:
        names = {f"{c}_{k}": c if k == "v" else f"{c} (nM)" for c in columns for k in "vi"}
        out = out.withColumnsRenamed(names)
    return out.na.fill("", subset=[c for c in out.columns if c != entity])


def first_seen(rows: DataFrame, column: str, seq: str) -> list[str]:
    """The different headers of a table in the order of their first row: as many as it has columns."""
    return [r[column] for r in rows.groupBy(column).agg(F.min(seq).alias("_s")).orderBy("_s", column).collect()]


def wide_table(entities: DataFrame, measurements: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """Every entity with its columns, then two for each of ``columns``: what was published (a bin's letter first) and the interval or standardized value. Unmeasured entities have blanks.

    Measurements: entity, seq, name, bin_label, published_value, lower, upper, relation, value, units.
    """
    text = interval_text(F.col("lower"), F.col("upper"), F.col("relation"), F.col("value"), F.col("units"))
    cells = measurements.select(entity, "seq", "name", F.coalesce("bin_label", "published_value").alias("said"), text.alias("interval"))
    made = wide(cells, entity, "name", "said", "seq", columns, "interval")
    return entities.join(made, entity, "left").na.fill("", subset=[c for c in made.columns if c != entity])


def screen_table(entities: DataFrame, measurements: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """The table for the eye: entities by rank (unranked last), a column for each assay with the published text and its interval in brackets."""
    span = rounded_interval(F.col("lower"), F.col("upper"), F.col("units"))
    cells = measurements.select(entity, "seq", "name", F.concat(F.coalesce("published_value", F.lit("")), F.coalesce(F.concat(F.lit(" ("), span, F.lit(")")), F.lit(""))).alias("said"))
    made = wide(cells, entity, "name", "said", "seq", columns)
    return entities.join(made, entity, "left").na.fill("", subset=list(columns)).orderBy(F.asc_nulls_last("rank"), entity)


def long_table(measurements: DataFrame, provenance: str = "provenance") -> DataFrame:
    """Measurements with the fields of their origin as columns; the box as one text."""
    kept = [c for c in measurements.columns if c != provenance]
    p = F.col(provenance)
    return measurements.select(*kept, p["page_no"].alias("page_no"), F.concat(F.lit("("), F.array_join(p["bbox"], ", "), F.lit(")")).alias("bbox"), p["crop_path"].alias("crop_path"), p["extractor"].alias("extractor"))


def adjacent_anomalies(df: DataFrame, doc: str, position: str, number: str) -> DataFrame:
    """(doc, position, kind, previous, number): unreadable; and of readable neighbours duplicate, order, or a gap wider than the unreadable cells between explain."""
    w = Window.partitionBy(doc).orderBy(position)
    unreadable = df.where(F.col(number).isNull()).select(doc, position, F.lit("unreadable").alias("kind"), F.lit(None).cast("long").alias("previous"), F.lit(None).cast("long").alias("number"))
    near = df.where(F.col(number).isNotNull()).select(doc, F.col(position), F.col(number).cast("long").alias("number"), F.lag(number).over(w).cast("long").alias("previous"), F.lag(position).over(w).alias("_at"))
    step = F.col("number") - F.col("previous")
    kind = F.when(step == 0, "duplicate").when(step < 0, "order").when(step - 1 > F.col(position) - F.col("_at") - 1, "gap")
    return unreadable.unionByName(near.withColumn("kind", kind).where("kind IS NOT NULL").select(doc, position, "kind", "previous", "number"))


def duplicate_links(rows: DataFrame, key: str, ident: str, seq: str) -> DataFrame:
    """(key, first, other): every other id of a shared key against the earliest; the pairs of a group follow from them, and their count is linear."""
    ids = rows.where(F.col(key).isNotNull()).groupBy(key, ident).agg(F.min(seq).alias("_s"))
    first = F.first(ident).over(Window.partitionBy(key).orderBy("_s", ident))
    return ids.withColumn("first", first).where(~F.col("first").eqNullSafe(F.col(ident))).select(key, "first", F.col(ident).alias("other"))


def dedupe_numberless(rows: DataFrame, doc: str, seq: str, number: str, name: str) -> DataFrame:
    """``doc, seq`` of rows that stay: all numbered ones; of the others, in order, those whose name (letters and digits) neither holds nor is held by one that already stays; a row without a name stays. A fold over one document's rows."""
    key = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")
    docs = rows.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(number).isNotNull().alias("n"), key.alias("k")))).alias("_rows"))
    numbered, others = F.filter("_rows", lambda r: r["n"]), F.filter("_rows", lambda r: ~r["n"])
    start = F.struct(F.transform(F.filter(numbered, lambda r: r["k"] != ""), lambda r: r["k"]).alias("names"), F.transform(numbered, lambda r: r["s"]).alias("stay"))

    def step(acc: Column, r: Column) -> Column:
        held = (r["k"] != "") & F.exists(acc["names"], lambda o: F.contains(o, r["k"]) | F.contains(r["k"], o))
        own = F.filter(F.array(r["k"]), lambda k: k != "")
        return F.when(held, acc).otherwise(F.struct(F.concat(acc["names"], own).alias("names"), F.concat(acc["stay"], F.array(r["s"])).alias("stay")))

    return docs.select(doc, F.explode(F.aggregate(others, start, step)["stay"]).alias(seq))
