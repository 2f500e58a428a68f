"""Measurements out of table cells: one measurement or one refusal for each cell that says something.

Rows, entities and legends meet within their document; a header is matched once, however many rows stand under it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import plain_integer
from ..functions.values import bin_key, normalize_bin_cell, normalize_units, parse_cell, pchembl, pdc50, standardize
from .legends import gather, labels_of
from .lexicon import NUMBER_HEADER, match_headers, step
from .pages import reads_chemical

#: Which side of a censored value is known.
DIRECTIONS = {">": "lower_bound", ">=": "lower_bound", "<": "upper_bound", "<=": "upper_bound"}
FIGURES = ("value", "units", "relation", "lower", "upper", "direction", "bin_label", "bin_score")
#: So many different headers are sent to the executors at once; more are merged.
HEADERS_AT_ONCE = 10_000
MARK = "\x00"


def build(cells: DataFrame) -> DataFrame:
    """``cells`` with ``status`` (measured, blank, refused) and the figures of a measured cell, null for others.

    Columns: raw; standard_type, unit (canonical), is_log_form of the header; bin: struct(label, score, fields: its ``bin_fields``), null
    where the cell's text is no label of the header's legend. A blank cell is a gap. A number without usable units, and
    a text that is no label, are refused. No midpoint is made of an interval. A degradation constant has no pchembl.
    """
    cell = parse_cell(F.col("raw"))
    made = cells.withColumns({"_value": cell["value"], "_relation": cell["relation"], "_blank": cell["is_blank"]})
    std = standardize(F.col("_value"), F.col("_relation"), F.col("unit"), F.coalesce("is_log_form", F.lit(False)), canonical=True)
    made = made.withColumn("_std", std)
    number, label = F.col("_std").isNotNull(), ~F.col("_blank") & F.col("_value").isNull() & F.col("bin").isNotNull()
    either = lambda name: F.when(number, F.col("_std")[name]).when(label, F.col("bin.fields")[name])
    direction = F.coalesce(*[F.when(F.col("_std.relation") == r, F.lit(d)) for r, d in DIRECTIONS.items()])
    made = step(
        made, status=F.when(F.col("_blank"), "blank").when(number | label, "measured").otherwise("refused"), value=F.when(number, F.col("_std.value")), units=either("units"), relation=either("relation"),
        lower=F.when(label, F.col("bin.fields.lower")), upper=F.when(label, F.col("bin.fields.upper")), direction=F.when(number, direction).when(label, F.col("bin.fields.direction")),
        bin_label=F.when(label, F.col("bin.label")), bin_score=F.when(label, F.col("bin.score")),
    )
    degraded = (F.col("standard_type") == "DC50") & (F.col("units") == "nM") & F.col("value").isNotNull()
    return made.withColumns({
        "pdc50": F.when(degraded, pdc50(F.col("value"), F.col("relation"))),
        "pchembl": F.when(~F.coalesce(degraded, F.lit(False)), pchembl(F.col("standard_type"), F.col("relation"), F.col("value"), F.col("units"))),
    }).drop("_value", "_relation", "_blank", "_std")


def activity_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, table_id, row_no, header, texts: arrays) with number_col, number and accepted: a number that repeats or precedes an earlier one of its table is not."""
    # the first one that matches, by a search in all of them at once; one by one where a header holds the mark between them itself
    flags, pattern = NUMBER_HEADER[:4], NUMBER_HEADER[4:]
    together = F.array_join("header", MARK, "")
    marks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(MARK), F.lit("")))
    ahead = F.when(together.rlike(NUMBER_HEADER), marks(F.regexp_extract(together, f"{flags}(?s)^(.*?)(?:{pattern})", 1))).otherwise(F.lit(0))
    singly = F.array_position(F.transform("header", lambda h: F.coalesce(h.rlike(NUMBER_HEADER), F.lit(False))), True).cast("int")
    at = F.when(marks(together) < F.size("header"), ahead).otherwise(F.greatest(singly - 1, F.lit(0)))
    read = rows.withColumn("number_col", F.coalesce(at, F.lit(0)))
    read = read.withColumn("number", plain_integer(F.try_element_at("texts", F.col("number_col") + 1)))
    before = F.max("number").over(Window.partitionBy("doc", "table_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, -1))
    return read.withColumn("_before", before).withColumn("accepted", F.col("number").isNotNull() & (F.col("_before").isNull() | (F.col("number") > F.col("_before")))).drop("_before")


def owned(told: DataFrame, entities: DataFrame) -> DataFrame:
    """``told`` (doc, number) with entity_seq of the last entity of its document and number; rows without one are left out.

    Both go through one sort, entities first: tables that are dealt by document stay where they are, which a join on two keys doesn't allow.
    """
    kind = told.schema["number"].dataType
    owner = entities.where("doc IS NOT NULL AND number IS NOT NULL").groupBy("doc", "number").agg(F.max("entity_seq").alias("entity_seq"))
    both = told.where("doc IS NOT NULL").withColumn("_row", F.lit(1)).unionByName(owner.withColumn("_row", F.lit(0)), allowMissingColumns=True)
    here = Window.partitionBy("doc").orderBy("number", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("_row") == 0, F.struct("number", "entity_seq")), ignorenulls=True).over(here)
    met = both.withColumn("_last", last).where("_row = 1 AND _last.number = number")
    return met.withColumns({"number": F.col("number").cast(kind), "entity_seq": F.col("_last.entity_seq")}).drop("_row", "_last")


def known_headers(rows: DataFrame) -> DataFrame:
    """published_type, and what ``match_headers`` finds for it, of every header of ``rows`` that is known; they are matched here, to be sent or merged by their number."""
    headers = rows.select("header").distinct().select(F.explode("header").alias("published_type")).where("published_type IS NOT NULL").distinct()
    # a generator and no filter: a filter's condition would carry the whole lexicon through every step above as a constraint
    found = F.explode(F.filter(F.array("match"), lambda m: m.isNotNull()))
    known = match_headers(headers, "published_type").select("published_type", found.alias("match")).select("published_type", "match.*")
    known = known.select("published_type", "standard_type", "target", normalize_units(F.col("units")).alias("unit"), "is_log_form", F.upper("published_type").alias("_printed"), F.upper(F.coalesce("target", F.lit(""))).alias("_wanted"))
    few = known.limit(HEADERS_AT_ONCE + 1).collect()
    return known.hint("merge") if len(few) > HEADERS_AT_ONCE else rows.sparkSession.createDataFrame(few, known.schema).hint("broadcast")


def build_measurements(rows: DataFrame, entities: DataFrame, legends: DataFrame, off_target: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Measurements and refusals of all tables.

    Rows: as for ``activity_rows``; entities: doc, entity_seq, number (the last entity of a number counts); legends: as
    ``legends.legends`` gives them, with a document column doc, or as ``legends.gather`` does. A row whose number isn't accepted or names no entity
    measures nothing; blank cells are left out; a cell that can't be standardized is a refusal. What grows with the documents
    is dealt by document and merged there: Spark's size check doesn't see how many entities and labels a document has.
    """
    known = known_headers(rows)
    each = owned(activity_rows(rows).where("accepted"), entities).select("doc", "table_id", "row_no", "number", "entity_seq", "number_col", "header", "texts")
    each = each.join((legends if "bins" in legends.columns else gather(legends, "doc")).hint("merge"), "doc", "left")
    each = each.select("doc", "table_id", "row_no", "number", "entity_seq", "number_col", "assays", "bins", F.posexplode(F.arrays_zip("header", "texts")).alias("col", "c"))
    each = each.where((F.col("col") != F.col("number_col")) & F.col("c.header").isNotNull() & F.col("c.texts").isNotNull()).select("*", F.col("c.header").alias("published_type"), F.trim("c.texts").alias("text")).drop("c", "number_col")
    # labels are letters, so what holds a digit is none of them and goes on without the legend
    cells = each.join(known, "published_type").withColumn("_plain", ~F.col("text").rlike("[0-9]"))
    cells = step(cells, _assays=F.when(F.col("_plain"), F.col("assays")), _bins=F.when(F.col("_plain"), F.col("bins"))).drop("assays", "bins")
    letters = normalize_bin_cell(F.col("text"), labels_of(F.col("_printed"), F.col("_wanted"), F.col("_assays")))
    cells = cells.withColumn("raw", F.when(F.col("_plain"), letters).otherwise(F.col("text")))
    cells = cells.withColumn("bin", F.when(F.col("_plain"), F.try_element_at("_bins", bin_key(F.col("raw")))))
    out = build(cells.drop("_assays", "_bins", "_plain", "_printed", "_wanted", "text"))
    off = F.coalesce(F.upper("target") == F.lit((off_target or "").upper()), F.lit(False)) if off_target else F.lit(False)
    keep = ["doc", "table_id", "row_no", "number", "entity_seq", "col", "published_type", "standard_type", "target", "raw"]
    measured = out.where("status = 'measured'").select(*keep, *FIGURES, "pchembl", "pdc50", off.alias("is_off_target"))
    return measured, out.where("status = 'refused'").select(*keep, F.lit("unit_missing").alias("kind"))


def is_compound_row(number: Column, name: Column) -> Column:
    """A band with a readable number, or with a name that reads chemical."""
    return number.isNotNull() | F.coalesce(reads_chemical(name), F.lit(False))


def first_reading(*texts: Column) -> Column:
    """A cell's text: the first reading that isn't blank, empty without any."""
    return F.coalesce(*[F.nullif(F.trim(t), F.lit("")) for t in texts], F.lit(""))


def compound_cells(cells: DataFrame) -> DataFrame:
    """(doc, page_no, row_no, number, name, crop) of cells (doc, page_no, row_no, role, text, crop); rows with neither a name nor a drawing are left out."""
    of = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    rows = cells.groupBy("doc", "page_no", "row_no").agg(plain_integer(of("number", "text")).alias("number"), F.coalesce(of("name", "text"), F.lit("")).alias("name"), of("structure", "crop").alias("crop"))
    return rows.where((F.trim("name") != "") | F.col("crop").isNotNull())


def text_matrix(cells: DataFrame) -> DataFrame:
    """(doc, page_no, rows): the texts of a page's cells (doc, page_no, row_no, col_no, text), row by row."""
    rows = cells.groupBy("doc", "page_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", F.coalesce("text", F.lit("")).alias("t")))).alias("c"))
    rows = rows.groupBy("doc", "page_no").agg(F.array_sort(F.collect_list(F.struct("row_no", F.transform("c", lambda x: x["t"]).alias("texts")))).alias("r"))
    return rows.select("doc", "page_no", F.transform("r", lambda x: x["texts"]).alias("rows"))


def compounds(cells: DataFrame) -> DataFrame:
    """``cells`` (doc, seq, page_no, number) with local_id and compound_id: the number, else page and place; one for each cell."""
    local = F.coalesce(F.col("number").cast("string"), F.concat(F.lit("p"), "page_no", F.lit("r"), F.col("seq")))
    return cells.withColumn("local_id", local).withColumn("compound_id", F.concat_ws(":", "doc", "local_id"))
