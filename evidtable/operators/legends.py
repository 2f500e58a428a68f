"""Letter-bin legends out of prose: statements by expressions, first ones, inherited units, contradictions and scores by windows.

All windows are within a document. An interval without units, its own or a sibling's before it, is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, name_key
from ..functions.values import bin_fields, let, lookup, normalize_units, to_nm

#: Relation words and symbols, longer ones first.
CANONICAL = {
    "between": "between", "less than or equal to": "<=", "greater than or equal to": ">=", "no more than": "<=", "no less than": ">=",
    "less than": "<", "greater than": ">", "<=": "<=", ">=": ">=", "≤": "<=", "≥": ">=", "<": "<", ">": ">",
}
#: Fixed patterns: a relation, a number with its unit, the two kinds of statement.
RELATION = "|".join(words.replace(" ", r"\s+") for words in CANONICAL)
NUMBER = r"([0-9]+(?:\.\s?[0-9]+)?|\.\s?[0-9]+)\s*(%|uM|nM|mM|nm|M)?"
DEFINITION = r"(?i)having\s+([\s\S]{1,120}?)\s*\b(?:are|is)\b\s+level\s+([A-Za-z])\b"
SUMMARY = r"(?i)\(\s*activity\s+level\s+([A-Za-z])\s*\)"
NOISE = r"(?i)\blevel\b|\bformula\b|\bcompounds\b"
ENDPOINT = r"\b[A-Za-z]{1,6}[0-9]{1,2}\b"
REACH = 200
TOLERANCE = 1e-9
PARTS = 64


def plain_units(text: Column) -> Column:
    """Signs for micro, and p misread for one, as u."""
    return F.regexp_replace(F.translate(text, "µμ", "uu"), r"\bpM\b", "uM")


def from_relation(text: Column) -> Column:
    return F.regexp_extract(text, f"(?is)(?:{RELATION}).*", 0)


def interval(text: Column) -> Column:
    """struct(lower, upper, units, lower_inclusive, upper_inclusive) of a clause; null without a number, or with one and no relation."""
    relation = lookup(F.lower(collapse(F.regexp_extract(text, f"(?i){RELATION}", 0))), CANONICAL)
    numbers = F.transform(F.regexp_extract_all(text, F.lit(NUMBER), 1), lambda n: F.regexp_replace(n, r"\s", "").try_cast("double"))
    units = F.filter(F.transform(F.regexp_extract_all(text, F.lit(NUMBER), 2), lambda u: normalize_units(u)), lambda u: u.isNotNull())

    def told(p: Column) -> Column:
        r, first, second = p["r"], F.try_element_at(p["n"], F.lit(1)), F.try_element_at(p["n"], F.lit(2))
        above, below = r.isin(">", ">="), r.isin("<", "<=")
        found = F.struct(
            F.when(second.isNotNull() | above, first).alias("lower"), F.when(second.isNotNull(), second).when(below, first).alias("upper"), F.try_element_at(p["u"], F.lit(1)).alias("units"),
            F.coalesce(r != ">", F.lit(True)).alias("lower_inclusive"), (second.isNotNull() | ~F.coalesce(r == "<", F.lit(False))).alias("upper_inclusive"),
        )
        return F.when(second.isNotNull() | (first.isNotNull() & F.coalesce(above | below, F.lit(False))), found)

    return let(F.struct(relation.alias("r"), numbers.alias("n"), units.alias("u")), told)


def statements(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, sentences, clauses: all of a text that its legend is read from, the two kinds of statement in their order."""
    labels = F.regexp_extract_all(text, F.lit(SUMMARY), 1)
    zipped = F.zip_with(labels, F.split(text, SUMMARY), lambda label, before: F.struct(F.upper(label).alias("label"), F.right(before, F.lit(REACH)).alias("clause")))
    clauses = F.when(F.size(labels) > 0, F.filter(zipped, lambda z: z["label"].isNotNull())).otherwise(F.array().cast("array<struct<label:string,clause:string>>"))
    return docs.select(doc, F.inline(F.array(F.struct(F.regexp_extract_all(text, F.lit(DEFINITION), 0).alias("sentences"), clauses.alias("clauses")))))


def definitions(told: DataFrame, doc: str) -> DataFrame:
    """``having <assay> <interval> is level X``: doc, seq, label, assay, assay_key, sentence, i; the first of each assay and label, under the assay's first name."""
    found = told.select(doc, F.posexplode("sentences").alias("seq", "sentence"))
    found = found.withColumns({"_body": F.regexp_extract("sentence", DEFINITION, 1), "label": F.upper(F.regexp_extract("sentence", DEFINITION, 2))}).where(~F.col("_body").rlike(NOISE))
    assay = F.regexp_replace(collapse(F.regexp_extract("_body", f"(?is)^(.*?)(?:{RELATION})", 1)), r"^[ %.,;:\-–]+|[ %.,;:\-–]+$", "")
    found = found.withColumns({"assay": assay, "i": interval(plain_units(from_relation(F.col("_body"))))}).where("assay <> '' AND i IS NOT NULL")
    found = found.withColumn("assay_key", name_key(F.col("assay")))
    nth = F.row_number().over(Window.partitionBy(doc, "assay_key", "label").orderBy("seq"))
    name = F.first("assay").over(Window.partitionBy(doc, "assay_key").orderBy("seq"))
    return found.withColumns({"_n": nth, "assay": name}).where("_n = 1").select(doc, "seq", "label", "assay", "assay_key", F.col("sentence"), "i")


def summaries(told: DataFrame, doc: str) -> DataFrame:
    """``... <interval> (activity level X)``: doc, label, s; the first of each label that has an interval."""
    found = told.select(doc, F.posexplode("clauses").alias("seq", "z")).select(doc, "seq", "z.label", "z.clause")
    clause = plain_units(F.regexp_replace("clause", r"(?is)^.*\bvalues?\b", ""))
    stated = F.when(clause.rlike(f"(?i){RELATION}"), from_relation(clause)).otherwise(F.regexp_extract(F.regexp_replace(clause, ENDPOINT, " "), "(?s)[0-9].*", 0))
    found = found.withColumn("s", interval(stated)).where("s IS NOT NULL")
    return found.groupBy(doc, "label").agg(F.min_by("s", "seq").alias("s"))


def discrepancy(own: Column, other: Column, units: Column) -> Column:
    """What a restated interval says otherwise, joined by ``; ``; null where both agree or ``other`` is null. A lower bound of zero is none."""
    scaled = lambda v, u: F.coalesce(to_nm(v, u), v)
    other_units = F.coalesce(other["units"], units)
    low, high = scaled(F.nullif(own["lower"], F.lit(0.0)), units), scaled(own["upper"], units)
    low2, high2 = scaled(F.nullif(other["lower"], F.lit(0.0)), other_units), scaled(other["upper"], other_units)
    differs = lambda a, b: F.coalesce(F.abs(a - b) > TOLERANCE * F.greatest(F.lit(1.0), F.abs(a), F.abs(b)), F.lit(False))
    opposite = (low.isNull() != low2.isNull()) | (high.isNull() != high2.isNull())
    notes = F.array_compact(F.array(
        F.when(other["units"] != units, F.concat(F.lit("units restated as "), other["units"], F.lit(" rather than "), units)), F.when(opposite, F.lit("the interval is bounded from the opposite side")),
        F.when(~opposite & differs(low, low2), F.lit("lower bound differs")), F.when(~opposite & differs(high, high2), F.lit("upper bound differs")),
    ))
    return F.when(other.isNotNull() & (F.size(notes) > 0), F.array_join(notes, "; "))


def legends(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, assay, label, lower, upper, units, the inclusive flags, definition, discrepancy, score (the most desirable bin of an assay has the highest)."""
    return stated(statements(docs, doc, text), doc)


def stated(told: DataFrame, doc: str) -> DataFrame:
    """``legends`` of texts whose ``statements`` are given."""
    before = Window.partitionBy(doc, "assay_key").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    known = definitions(told, doc).withColumn("units", F.coalesce("i.units", F.first("i.units", ignorenulls=True).over(before))).where("units IS NOT NULL")
    assay = Window.partitionBy(doc, "assay_key")
    known = known.withColumn("_percent", F.first("units").over(assay.orderBy("seq")) == "%")
    order = F.when(F.col("_percent"), -F.col("i.lower")).otherwise(F.col("i.upper"))
    known = known.withColumn("score", (F.count("*").over(assay) - F.row_number().over(assay.orderBy(F.asc_nulls_last(order), "seq")) + 1).cast("int"))
    both = known.join(summaries(told, doc).hint("merge"), [doc, "label"], "left")
    return both.select(doc, "assay", "label", "i.lower", "i.upper", "units", "i.lower_inclusive", "i.upper_inclusive", collapse(F.col("sentence")).alias("definition"), discrepancy(F.col("i"), F.col("s"), F.col("units")).alias("discrepancy"), "score", "seq")


def legal_labels(headers: DataFrame, known: DataFrame, doc: str) -> DataFrame:
    """``headers`` (doc, header, target) with the labels of the first assay that holds the target or is held by the header; none gives an empty array."""
    assays = known.groupBy(doc, "assay").agg(F.min("seq").alias("_at"), F.transform(F.array_sort(F.collect_list(F.struct("seq", "label"))), lambda x: x["label"]).alias("labels"))
    h, a = headers.alias("h"), assays.alias("a").hint("merge")
    target, key = F.upper(F.coalesce("h.target", F.lit(""))), F.upper("a.assay")
    met = h.join(a, (F.col(f"h.{doc}") == F.col(f"a.{doc}")) & (((target != "") & F.contains(key, target)) | F.contains(F.upper("h.header"), key)), "left")
    first = met.groupBy(F.col(f"h.{doc}").alias(doc), F.col("h.header").alias("header"), F.col("h.target").alias("target")).agg(F.min_by("a.labels", "a._at").alias("labels"))
    return first.withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def gather(known: DataFrame, doc: str) -> DataFrame:
    """``legends`` as one row for each document: ``assays``, in their order (at, key: the name in capitals, labels), and ``bins`` by label.

    A label that two assays of a document have is no bin: it decodes to nothing.
    """
    row = F.struct("seq", "label", "lower", "upper", "units", "score")
    assays = known.groupBy(doc, "assay").agg(F.min("seq").alias("at"), F.array_sort(F.collect_list(row)).alias("rows"))
    one = F.struct("at", F.upper("assay").alias("key"), F.transform("rows", lambda r: r["label"]).alias("labels"), "rows")
    met = assays.groupBy(doc).agg(F.array_sort(F.collect_list(one)).alias("assays")).withColumn("rows", F.flatten("assays.rows"))
    of = lambda key: F.filter("rows", lambda r: F.upper(r["label"]) == key)
    alone = F.filter(F.transform(F.array_distinct(F.transform("rows", lambda r: F.upper(r["label"]))), lambda key: F.struct(key.alias("key"), of(key).alias("of"))), lambda b: F.size(b["of"]) == 1)
    fields = lambda r: F.struct(r["label"].alias("label"), r["score"].alias("score"), bin_fields(r["lower"], r["upper"], r["units"]).alias("fields"))
    bins = F.map_from_entries(F.transform(alone, lambda b: F.struct(b["key"], fields(b["of"][0]))))
    return met.select(doc, F.transform("assays", lambda a: F.struct(a["key"].alias("key"), a["labels"].alias("labels"))).alias("assays"), bins.alias("bins"))


def gathered(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``gather`` of the ``legends`` of docs (each once); documents that state the same have it read once in each of ``PARTS``."""
    # a part of the documents each, so that no task has all that state the same
    part = F.pmod(F.xxhash64(doc), F.lit(PARTS)).alias("part")
    told = statements(docs, doc, text).select(doc, F.struct("sentences", "clauses", part).alias("said"))
    once = gather(stated(told.select("said").distinct().select("said", "said.sentences", "said.clauses"), "said"), "said")
    return told.join(once, "said").drop("said")


def labels_of(header: Column, target: Column, assays: Column) -> Column:
    """``legal_labels`` out of a document's gathered ``assays``; header and target in capitals, the target empty without one."""
    first = F.get(F.filter(assays, lambda a: ((target != "") & F.contains(a["key"], target)) | F.contains(header, a["key"])), F.lit(0))
    return F.coalesce(first["labels"], F.array().cast("array<string>"))
