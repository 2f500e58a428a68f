"""Cells, units and intervals on single values."""

import pytest
from pyspark.sql import functions as F

from evidtable.functions import text as T
from evidtable.functions import values as V

CELLS = [
    (">10,000", (">", 10000.0, None, False)), ("5.6 ± 0.3", ("=", 5.6, None, False)), ("A", ("=", None, "A", False)), ("≤ 3", ("<=", 3.0, None, False)),
    ("", ("=", None, None, True)), ("-", ("=", None, None, True)), ("–", ("=", None, None, True)), (None, ("=", None, None, True)),
]


def test_cells(spark):
    df = spark.createDataFrame([(c,) for c, _ in CELLS], "raw string")
    got = [tuple(r["p"]) for r in df.select(V.parse_cell(F.col("raw")).alias("p")).collect()]
    assert got == [want for _, want in CELLS]


@pytest.mark.parametrize(("raw", "want"), [("µM", "uM"), ("pM", "uM"), ("nm", "nm"), ("(nM)", "nM"), ("pct", "%"), ("mg", None), ("", None)])
def test_units(spark, raw, want):
    assert spark.range(1).select(V.normalize_units(F.lit(raw))).first()[0] == want


def test_log_form_inverts_the_relation(spark):
    s = spark.range(1).select(V.standardize(F.lit(8.0), F.lit(">"), F.lit(None).cast("string"), F.lit(True)).alias("s")).first()["s"]
    assert (round(s["value"], 9), s["units"], s["relation"]) == (10.0, "nM", "<")


def test_no_units_is_refused(spark):
    assert spark.range(1).select(V.standardize(F.lit(8.0), F.lit("="), F.lit(None).cast("string"), F.lit(False))).first()[0] is None


@pytest.mark.parametrize(("cell", "want"), [("Cc", "C"), ("A b", "A b"), ("C1", "C1"), ("X", "X")])
def test_bin_cells(spark, cell, want):
    assert spark.range(1).select(V.normalize_bin_cell(F.lit(cell), F.array(*map(F.lit, "ABC")))).first()[0] == want


def test_decades(spark):
    row = spark.range(1).select(*[V.decade_gap(F.lit(1.0), F.lit(x)) for x in (1e3, 1e6, 1e2)]).first()
    assert tuple(row) == (True, True, False)


def test_text(spark):
    row = spark.range(1).select(T.page_ranges(F.lit("3-5, 9,x,4")), T.reconstruct_header(F.array(F.lit("Iso-"), F.lit("indoline"))), T.similarity(F.lit("abc"), F.lit("abc"))).first()
    assert tuple(row) == ([3, 4, 5, 9], "Isoindoline", 1.0)
