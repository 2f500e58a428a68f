"""Legends, headers, prose, repairs and pages on small cases."""

import random

from pyspark.sql import functions as F

from evidtable.functions import prose
from evidtable.operators import legends, lexicon, pages, repair, scoring, tables

TEXT = """compounds having HbF Induction % between 66 and 100% are level A. having HbF induction, %: between 33 and 66% are level B.
having HbF Induction less than 33 % are level C; having WIZ EC50 < .01 pM are level D, having WIZ EC50 between 0. 01 and 0.1 are level E.
having WIZ-EC50 greater than 0.1 µM are level F. having WIZ EC50 < 9 uM are level D. having Foo of 3 are level Z. having Bar < 7 are level Y.
Values of 67 to 100% (activity level A), a value of between 0 and 33% (activity level C), EC50 less than 10 nM (activity level D), WIZ EC50 less than 100 nM (activity level F)"""


def test_legends(spark):
    docs = spark.createDataFrame([("d", TEXT), ("none", "no legend"), ("null", None), ("empty", "")], "doc string, text string")
    out = {r["label"]: r for r in legends.legends(docs, "doc", "text").collect()}
    assert sorted(out) == ["A", "B", "C", "D", "E", "F"]
    assert [out[k]["assay"] for k in "ABCDEF"] == ["HbF Induction"] * 3 + ["WIZ EC50"] * 3
    assert [(out[k]["lower"], out[k]["upper"], out[k]["units"]) for k in "ABCDEF"] == [(66.0, 100.0, "%"), (33.0, 66.0, "%"), (None, 33.0, "%"), (None, 0.01, "uM"), (0.01, 0.1, "uM"), (0.1, None, "uM")]
    assert [out[k]["score"] for k in "ABCDEF"] == [3, 2, 1, 3, 2, 1]
    assert out["A"]["discrepancy"] == "lower bound differs" and out["B"]["discrepancy"] is None and out["C"]["discrepancy"] is None
    assert out["D"]["discrepancy"] == "units restated as nM rather than uM"
    assert out["F"]["discrepancy"] == "units restated as nM rather than uM; the interval is bounded from the opposite side"
    headers = spark.createDataFrame([("d", "WIZ ECS50 (uM)", "WIZ"), ("d", "Mass", None)], "doc string, header string, target string")
    got = {r["header"]: r["labels"] for r in legends.legal_labels(headers, legends.legends(docs, "doc", "text"), "doc").collect()}
    assert got == {"WIZ ECS50 (uM)": ["D", "E", "F"], "Mass": []}


def test_headers(spark):
    cases = {
        "WIZ EC50 (uM)": ("EC50", "uM", "WIZ", 1.0), "compound  no.": ("CompoundNumber", None, None, 1.0), "BRD4 pIC50 (nM)": ("IC50", None, "BRD4", 0.95), "GSPT1 DC50 nM": ("DC50", "nM", "GSPT1", 0.95),
        "% inhibition @ 10 uM": ("Inhibition", "%", None, 0.95), "Dmax": ("Dmax", "%", None, 0.95), "HiBiT DC50 (nM)": ("DC50", "nM", "HiBiT DC50", 1.0), "Mass found": None, "": None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in [*cases, "ZBTB7A ECS0 (uM)"]], "h string")
    got = {r["h"]: r["match"] for r in lexicon.match_headers(rows, "h").collect()}
    near = got.pop("ZBTB7A ECS0 (uM)")
    assert near["standard_type"] == "EC50" and 0.9 < near["confidence"] < 0.95
    assert {k: v and (v["standard_type"], v["units"], v["target"], v["confidence"]) for k, v in got.items()} == cases


def test_repair(spark):
    known = ["1H-indazol", "methyl-1,3-dione", "corner", "benzo[d]", "a1b1c1", "(R)-1,2-x"]
    asked = {"lH-indazol": known[0], "methyl-l,3-dione": known[1], "comer": known[2], "benzo[dl": None, "alblcl": known[4], "(7?)-l,2-x": known[5], "corner & other": known[2], "zzz": None, "": None, None: None}
    names = spark.createDataFrame(list(enumerate(asked)), "id long, name string")
    out = {r["id"]: r for r in repair.repair(names, spark.createDataFrame([(k, k.upper()) for k in known], "name string, value string"), "id", "name").collect()}
    assert [out[i]["repaired"] for i in range(len(asked))] == list(asked.values())
    assert [out[i]["depth"] for i in range(len(asked))] == [1, 1, 1, None, 1, 2, 0, None, None, None]
    assert out[6]["note"] == "first of 2"
    rows = repair.candidates(spark.createDataFrame([("ll1l-Ol",), ("",), ("rnx",)], "seed string")).collect()
    texts = [r["text"] for r in rows if r["seed"] == "ll1l-Ol"]
    assert len(texts) == len(set(texts)) and "ll1l-Ol" not in texts and not any(r["seed"] == "" for r in rows)
    few = sorted((r["n"], r["text"], r["depth"], r["edits"]) for r in rows if r["seed"] == "rnx")
    assert few == [(1, "mx", 1, ["rn → m everywhere"])]


def test_prose(spark):
    text = "[0100] Example 1: 3-(4-methyl-phenoxy)-piperidine\n1H NMR (400 MHz)\nExample 2A - 2-chloro-5-nitro-benzonitrile\nMS (ESI) m/z 100. Example 3: short"
    d = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    out = [r[0] for r in d.select(prose.examples(F.col("t"))).collect()]
    assert [tuple(x) for x in out[0]] == [("1", "3-(4-methyl-phenoxy)-piperidine", True, False), ("2A", "2-chloro-5-nitro-benzonitrile", False, True)]
    assert out[1] == [] and out[2] is None
    cases = ["Mouse Anti-Human antibody", "dosed in mice, AUC and Cmax", "in vivo imaging " + "x" * 200 + " in vivo efficacy", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "t string").coalesce(1).select(prose.in_vivo_terms("t")).collect()]
    assert got == [[], ["mouse", "AUC", "Cmax"], ["in vivo"], []]
    numbers = ["PCT/US2023/078600 A1 (10) International Publication Number WO 2024/097932 Al", "US 20250368620 A1 then GB 1234567 A", "XX 1234567 A1", "none", None]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in numbers], "t string").coalesce(1).select(prose.publication_number_in("t")).collect()]
    assert got == ["WO2024097932A1", "US20250368620A1", None, None, None]


def test_pages(spark):
    rows = [
        ("d", 1, 4, ["Compound No.\n1", "WIZ EC50 (uM)\nA", "x"], [50.0, 100.0, 90.0]), ("d", 2, 4, ["12", "N O HN", "3-(4-methyl-phenoxypiperidin"], [20.0, 90.0, 95.0]),
        ("d", 3, 4, ["piperidin-2,6-dione dioxopiperidin", "7"], [80.0, 20.0]), ("d", 4, 0, ["a", "b"], [1.0, 1.0]),
    ]
    p = spark.createDataFrame(rows, "doc string, page int, n_rows int, texts array<string>, widths array<double>")
    assert [r["kind"] for r in pages.classify(p, ["doc", "page"]).orderBy("page").collect()] == ["activity_table", "compound_table", None, None]
    roles = [["number", "structure", "unknown"], ["number", "structure", "name"], ["name", "number"], ["number", "unknown"]]
    assert [r[0] for r in p.orderBy("page").select(pages.column_roles(F.col("texts"), F.col("widths"))).collect()] == roles
    heads = spark.createDataFrame([(["Compound No.", "HbF Induction (%)"],), (["32", "A", "D", "H"],), ([],), (["", None],)], "c array<string>")
    assert [bool(r[0]) for r in heads.coalesce(1).select(pages.is_header(F.col("c"))).collect()] == [True, False, False, False]


def test_inherit_equals_the_loop(spark):
    random.seed(5)
    rows, want = [], {}
    for doc in range(80):
        kinds = {}
        for page in sorted(random.sample(range(9), 6)):
            kind, on = random.choice([None, None, "a", "b"]), random.random() < 0.7
            rows.append((doc, page, kind, on))
            kinds[page] = kind or (kinds.get(page - 1) if on else None)
        want |= {(doc, p): k for p, k in kinds.items()}
    out = pages.inherit_kind(spark.createDataFrame(rows, "doc int, page int, kind string, goes boolean"), "doc", "page", "kind", F.col("goes")).collect()
    assert {(r["doc"], r["page"]): r["kind"] for r in out} == want


def test_reconcile(spark):
    rows = [
        (1, [0, 50, 100], [0, 40, 80], [0, 50, 100], [0, 40, 80], None), (2, [0, 50, 100], [0, 80], [0, 25, 50, 100], [0, 40, 80], None), (3, [0, 50], [0, 80], None, None, None), (4, None, None, [0, 9], [0, 9], None),
        (5, [0, 50, 100], [0, 40, 80], [0, 100], [0, 20, 40, 60, 80], 4), (6, None, None, None, None, None), (7, [0, 50, 100], [0, 80], [0, 50, 100], [0, 40, 80], None),
    ]
    p = spark.createDataFrame(rows, "id int, a_xs array<int>, a_ys array<int>, b_xs array<int>, b_ys array<int>, expected_rows int")
    out = {r["id"]: r for r in pages.reconcile(p).collect()}
    assert [out[i]["chosen"] for i in range(1, 8)] == ["a", "merged", "a", "b", "b", None, "b"]
    assert [out[i]["disagreement"] for i in range(1, 8)] == [False, True, False, False, True, False, True]
    assert out[2]["ys"] == [0, 40, 80] and out[2]["xs"] == [0, 50, 100] and out[1]["agreement"] == 1.0


def test_numberless_rows(spark):
    rows = [(1, 1, 5, "alpha-beta"), (1, 2, None, "alpha"), (1, 3, None, "gamma delta"), (1, 4, None, "Gamma"), (1, 5, None, None), (1, 6, None, "omega"), (2, 1, None, "alpha")]
    out = tables.dedupe_numberless(spark.createDataFrame(rows, "doc int, seq int, number int, name string"), "doc", "seq", "number", "name").collect()
    assert sorted(map(tuple, out)) == [(1, 1), (1, 3), (1, 5), (1, 6), (2, 1)]


def test_adjacent_anomalies(spark):
    rows = [(1, i, n) for i, n in enumerate([1, None, 3, 3, 2, 7])]
    out = tables.adjacent_anomalies(spark.createDataFrame(rows, "doc int, pos int, n int"), "doc", "pos", "n").orderBy("pos").collect()
    assert [(r["pos"], r["kind"], r["previous"], r["number"]) for r in out] == [(1, "unreadable", None, None), (3, "duplicate", 3, 3), (4, "order", 3, 2), (5, "gap", 2, 7)]


def test_evaluation_of_keys(spark):
    k = lambda a, b: f"{a * 14}-{b}"
    entities = spark.createDataFrame([(1, 1, "x1", None, "full"), (2, 1, "x2", k("A", "N"), "interpolated"), (3, None, "2", k("B", "N"), None), (4, 3, "c", k("C", "Q"), None)], "seq int, number int, local_id string, key string, join_method string")
    gold = spark.createDataFrame([("1", k("A", "N")), ("2", k("Z", "N")), ("3", k("C", "N")), ("4", None)], "id string, key string")
    r = scoring.score_keys(gold, entities).first()
    assert (r["scored"], r["correct"], r["skeleton_correct"]) == (3, 1, 1) and abs(r["skeleton_accuracy"] - 2 / 3) < 1e-9
    r = scoring.score_examples(gold.where("key IS NOT NULL"), entities).first()
    assert (r["scored"], r["correct"], r["skeleton_correct"]) == (3, 1, 2)
    values = lambda rows: spark.createDataFrame(rows, "id string, value string")
    r = scoring.score_join(values([("1", "A"), ("2", None), ("3", "B")]), values([("1", "X"), ("3", "")]), entities).first()
    assert (r["gold_ids"], r["matched"], r["interpolated"], r["accuracy"]) == (2, 1, 1, 0.5)
    r = scoring.score_legends(spark.createDataFrame([("w", "A"), ("w", "B"), ("z", "C")], "assay string, label string"), spark.createDataFrame([("w", "A", None), ("w", "B", "x"), ("w", "C", None)], "assay string, label string, discrepancy string")).first()
    assert (r["expected"], r["recovered"], r["contradictions"]) == (2, 1, 1)
    s = spark.createDataFrame([("e", 2, "ZB", "I", 1, True), ("e", 1, "WIZ", "D", 3, True), ("e", 3, "HbF", None, None, False)], "e string, seq int, name string, label string, bin_score int, is_censored boolean")
    assert scoring.potency_lines(s, "e", 3).first()["lines"] == ["potency 4 = WIZ D→3, ZB I→1", "scored on 2 of 3 assays; blank cells are omitted, not counted as low", "letter-bin values are censored; efficiency metrics undefined"]
