"""Windows and folds against plain loops."""

import random

from pyspark.sql import functions as F

from evidtable.operators import legends, linking, measurements, scoring, tables


def test_accept_equals_the_loop(spark):
    random.seed(3)
    rows, want = [], {}
    for doc in range(60):
        last = None
        for seq in range(random.randint(1, 12)):
            n = random.choice([None, *range(8)])
            ok = n is not None and (last is None or n > last)
            last = n if ok else last
            rows.append((doc, seq, n))
            want[doc, seq] = ok
    out = tables.accept_increasing(spark.createDataFrame(rows, "doc long, seq long, n long"), "doc", "seq", "n").collect()
    assert {(r["doc"], r["seq"]): r["accepted"] for r in out} == want


def test_merge_moves_the_edge(spark):
    assert spark.range(1).select(tables.merge_edges(F.array(*map(F.lit, (16, 0, 8))))).first()[0] == [4, 16]


def test_stitch(spark):
    pages = spark.createDataFrame([("d", 1, True, [0.0, 50.0], 100.0), ("d", 2, False, [0.0, 51.0], 100.0), ("d", 3, True, [0.0, 50.0], 100.0), ("d", 5, False, [0.0, 50.0], 100.0)], "doc string, page_no int, has_header boolean, xs array<double>, width double")
    assert [r["table_id"] for r in tables.stitch_pages(pages).orderBy("page_no").collect()] == [1, 1, 2, 3]


def test_tie_breaks(spark):
    rows = [("X", 6, 1, 0.1, 500.0), ("Y", 6, 0, 0.9, 500.0), ("Z", 6, 0, 0.5, 400.0), ("W", 6, 0, 0.5, 300.0), ("N", None, 0, 1.0, 1.0)]
    out = scoring.rank(spark.createDataFrame(rows, "id string, potency long, top_bins long, qed double, mw double"), "id").where("rank is not null").orderBy("rank").collect()
    assert [r["id"] for r in out] == ["X", "Y", "W", "Z"]
    assert [r["tie_group"] for r in out] == [1, 2, 2, 2]
    assert [r["signal"] for r in out] == ["top", "top-bin count", "QED", "MW"]


def test_self_evaluation_is_perfect(spark):
    gold = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (2, "a", "y")], "id long, assay string, value string")
    one = scoring.evaluate(scoring.cell_status(gold, gold)).first()
    assert (one["f1"], one["accuracy"], one["spurious"]) == (1.0, 1.0, 0)
    pred = spark.createDataFrame([(1, "b", "z"), (9, "a", "q")], "id long, assay string, value string")
    two = scoring.evaluate(scoring.cell_status(gold, pred)).first()
    assert (two["spurious"], two["missing"], two["predicted_total"]) == (1, 2, 2)


def test_tiers(spark):
    pairs = [(None, " ", "NONE"), ("A" * 14 + "X", None, "SINGLE_SOURCE"), ("K", "K", "AGREE_FULL"), ("A" * 14 + "X", "A" * 14 + "Y", "AGREE_SKELETON"), ("A", "B", "CONFLICT")]
    df = spark.createDataFrame(pairs, "a string, b string, want string")
    assert df.where(linking.tier(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_claims_are_one_to_one(spark):
    e = spark.createDataFrame([("d", 1, "k", None, "foo"), ("d", 2, None, None, "methylbenzene")], "doc string, example_seq long, full_key string, skeleton string, name string")
    n = spark.createDataFrame([("d", 7, "k", None, "methylbenzene"), ("d", 8, None, None, "methylbenzenee")], "doc string, entity_seq long, full_key string, skeleton string, name string")
    out = {r["example_seq"]: (r["entity_seq"], r["method"]) for r in linking.claim(linking.precedence_candidates(e, n)).collect()}
    assert out == {1: (7, "full"), 2: (8, "name")}


def test_claims_equal_the_loop(spark):
    rng = random.Random(4)
    rows = {(f"d{rng.randrange(40)}", rng.randrange(6), rng.randrange(6), rng.choice(["full", "name", "skeleton"])): rng.choice([0.9, 0.95, 1.0]) for _ in range(900)}
    want, rank = set(), ["full", "name", "skeleton"]
    for doc in {k[0] for k in rows}:
        taken = set()
        for seq in range(6):
            picks = {}
            for m in rank:
                free = [(-s, e) for (d, x, e, how), s in rows.items() if (d, x, how) == (doc, seq, m) and e not in taken]
                picks |= {m: min(free)[1]} if free else {}
            if picks:
                m = next(iter(picks))
                taken.add(picks[m])
                want.add((doc, seq, picks[m], m, ",".join(x for x in picks if picks[x] == picks[m])))
    c = spark.createDataFrame([(*k, s) for k, s in rows.items()], "doc string, example_seq long, entity_seq long, method string, score double")
    assert {(*r[:4], ",".join(r[4])) for r in linking.claim(c).collect()} == want


def test_links_and_joins_broadcast_no_growing_table(spark):
    kind = "doc string, {} long, full_key string, skeleton string, name string, local_id string, number long, key_from_name string, key_from_image string"
    e, n = (spark.createDataFrame([], kind.format(k)) for k in ("example_seq", "entity_seq"))
    links = linking.claim(linking.precedence_candidates(e, n))
    for out in (links, linking.full_join(n, n.select("doc", "number", F.col("entity_seq").alias("seq")), e, links)):
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_agreeing_boxes_equal_all_pairs(spark):
    rng = random.Random(8)
    box = lambda s: (x := rng.uniform(-40, 40) * s, y := rng.uniform(-20, 20) * s, x + rng.uniform(-1, 30) * s, y + rng.choice([0, 8, 16, 20]) * s)
    some = lambda n: [(i, i % 2, box(rng.choice([0.01, 1, 1, 1, 900]))) for i in range(n)]
    left, right = some(400), some(300)
    left += [(1000 + i, p, b) for i, p, b in right[:40]] + [(2000, 0, (0.0, 0.0, 8.0, 8.0))]
    right += [(2000, 0, (0.0, 0.0, 8.0, 4.0)), (2001, 0, (0.0, 0.0, 16.0, 8.0)), (2002, 0, (0.0, 0.0, 8.0, 3.999))]  # exactly a half, exactly a half, just less

    def iou(a, b):
        i = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
        return i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i)

    good = lambda b: b[2] > b[0] and b[3] > b[1]
    frame = lambda rows, k: spark.createDataFrame(rows, f"{k} long, page long, {k}_box struct<x0: double, y0: double, x1: double, y1: double>")
    for least in (0.5, 0.2, 0.9, 1.0):
        want = sorted((i, j) for i, p, a in left for j, q, b in right if p == q and good(a) and good(b) and iou(a, b) >= least)
        got = tables.agreeing(frame(left, "a"), frame(right, "b"), ["page"], "a_box", "b_box", least).select("a", "b").collect()
        assert sorted(map(tuple, got)) == want and want


def test_measurements_broadcast_nothing_but_headers(spark):
    rows = spark.createDataFrame([], "doc long, table_id int, row_no long, header array<string>, texts array<string>")
    known = legends.legends(rows.select("doc", F.lit("").alias("text")), "doc", "text")
    for out in measurements.build_measurements(rows, spark.createDataFrame([], "doc long, entity_seq long, number long"), known):
        joins = [x for x in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in x]
        assert joins and not [x for x in joins if "Broadcast" in x and "[published_type" not in x]


def test_measurements_read_rows_once(spark):
    from evidtable.plans import assembly

    plan = assembly.measurement_build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "+- " in x]
    assert plan.count("l_returnflag") and "ArrowEvalPython" not in plan
    assert len([x for x in plan.splitlines() if "FileScan parquet" in x and "l_returnflag" in x]) == 1  # headers and labels are not found by reading all rows again
    assert exchanges and not [x for x in exchanges if "number" in x]  # entities meet the rows where both are dealt by document


def test_measurements_equal_with_either_form_of_legends_and_many_headers(spark, monkeypatch):
    both = "having WIZ EC50 less than 1 nM are level A. having WIZ EC50 greater than 5 nM are level C."
    texts = [(1, both), (2, both), (3, both + " having GSPT1 DC50 less than 9 uM are level A."), (4, "nothing"), (5, None)]
    header = ["x", "Compound No", "WIZ EC50 (uM)", "GSPT1 DC50 nM", None]
    rows = [(d, 1, i, header, ["9", n, wiz, dc, "7"]) for d, _ in texts for i, (n, wiz, dc) in enumerate([("1", " Aa", ">1,200"), ("2", "C", "-"), ("3", "2.5e1", "A"), ("2", "A", "3"), ("", "A", "3"), ("4", "B", "n.d."), ("6", "A", "1")])]
    rows = spark.createDataFrame(rows, "doc long, table_id int, row_no long, header array<string>, texts array<string>")
    entities = spark.createDataFrame([(d, 10 * n + k, n) for d, _ in texts for n in (1, 2, 3, 4, 5) for k in (1, 2)] + [(9, 1, 1), (1, 99, None)], "doc long, entity_seq long, number long")
    docs = spark.createDataFrame(texts, "doc long, text string")

    def figures(known):
        measured, refused = measurements.build_measurements(rows, entities, known, "GSPT1")
        return sorted(map(str, measured.collect())), sorted(map(str, refused.collect())), measured, refused

    want = figures(legends.legends(docs, "doc", "text"))
    assert figures(legends.gathered(docs, "doc", "text"))[:2] == want[:2]
    monkeypatch.setattr(measurements, "HEADERS_AT_ONCE", 0)
    assert figures(legends.gathered(docs, "doc", "text"))[:2] == want[:2]
    got = {(r["doc"], r["row_no"], r["col"]): (r["entity_seq"], r["raw"], r["value"], r["units"], r["relation"], r["lower"], r["upper"], r["bin_score"]) for r in want[2].collect()}
    one = {(1, 0, 2): (12, "A", None, "nM", "<", None, 1.0, 2), (1, 0, 3): (12, ">1,200", 1200.0, "nM", ">", None, None, None), (1, 1, 2): (22, "C", None, "nM", ">", 5.0, None, 1), (1, 2, 2): (32, "2.5e1", 25000.0, "nM", "=", None, None, None)}
    assert {k: v for k, v in got.items() if k[0] == 1 and k != (1, 2, 3)} == one and got[1, 2, 3][1:2] == ("A",)
    # two assays of document 3 have an A: it decodes to nothing; documents 4 and 5 have no legend
    assert sorted(k for k in got if k[0] == 3) == [(3, 0, 3), (3, 1, 2), (3, 2, 2)] and sorted(k for k in got if k[0] > 3) == [(d, i, c) for d in (4, 5) for i, c in ((0, 3), (2, 2))]
    assert sorted((r["row_no"], r["col"]) for r in want[3].collect() if r["doc"] == 1) == [(5, 2), (5, 3)]


def test_number_columns_equal_header_by_header(spark):
    headers = [["x", "Compound #"], ["compound\x00no", "Compd no"], ["a\x00b", None, "compound number"], ["comp", "ound no"], [None, "Cmpd. No."], [], None, ["x\ny", "z", "(Compound no.)", "compound no"]]
    rows = spark.createDataFrame([(i, 1, 1, h, ["5", "6", "7"]) for i, h in enumerate(headers)], "doc long, table_id int, row_no long, header array<string>, texts array<string>")
    got = measurements.activity_rows(rows).orderBy("doc").select("number_col", "number", "accepted").collect()
    assert list(map(tuple, got)) == [(at, 5 + at, True) for at in (1, 1, 2, 0, 0, 0, 0, 2)]
