"""Engines behind their interface, with fakes; pixels; runs."""

import json
import random
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evidtable import run
from evidtable.sources import bundles, engines, readings

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't have this file


def key(c):
    return F.when(c != "?", F.upper(F.md5(c)))


def upper():
    return lambda texts: [{"text": t.upper()} for t in texts]


def absent():
    raise RuntimeError("not here")


def fragile():
    def answer(inputs):
        if "bad" in inputs:
            raise ValueError("broken")
        return [{"smiles": x, "confidence": 0.9, "atoms": [0.9, 0.4], "bonds": []} if x != "none" else None for x in inputs]

    return answer


def test_answers_and_failures(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(["a", "bad", "c", "none", None, "?", "g"])], "id int, crop string").coalesce(1)
    assert {r["id"]: r["text"] for r in engines.text_of(rows, "crop", upper).collect()} == {0: "A", 1: "BAD", 2: "C", 3: "NONE", 4: "", 5: "?", 6: "G"}
    assert {r["error"] for r in engines.text_of(rows, "crop", absent).where("crop IS NOT NULL").collect()} == {"engine unavailable: not here"}
    got = {r["id"]: r for r in engines.recognized(rows, "crop", fragile, key, chunk=2).collect()}
    assert [got[i]["smiles"] for i in range(7)] == [None, None, "c", None, None, "?", "g"]
    assert got[0]["error"] == got[1]["error"] == "engine failed: broken" and got[3]["error"] == "no structure found" and got[5]["error"] == "structure can't be read"
    assert (got[6]["min_atom"], got[6]["min_bond"], got[6]["error"], got[4]["error"]) == (0.4, None, None, None)


def test_names(spark):
    def parser():
        return lambda names: [{"smiles": "C", "warnings": ["APPEARS_AMBIGUOUS: x"]} if "amb" in n else {"smiles": " " if "no" in n else "N", "warnings": []} for n in names]

    names = spark.createDataFrame([("ambig",), ("nope",), ("fine",), (None,)], "name string")
    out = {r["name"]: (r["smiles"], r["status"], r["ambiguous"]) for r in engines.parsed_names(names, "name", parser, key).collect()}
    assert out == {"ambig": ("C", "WARNING", True), "nope": (None, "FAILURE", False), "fine": ("N", "SUCCESS", False), None: (None, "FAILURE", False)}
    payload = '{"PropertyTable": {"Properties": [{"CanonicalSMILES": "CC", "InChIKey": "K"}]}}'
    cache = spark.createDataFrame([("known", payload)], "name string, payload string")
    asked = spark.createDataFrame([("known",), ("new",), ("lost",), (None,)], "name string")
    found, new = engines.resolved_names(asked, cache, lambda: lambda names: [{"payload": payload.replace("CC", n)} if n == "new" else {"payload": "{}"} for n in names])
    assert sorted(map(tuple, found.collect())) == [("known", "CC", "K"), ("new", "new", "K")] and [r["name"] for r in new.collect()] == ["new"]
    assert [r["name"] for r in engines.resolved_names(asked, cache, None)[0].collect()] == ["known"]


def test_only_clean_crops_are_recognized(spark):
    def classifier():
        return lambda crops: [{"label": c.split("-")[0], "score": 0.9} for c in crops]

    e = spark.createDataFrame([(1, "Markush-1"), (2, "clean-2"), (3, "noise-3"), (4, "odd-4"), (5, None)], "entity int, crop string")
    out = {r["entity"]: (r["markush"], r["smiles_from_image"]) for r in engines.image_channel(e, "crop", classifier, fragile, key).collect()}
    assert out == {1: (True, None), 2: (False, "clean-2"), 3: (False, None), 4: (False, "odd-4"), 5: (False, None)}
    routed = engines.routed_crops(e, "crop", absent).collect()
    assert {(r["crop_class"], r["class_score"], r["route"]) for r in routed} == {("clean", 0.0, "ocsr")}


def test_fetching_never_keeps_an_empty_page(spark):
    page = '<section itemprop="description">text {}'
    wanted = spark.createDataFrame([("A1",), ("B2",), ("C3",), ("A1",)], "pubnum string")
    cache = spark.createDataFrame([("A1", page.format(1)), ("Z9", "x")], "pubnum string, html string")
    pages, new = engines.fetched(wanted, cache, lambda: lambda ids: [{"html": page.format(i) if i == "B2" else "<p>blocked"} for i in ids])
    assert sorted(r["pubnum"] for r in pages.collect()) == ["A1", "B2"] and [r["pubnum"] for r in new.collect()] == ["B2"]
    assert [r["pubnum"] for r in engines.fetched(wanted, cache, None)[0].collect()] == ["A1"]
    sources = spark.createDataFrame([("x/A.PDF", "A1"), ("q.pdf", "Q1"), ("b 2", None), ("none", None)], "source string, file_pubnum string")
    read = lambda force: {r["source"]: (r["mode"], r["anomaly"]) for r in engines.resolved_sources(sources, pages, force).collect()}
    assert read(False) == {"x/A.PDF": ("structured", None), "q.pdf": ("pdf_ocr", "source_unavailable"), "b 2": ("structured", None), "none": ("error", "source_unavailable")}
    assert read(True)["x/A.PDF"] == ("pdf_ocr", None) and read(True)["b 2"][0] == "error"
    links = spark.createDataFrame([("u1",), ("u2",), ("u2",), ("u3",)], "url string")
    got = engines.fetched_images(links, spark.createDataFrame([("u1",)], "url string"), lambda: lambda urls: [{"content": b"x"} if u == "u2" else None for u in urls])
    assert [tuple(r) for r in got.collect()] == [("u2", bytearray(b"x"))]


def test_pages_and_their_prose(spark):
    files = spark.createDataFrame([("a", "2|1|" + "x " * 16), ("b", "2|0|" + "x" * 90), ("c", "2|1|xx"), ("d", None)], "doc string, content string")
    reader = lambda: lambda c: [dict(zip(("n_pages", "n_fonts", "text"), (int(x.split("|")[0]), int(x.split("|")[1]), x.split("|")[2]), strict=True)) for x in c]
    assert {r["doc"]: (r["n_pages"], r["has_text"]) for r in engines.documents(files, "content", reader).collect()} == {"a": (2, True), "b": (2, False), "c": (2, False), "d": (0, False)}
    own = spark.createDataFrame([("a", 1, 0, 2000, 1200), ("a", 1, 1, 10, 10), ("a", 2, 0, 900, 5000)], "doc string, page_no int, idx int, width int, height int")
    made = spark.createDataFrame([("a", n, 2480, 3508) for n in (1, 2, 3)], "doc string, page_no int, width int, height int")
    assert sorted((r["page_no"], r["idx"], r["source"]) for r in engines.page_rasters(own, made).collect()) == [(1, 0, "embedded"), (1, 1, "embedded"), (2, 0, "rendered"), (3, 0, "rendered")]
    pages = spark.createDataFrame([("a", n, f"p{n}") for n in (3, 1, 2)] + [("b", 1, None)], "doc string, page_no int, text string")
    assert {r["page_no"] for r in engines.chosen_pages(pages, [(2, 3), (9, 12)], 1).collect()} == {2, 3} and engines.chosen_pages(pages, None, 1).count() == 2
    assert {r["doc"]: r["prose"] for r in engines.page_prose(pages).collect()} == {"a": "p1\np2\np3", "b": ""}
    table = engines.standardized(spark.createDataFrame([("C",), ("x",)], "s string"), "s", lambda: lambda s: [{"smiles": "c", "inchikey": "K" * 20} if x == "C" else None for x in s])
    assert {r["s"]: (r["standard_smiles"], r["skeleton"], r["skipped"]) for r in table.collect()} == {"C": ("c", "K" * 14, False), "x": ("x", None, True)}
    assert engines.descriptors(spark.createDataFrame([("C",)], "s string"), "s", absent).select("mw", "qed").first() == (None, None)


def page(height, width, ys, xs):
    out = np.full((height, width), 255, np.uint8)
    for y in ys:
        out[y : y + 3, 20 : width - 20] = 0
    for x in xs:
        out[20 : height - 20, x : x + 3] = 0
    return out


def test_rulings_and_ink(spark):
    image = page(400, 600, (50, 150, 350), (40, 300, 560))
    image[200:230, 100:112] = 0  # a glyph
    rows = spark.createDataFrame([(bytearray(image.tobytes()), 600, 400), (bytearray(np.full((10, 10), 255, np.uint8).tobytes()), 10, 10)], "pixels binary, width int, height int").coalesce(1)
    found = rows.select(readings.rulings("pixels", "width", "height").alias("r")).collect()
    assert (found[0]["r"]["ys"], found[0]["r"]["xs"]) == ([51, 151, 351], [41, 301, 561]) and found[1]["r"]["ys"] == []
    box = lambda *b: F.struct(*[F.lit(x).alias(n) for x, n in zip(b, ("x0", "y0", "x1", "y1"), strict=True)])
    blank = lambda b: readings.is_blank(F.col("pixels"), F.col("width"), F.col("height"), b)
    one = rows.limit(1).select(blank(box(40, 150, 300, 350)), blank(box(300, 150, 560, 350)), blank(box(5, 5, 5, 50)), readings.ink_share(F.col("pixels"), F.col("width"), F.col("height"), box(100, 200, 124, 230))).first()
    assert tuple(one) == (False, True, True, 0.5)
    runs = np.array([[1, 1, 0, 1, 1, 1], [1, 1, 1, 1, 0, 1]], bool)
    assert readings.long_runs(runs, 3).tolist() == [[False, False, False, True, True, True], [True, True, True, True, False, False]]
    opinion = spark.range(1).select(readings.looks_ruled(F.lit(1), F.lit(2)), readings.looks_ruled(F.lit(1), F.lit(1)), readings.wants_second_opinion(F.lit(1.0), F.lit(2)), readings.column_text(F.array(F.lit("a"), F.lit(None), F.lit("b"), F.lit("c")))).first()
    assert tuple(opinion) == (True, False, False, "a\nb")


def test_longest_number_wins(spark):
    rng = random.Random(3)
    rows = [([rng.choice(["4", "41", "-", "5 6", "x"]) for _ in range(rng.randint(0, 4))], [rng.choice(["4", "6", "16"]) for _ in range(rng.randint(0, 2))]) for _ in range(200)]
    out = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", readings.number(F.col("a"), F.col("b")).alias("n")).collect()
    for r in out:
        own, other = ([x for t in c for x in t.split() if x.isdigit()] for c in (r["a"], r["b"]))
        every = own + other
        assert r["n"] == (int(max(every, key=lambda v: (len(v), v in own, every.count(v)))) if every else None)


def test_a_run_and_its_evaluation(spark, tmp_path, capsys):
    pages = spark.createDataFrame(
        [("d", 1, True, [0.0, 50.0], 100.0, [["Cmpd. No.", "WIZ EC50 (uM)"], ["1", "A"], ["2", "Cc"]]), ("d", 2, False, [0.0, 51.0], 100.0, [["3", ""], ["4", "Q"], ["2", "A"]])],
        "doc string, page_no int, has_header boolean, xs array<double>, width double, rows array<array<string>>",
    )
    text = "having WIZ EC50 less than 1 nM are level A. having WIZ EC50 greater than 5 nM are level C."
    names = "doc string, entity_seq long, number int, qed double, mw double, parse_status string, tier string, broken array<string>, min_atom double, min_bond double, heavy_atoms int, markush boolean"
    entities = spark.createDataFrame([("d", n, n, 0.5, 300.0, "FAILURE" if n == 4 else "SUCCESS", "AGREE_FULL", [], None, None, 20, False) for n in range(1, 5)], names)
    source = {"pages": pages, "prose": spark.createDataFrame([("d", text)], "doc string, text string"), "entities": entities}
    for name, df in source.items():
        df.write.parquet(str(tmp_path / "in" / name))
    out = str(tmp_path / "out")
    assert run.main(["run", str(tmp_path / "in"), "--out", out, "--pubnum", "P1", "--run-id", "r1"], spark) == 0
    manifest = bundles.read_manifest(spark, out).first()
    assert manifest["counts"]["measurements"] == 2 and set(manifest["stage_seconds"]) >= {"stitch", "measure", "rank"} and manifest["versions"]["pyspark"] != "absent"
    ranked = bundles.read_bundle(spark, out, "entities", "P1", "r1", {"a potency is a sum of scores": F.coalesce(F.col("potency") > 0, F.lit(True))})
    assert {r["number"]: (r["potency"], r["rank"]) for r in ranked.collect()} == {1: (2, 1), 2: (1, 2), 3: (None, None), 4: (None, None)}
    assert [(r["kind"], r["raw"]) for r in bundles.read_bundle(spark, out, "refusals", "P1", "r1").collect()] == [("unit_missing", "Q")]
    assert {(r["entity_seq"], r["trigger"]) for r in bundles.read_bundle(spark, out, "review", "P1", "r1").collect()} == {(4, "opsin_parse_failure")}
    gold = tmp_path / "gold.json"
    gold.write_text("\n".join(json.dumps({"id": i, "assay": "WIZ ECS0", "value": v}) for i, v in (("1", "A"), ("2", "B"), ("3", None))))
    capsys.readouterr()
    assert run.main(["evaluate", out, "P1", "r1", "--gold", str(gold), "--json"], spark) == 0
    told = json.loads(capsys.readouterr().out)
    assert (told["correct"], told["wrong"], told["accuracy"]) == ("1", "1", "0.500")
    scored = tmp_path / "scored.json"
    scored.write_text("\n".join(json.dumps({"confidence": c, "is_error": c < 0.4}) for c in (0.1, 0.2, 0.5, 0.9)))
    assert run.main(["calibrate", str(scored)], spark) == 0
    assert [r["threshold"] for r in json.loads(capsys.readouterr().out) if r["best"]] == [0.25]


def test_stages_are_told_and_timed_also_when_they_fail(tmp_path, monkeypatch):
    heard = []
    r = run.Recorder(lambda *x: heard.append(x), ("a", "b"))
    try:
        with r.stage("a"):
            raise ValueError
    except ValueError:
        pass
    assert heard == [("a", "start", 1, 2), ("a", "end", 1, 2)] and r.seconds["a"] >= 0 and r.over_budget(1) and not r.over_budget(1e9)
    monkeypatch.setenv("EVIDTABLE_CONFIDENCE", "much")
    monkeypatch.setenv("EVIDTABLE_TARGET", "ABC")
    monkeypatch.delenv("EVIDTABLE_HEAVY_ATOMS", raising=False)
    (tmp_path / "env").write_text("# x\nEVIDTABLE_TARGET=no\nEVIDTABLE_HEAVY_ATOMS='55'\nodd\n")
    run.read_settings(str(tmp_path / "env"))
    run.read_settings(str(tmp_path / "missing"))
    c = run.Config()
    assert (c.confidence, c.target, c.heavy_atoms) == (0.85, "ABC", 55)
    monkeypatch.delenv("EVIDTABLE_HEAVY_ATOMS")
