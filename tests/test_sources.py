"""Pages, bundles, small text functions, grids and the streaming form."""

from pyspark.sql import functions as F

from evidtable.functions import text as T
from evidtable.operators import tables
from evidtable.sources import bundles, html
from evidtable.streaming.sequences import standardized


def test_html(spark):
    page = '<title>T &amp; t</title><section itemprop="description">a<br> b<table><tr><td>1<td>2</tr></table></section><a href="x">y</a><script>z'
    row = spark.createDataFrame([(page,), (None,)], "h string").select(html.html_fields("h").alias("f"), html.html_tables("h").alias("t"), html.sanitize(F.col("h"))).collect()
    assert (row[0]["f"]["title"], row[0]["f"]["description"], row[0]["f"]["n_links"]) == ("T & t", "a b12", 1)
    assert row[0]["t"] == [[["1", "2"]]] and row[1]["f"]["title"] is None


def test_bundles(spark, tmp_path):
    df = spark.createDataFrame([("P1", "20250101T000000", 1), ("P1", "20250201T000000", 2)], "pubnum string, run_id string, v int")
    bundles.write_bundle({"m": df}, str(tmp_path))
    assert [r["v"] for r in bundles.read_bundle(spark, str(tmp_path), "m", "P1", "20250201T000000").collect()] == [2]
    assert {(r["run_id"], r["latest"]) for r in bundles.runs(spark, str(tmp_path), "m").collect()} == {("20250101T000000", False), ("20250201T000000", True)}


def test_text(spark):
    one = spark.range(1).select(
        T.interval_text(F.lit(0.5), F.lit(None).cast("double")), T.clean_ocr_name(F.lit("ab\ncd-\n1")), T.split_pair(F.lit(" & x & y"))["n"], T.mentioned_ids(F.lit("Compound 7 and compound 9")), T.publication_number(F.lit("wo 2024/1-a1")), T.first_integer(F.lit("l2 x")), T.dehyphenate(F.lit("a- b"))
    ).first()
    assert tuple(one) == ("> 0.5", "ab cd-1", 2, ["7", "9"], "WO20241A1", 12, "ab")


def test_cells_of_a_grid(spark):
    g = spark.createDataFrame([("d", [0, 5, 15, 30], [0, 10, 20])], "doc string, xs array<int>, ys array<int>")
    assert tables.grid_cells(g).count() == 6


def test_stream(spark, tmp_path):
    spark.createDataFrame([(">10", "uM")], "raw string, units string").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("raw string, units string").parquet(str(tmp_path / "in"))
    q = standardized(s, "raw", "units").select("standard.*").writeStream.format("memory").queryName("std").start()
    q.processAllAvailable()
    q.stop()
    assert tuple(spark.table("std").first()) == (10000.0, "nM", ">")


def test_page_sections_equal_their_sql_on_odd_titles(spark, tmp_path):
    import duckdb

    import __spark_entry__

    titles = ["a &lt;b&gt; &amp;amp; c", "x&amp", "&quot;q&quot; &#65;", " a\n\t b  c ", "", "ſ K"]
    pages = [f"<html><TITLE lang='x'>{t}</Title ><title>{t}</title></html>" for t in titles] + [f"<h1 id='title'>h</h1><title>{t}</title>" for t in titles] + ["<title>open", "no title", "", None, '<meta name="DC.title" content="m"><title>\nt</title>']
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = __spark_entry__.queries()["page_sections"](spark, str(tmp_path)).select("page_id", "title").collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(f"SELECT page_id, title FROM ({__spark_entry__.oracle_sql()['page_sections']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
