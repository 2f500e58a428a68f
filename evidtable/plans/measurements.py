"""Queries on the star-schema tables: cells, units, sequences, ranks, evaluation, review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import linking, review, scoring, tables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def big(c: str):  # noqa: ANN201
    return F.col(c).cast("long")


_CELL = "CASE l_linenumber % 7 WHEN 1 THEN '>' WHEN 2 THEN '< ' WHEN 3 THEN '>=' WHEN 4 THEN '≤' ELSE '' END || CASE l_linenumber % 7 WHEN 5 THEN '-' WHEN 6 THEN 'Aa' ELSE {} END"


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    number = "format_number(cast(l_quantity as bigint) * 1234, 0)"
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.expr(_CELL.format(number)).alias("raw"))


_CELL_SQL = f"SELECT l_orderkey, l_linenumber, l_quantity, {_CELL.format("format('{:,}', CAST(l_quantity AS BIGINT) * 1234)")} AS raw FROM lineitem"


@query(rf"""WITH c AS ({_CELL_SQL})
SELECT l_orderkey, l_linenumber, raw, CASE l_linenumber % 7 WHEN 1 THEN '>' WHEN 2 THEN '<' WHEN 3 THEN '>=' WHEN 4 THEN '<=' ELSE '=' END AS relation,
CASE WHEN l_linenumber % 7 IN (5, 6) THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) * 1234 AS DOUBLE) END AS value,
CASE WHEN l_linenumber % 7 = 6 THEN 'Aa' END AS text, l_linenumber % 7 = 5 AS is_blank FROM c""")
def cell_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _cells(spark, sf).select("l_orderkey", "l_linenumber", "raw", V.parse_cell(F.col("raw")).alias("p")).select("l_orderkey", "l_linenumber", "raw", "p.*")


_UNITS = ["nM", "µM", "μM", "pM", "(mM)", "M", "nm", "%", "percent", "Molar", "mg/mL", " nM. ", "xM", "pct", "NM"]
_UNITS_OUT = ["nM", "uM", "uM", "uM", "mM", "M", "nm", "%", "%", "M", None, "nM", None, "%", "nM"]


@query("WITH u(i, raw, unit) AS (VALUES " + ", ".join(f"({i}, '{u}', {'NULL' if o is None else repr(o)})" for i, (u, o) in enumerate(zip(_UNITS, _UNITS_OUT, strict=True))) + """)
SELECT p_partkey, raw, unit, p_size * CASE unit WHEN 'M' THEN 1e9 WHEN 'mM' THEN 1e6 WHEN 'uM' THEN 1e3 WHEN 'nM' THEN 1.0 END AS value_nm FROM part JOIN u ON p_partkey % 15 = i""")
def unit_normalize(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.element_at(F.array(*map(F.lit, _UNITS)), (F.col("p_partkey") % len(_UNITS) + 1).cast("int"))
    return read(spark, sf, "part").select("p_partkey", raw.alias("raw"), "p_size").select("p_partkey", "raw", V.normalize_units(F.col("raw")).alias("unit"), V.to_nm(F.col("p_size").cast("double"), F.col("raw")).alias("value_nm"))


_KIND = "CASE l_linenumber % 3 WHEN 0 THEN 'DC50' WHEN 1 THEN 'IC50' ELSE 'pIC50' END"
_UNIT = "CASE l_orderkey % 4 WHEN 0 THEN 'uM' WHEN 1 THEN 'nM' WHEN 2 THEN '%' ELSE NULL END"


@query(f"""WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity / 10 AS v, {_KIND} AS kind, {_UNIT} AS unit, CASE WHEN l_returnflag = 'N' THEN '=' ELSE '>' END AS rel FROM lineitem),
s AS (SELECT *, CASE WHEN kind = 'pIC50' THEN pow(10, 9 - v) WHEN unit = 'uM' THEN v * 1000 WHEN unit IS NOT NULL THEN v END AS value,
CASE WHEN kind = 'pIC50' OR unit IN ('uM', 'nM') THEN 'nM' ELSE unit END AS units, CASE WHEN kind = 'pIC50' AND rel = '>' THEN '<' ELSE rel END AS relation FROM b)
SELECT l_orderkey, l_linenumber, kind, round(value, 6) AS value, CASE WHEN value IS NOT NULL THEN units END AS units, CASE WHEN value IS NOT NULL THEN relation END AS relation, value IS NULL AS refused,
CASE WHEN kind = 'IC50' AND units = 'nM' AND relation = '=' AND value > 0 THEN round(9 - log10(value), 6) END AS pchembl, CASE WHEN kind = 'DC50' AND units = 'nM' AND relation = '=' AND value > 0 THEN round(9 - log10(value), 6) END AS pdc50 FROM s""")
def measure_build(spark: SparkSession, sf: str) -> DataFrame:
    b = read(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity / 10 AS v", f"{_KIND} AS kind", f"{_UNIT} AS unit", "CASE WHEN l_returnflag = 'N' THEN '=' ELSE '>' END AS rel")
    s = b.withColumn("s", V.standardize(F.col("v"), F.col("rel"), F.col("unit"), F.col("kind") == "pIC50"))
    p = V.pchembl(F.col("kind"), F.col("s.relation"), F.col("s.value"), F.col("s.units"))
    d = F.when((F.col("kind") == "DC50") & (F.col("s.units") == "nM"), V.pdc50(F.col("s.value"), F.col("s.relation")))
    return s.select("l_orderkey", "l_linenumber", "kind", F.round("s.value", 6).alias("value"), F.col("s.units").alias("units"), F.col("s.relation").alias("relation"), F.col("s").isNull().alias("refused"), F.round(p, 6).alias("pchembl"), F.round(d, 6).alias("pdc50"))


_BINS = [("A", 66.0, 100.0, "%"), ("B", 33.0, 66.0, "%"), ("C", None, 33.0, "%"), ("D", None, 10.0, "nM"), ("E", 0.01, 0.1, "uM"), ("F", 0.1, None, "uM"), ("F", 0.5, None, "uM")]
_BIN_VALUES = ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in _BINS)
_BIN_LABEL = "element_at(array('A','B','Cc','D','E.','F','Z'), cast(o_orderkey % 7 + 1 as int))"


@query(f"""WITH b(label, lower, upper, units) AS (VALUES {_BIN_VALUES}), ok AS (SELECT * FROM b WHERE label IN (SELECT label FROM b GROUP BY label HAVING count(*) = 1)),
o AS (SELECT o_orderkey, ['A','B','Cc','D','E.','F','Z'][o_orderkey % 7 + 1] AS raw, ['A','B','C','D','E','F','Z'][o_orderkey % 7 + 1] AS label FROM orders)
SELECT o_orderkey, raw, round(lower * CASE WHEN units = 'uM' THEN 1000 ELSE 1 END, 6) AS lower, round(upper * CASE WHEN units = 'uM' THEN 1000 ELSE 1 END, 6) AS upper, CASE WHEN units = 'uM' THEN 'nM' ELSE units END AS units,
CASE WHEN ok.label IS NULL THEN NULL WHEN lower IS NULL THEN '<' WHEN upper IS NULL THEN '>' ELSE '=' END AS relation FROM o LEFT JOIN ok USING (label)""")
def bin_decode_interval(spark: SparkSession, sf: str) -> DataFrame:
    bins = spark.createDataFrame(_BINS, "label string, lower double, upper double, units string")
    ok = tables_unique(bins, "label")
    o = read(spark, sf, "orders").selectExpr("o_orderkey", f"{_BIN_LABEL} AS raw").withColumn("label", V.bin_key(F.col("raw")))
    f = F.when(F.col("units").isNotNull(), V.bin_fields(F.col("lower"), F.col("upper"), F.col("units")))
    return o.join(ok, "label", "left").select("o_orderkey", "raw", f.alias("f")).select("o_orderkey", "raw", F.round("f.lower", 6).alias("lower"), F.round("f.upper", 6).alias("upper"), "f.units", "f.relation")


def tables_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key no other row has: an ambiguous label decodes to nothing."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(key))).where("_n = 1").drop("_n")


@query("""WITH e AS (SELECT event_id, user_id, event_type, (1 + event_id % 50) * CASE event_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1000.0 ELSE 1000000.0 END AS v FROM events)
SELECT a.user_id, a.event_type, a.event_id AS seq_a, b.event_id AS seq_b, a.v AS v_a, b.v AS v_b FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.event_id < b.event_id
WHERE abs(abs(log10(a.v) - log10(b.v)) - 3) <= 1e-9 OR abs(abs(log10(a.v) - log10(b.v)) - 6) <= 1e-9""")
def qc_decade_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").selectExpr("event_id", "user_id", "event_type", "'nM' AS units", "(1 + event_id % 50) * CASE event_id % 3 WHEN 0 THEN 1.0D WHEN 1 THEN 1000.0D ELSE 1000000.0D END AS v")
    return scoring.transcription_pairs(e, ["user_id", "event_type"], "units", "v", "event_id")


@query("""SELECT p_partkey, NOT (p_retailprice * 100 BETWEEN 0.01 AND 1e5) AS outside, coalesce(abs(log10(p_retailprice) - log10(p_size * 100)) > 0.3, false) AS differs, round(1.37 * p_retailprice / p_size, 6) AS le FROM part""")
def qc_ranges(spark: SparkSession, sf: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return read(spark, sf, "part").select("p_partkey", V.outside_typical_range(F.lit("IC50"), price * 100, F.lit("nM")).alias("outside"), V.meaningful_difference(price, size * 100).alias("differs"), F.round(V.efficiency(price, size, size, size, size)["le"], 6).alias("le"))


@query("""WITH s AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n, max(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM lineitem)
SELECT l_orderkey, n, count(*) AS n_rows, count(*) FILTER (m IS NULL OR n > m) AS n_accepted FROM s GROUP BY ALL""")
def seq_accept(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"), big("l_quantity").alias("n"))
    return tables.accept_increasing(d, "l_orderkey", "seq", "n").groupBy("l_orderkey", "n").agg(F.count("*").alias("n_rows"), F.count_if("accepted").alias("n_accepted"))


@query("""WITH k AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq, CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS n FROM lineitem),
p AS (SELECT *, lag(n) OVER (PARTITION BY doc ORDER BY seq) AS q FROM k WHERE n IS NOT NULL), x AS (SELECT doc, n, lead(n) OVER (PARTITION BY doc ORDER BY n) AS m FROM (SELECT DISTINCT doc, n FROM k WHERE n IS NOT NULL))
SELECT doc, 'unreadable' AS kind, CAST(NULL AS BIGINT) AS number, CAST(NULL AS BIGINT) AS until FROM k WHERE n IS NULL UNION ALL SELECT doc, 'duplicate', n, NULL FROM k WHERE n IS NOT NULL GROUP BY doc, n HAVING count(*) > 1
UNION ALL SELECT doc, 'order', n, NULL FROM p WHERE n < q UNION ALL SELECT doc, 'gap', n + 1, m - 1 FROM x WHERE m > n + 1""")
def seq_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    d = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.row_number().over(w).alias("seq"), F.when(F.col("l_returnflag") != "R", big("l_quantity")).alias("n"))
    return tables.sequence_anomalies(d, "doc", "seq", "n")


@query("""WITH e AS (SELECT user_id, event_id, event_type, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d, ts FROM events),
m AS (SELECT *, CASE WHEN d - lag(d) OVER w <= 1 AND event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS table_id FROM m)
SELECT user_id, CAST(table_id AS BIGINT) AS table_id, count(*) AS n, CAST(min(d) AS BIGINT) AS first_page, CAST(max(d) AS BIGINT) AS last_page FROM s GROUP BY ALL""")
def sessionize_stitch(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("user_id", "event_id", "event_type", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("d"), "ts")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    linked = (F.col("d") - F.lag("d").over(w) <= 1) & (F.col("event_type") == F.lag("event_type").over(w))
    return tables.sessions(e, "user_id", ["ts", "event_id"], linked).groupBy("user_id", "table_id").agg(F.count("*").alias("n"), F.min("d").cast("long").alias("first_page"), F.max("d").cast("long").alias("last_page"))


@query("""WITH p AS (SELECT DISTINCT l_suppkey, CAST(l_extendedprice AS BIGINT) // 100 AS x FROM lineitem), s AS (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY l_suppkey ORDER BY x) <= 8 THEN 0 ELSE 1 END AS new FROM p),
g AS (SELECT *, sum(new) OVER (PARTITION BY l_suppkey ORDER BY x) AS g FROM s) SELECT l_suppkey, CAST(floor(avg(x)) AS BIGINT) AS coordinate, count(*) AS n FROM g GROUP BY l_suppkey, g""")
def group_rulings(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "lineitem").select("l_suppkey", F.expr("cast(round(l_extendedprice) as bigint) div 100").alias("x")).distinct()
    return tables.group_positions(p, ["l_suppkey"], "x")


@query("""WITH RECURSIVE e AS (SELECT l_orderkey AS k, CAST(l_quantity AS INT) AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_quantity AS INT)) AS i FROM lineitem),
m AS (SELECT k, i, [x] AS acc FROM e WHERE i = 1 UNION ALL SELECT m.k, e.i, CASE WHEN e.x - m.acc[-1] <= 8 THEN m.acc[:-2] || [(m.acc[-1] + e.x) // 2] ELSE m.acc || [e.x] END FROM m JOIN e ON e.k = m.k AND e.i = m.i + 1),
d AS (SELECT k, arg_max(acc, i) AS acc FROM m GROUP BY k), b(k, acc, j, kept) AS (SELECT k, acc, 1, [acc[1]] FROM d UNION ALL SELECT k, acc, j + 1, CASE WHEN acc[j + 1] - kept[-1] >= 12 THEN kept || [acc[j + 1]] ELSE kept END FROM b WHERE j < len(acc))
SELECT k AS l_orderkey, array_to_string(arg_max(acc, j), ',') AS rulings, array_to_string(arg_max(kept, j), ',') AS bands FROM b GROUP BY k""")
def merge_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_quantity").cast("int")).alias("edges"))
    return e.select("l_orderkey", F.array_join(tables.merge_edges(F.col("edges")), ",").alias("rulings"), F.array_join(tables.merge_edges(F.col("edges"), least_band=12), ",").alias("bands"))


_BOX = "p_partkey % 97 AS x0, p_partkey % 89 AS y0, p_partkey % 97 + p_size AS x1, p_partkey % 89 + 20 AS y1"


@query(f"""WITH a AS (SELECT p_partkey, p_size % 7 AS page, {_BOX} FROM part), b AS (SELECT s_suppkey, s_suppkey % 7 AS page, s_suppkey % 97 AS x0, s_suppkey % 89 AS y0, s_suppkey % 97 + 25 AS x1, s_suppkey % 89 + 20 AS y1 FROM supplier),
j AS (SELECT p_partkey, s_suppkey, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS t FROM a JOIN b USING (page))
SELECT p_partkey, s_suppkey, round(i / (t - i), 6) AS iou FROM j WHERE i / (t - i) >= 0.5""")
def iou_agreement(spark: SparkSession, sf: str) -> DataFrame:
    box = lambda k, wide: F.expr(f"struct({k} % 97 AS x0, {k} % 89 AS y0, {k} % 97 + {wide} AS x1, {k} % 89 + 20 AS y1)")
    a = read(spark, sf, "part").select("p_partkey", (F.col("p_size") % 7).cast("long").alias("page"), box("p_partkey", "p_size").alias("a"))
    b = read(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 7).alias("page"), box("s_suppkey", "25").alias("b"))
    return tables.agreeing(a, b, ["page"], "a", "b", 0.5).select("p_partkey", "s_suppkey", F.round(tables.iou("a", "b"), 6).alias("iou"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders), c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 3 THEN c_custkey END AS number FROM customer)
SELECT 'linked' AS status, c_custkey, o_orderkey FROM c JOIN r ON number = o_custkey AND k = 1 UNION ALL SELECT 'left', c_custkey, NULL FROM c WHERE number IS NULL OR number NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'right', NULL, o_orderkey FROM r WHERE k = 1 AND o_custkey NOT IN (SELECT number FROM c WHERE number IS NOT NULL)""")
def link_exact_anti(spark: SparkSession, sf: str) -> DataFrame:
    left = read(spark, sf, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 10 <> 3 THEN c_custkey END").alias("number"))
    right = read(spark, sf, "orders").select(F.col("o_custkey").alias("number"), "o_orderkey")
    linked, lonely, stray = linking.link_keyed(left, right, "number", "o_orderkey")
    null = F.lit(None).cast("long")
    say = lambda s, d, c=F.col("c_custkey"), o=F.col("o_orderkey"): d.select(F.lit(s).alias("status"), c.alias("c_custkey"), o.alias("o_orderkey"))
    return say("linked", linked).unionByName(say("left", lonely, o=null)).unionByName(say("right", stray, c=null))


def _examples(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Entities in documents of 50, and an example for each: told by its key, by its misspelt name, by its skeleton, or by nothing."""
    doc, key = F.expr("concat('D', p_partkey div 50)"), F.upper(F.md5(F.col("p_partkey").cast("string")))
    p = read(spark, sf, "part").select(doc.alias("doc"), F.col("p_partkey").alias("entity_seq"), key.alias("full_key"), F.substring(key, 1, 14).alias("skeleton"), F.sha1(F.col("p_partkey").cast("string")).alias("name"))
    at = lambda k, c: F.when(F.col("entity_seq") % 4 == k, c)
    e = p.select(
        "doc", F.col("entity_seq").alias("example_seq"), at(0, F.col("full_key")).alias("full_key"), F.coalesce(at(0, F.col("skeleton")), at(2, F.col("skeleton"))).alias("skeleton"),
        F.coalesce(at(0, F.col("name")), at(1, F.concat("name", F.lit("x"))), F.lit("q")).alias("name"),
    )
    return p, e


@query("""SELECT 'D' || CAST(p_partkey // 50 AS VARCHAR) AS doc, p_partkey AS example_seq, p_partkey AS entity_seq, CASE p_partkey % 4 WHEN 0 THEN 'full' WHEN 1 THEN 'name' ELSE 'skeleton' END AS method,
CASE p_partkey % 4 WHEN 0 THEN 'full,name,skeleton' WHEN 1 THEN 'name' ELSE 'skeleton' END AS agreed FROM part WHERE p_partkey % 4 < 3""")
def link_precedence(spark: SparkSession, sf: str) -> DataFrame:
    p, e = _examples(spark, sf)
    return linking.claim(linking.precedence_candidates(e, p)).select("doc", "example_seq", "entity_seq", "method", F.array_join("agreed", ",").alias("agreed"))


@query("""WITH a AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE md5(CAST(quality AS VARCHAR)) END AS a, CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 7 = 0 THEN left(md5(CAST(toxic AS VARCHAR)), 14) || 'X' ELSE md5(CAST(toxic AS VARCHAR)) END AS b FROM labels),
k AS (SELECT doc_id, nullif(trim(a), '') AS a, nullif(trim(b), '') AS b FROM a), t AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'NONE' WHEN a IS NULL OR b IS NULL THEN 'SINGLE_SOURCE' WHEN a = b THEN 'AGREE_FULL' WHEN left(a, 14) = left(b, 14) THEN 'AGREE_SKELETON' ELSE 'CONFLICT' END AS tier FROM k)
SELECT doc_id, tier, coalesce(a, b) AS key, left(coalesce(a, b), 14) AS skeleton, CASE WHEN tier LIKE 'AGREE%' THEN 'name+image' WHEN a IS NOT NULL THEN 'name' WHEN b IS NOT NULL THEN 'image' ELSE 'none' END AS source FROM t""")
def tier_crosscheck(spark: SparkSession, sf: str) -> DataFrame:
    h = F.md5(F.col("toxic").cast("string"))
    d = read(spark, sf, "labels").select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(" ")).otherwise(F.md5(F.col("quality").cast("string"))).alias("a"),
        F.when(F.col("doc_id") % 4 != 1, F.when(F.col("doc_id") % 7 == 0, F.concat(F.substring(h, 1, 14), F.lit("X"))).otherwise(h)).alias("b"),
    )
    return d.select("doc_id", linking.cross_check(F.col("a"), F.col("b")).alias("c")).select("doc_id", "c.*")


_SCORE = "CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 END"
_RANK_SQL = f"""s AS (SELECT o_custkey, {_SCORE} AS b FROM orders), p AS (SELECT o_custkey, sum(b) AS potency, count(*) FILTER (b = 3) AS top_bins FROM s GROUP BY o_custkey),
e AS (SELECT c_custkey, potency, coalesce(top_bins, 0) AS top_bins, CASE WHEN c_custkey % 3 > 0 THEN round(c_acctbal) END AS qed FROM customer LEFT JOIN p ON c_custkey = o_custkey),
r AS (SELECT *, row_number() OVER (ORDER BY potency DESC, top_bins DESC, qed DESC NULLS LAST, c_custkey) AS rank, dense_rank() OVER (ORDER BY potency DESC, top_bins DESC) AS tie_group FROM e WHERE potency IS NOT NULL),
t AS (SELECT *, count(*) OVER (PARTITION BY tie_group) AS tie_size, CASE WHEN lag(potency) OVER w IS NULL THEN 'top' WHEN potency <> lag(potency) OVER w THEN 'potency' WHEN top_bins <> lag(top_bins) OVER w THEN 'top-bin count' WHEN qed IS DISTINCT FROM lag(qed) OVER w THEN 'QED' ELSE 'tied' END AS signal FROM r WINDOW w AS (ORDER BY rank))"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    scores = read(spark, sf, "orders").select("o_custkey", F.expr(_SCORE).alias("bin_score"))
    c = read(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.round("c_acctbal")).alias("qed"), F.lit(None).cast("double").alias("mw"))
    return c.join(scoring.potency(scores, "o_custkey").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").withColumn("top_bins", F.coalesce("top_bins", F.lit(0).cast("long")))


@query(f"WITH {_RANK_SQL} SELECT c_custkey, CAST(potency AS BIGINT) AS potency, top_bins, qed, rank, tie_group, tie_size, signal FROM t UNION ALL SELECT c_custkey, NULL, top_bins, qed, NULL, NULL, NULL, NULL FROM e WHERE potency IS NULL")
def rank_tiegroups(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.rank(_scored(spark, sf), "c_custkey").select("c_custkey", "potency", "top_bins", "qed", "rank", "tie_group", "tie_size", "signal")


@query(f"WITH {_RANK_SQL} SELECT c_custkey, rank, tie_group FROM t WHERE rank <= 10")
def shortlist_top10(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.shortlist(_scored(spark, sf), "c_custkey", 10).select("c_custkey", "rank", "tie_group")


_LSCORE = "CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 30 THEN 2 WHEN l_quantity < 45 THEN 3 END"


_ASSAY = "CASE l_returnflag WHEN 'A' THEN 'wiz' WHEN 'N' THEN 'ZBTB7A assay' ELSE 'x WIZ y' END"


@query(f"""WITH s AS (SELECT l_orderkey, l_returnflag, {_LSCORE} AS b, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem),
a AS (SELECT l_orderkey, coalesce(arg_min(b, k) FILTER (l_returnflag = 'A' AND b IS NOT NULL), arg_min(b, k) FILTER (l_returnflag = 'R' AND b IS NOT NULL)) AS a, arg_min(b, k) FILTER (l_returnflag = 'N' AND b IS NOT NULL) AS n FROM s GROUP BY l_orderkey) SELECT l_orderkey, CAST(a - n AS BIGINT) AS selectivity FROM a""")
def selectivity(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    s = read(spark, sf, "lineitem").select("l_orderkey", F.expr(_ASSAY).alias("assay"), F.expr(_LSCORE).alias("bin_score"), F.row_number().over(w).alias("k"))
    return scoring.selectivity(s, "l_orderkey", "assay", "WIZ", "ZBTB7A", "k").withColumn("selectivity", big("selectivity"))


_FLAGS = ("A", "N", "R")


@query("WITH s AS (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS BIGINT) AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) SELECT l_orderkey, " + ", ".join(f"coalesce(CAST(arg_max(v, k) FILTER (l_returnflag = '{f}') AS VARCHAR), '') AS {f}" for f in _FLAGS) + " FROM s GROUP BY l_orderkey")
def wide_pivot(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    s = read(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", big("l_quantity").cast("string").alias("v"), F.row_number().over(w).alias("k"))
    return tables.wide(s, "l_orderkey", "l_returnflag", "v", "k", _FLAGS)


_EVAL_SQL = """r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq FROM lineitem),
v AS (SELECT l_orderkey, seq, CASE l_linenumber % 3 WHEN 0 THEN 'WIZ' WHEN 1 THEN 'ZBTB7A' ELSE 'HIBIT' || CAST(l_linenumber AS VARCHAR) END AS assay, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS said,
  CASE WHEN l_returnflag = 'R' THEN '' WHEN l_returnflag = 'A' THEN 'B' || CAST(l_linenumber AS VARCHAR) ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || CASE WHEN l_orderkey % 13 = 0 THEN '0' ELSE '' END END AS got FROM r),
p AS (SELECT l_orderkey AS id, assay, arg_max(got, seq) AS value FROM v WHERE got <> '' GROUP BY ALL),
g AS (SELECT l_orderkey + CASE WHEN l_orderkey % 17 = 0 THEN 1000000000 ELSE 0 END AS id, assay, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE arg_max(said, seq) END AS value FROM v GROUP BY l_orderkey, assay),
s AS (SELECT coalesce(g.id, p.id) AS id, coalesce(g.assay, p.assay) AS assay, g.value AS expected, p.value AS got, CASE WHEN g.id IS NULL THEN 'unlisted' WHEN g.value IS NULL AND p.value IS NOT NULL THEN 'spurious' WHEN g.value IS NULL THEN 'blank' WHEN p.value IS NULL THEN 'missing' WHEN p.value = g.value THEN 'correct' ELSE 'wrong' END AS status FROM g FULL JOIN p ON g.id = p.id AND g.assay = p.assay)"""


def _status(spark: SparkSession, sf: str) -> DataFrame:
    """Gold has the last quantity of each assay of an order, without some values and under other ids; predictions come from measurements, the last that says something."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    said = big("l_quantity").cast("string")
    m = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("entity"), F.row_number().over(w).alias("seq"), F.when(F.col("l_linenumber") % 3 == 0, " wiz").when(F.col("l_linenumber") % 3 == 1, "").alias("target"),
        F.when(F.col("l_linenumber") % 3 == 1, F.lit("zbt b7a (uM)")).otherwise(F.concat(F.lit("HiBiT #"), "l_linenumber")).alias("name"), F.when(F.col("l_returnflag") == "A", F.concat(F.lit("B"), "l_linenumber")).alias("bin_label"),
        F.when(F.col("l_returnflag") != "R", F.concat(said, F.when(F.col("l_orderkey") % 13 == 0, "0").otherwise(""))).otherwise("").alias("published_value"), said.alias("said"),
    )
    pred = scoring.predicted_values(m, m.select("entity", F.col("entity").alias("local_id")).distinct())
    ident = F.expr("entity + CASE WHEN entity % 17 = 0 THEN 1000000000 ELSE 0 END").alias("id")
    last = m.select("entity", ident, "seq", scoring.assay_identity(F.col("target"), F.col("name")).alias("assay"), "said").groupBy("entity", "id", "assay").agg(F.max_by("said", "seq").alias("said"))
    gold = last.select("id", "assay", F.when(F.col("entity") % 11 != 0, F.col("said")).alias("value"))
    return scoring.cell_status(gold, pred)


@query(f"WITH {_EVAL_SQL} SELECT * FROM s")
def eval_cells(spark: SparkSession, sf: str) -> DataFrame:
    return _status(spark, sf)


@query(f"""WITH {_EVAL_SQL}, c AS (SELECT count(*) FILTER (status = 'correct') AS correct, count(*) FILTER (status = 'wrong') AS wrong, count(*) FILTER (status = 'missing') AS missing, count(*) FILTER (status = 'spurious') AS spurious, count(*) FILTER (status IN ('correct', 'wrong', 'missing')) AS gold_total, count(*) FILTER (status IN ('correct', 'wrong', 'spurious', 'unlisted')) AS predicted_total FROM s)
SELECT *, round(correct / (gold_total + spurious), 6) AS accuracy, round(correct / predicted_total, 6) AS precision, round(correct / gold_total, 6) AS recall, round(2 * (correct / predicted_total) * (correct / gold_total) / (correct / predicted_total + correct / gold_total), 6) AS f1 FROM c""")
def eval_triplets(spark: SparkSession, sf: str) -> DataFrame:
    out = scoring.evaluate(_status(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query("""WITH s AS (SELECT (doc_id * 37 % 101) / 101 AS c, quality = 0 AS e FROM labels), t AS (SELECT i / 20 AS threshold FROM range(0, 21) r(i)),
a AS (SELECT threshold, count(*) FILTER (c < threshold) AS flagged, count(*) FILTER (c < threshold AND e) AS caught, count(*) FILTER (e) AS errors FROM t, s GROUP BY threshold),
p AS (SELECT threshold, flagged, coalesce(caught / nullif(flagged, 0), 0) AS precision, coalesce(caught / nullif(errors, 0), 0) AS recall FROM a), f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p)
SELECT threshold, flagged, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, threshold = (SELECT threshold FROM f ORDER BY round(f1, 12) DESC, threshold LIMIT 1) AS best FROM f""")
def calibrate(spark: SparkSession, sf: str) -> DataFrame:
    s = read(spark, sf, "labels").select((F.col("doc_id") * 37 % 101 / 101).alias("c"), "quality")
    out = scoring.calibrate(s, "c", F.col("quality") == 0)
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("""SELECT o_orderkey, 'high' AS priority, 'parse_failure' AS trigger FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT o_orderkey, 'medium', 'low_confidence' FROM orders WHERE o_totalprice < 20000
UNION ALL SELECT o_orderkey, 'medium', 'large' FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT o_orderkey, 'info', 'open' FROM orders WHERE o_orderstatus = 'O'""")
def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    rules = [("high", "parse_failure", F.col("o_orderkey") % 50 == 0), ("medium", "low_confidence", F.col("o_totalprice") < 20000), ("medium", "large", F.col("o_totalprice") > 400000), ("info", "open", F.col("o_orderstatus") == "O")]
    return review.sorted_queue(review.findings(o, ["o_orderkey"], rules).drop("rule_no"), "o_orderkey")


@query("""SELECT user_id AS target_id, event_type AS field, arg_min(CAST(event_id AS VARCHAR), event_id) AS original, arg_max(props, event_id) AS corrected, count(*) AS n_edits FROM events GROUP BY ALL""")
def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    log = read(spark, sf, "events").select(F.col("user_id").alias("target_id"), F.col("event_type").alias("field"), F.col("event_id").cast("string").alias("original"), F.col("props").alias("corrected"), F.col("event_id").alias("seq"))
    return review.latest_corrections(log)


@query("""WITH l AS (SELECT user_id % 1500 AS c, arg_max(event_id, event_id) AS v FROM events GROUP BY 1) SELECT c_custkey, c_name, coalesce(CAST(v AS DOUBLE), c_acctbal) AS c_acctbal FROM customer LEFT JOIN l ON c = c_custkey""")
def audit_replay(spark: SparkSession, sf: str) -> DataFrame:
    log = read(spark, sf, "events").select((F.col("user_id") % 1500).alias("target_id"), F.lit("c_acctbal").alias("field"), F.col("event_id").cast("string").alias("corrected"), F.col("event_id").alias("seq"))
    return review.replay(read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_custkey", log, ["c_acctbal"])


@query("""WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), p AS (SELECT event_id, CASE WHEN k < 5 THEN 'page,' ELSE '' END || CASE WHEN k % 10 = 0 THEN 'bbox,' ELSE '' END || CASE WHEN k % 3 = 0 THEN 'crop,' ELSE '' END AS g FROM e) SELECT event_id, rtrim(g, ',') AS gap FROM p WHERE g <> ''""")
def provenance_gaps(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    e = read(spark, sf, "events").select("event_id", k.alias("k"))
    gap = review.provenance_gap(F.when(F.col("k") >= 5, F.col("k")), F.lit(0), F.lit(0), F.col("k") % 10, F.lit(5), F.when(F.col("k") % 3 != 0, F.lit("c.png")).otherwise(F.lit(" ")))
    return e.select("event_id", gap.alias("gap")).where("gap is not null")


_HEAD = [("Cmpd.", "No."), ("HiBiT", "DC50 (nM)"), ("Iso-", "indoline synthesis"), ("", "Coupling procedure"), ("WIZ  EC50", "")]
_HEAD_OUT = ["Cmpd. No.", "HiBiT DC50 (nM)", "Isoindoline synthesis", "Coupling procedure", "WIZ EC50"]


@query("SELECT n_nationkey, [" + ", ".join(f"'{x}'" for x in _HEAD_OUT) + "][n_nationkey % 5 + 1] AS header FROM nation")
def header_reconstruct(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.element_at(F.array(*[F.array(*map(F.lit, h)) for h in _HEAD]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return read(spark, sf, "nation").select("n_nationkey", T.reconstruct_header(parts).alias("header"))
