"""Queries on legends, headers, names, prose and page grids; the SQL states what each row's text was made to say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import prose
from ..operators import legends, lexicon, pages, repair, scoring, tables

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


def pick(values: list[str], at: str):  # noqa: ANN201
    """One of ``values`` by the remainder of a number."""
    return F.element_at(F.array(*map(F.lit, values)), F.expr(f"cast({at} % {len(values)} + 1 as int)"))


def listed(values: list[str]) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


_LEGEND = "concat('having WIZ EC50 less than ', p_size, ' nM are level A. having WIZ-EC50 between ', p_size, ' and ', 2 * p_size, ' are level B; having wiz ec50 > ', 2 * p_size, ' are level C. Values less than ', p_size + p_partkey % 2, ' nM (activity level A), value over (activity level B), values of less than 5 uM (activity level C)')"


@query("""WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS n, p_partkey % 2 = 1 AS odd FROM part)
SELECT p_partkey, 'A' AS label, CAST(NULL AS DOUBLE) AS lower, n AS upper, 'nM' AS units, 3 AS score, CASE WHEN odd THEN 'upper bound differs' END AS discrepancy FROM p
UNION ALL SELECT p_partkey, 'B', n, 2 * n, 'nM', 2, NULL FROM p
UNION ALL SELECT p_partkey, 'C', 2 * n, NULL, 'nM', 1, 'units restated as uM rather than nM; the interval is bounded from the opposite side' FROM p""")
def legend_bins(spark: SparkSession, sf: str) -> DataFrame:
    text = read(spark, sf, "part").select("p_partkey", F.expr(_LEGEND).alias("text"))
    return legends.legends(text, "p_partkey", "text").select("p_partkey", "label", "lower", "upper", "units", "score", "discrepancy")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'ABC' WHEN p_partkey % 3 = 1 THEN 'ABC' ELSE '' END AS labels FROM part""")
def legend_labels(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part")
    known = legends.legends(part.select("p_partkey", F.expr(_LEGEND).alias("text")), "p_partkey", "text")
    headers = part.select("p_partkey", pick(["WIZ EC5O (uM)", "wiz ec50 x", "Mass"], "p_partkey").alias("header"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'wiz' END").alias("target"))
    return legends.legal_labels(headers, known, "p_partkey").select("p_partkey", F.array_join("labels", "").alias("labels"))


_HEADERS = ["WIZ EC50 (uM)", "BRD4 pIC50 (nM)", "GSPT1 DC50 nM", "% inhibition @ 10 uM", "Dmax", "Mass found", "Cmpd. No", "ZBTB7A ECS0 (uM)"]
_TYPES = ["EC50", "IC50", "DC50", "Inhibition", "Dmax", None, "CompoundNumber", "EC50"]
_TARGETS = ["WIZ", "BRD4", "GSPT1", None, None, None, None, "ZBTB7A"]
_HEADER_UNITS = ["uM", None, "nM", "%", "%", None, None, "uM"]


@query(f"SELECT p_partkey, {listed(_TYPES)}[p_partkey % 8 + 1] AS standard_type, {listed(_TARGETS)}[p_partkey % 8 + 1] AS target, {listed(_HEADER_UNITS)}[p_partkey % 8 + 1] AS units, p_partkey % 8 = 1 AS is_log_form FROM part")
def header_match(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part").select("p_partkey", pick(_HEADERS, "p_partkey").alias("header"))
    known = lexicon.match_headers(part.select("header").distinct(), "header")
    return part.join(known, "header").select("p_partkey", "match.standard_type", "match.target", "match.units", F.coalesce("match.is_log_form", F.lit(False)).alias("is_log_form"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN c_name END AS repaired, CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS depth FROM customer")
def name_repair(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    read_as = F.when(F.col("c_custkey") % 3 == 0, F.replace("c_name", F.lit("0"), F.lit("O"))).when(F.col("c_custkey") % 3 == 1, F.col("c_name")).otherwise(F.concat(F.lit("?"), "c_name"))
    return repair.repair(c.select("c_custkey", read_as.alias("name")), c.select(F.col("c_name").alias("name"), F.col("c_name").alias("value")), "c_custkey", "name").select("c_custkey", "repaired", "depth")


@query("""WITH n AS (SELECT s_suppkey, unnest([1, 2]) AS k FROM supplier) SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || CASE k WHEN 2 THEN 'b' ELSE '' END AS id, CASE k WHEN 1 THEN '2-(4-methylphenyl)-pyridine ' || CAST(s_suppkey AS VARCHAR) ELSE '3-(chlorophenyl)-piperidine' END AS name, k = 1 AS has_nmr, k = 2 AND s_suppkey % 2 = 0 AS has_ms FROM n""")
def prose_examples(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("concat('[0101] Example ', s_suppkey, ': 2-(4-methylphenyl)-pyridine  ', s_suppkey, '\n1H NMR (400)\nExample ', s_suppkey, 'b - 3-(chlorophenyl)-piperidine\n', CASE WHEN s_suppkey % 2 = 0 THEN 'MS (ESI) 100' ELSE 'oil' END)")
    return read(spark, sf, "supplier").select("s_suppkey", F.explode(prose.examples(text)).alias("e")).select("s_suppkey", "e.*")


_VIVO = ["Mouse Anti-Human antibody", "dosed in mice; AUC and C max", "no data", "oral  bioavailability in rats", "murine flow cytometry", "PK of the xenografts"]
_VIVO_OUT = ["", "mouse,AUC,Cmax", "", "rat,oral bioavailability", "", "xenograft,PK"]


@query(f"""SELECT doc_id, {listed(_VIVO_OUT)}[doc_id % 6 + 1] AS terms, CASE WHEN {listed(_VIVO_OUT)}[doc_id % 6 + 1] <> '' THEN 'named in the claims|in vivo data reported (' || replace({listed(_VIVO_OUT)}[doc_id % 6 + 1], ',', ', ') || ')' ELSE 'named in the claims' END AS reasons FROM documents""")
def in_vivo_signal(spark: SparkSession, sf: str) -> DataFrame:
    # the whole text, and far enough behind it that neither is the other's context, a line that says something
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(" " + "x" * 2 * prose.CONTEXT + " "), pick(_VIVO, "doc_id"))
    d = read(spark, sf, "documents").select("doc_id", prose.in_vivo_terms(said).alias("t"))
    reasons = prose.investment_reasons(F.lit(False), F.lit(True), F.lit(None).cast("boolean"), F.col("t"))
    return d.select("doc_id", F.array_join("t", ",").alias("terms"), F.array_join(reasons, "|").alias("reasons"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'WO2024' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') || 'A1' WHEN 1 THEN 'XX' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || 'B2' END AS pubnum FROM orders""")
def publication_numbers(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr("CASE o_orderkey % 3 WHEN 0 THEN concat('PCT/US', lpad(o_orderkey, 9, '0'), ' A1 and WO 2024/', lpad(o_orderkey, 6, '0'), ' Al') WHEN 1 THEN concat('US 1234567 A1. (10) Pub. No. XX ', lpad(o_orderkey, 9, '0'), ' B2') ELSE concat('ZZ', lpad(o_orderkey, 9, '0'), 'A1') END")
    return read(spark, sf, "orders").select("o_orderkey", prose.publication_number_in(text).alias("pubnum"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'activity_table' WHEN 1 THEN 'compound_table' END AS kind, CASE p_partkey % 3 WHEN 0 THEN 'number,structure,unknown' WHEN 1 THEN 'number,structure,name' ELSE 'unknown,number' END AS roles FROM part""")
def page_kinds(spark: SparkSession, sf: str) -> DataFrame:
    made = "CASE p_partkey % 3 WHEN 0 THEN struct(array('Compound No.\n1', 'WIZ EC50 (uM)\nA', 'x') AS t, array(50D, 100D, 90D) AS w) WHEN 1 THEN struct(array('12', 'N O HN', '3-(4-methyl-phenoxypiperidin') AS t, array(20D, 90D, 95D) AS w) ELSE struct(array('a', 'b') AS t, array(2D, 1D) AS w) END"
    p = read(spark, sf, "part").select("p_partkey", F.lit(3).alias("n_rows"), F.expr(made).alias("m")).select("p_partkey", "n_rows", F.col("m.t").alias("texts"), F.col("m.w").alias("widths"))
    return pages.classify(p, ["p_partkey"]).select("p_partkey", "kind", F.array_join(pages.column_roles(F.col("texts"), F.col("widths")), ",").alias("roles"))


@query("""WITH k AS (SELECT user_id, event_id, row_number() OVER w AS page, CASE WHEN event_id % 4 = 0 THEN event_type END AS kind, event_id % 3 > 0 AS goes FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(CASE WHEN kind IS NULL AND goes AND page > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY page) AS run FROM k), h AS (SELECT *, first_value(kind) OVER (PARTITION BY user_id, run ORDER BY page) AS head FROM r)
SELECT event_id, coalesce(kind, head) AS kind, kind IS NULL AND head IS NOT NULL AS inherited FROM h""")
def page_continuations(spark: SparkSession, sf: str) -> DataFrame:
    page = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    k = read(spark, sf, "events").select("user_id", "event_id", page.alias("page"), F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("kind"))
    return pages.inherit_kind(k, "user_id", "page", "kind", F.col("event_id") % 3 > 0).select("event_id", "kind", "inherited")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'merged' WHEN 2 THEN 'b' ELSE 'a' END AS chosen, round(CASE p_partkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 4 / 6 WHEN 2 THEN 0.0 END, 6) AS agreement, p_partkey % 4 IN (1, 2) AS disagreement,
CASE p_partkey % 4 WHEN 0 THEN '0,40,80' WHEN 1 THEN '0,42,80' WHEN 2 THEN '0,10,20,30,80' ELSE '0,40,80' END AS ys FROM part""")
def grid_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    at = "p_partkey % 4"
    p = read(spark, sf, "part").selectExpr(
        "p_partkey", "array(0, 50, 100) AS a_xs", "array(0, 40, 80) AS a_ys", f"CASE {at} WHEN 0 THEN array(0, 50, 100) WHEN 1 THEN array(0, 50, 60, 100) WHEN 2 THEN array(0, 100) END AS b_xs",
        f"CASE {at} WHEN 0 THEN array(0, 41, 80) WHEN 1 THEN array(0, 44, 80) WHEN 2 THEN array(0, 10, 20, 30, 80) END AS b_ys", "CAST(4 AS INT) AS expected_rows",
    )
    return pages.reconcile(p).select("p_partkey", "chosen", F.round("agreement", 6).alias("agreement"), "disagreement", F.array_join("ys", ",").alias("ys"))


@query("""SELECT n_nationkey, n_nationkey % 3 = 0 AS header, n_nationkey % 3 = 1 AS chemical FROM nation""")
def row_tests(spark: SparkSession, sf: str) -> DataFrame:
    cells = F.expr("CASE n_nationkey % 3 WHEN 0 THEN array('Compound No.', 'HbF Induction (%)', 'B') WHEN 1 THEN array('32', 'A', 'dioxopiperidin name') ELSE array('words here', 'other', 'word') END")
    return read(spark, sf, "nation").select("n_nationkey", pages.is_header(cells).alias("header"), pages.reads_chemical(pick(["Compound No. Structure", "2-(dioxopiperidin)", "2-(methyl)"], "n_nationkey")).alias("chemical"))


@query("""WITH k AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS n FROM lineitem),
p AS (SELECT *, lag(n) OVER w AS previous, lag(pos) OVER w AS before FROM k WHERE n IS NOT NULL WINDOW w AS (PARTITION BY doc ORDER BY pos)), t AS (SELECT *, CASE WHEN n = previous THEN 'duplicate' WHEN n < previous THEN 'order' WHEN n - previous > pos - before THEN 'gap' END AS kind FROM p)
SELECT doc, CAST(pos AS BIGINT) AS pos, 'unreadable' AS kind, CAST(NULL AS BIGINT) AS previous, CAST(NULL AS BIGINT) AS number FROM k WHERE n IS NULL UNION ALL SELECT doc, pos, kind, previous, n FROM t WHERE kind IS NOT NULL""")
def seq_adjacent(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    d = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), F.row_number().over(w).cast("long").alias("pos"), F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("long")).alias("n"))
    return tables.adjacent_anomalies(d, "doc", "pos", "n")


@query("""WITH k AS (SELECT md5(text) AS k, doc_id FROM documents WHERE text IS NOT NULL), f AS (SELECT k, min(doc_id) AS first FROM k GROUP BY k) SELECT first, doc_id AS other FROM k JOIN f USING (k) WHERE doc_id <> first""")
def dup_links(spark: SparkSession, sf: str) -> DataFrame:
    k = read(spark, sf, "documents").select(F.md5("text").alias("k"), "doc_id")
    return tables.duplicate_links(k, "k", "doc_id", "doc_id").select("first", "other")


@query("""WITH RECURSIVE r AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq, l_returnflag <> 'R' AS numbered, left(md5(CAST(l_partkey AS VARCHAR)), 2) AS name FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS i FROM r WHERE NOT numbered), b AS (SELECT k, list(name) FILTER (numbered) AS names FROM r GROUP BY k),
f(k, i, names, stay) AS (SELECT k, 0, coalesce(names, []), CAST([] AS BIGINT[]) FROM b UNION ALL SELECT f.k, o.i, CASE WHEN len(list_filter(f.names, lambda x: contains(x, o.name) OR contains(o.name, x))) > 0 THEN f.names ELSE list_append(f.names, o.name) END,
  CASE WHEN len(list_filter(f.names, lambda x: contains(x, o.name) OR contains(o.name, x))) > 0 THEN f.stay ELSE list_append(f.stay, o.seq) END FROM f JOIN o ON o.k = f.k AND o.i = f.i + 1)
SELECT k AS l_orderkey, seq FROM r WHERE numbered UNION ALL SELECT k, unnest(arg_max(stay, i)) FROM f GROUP BY k""")
def dedupe_unnumbered(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    d = read(spark, sf, "lineitem").select("l_orderkey", F.row_number().over(w).alias("seq"), F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("number"), F.substring(F.md5(F.col("l_partkey").cast("string")), 1, 2).alias("name"))
    return tables.dedupe_numberless(d, "l_orderkey", "seq", "number", "name")


@query("""SELECT count(*) AS scored, count(*) FILTER (c_custkey % 5 = 0) AS correct, count(*) FILTER (c_custkey % 5 = 1) AS skeleton_correct FROM customer""")
def eval_keys(spark: SparkSession, sf: str) -> DataFrame:
    c = read(spark, sf, "customer")
    frame = F.substring(F.upper(F.md5(F.col("c_custkey").cast("string"))), 1, 14)
    gold = c.select((F.col("c_custkey") + 1).alias("id"), F.concat(frame, F.lit("-N")).alias("key"))
    got = F.when(F.col("c_custkey") % 5 == 0, F.concat(frame, F.lit("-N"))).when(F.col("c_custkey") % 5 == 1, F.concat(frame, F.lit("-Q"))).when(F.col("c_custkey") % 5 == 2, F.lit("X"))
    rows = c.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), (F.col("c_custkey") + 1).alias("number"), F.lit("").alias("local_id"), got.alias("g")).select("seq", "number", "local_id", F.when(F.col("seq") == 2, F.col("g")).alias("key"))
    return scoring.score_keys(gold, rows).select("scored", "correct", "skeleton_correct")


@query("""WITH g AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag <> 'R'), p AS (SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F') SELECT count(*) AS gold_ids, count(p.id) AS matched FROM g LEFT JOIN p USING (id)""")
def eval_join(spark: SparkSession, sf: str) -> DataFrame:
    gold = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") != "R", F.lit("A")).alias("value"))
    got = read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.lit("A")).otherwise("").alias("value"))
    return scoring.score_join(gold, got, read(spark, sf, "nation").select(F.lit("keyed").alias("join_method"))).select("gold_ids", "matched")


@query("""WITH g AS (SELECT DISTINCT p_brand AS assay, p_size % 5 AS label FROM part), f AS (SELECT DISTINCT p_brand AS assay, CASE WHEN p_partkey % 4 = 0 THEN p_size % 5 END AS label FROM part), w AS (SELECT assay, bool_and(f.label IS NOT NULL) AS whole FROM g LEFT JOIN f USING (assay, label) GROUP BY assay)
SELECT count(*) AS expected, count(*) FILTER (whole) AS recovered, (SELECT count(*) FROM part WHERE p_size > 40) AS contradictions FROM w""")
def eval_legends(spark: SparkSession, sf: str) -> DataFrame:
    p = read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("assay"), (F.col("p_size") % 5).cast("string").alias("label"), F.when(F.col("p_size") > 40, F.lit("differs")).alias("discrepancy"))
    return scoring.score_legends(p, p.withColumn("label", F.when(F.col("p_partkey") % 4 == 0, F.col("label"))))


@query("""WITH s AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq, CASE WHEN l_returnflag <> 'R' THEN 1 + l_linenumber % 3 END AS score FROM lineitem)
SELECT l_orderkey, 'potency ' || CAST(coalesce(sum(score), 0) AS VARCHAR) || ' = ' || coalesce(string_agg('P' || CAST(l_partkey AS VARCHAR) || ' B→' || CAST(score AS VARCHAR), ', ' ORDER BY seq) FILTER (score IS NOT NULL), '') AS line,
1 + CASE WHEN count(score) < 4 THEN 1 ELSE 0 END AS n_lines FROM s GROUP BY l_orderkey""")
def potency_rationale(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    score = F.when(F.col("l_returnflag") != "R", 1 + F.col("l_linenumber") % 3)
    s = read(spark, sf, "lineitem").select("l_orderkey", F.row_number().over(w).alias("seq"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("name"), F.lit("B").alias("label"), score.alias("bin_score"), F.lit(False).alias("is_censored"))
    return scoring.potency_lines(s, "l_orderkey", 4).select("l_orderkey", F.element_at("lines", 1).alias("line"), F.size("lines").alias("n_lines"))
