"""Queries on documents and pages: duplicates, page fields, references, text quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import tables
from ..sources import html

QUERIES: dict = {}
SQL: dict[str, str] = {}
VOCABULARY = ["the", "and", "that", "for", "was", "with", "les", "des", "que", "qui", "der", "die", "und", "las", "los"]


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("""WITH k AS (SELECT source, n_chars // 1000 AS bucket, doc_id, text FROM documents) SELECT source, bucket, sha256(arg_max(text, length(text) * 1e7 - doc_id)) AS text_sha, min(doc_id) AS doc_id, count(*) AS n_merged FROM k GROUP BY source, bucket""")
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = read(spark, sf, "documents").select("source", F.expr("n_chars div 1000").alias("bucket"), "doc_id", "text")
    return tables.dedupe_numbered(d, ["source", "bucket"], "text", "doc_id").select("source", "bucket", F.sha2("text", 256).alias("text_sha"), "doc_id", "n_merged")


@query("""WITH k AS (SELECT doc_id, left(md5(trim(text)), 14) AS skeleton FROM documents), n AS (SELECT *, count(*) OVER (PARTITION BY skeleton) AS n FROM k) SELECT * FROM n WHERE n > 1""")
def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    k = read(spark, sf, "documents").select("doc_id", F.substring(F.md5(F.trim("text")), 1, 14).alias("skeleton"))
    return tables.duplicate_groups(k, "skeleton", "doc_id")


@query("""SELECT page_id, TRY_CAST(nullif(regexp_extract(u, 'imgf([0-9]{6})_[0-9]{4}\\.png$', 1), '') AS INT) AS page, CASE WHEN page_id % 3 > 0 THEN 1 END AS index, u AS url FROM (SELECT page_id, 'https://x.example/imgf' || lpad(CAST(page_id % 900 AS VARCHAR), 6, '0') || CASE WHEN page_id % 3 = 0 THEN '' ELSE '_0001.png' END AS u FROM pages)""")
def image_index(spark: SparkSession, sf: str) -> DataFrame:
    u = F.concat(F.lit("//x.example/imgf"), F.lpad((F.col("page_id") % 900).cast("string"), 6, "0"), F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.lit("_0001.png")))
    return read(spark, sf, "pages").select("page_id", T.image_page_index(F.concat(u, F.lit("?w=1"))).alias("i"), T.absolute_url(u, "https://y.example").alias("url")).select("page_id", "i.page", "i.index", "url")


@query()
def html_fields(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", html.html_fields("html").alias("f")).select("page_id", "f.title", "f.description", "f.n_links")


@query()
def html_tables(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "pages").select("page_id", F.posexplode_outer(html.html_tables("html")).alias("table_no", "rows"))


_KNOWN = ", ".join(f"'{v}'" for v in VOCABULARY)
_CHEMICAL = "|".join([*(f.replace("(", "\\(").replace(")", "\\)") for f in T.FRAGMENTS), T.SUBSTITUENT])
_NAMED = "2-(4-methylphenyl)-pyridine Isoindoline, 3-(x) 12-(ab N1a the"


@query(rf"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, '') || ' ' || CASE WHEN doc_id % 2 = 0 THEN '{_NAMED}' ELSE '' END, '[A-Za-z0-9][A-Za-z0-9()\[\]''’,.\-]*') AS t FROM documents),
w AS (SELECT doc_id, list_filter(list_transform(t, lambda x: lower(x)), lambda x: length(regexp_replace(x, '[^a-z]', '', 'g')) >= 3) AS w FROM t)
SELECT doc_id, CASE WHEN len(w) > 0 THEN round(len(list_filter(w, lambda x: regexp_replace(x, '[^a-z]', '', 'g') IN ({_KNOWN}) OR regexp_matches(x, '{_CHEMICAL}'))) / len(w), 6) ELSE 0 END AS quality FROM w""")
def ocr_quality(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.when(F.col("doc_id") % 2 == 0, F.lit(_NAMED)).otherwise(F.lit("")))
    return read(spark, sf, "documents").select("doc_id", F.round(T.ocr_quality(text, VOCABULARY), 6).alias("quality"))


@query(r"""WITH b AS (SELECT doc_id, coalesce(text, '') || '[0001] none [' || lpad(CAST(doc_id % 9000 AS VARCHAR), 4, '0') || '] see Table 1 below and ' || CASE WHEN doc_id % 3 = 0 THEN 'Table 2 below' ELSE 'Table 1 below' END AS t FROM documents),
p AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '\[([0-9]{4,6})\]', chr(1) || '[\1]', 'g'), chr(1))) AS p FROM b)
SELECT doc_id, '[' || regexp_extract(p, '\[([0-9]{4,6})\]', 1) || ']' AS paragraph FROM p WHERE len(list_distinct(regexp_extract_all(p, '[Tt]able\s+([0-9]+)\s+below', 1))) >= 2""")
def cross_refs(spark: SparkSession, sf: str) -> DataFrame:
    tag = F.concat(F.lit("["), F.lpad((F.col("doc_id") % 9000).cast("string"), 4, "0"), F.lit("]"))
    body = F.concat(F.coalesce("text", F.lit("")), F.lit("[0001] none "), tag, F.lit(" see Table 1 below and "), F.when(F.col("doc_id") % 3 == 0, F.lit("Table 2 below")).otherwise(F.lit("Table 1 below")))
    return read(spark, sf, "documents").select("doc_id", F.explode(T.cross_references(body)).alias("r")).select("doc_id", F.concat(F.lit("["), "r.paragraph", F.lit("]")).alias("paragraph"))


@query("""SELECT source || '::' || trim(regexp_replace(lower(replace(lang || ' Assay ß ' || CAST(doc_id % 10 AS VARCHAR), 'ß', 'ss')), '[^a-z0-9]+', '-', 'g'), '-') AS assay_group, count(*) AS n FROM documents GROUP BY ALL""")
def assay_groups(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("lang", F.lit(" Assay ß "), (F.col("doc_id") % 10).cast("string"))
    return read(spark, sf, "documents").groupBy(T.group_key(F.col("source"), name).alias("assay_group")).agg(F.count("*").alias("n"))
