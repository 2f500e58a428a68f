"""Engines outside Spark (recognition, name parsers, chemistry, fetching) behind one interface, and what is made of their answers.

An engine is a function without arguments, called once in each Python worker, that returns a function from a list of
inputs to a list of answers, one for each, None where it has none. A chunk on which it fails has an error and costs no
other; an engine that can't be made answers nothing. Tests use fakes; what an engine needs is installed by who names it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .html import html_fields

Engine = Callable[[], Callable[[list], list]]
#: Where a crop goes by its class; spellings of a structure in a name service's answer, first wins.
ROUTES = {"clean": "ocsr", "markush": "markush", "trash": "skip"}
SMILES_KEYS = ("SMILES", "IsomericSMILES", "CanonicalSMILES", "ConnectivitySMILES")
AMBIGUOUS = "APPEARS_AMBIGUOUS"
DESCRIPTORS = "mw double, clogp double, tpsa double, hbd int, hba int, rotatable int, heavy_atoms int, rings int, fsp3 double, qed double"
LEAST_PIXELS, LEAST_CHARS = 1000, 8


def ask(df: DataFrame, column: str, engine: Engine, schema: str, chunk: int = 4) -> DataFrame:
    """``df`` with ``answer`` (a struct of ``schema``) and ``error``; rows whose input is null aren't asked."""
    kind = T.StructType.fromDDL(schema)
    at = df.columns.index(column)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        why, answer = "", None
        try:
            answer = engine()
        except Exception as e:  # an absent engine is an answer
            why = f"engine unavailable: {e}"
        for rows in batches:
            asked = [i for i, x in enumerate(rows.iloc[:, at]) if x is not None]
            told: list = [None] * len(rows)
            error: list = [None] * len(rows)
            for k in range(0, len(asked), chunk):
                part = asked[k : k + chunk]
                try:
                    got = list(answer([rows.iat[i, at] for i in part])) if answer else []
                    said = why if not answer else None
                except Exception as e:  # one bad chunk costs no other
                    got, said = [], f"engine failed: {e}"
                for i, a in zip(part, [*got, *[None] * (len(part) - len(got))], strict=False):
                    told[i], error[i] = a, said
            yield rows.assign(answer=pd.Series(told, index=rows.index, dtype=object), error=pd.Series(error, index=rows.index, dtype=object))

    return df.mapInPandas(work, T.StructType([*df.schema.fields, T.StructField("answer", kind), T.StructField("error", T.StringType())]))


def text_of(cells: DataFrame, column: str, engine: Engine) -> DataFrame:
    """Recognized text of crops or pages (``text``), empty where nothing was read."""
    return ask(cells, column, engine, "text string").withColumn("text", F.coalesce("answer.text", F.lit(""))).drop("answer")


def parsed_names(names: DataFrame, column: str, engine: Engine, inchikey: Callable[[Column], Column]) -> DataFrame:
    """``names``, one row for each, with smiles, status (FAILURE without a structure, WARNING with one and a warning), ambiguous, inchikey."""
    out = ask(names, column, engine, "smiles string, warnings array<string>", chunk=4096)
    smiles, said = F.nullif(F.trim("answer.smiles"), F.lit("")), F.coalesce("answer.warnings", F.array().cast("array<string>"))
    status = F.when(smiles.isNull(), "FAILURE").when(F.size(said) > 0, "WARNING").otherwise("SUCCESS")
    return out.select(*names.columns, smiles.alias("smiles"), status.alias("status"), F.exists(said, lambda w: w.startswith(AMBIGUOUS)).alias("ambiguous"), F.when(smiles.isNotNull(), inchikey(smiles)).alias("inchikey"))


def crop_class(label: Column) -> Column:
    """The class that a label means; one that nothing names is clean, as is a crop that wasn't classified."""
    t = F.lower(F.trim(label))
    return F.when(t.contains("markush"), "markush").when(t.contains("trash") | t.contains("noise"), "trash").otherwise("clean")


def routed_crops(crops: DataFrame, column: str, classifier: Engine) -> DataFrame:
    """``crops`` with crop_class, class_score (0 where not classified) and route."""
    out = ask(crops, column, classifier, "label string, score double")
    route = F.coalesce(*[F.when(F.col("crop_class") == c, F.lit(r)) for c, r in ROUTES.items()])
    return out.withColumn("crop_class", crop_class(F.col("answer.label"))).select(*crops.columns, "crop_class", F.coalesce("answer.score", F.lit(0.0)).alias("class_score"), route.alias("route"))


def recognized(crops: DataFrame, column: str, engine: Engine, inchikey: Callable[[Column], Column], chunk: int = 4) -> DataFrame:
    """``crops`` with smiles, inchikey, confidence, min_atom, min_bond (the least sure atom and bond) and error; a structure that can't be read keeps its text."""
    out = ask(crops, column, engine, "smiles string, confidence double, atoms array<double>, bonds array<double>", chunk)
    smiles = F.nullif(F.col("answer.smiles"), F.lit(""))
    out = out.withColumns({"smiles": smiles, "inchikey": inchikey(smiles)})
    error = F.coalesce("error", F.when(F.col(column).isNotNull() & F.col("smiles").isNull(), "no structure found"), F.when(F.col("smiles").isNotNull() & F.col("inchikey").isNull(), "structure can't be read"))
    return out.select(*crops.columns, "smiles", "inchikey", F.col("answer.confidence").alias("confidence"), F.array_min("answer.atoms").alias("min_atom"), F.array_min("answer.bonds").alias("min_bond"), error.alias("error"))


def image_channel(entities: DataFrame, crop: str, classifier: Engine, recognizer: Engine, inchikey: Callable[[Column], Column]) -> DataFrame:
    """``entities`` with markush, smiles_from_image, key_from_image, confidence, min_atom, min_bond: only clean crops are recognized, a generic structure never is."""
    routed = routed_crops(entities, crop, classifier)
    asked = routed.withColumn("_asked", F.when(F.col(crop).isNotNull() & (F.col("route") == "ocsr"), F.col(crop)))
    out = recognized(asked, "_asked", recognizer, inchikey)
    return out.select(*entities.columns, (F.col(crop).isNotNull() & (F.col("crop_class") == "markush")).alias("markush"), F.col("smiles").alias("smiles_from_image"), F.col("inchikey").alias("key_from_image"), "confidence", "min_atom", "min_bond")


def standardized(structures: DataFrame, column: str, engine: Engine) -> DataFrame:
    """``structures`` with standard_smiles, inchikey, skeleton, tautomer, undefined_stereo and skipped; what the engine leaves out passes through as it is."""
    out = ask(structures, column, engine, "smiles string, inchikey string, tautomer string, undefined_stereo int, skipped boolean")
    return out.select(
        *structures.columns, F.coalesce("answer.smiles", column).alias("standard_smiles"), F.col("answer.inchikey").alias("inchikey"), F.substring("answer.inchikey", 1, 14).alias("skeleton"), F.col("answer.tautomer").alias("tautomer"),
        (F.coalesce("answer.undefined_stereo", F.lit(0)) > 0).alias("undefined_stereo"), F.coalesce("answer.skipped", F.col("answer").isNull()).alias("skipped"),
    )


def descriptors(structures: DataFrame, column: str, engine: Engine) -> DataFrame:
    """``structures`` with ten properties, all null where the structure can't be read."""
    return ask(structures, column, engine, DESCRIPTORS).select(*structures.columns, "answer.*")


def detected_boxes(pages: DataFrame, column: str, engine: Engine) -> DataFrame:
    """``pages`` with row_boxes and column_boxes of a second detector, null where it has none."""
    box = "array<struct<x0:double,y0:double,x1:double,y1:double>>"
    return ask(pages, column, engine, f"rows {box}, columns {box}", chunk=1).select(*pages.columns, F.col("answer.rows").alias("row_boxes"), F.col("answer.columns").alias("column_boxes"))


def fetched(wanted: DataFrame, cache: DataFrame, engine: Engine | None) -> tuple[DataFrame, DataFrame]:
    """(pubnum, html) of what is cached or could be fetched, and the part to cache: a page without a description is no page.

    Only what the cache doesn't have is asked for; without an engine nothing is.
    """
    missing = wanted.select("pubnum").distinct().join(cache, "pubnum", "left_anti")
    known = cache.join(wanted.select("pubnum").distinct(), "pubnum").select("pubnum", "html")
    if engine is None:
        return known, known.limit(0)
    new = ask(missing.withColumn("asked", F.col("pubnum")), "asked", engine, "html string", chunk=1).select("pubnum", F.col("answer.html").alias("html"))
    new = new.where(html_fields("html")["description"].isNotNull())
    return known.unionByName(new), new


def fetched_images(links: DataFrame, cache: DataFrame, engine: Engine) -> DataFrame:
    """(url, content) of page images that the cache doesn't have; a failure leaves one out."""
    missing = links.select("url").distinct().join(cache, "url", "left_anti")
    return ask(missing.withColumn("asked", F.col("url")), "asked", engine, "content binary", chunk=1).where("answer.content IS NOT NULL").select("url", F.col("answer.content").alias("content"))


def name_answer(payload: Column) -> Column:
    """struct(smiles, inchikey) of a name service's JSON; nulls where it has none."""
    first = lambda k: F.nullif(F.get_json_object(payload, f"$.PropertyTable.Properties[0].{k}"), F.lit(""))
    return F.struct(F.coalesce(*map(first, SMILES_KEYS)).alias("smiles"), first("InChIKey").alias("inchikey"))


def resolved_names(names: DataFrame, cache: DataFrame, engine: Engine | None) -> tuple[DataFrame, DataFrame]:
    """(name, smiles, inchikey) by a cache of payloads, else by a service that its one task asks in turn; and the payloads to cache, those that tell something."""
    wanted = names.select("name").where("name IS NOT NULL").distinct()
    payloads = cache.join(wanted, "name").select("name", "payload")
    new = payloads.limit(0)
    if engine is not None:
        # one partition: the service limits how often it may be asked
        asked = wanted.join(cache, "name", "left_anti").withColumn("asked", F.col("name")).repartition(1)
        new = ask(asked, "asked", engine, "payload string", chunk=1).select("name", F.col("answer.payload").alias("payload"))
        told = name_answer(F.col("payload"))
        new = new.where(told["smiles"].isNotNull() | told["inchikey"].isNotNull())
    return payloads.unionByName(new).select("name", name_answer(F.col("payload")).alias("a")).select("name", "a.*"), new


def documents(files: DataFrame, column: str, engine: Engine) -> DataFrame:
    """``files`` with n_pages (0 where unreadable) and has_text: fonts, and enough letters for each page."""
    out = ask(files, column, engine, "n_pages int, n_fonts int, text string", chunk=1)
    pages, chars = F.coalesce("answer.n_pages", F.lit(0)), F.length(F.regexp_replace("answer.text", r"(?U)\s", ""))
    return out.select(*files.columns, pages.alias("n_pages"), F.coalesce((F.col("answer.n_fonts") > 0) & (chars >= LEAST_CHARS * F.greatest(pages, F.lit(1))), F.lit(False)).alias("has_text"))


def page_rasters(embedded: DataFrame, rendered: DataFrame) -> DataFrame:
    """(doc, page_no, idx, source, width, height): the embedded bitmaps of a page if one is large enough, else its rendering."""
    usable = embedded.groupBy("doc", "page_no").agg(F.max(F.least("width", "height")).alias("_m")).where(F.col("_m") >= LEAST_PIXELS).select("doc", "page_no")
    own = embedded.join(usable, ["doc", "page_no"]).select("doc", "page_no", "idx", F.lit("embedded").alias("source"), "width", "height")
    return own.unionByName(rendered.join(usable, ["doc", "page_no"], "left_anti").select("doc", "page_no", F.lit(0).alias("idx"), F.lit("rendered").alias("source"), "width", "height"))


def chosen_pages(pages: DataFrame, ranges: list[tuple[int, int]] | None = None, most: int | None = None) -> DataFrame:
    """``pages`` (page_no) of inclusive ranges, which go before a largest number of pages; all without either."""
    if ranges:
        keep = F.lit(False)
        for a, z in ranges:
            keep = keep | F.col("page_no").between(a, z)
        return pages.where(keep)
    return pages.where(F.col("page_no") <= most) if most else pages


def page_prose(pages: DataFrame) -> DataFrame:
    """(doc, prose): the texts of a document's pages in order, a line break between."""
    one = pages.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("t")))).alias("p"))
    return one.select("doc", F.array_join(F.transform("p", lambda x: x["t"]), "\n").alias("prose"))


def resolved_sources(sources: DataFrame, pages: DataFrame, force_file: bool = False) -> DataFrame:
    """How each source is read: (source, pubnum, mode, anomaly). Sources: source, file_pubnum (read from the first page of a file, null for none); pages: pubnum, html of what was fetched.

    A name that ends in .pdf is a file, anything else a number. What was fetched goes first, unless files are forced;
    then the file; a number with neither is an error. A file read because nothing was fetched is an anomaly.
    """
    file = F.lower("source").endswith(".pdf")
    asked = sources.withColumn("_file", file).withColumn("pubnum", F.when(file, F.col("file_pubnum")).otherwise(F.upper(F.regexp_replace("source", r"(?U)[\s/,.\-‐-―]", ""))))
    met = asked.join(pages.select("pubnum", F.lit(True).alias("_page")), "pubnum", "left")
    structured = F.coalesce("_page", F.lit(False)) & ~F.lit(force_file)
    mode = F.when(structured, "structured").when(F.col("_file"), "pdf_ocr").otherwise("error")
    anomaly = F.when(~structured & F.lit(not force_file), "source_unavailable")
    return met.select("source", "pubnum", mode.alias("mode"), anomaly.alias("anomaly"))
