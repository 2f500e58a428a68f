"""Run bundles: a manifest, and entity, measurement and anomaly tables under (pubnum, run_id); the wide sheet as CSV or, where a writer is installed, XLSX."""

from __future__ import annotations

import importlib.metadata
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "pubnum string, run_id string, created_at string, source_mode string, target_assay string, off_target_assay string, counts map<string,bigint>, stage_seconds map<string,double>, versions map<string,string>"


def write_bundle(tables: dict[str, DataFrame], root: str, manifest: dict | None = None) -> None:
    """Each table has pubnum and run_id; later runs stand beside earlier ones. The manifest is written last: a run without one isn't whole."""
    for df in tables.values():
        spark = df.sparkSession
    for name, df in tables.items():
        df.write.mode("append").partitionBy("pubnum", "run_id").parquet(f"{root}/{name}")
    if manifest is not None:
        counts = {name: df.where((F.col("pubnum") == manifest["pubnum"]) & (F.col("run_id") == manifest["run_id"])).count() for name, df in tables.items()}
        row = {"source_mode": "", "target_assay": None, "off_target_assay": None, "stage_seconds": {}, "versions": {}, "created_at": None} | manifest | {"counts": counts}
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per run, by the manifest's schema; a line that doesn't fit it stops the job."""
    return spark.read.schema(MANIFEST).option("mode", "FAILFAST").json(f"{root}/manifest")


def checked(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rows``, each checked: the first broken rule stops the job and is named in the error."""
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    first = rows.columns[0]
    told = F.when(broken.isNull(), F.col(first)).otherwise(F.raise_error(F.concat(F.lit("invalid row: "), broken)).cast(rows.schema[first].dataType))
    return rows.select(told.alias(first), *rows.columns[1:])


def read_bundle(spark: SparkSession, root: str, name: str, pubnum: str, run_id: str, rules: dict[str, Column] | None = None) -> DataFrame:
    found = spark.read.parquet(f"{root}/{name}").where((F.col("pubnum") == pubnum) & (F.col("run_id") == run_id))
    return checked(found, rules) if rules else found


def runs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(pubnum, run_id, latest); run ids sort by time."""
    found = spark.read.parquet(f"{root}/{name}").select("pubnum", F.col("run_id").cast("string").alias("run_id")).distinct()
    last = found.groupBy("pubnum").agg(F.max("run_id").alias("_m"))
    return found.join(last, "pubnum").select("pubnum", "run_id", (F.col("run_id") == F.col("_m")).alias("latest"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_xlsx(sheets: dict[str, DataFrame], path: str) -> None:
    """Sheets of one workbook, by pandas on the driver: for the tables of one document. Needs a writer that pandas knows."""
    import pandas as pd

    with pd.ExcelWriter(path) as book:
        for name, df in sheets.items():
            df.toPandas().to_excel(book, sheet_name=name, index=False)


def crop_name(page: Column, kind: Column, idx: Column) -> Column:
    return F.format_string("p%03d_%s_%d.png", page.cast("int"), kind, idx.cast("int"))


def crop_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, pad: int = 0) -> Column:
    """struct(x0, y0, x1, y1) padded and clamped to the page; null where nothing of the box is left."""
    at = lambda c, limit: F.greatest(F.lit(0), F.least(c, limit)).cast("int")
    box = F.struct(at(x0 - pad, width).alias("x0"), at(y0 - pad, height).alias("y0"), at(x1 + pad, width).alias("x1"), at(y1 + pad, height).alias("y1"))
    return F.when((x1 > x0) & (y1 > y0) & (box["x1"] > box["x0"]) & (box["y1"] > box["y0"]), box)


def read_lexicon(spark: SparkSession, path: str) -> list[tuple]:
    """Lexicon entries (type, aliases, endpoint id, is_log_form, units) of a JSON file with one object a line: as many rows as it names endpoints."""
    schema = "standard_type string, aliases array<string>, bao_endpoint string, is_log_form boolean, units string"
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path).orderBy("standard_type", "is_log_form").collect()
    return [(r["standard_type"], tuple(r["aliases"] or ()), r["bao_endpoint"], bool(r["is_log_form"]), r["units"]) for r in rows]


def versions(names: Iterable[str] = ("pyspark", "pyarrow", "pandas", "numpy")) -> dict[str, str]:
    """Version stamps of what a run used; "absent" for what isn't installed."""
    out = {}
    for name in names:
        try:
            out[name] = importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            out[name] = "absent"
    return out


def manifest_text(manifest: dict) -> str:
    return json.dumps(manifest, indent=2, ensure_ascii=False, sort_keys=True)
