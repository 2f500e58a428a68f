"""A run over given tables: stages in order, timed; a bundle with its manifest at the end. ``python -m evidtable.run --help``."""

from __future__ import annotations

import argparse
import json
import os
import resource
import sys
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import legends, measurements, review, scoring, tables
from .sources import bundles

STAGES = ("stitch", "legends", "measure", "rank", "review", "write")


def setting(name: str, default: str) -> str:
    return os.environ.get(f"EVIDTABLE_{name}", "").strip() or default


def number_setting(name: str, default: float) -> float:
    """A number from the environment; the default where it is none."""
    try:
        return float(setting(name, str(default)))
    except ValueError:
        return default


def read_settings(path: str) -> None:
    """KEY=VALUE lines of a file into the environment, where it has no such key; no file is no error."""
    if not os.path.isfile(path):
        return
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, sign, value = line.strip().partition("=")
            if sign and key and not key.startswith("#") and value.strip().strip("\"'"):
                os.environ.setdefault(key.strip(), value.strip().strip("\"'"))


@dataclass
class Config:
    target: str = field(default_factory=lambda: setting("TARGET", "WIZ"))
    off_target: str | None = field(default_factory=lambda: setting("OFF_TARGET", "ZBTB7A") or None)
    confidence: float = field(default_factory=lambda: number_setting("CONFIDENCE", review.CONFIDENCE))
    heavy_atoms: int = field(default_factory=lambda: int(number_setting("HEAVY_ATOMS", review.HEAVY_ATOMS)))
    budget_mb: float = field(default_factory=lambda: number_setting("BUDGET_MB", 2400))


class Recorder:
    """Seconds and peak memory of the driver for each stage, also of one that fails; ``told`` hears of every start and end."""

    def __init__(self, told: Callable[[str, str, int, int], None] | None = None, stages: tuple[str, ...] = STAGES) -> None:
        self.seconds: dict[str, float] = {}
        self.peak_mb: dict[str, float] = {}
        self.told, self.stages, self.at = told or (lambda *_: None), stages, 0

    @contextmanager
    def stage(self, name: str, spark: SparkSession | None = None) -> Iterator[None]:
        self.at += 1
        total, start = max(len(self.stages), self.at), time.perf_counter()
        self.told(name, "start", self.at, total)
        if spark is not None:
            spark.sparkContext.setJobDescription(name)
        try:
            yield
        finally:
            self.seconds[name] = time.perf_counter() - start
            self.peak_mb[name] = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
            self.told(name, "end", self.at, total)

    def over_budget(self, budget_mb: float) -> bool:
        return max(self.peak_mb.values(), default=0.0) > budget_mb


def run(spark: SparkSession, source: dict[str, DataFrame], root: str, pubnum: str, run_id: str, config: Config | None = None, recorder: Recorder | None = None) -> dict[str, DataFrame]:
    """One document set through all stages; its tables and a manifest are written under (pubnum, run_id).

    Source: pages (as for ``tables.stitched_rows``), prose (doc, text), entities (doc, entity_seq, number, qed, mw and
    what ``review.entity_findings`` reads). Plans are made stage by stage; only the writes run them.
    """
    config, recorder = config or Config(), recorder or Recorder()
    with recorder.stage("stitch", spark):
        rows, notes = tables.stitched_rows(source["pages"])
    with recorder.stage("legends", spark):
        known = legends.legends(source["prose"], "doc", "text")
    with recorder.stage("measure", spark):
        measured, refused = measurements.build_measurements(rows, source["entities"], known, config.off_target)
        measured, refused = measured.persist(), refused.persist()
    with recorder.stage("rank", spark):
        keys = ["doc", "entity_seq"]
        wanted = F.upper("target") == config.target.upper()
        potency = measured.where(wanted).groupBy(*keys).agg(F.sum("bin_score").cast("long").alias("potency"), F.count_if(F.col("bin_score") == scoring.TOP_SCORE).alias("top_bins"))
        ranked = scoring.rank(source["entities"].join(potency, keys, "left").withColumn("top_bins", F.coalesce("top_bins", F.lit(0).cast("long"))), "entity_seq", ["doc"])
    with recorder.stage("review", spark):
        anomalies = notes.select("doc", F.col("page_no").cast("long").alias("seq"), "kind").unionByName(refused.select("doc", F.col("row_no").cast("long").alias("seq"), "kind"))
        told = measured.select(
            "doc", "entity_seq", F.xxhash64("doc", "table_id", "row_no", "col").alias("measurement_seq"), F.col("raw").alias("published_value"), F.lit(None).cast("string").alias("published_units"), "value", "units", "bin_label",
            F.col("bin_label").alias("bin_definition"), "lower", "upper", "bin_score",
        )
        queue = review.entity_findings(source["entities"], told, None, config.confidence, config.heavy_atoms).unionByName(review.measurement_findings(told)).unionByName(review.document_findings(anomalies))
    out = {"entities": ranked, "measurements": measured, "refusals": refused, "anomalies": anomalies, "review": queue}
    with recorder.stage("write", spark):
        stamped = {name: df.withColumns({"pubnum": F.lit(pubnum), "run_id": F.lit(run_id)}) for name, df in out.items()}
        manifest = {"pubnum": pubnum, "run_id": run_id, "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "source_mode": "tables", "target_assay": config.target, "off_target_assay": config.off_target}
        bundles.write_bundle(stamped, root, manifest | {"stage_seconds": dict(recorder.seconds), "versions": bundles.versions()})
    return out


def evaluate(spark: SparkSession, root: str, pubnum: str, run_id: str, gold: DataFrame) -> DataFrame:
    """(section, line): a run's measurements against gold (id, assay, value)."""
    m = bundles.read_bundle(spark, root, "measurements", pubnum, run_id)
    said = m.select(F.concat_ws("#", "doc", "entity_seq").alias("entity"), F.col("number").cast("string").alias("local_id"), F.struct("table_id", "row_no", "col").alias("seq"), "target", F.col("published_type").alias("name"), "bin_label", F.col("raw").alias("published_value"))
    predicted = scoring.predicted_values(said, said.select("entity", "local_id").distinct())
    rekeyed = gold.select(F.col("id").cast("string").alias("id"), scoring.assay_identity(F.lit(None).cast("string"), F.col("assay")).alias("assay"), "value")
    return scoring.report_lines({"cells": scoring.evaluate(scoring.cell_status(rekeyed, predicted))})


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    read_settings(".env.local")
    config = Config()
    parser = argparse.ArgumentParser(prog="evidtable", description="Tables out of documents: run, evaluate, calibrate.")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("run", help="pages, prose and entities (Parquet folders of one directory) into a bundle")
    p.add_argument("source")
    p.add_argument("--out", required=True)
    p.add_argument("--pubnum", required=True)
    p.add_argument("--run-id", default=time.strftime("%Y%m%dT%H%M%S", time.gmtime()))
    p.add_argument("--target", default=config.target)
    p.add_argument("--off-target", default=config.off_target)
    p = sub.add_parser("evaluate", help="a run against gold: JSON lines of id, assay, value")
    p.add_argument("root")
    p.add_argument("pubnum")
    p.add_argument("run_id")
    p.add_argument("--gold", required=True)
    p.add_argument("--json", action="store_true")
    p = sub.add_parser("calibrate", help="confidence thresholds against errors: JSON lines of confidence, is_error")
    p.add_argument("scored")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if args.command == "run":
        config.target, config.off_target = args.target, args.off_target or None
        source = {name: spark.read.parquet(f"{args.source}/{name}") for name in ("pages", "prose", "entities")}
        run(spark, source, args.out, args.pubnum, args.run_id, config, Recorder(lambda name, phase, at, total: print(f"[{at}/{total}] {name}: {phase}", file=sys.stderr)))
        print(f"{args.out} {args.pubnum} {args.run_id}")
    elif args.command == "evaluate":
        told = evaluate(spark, args.root, args.pubnum, args.run_id, spark.read.schema("id string, assay string, value string").json(args.gold)).collect()
        print(json.dumps({r["line"].partition(": ")[0]: r["line"].partition(": ")[2] for r in told}) if args.json else "\n".join(r["line"] for r in told))
    else:
        rows = scoring.calibrate(spark.read.schema("confidence double, is_error boolean").json(args.scored), "confidence", F.col("is_error")).orderBy("threshold").collect()
        print(json.dumps([r.asDict() for r in rows]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
