"""Review findings, corrections and provenance gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import looks_numeric
from . import scoring

PRIORITIES = {"high": 0, "medium": 1, "info": 2}
#: Anomalies of a document that a reader has to look at.
DOCUMENT_TRIGGERS = {"detector_disagreement": "medium", "rotation_uncertain": "medium"}
CONFIDENCE, HEAVY_ATOMS = 0.85, 70


def findings(rows: DataFrame, keep: list[str], rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One row per rule that a row meets: keep, priority, trigger, rule_no. Rules are evaluated in one pass."""
    made = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(priority).alias("priority"), F.lit(trigger).alias("trigger"), F.lit(i).alias("rule_no"))) for i, (priority, trigger, cond) in enumerate(rules)]))
    return rows.select(*keep, F.explode(made).alias("f")).select(*keep, "f.priority", "f.trigger", "f.rule_no")


def entity_findings(entities: DataFrame, measurements: DataFrame, expected: int | None = None, confidence: float = CONFIDENCE, heavy: int = HEAVY_ATOMS) -> DataFrame:
    """(doc, entity_seq, measurement_seq: null, priority, trigger, rule_no) of entities.

    Entities: doc, entity_seq, number, parse_status, tier, broken (channels whose structure can't be read: array),
    min_atom, min_bond, heavy_atoms, markush; measurements: doc, entity_seq. A number is compared with the last one
    read before it in its document.
    """
    n = measurements.groupBy("doc", "entity_seq").agg(F.count("*").alias("_n"))
    before = F.last("number", ignorenulls=True).over(Window.partitionBy("doc").orderBy("entity_seq").rowsBetween(Window.unboundedPreceding, -1))
    rows = entities.withColumn("_before", before).join(n, ["doc", "entity_seq"], "left")
    rules = [
        ("high", "opsin_parse_failure", F.col("parse_status") == "FAILURE"),
        ("high", "crosscheck_conflict", F.col("tier") == "CONFLICT"),
        ("high", "smiles_sanitization_failure", F.size("broken") > 0),
        ("high", "compound_number_unreadable", F.col("number").isNull()),
        ("high", "compound_number_monotonicity", F.col("number") < F.col("_before")),
        ("high", "activity_cell_blank", F.coalesce("_n", F.lit(0)) < F.lit(expected)),
        ("medium", "crosscheck_agree_skeleton", F.col("tier") == "AGREE_SKELETON"),
        ("medium", "ocsr_low_confidence", F.least("min_atom", "min_bond") < confidence),
        ("medium", "heavy_atom_count", F.col("heavy_atoms") > heavy),
        ("info", "markush_structure", F.col("markush")),
    ]
    return findings(rows.withColumn("measurement_seq", F.lit(None).cast("long")), ["doc", "entity_seq", "measurement_seq"], rules)


def measurement_findings(measurements: DataFrame) -> DataFrame:
    """The same columns of measurements: doc, entity_seq, measurement_seq, published_value, published_units, value, units, bin_label, bin_definition, lower, upper, bin_score."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    lettered = ~empty("bin_label")
    resolved = F.col("bin_definition").isNotNull() | F.col("lower").isNotNull() | F.col("upper").isNotNull() | F.col("bin_score").isNotNull()
    valued = looks_numeric(F.col("published_value")) | F.col("value").isNotNull()
    rules = [
        ("high", "activity_cell_blank", blank(F.col("published_value")) & ~lettered & F.col("value").isNull()),
        ("high", "bin_letter_outside_legend", lettered & ~resolved),
        ("high", "units_unrecognized", valued & ~lettered & empty("units") & empty("published_units")),
    ]
    return findings(measurements, ["doc", "entity_seq", "measurement_seq"], rules)


def document_findings(anomalies: DataFrame) -> DataFrame:
    """The same columns of anomalies (doc, seq, kind) of the kinds that need a reader; they belong to no entity."""
    rules = [(priority, kind, F.col("kind") == kind) for kind, priority in DOCUMENT_TRIGGERS.items()]
    found = findings(anomalies.select("doc", "kind", F.lit(None).cast("long").alias("entity_seq"), F.col("seq").cast("long").alias("measurement_seq")), ["doc", "entity_seq", "measurement_seq"], rules)
    return found.withColumn("measurement_seq", F.lit(None).cast("long"))


def build_queue(entities: DataFrame, measurements: DataFrame, anomalies: DataFrame, expected: int | None = None) -> DataFrame:
    """All findings with ``found_in`` (0: entities, 1: measurements, 2: document): with the sequence columns, the order in which a reader meets them."""
    parts = (entity_findings(entities, measurements, expected), measurement_findings(measurements), document_findings(anomalies))
    marked = [p.withColumn("found_in", F.lit(i)) for i, p in enumerate(parts)]
    return marked[0].unionByName(marked[1]).unionByName(marked[2])


def sorted_queue(queue: DataFrame, *ties: str) -> DataFrame:
    level = F.lit(len(PRIORITIES))
    for name, at in PRIORITIES.items():
        level = F.when(F.col("priority") == name, at).otherwise(level)
    return queue.orderBy(level, *ties)


def record_corrections(log: DataFrame, edits: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """``log`` with ``edits`` behind it (seq, target_kind, target_id, field, original, corrected, note); an edit of a field that its kind doesn't have stops the job."""
    known = F.coalesce(*[F.when(F.col("target_kind") == kind, F.col("field").isin(*names)) for kind, names in fields.items()], F.lit(False))
    told = F.when(known, F.col("field")).otherwise(F.raise_error(F.concat(F.col("field"), F.lit(" is no field of "), F.col("target_kind"))).cast("string"))
    return log.unionByName(edits.withColumn("field", told))


def correction_rows(log: DataFrame) -> DataFrame:
    """Every entry of a log beside the value before the first edit of its target and field."""
    first = F.first_value("original").over(Window.partitionBy("target_kind", "target_id", "field").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0))
    return log.withColumn("original", first)


def write_corrections(log: DataFrame, path: str) -> None:
    log.write.mode("errorifexists").parquet(path)


def read_corrections(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(path)


def latest_corrections(log: DataFrame) -> DataFrame:
    """(target_id, field, original, corrected, n_edits) of an append-only log: the value before the first edit, the last one after."""
    return log.groupBy("target_id", "field").agg(F.min_by("original", "seq").alias("original"), F.max_by("corrected", "seq").alias("corrected"), F.count("*").alias("n_edits"))


def replay(base: DataFrame, key: str, log: DataFrame, fields: list[str], whole_numbers: tuple[str, ...] = ()) -> DataFrame:
    """``base`` with the last correction of each field laid over it; a correction to null stays null, and so does one of ``whole_numbers`` to anything but digits."""
    last = log.where(F.col("field").isin(*fields)).groupBy("target_id", "field").agg(F.max_by(F.struct("corrected"), "seq").alias("c"))
    cols = last.groupBy("target_id").pivot("field", fields).agg(F.first("c"))
    cols = cols.select(F.col("target_id").alias(key), *[F.col(f).alias(f"_c_{f}") for f in fields])
    out = base.join(cols, key, "left")
    kinds = dict(base.dtypes)
    for f in fields:
        said = F.col(f"_c_{f}")["corrected"]
        said = F.when(said.rlike("^[0-9]+$"), said) if f in whole_numbers else said
        out = out.withColumn(f, F.when(F.col(f"_c_{f}").isNotNull(), said.try_cast(kinds[f])).otherwise(F.col(f)))
    return out.drop(*[f"_c_{f}" for f in fields])


def rekey(corrected: DataFrame, before: DataFrame, key: str, channels: dict[str, str], inchikey) -> DataFrame:  # noqa: ANN001
    """Identity keys that follow corrected structures.

    ``channels``: structure column to its key column; ``inchikey``: Column to Column, null for what can't be read. A
    changed channel gets its own key; where the final structure was empty or that channel's, or is itself corrected,
    final, inchikey_full and inchikey_skeleton follow, cleared if the new structure can't be read. Of several changed
    channels the first in order decides the final one. Both frames: ``key``, the channels, their keys, smiles_final.
    """
    old = before.select(key, *[F.col(c).alias(f"_was_{c}") for c in (*channels, "smiles_final")])
    out = corrected.join(old, key)
    changed = {c: ~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in (*channels, "smiles_final")}
    empty = F.coalesce(F.col("_was_smiles_final"), F.lit("")) == ""
    final, moved = F.when(changed["smiles_final"], F.col("smiles_final")), changed["smiles_final"]
    for c in channels:
        follows = changed[c] & ~moved & (empty | F.col("_was_smiles_final").eqNullSafe(F.col(f"_was_{c}")))
        final, moved = final.when(follows, F.col(c)), moved | follows
    out = out.withColumns({"_moved": moved, "_final": final})
    made = {own: F.when(changed[c], inchikey(F.col(c))).otherwise(F.col(own)) for c, own in channels.items()}
    full = F.when(F.col("_moved"), inchikey(F.col("_final"))).otherwise(F.col("inchikey_full"))
    made |= {"smiles_final": F.when(F.col("_moved"), F.col("_final")).otherwise(F.col("smiles_final")), "inchikey_full": full}
    out = out.withColumns(made)
    return out.withColumn("inchikey_skeleton", F.when(F.col("_moved"), F.substring("inchikey_full", 1, 14)).otherwise(F.col("inchikey_skeleton"))).select(*corrected.columns)


def corrected_ranking(entities: DataFrame, scores: DataFrame, entity: str, score_key: str, log: DataFrame) -> DataFrame:
    """Ranks after a log's corrections of ``bin_score`` are laid over ``scores`` (score_key, entity, bin_score); the tables themselves stay as they are."""
    mended = replay(scores, score_key, log, ["bin_score"])
    return scoring.rank(entities.join(scoring.potency(mended, entity), entity, "left").withColumn("top_bins", F.coalesce("top_bins", F.lit(0).cast("long"))), entity)


def provenance_gap(page: Column, x0: Column, y0: Column, x1: Column, y1: Column, path: Column) -> Column:
    """What is missing from a field's origin, joined; null where nothing is."""
    parts = F.array_compact(F.array(F.when(page.isNull() | (page < 1), "page"), F.when(F.coalesce((x1 <= x0) | (y1 <= y0), F.lit(True)), "bbox"), F.when(F.coalesce(F.trim(path) == "", F.lit(True)), "crop")))
    return F.when(F.size(parts) > 0, F.array_join(parts, ","))
