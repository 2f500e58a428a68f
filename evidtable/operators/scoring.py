"""Ranking with tie groups, evaluation against gold data, threshold calibration, transcription checks."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import decade_gap

TOP_SCORE = 3


def potency(scores: DataFrame, entity: str) -> DataFrame:
    """(entity, potency, top_bins): blanks add nothing; null where an entity has no score at all."""
    return scores.groupBy(entity).agg(F.sum("bin_score").cast("long").alias("potency"), F.count_if(F.coalesce(F.col("bin_score") == TOP_SCORE, F.lit(False))).alias("top_bins"))


def _order(seq: str) -> list[Column]:
    return [F.desc("potency"), F.desc("top_bins"), F.desc_nulls_last("qed"), F.asc_nulls_last("mw"), F.asc(seq)]


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 1) in a total order, and ``_part``, the range they were sorted in.

    Rows are dealt by ranges of the order and numbered where they lie; a range begins after the rows of the ranges before
    it, whose counts are one row each. The dealt rows are kept on disk, so that counts and rows come from one dealing.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part").alias("_other"), F.col("_n").alias("_m"))
    starts = sizes.join(F.broadcast(before), F.col("_other") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_start"))
    placed = dealt.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_start")


def _signal(previous: Column) -> Column:
    """What sets a row apart from the one before it, a struct that is null for the first."""
    said = F.when(previous.isNull(), "top")
    for c, name in (("potency", "potency"), ("top_bins", "top-bin count"), ("qed", "QED"), ("mw", "MW")):
        said = said.when(~F.col(c).eqNullSafe(previous[c]), name)
    return said.otherwise("tied")


def rank(entities: DataFrame, seq: str, doc: list[str] | None = None) -> DataFrame:
    """rank, tie_group, tie_size, signal: by potency, top bins, qed (nulls last), mw (nulls last), then ``seq``; null potency is unranked.

    Within ``doc`` by windows; over the whole table by ranges of the order, so that no task sorts it alone.
    """
    known, own = entities.where("potency is not null"), F.struct("potency", "top_bins", "qed", "mw")
    if doc:
        w = Window.partitionBy(*doc).orderBy(*_order(seq))
        ranked = known.withColumns({"rank": F.row_number().over(w).cast("long"), "tie_group": F.dense_rank().over(Window.partitionBy(*doc).orderBy(F.desc("potency"), F.desc("top_bins"))).cast("long")})
        ranked = ranked.withColumns({"signal": _signal(F.lag(own).over(w)), "tie_size": F.count("*").over(Window.partitionBy(*doc, "tie_group"))})
    else:
        placed = numbered(known, _order(seq), "rank")
        # the last row of a range stands before the first of the next: one row for each range
        ends = placed.groupBy("_part").agg(F.max("rank").alias("rank"), F.max_by(own, "rank").alias("_end")).select((F.col("rank") + 1).alias("rank"), "_end")
        inside = F.lag(own).over(Window.partitionBy("_part").orderBy("rank"))
        placed = placed.withColumn("_previous", inside).join(F.broadcast(ends), "rank", "left").withColumn("signal", _signal(F.coalesce("_previous", "_end")))
        ties = numbered(known.groupBy("potency", "top_bins").agg(F.count("*").alias("tie_size")), [F.desc("potency"), F.desc("top_bins")], "tie_group").drop("_part")
        ranked = placed.drop("_part", "_previous", "_end").join(ties, ["potency", "top_bins"]).select(*entities.columns, "rank", "tie_group", "signal", "tie_size")
    null = lambda t: F.lit(None).cast(t)
    rest = entities.where("potency is null").withColumns({"rank": null("long"), "tie_group": null("long"), "signal": null("string"), "tie_size": null("long")})
    return ranked.unionByName(rest)


def shortlist(entities: DataFrame, seq: str, n: int) -> DataFrame:
    """The ``n`` first of ``rank`` with rank and tie_group, without ranking the others: taken in order, then numbered."""
    top = entities.where("potency is not null").orderBy(*_order(seq)).limit(n)
    w = Window.orderBy(*_order(seq))  # n rows
    return top.withColumns({"rank": F.row_number().over(w).cast("long"), "tie_group": F.dense_rank().over(Window.orderBy(F.desc("potency"), F.desc("top_bins"))).cast("long")})


def distinct_assays(scores: DataFrame, assay: str) -> DataFrame:
    """One row: n_assays, at least 1."""
    return scores.agg(F.greatest(F.count_distinct(assay), F.lit(1)).cast("long").alias("n_assays"))


def counts_by(rows: DataFrame, kind: str, levels: list[str] | None = None) -> DataFrame:
    """(kind, n): anomalies by their kind, findings by their priority; listed levels without a row count 0."""
    found = rows.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    if levels is None:
        return found
    listed = rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, levels))).alias("kind"))
    return listed.join(found, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


def selectivity(scores: DataFrame, entity: str, assay: str, target: str, off_target: str | None, seq: str) -> DataFrame:
    """(entity, selectivity): the score on the target less that on the off-target; null if either is missing, or no off-target is named.

    Of an entity's scored rows the first whose assay is the name itself counts, else the first whose assay holds it.
    """

    def pick(name: str | None) -> Column:
        own = F.when(F.lower(assay) == (name or "").lower(), 0).when(F.contains(F.lower(assay), F.lit((name or "").lower())), 1)
        met = own.isNotNull() & F.col("bin_score").isNotNull() & F.lit(bool(name))
        return F.min_by(F.when(met, F.col("bin_score")), F.when(met, F.struct(own.alias("k"), F.col(seq).alias("s"))))

    return scores.groupBy(entity).agg((pick(target) - pick(off_target)).alias("selectivity"))


#: Tokens by which an assay without a target is known.
ASSAY_TOKENS = ("ZBTB7A", "WIZ", "HBF", "ARNT")


def assay_identity(target: Column, name: Column) -> Column:
    """The target in capitals if there is one, else the first known token in the name, else the name's letters and digits in capitals."""
    upper = F.upper(F.coalesce(name, F.lit("")))
    close = F.replace(upper, F.lit(" "), F.lit(""))
    token = F.coalesce(*[F.when(F.contains(close, F.lit(t)), F.lit(t)) for t in ASSAY_TOKENS])
    return F.when(F.coalesce(target, F.lit("")) != "", F.upper(F.trim(target))).otherwise(F.coalesce(token, F.regexp_replace(upper, r"[^\p{L}\p{N}]", "")))


def predicted_values(measurements: DataFrame, entities: DataFrame) -> DataFrame:
    """(id, assay, value): the last value that isn't empty of each entity and assay; a bin's label before the published text.

    Measurements: entity, seq, target, name, bin_label, published_value; entities: entity, local_id.
    """
    said = F.coalesce(F.nullif("bin_label", F.lit("")), F.nullif("published_value", F.lit("")))
    rows = measurements.select("entity", "seq", assay_identity(F.col("target"), F.col("name")).alias("assay"), said.alias("value")).where("value IS NOT NULL")
    return rows.join(entities.select("entity", F.col("local_id").alias("id")), "entity").groupBy("id", "assay").agg(F.max_by("value", "seq").alias("value"))


def report_lines(scores: dict[str, DataFrame]) -> DataFrame:
    """(section, line) of one-row score tables: every figure as name: value, ratios with three places, ordered by section and column."""
    parts = None
    for at, (section, one) in enumerate(scores.items()):
        told = [F.concat(F.lit(f"{c}: "), F.format_string("%.3f", F.col(c)) if t == "double" else F.col(c).cast("string")) for c, t in one.dtypes]
        lines = one.select(F.lit(at).alias("at"), F.lit(section).alias("section"), F.posexplode(F.array(*told)).alias("no", "line"))
        parts = lines if parts is None else parts.unionByName(lines)
    return parts.orderBy("at", "no").select("section", "line")


def cell_status(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """(id, assay, expected, got, status) over both; predictions for keys that gold doesn't have are ``unlisted``."""
    g = gold.select("id", "assay", F.col("value").alias("expected"), F.lit(True).alias("_g"))
    p = predicted.where("value is not null and value <> ''").select("id", "assay", F.col("value").alias("got"))
    both = g.join(p, ["id", "assay"], "full_outer")
    status = (
        F.when(F.col("_g").isNull(), "unlisted").when(F.col("expected").isNull() & F.col("got").isNotNull(), "spurious").when(F.col("expected").isNull(), "blank")
        .when(F.col("got").isNull(), "missing").when(F.col("got") == F.col("expected"), "correct").otherwise("wrong")
    )
    return both.withColumn("status", status).drop("_g")


def evaluate(status: DataFrame) -> DataFrame:
    """One row: counts, accuracy over scorable and spurious cells, precision over all predictions, recall, f1."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    one = status.agg(n("correct").alias("correct"), n("wrong").alias("wrong"), n("missing").alias("missing"), n("spurious").alias("spurious"), n("correct", "wrong", "missing").alias("gold_total"), n("correct", "wrong", "spurious", "unlisted").alias("predicted_total"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    one = one.withColumns({"accuracy": ratio(F.col("correct"), F.col("gold_total") + F.col("spurious")), "precision": ratio(F.col("correct"), F.col("predicted_total")), "recall": ratio(F.col("correct"), F.col("gold_total"))})
    return one.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def calibrate(scored: DataFrame, confidence: str, is_error: Column, steps: int = 20) -> DataFrame:
    """threshold, flagged, precision, recall, f1, best: one pass over the rows for all thresholds, the first strict maximum is best."""
    bucketed = scored.groupBy(F.col(confidence).alias("_c")).agg(F.count("*").alias("n"), F.count_if(is_error).alias("e"))
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i / steps))
    rows = bucketed.select("_c", "n", "e", grid.alias("threshold")).groupBy("threshold").agg(F.sum(F.when(F.col("_c") < F.col("threshold"), F.col("n")).otherwise(0)).alias("flagged"), F.sum(F.when(F.col("_c") < F.col("threshold"), F.col("e")).otherwise(0)).alias("caught"), F.sum("e").alias("errors"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rows = rows.withColumns({"precision": ratio(F.col("caught"), F.col("flagged")), "recall": ratio(F.col("caught"), F.col("errors"))})
    rows = rows.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    best = rows.agg(F.max_by("threshold", F.struct(F.round("f1", 12), -F.col("threshold"))).alias("_b"))
    return rows.crossJoin(F.broadcast(best)).withColumn("best", F.col("threshold") == F.col("_b")).select("threshold", "flagged", "precision", "recall", "f1", "best")


def transcription_pairs(rows: DataFrame, keys: list[str], units: str, value: str, seq: str) -> DataFrame:
    """Pairs of one key (null units are one unit) whose values are exactly three or six decades apart.

    Values meet by their decade remainder instead of all with all: partners share it, to within a bucket.
    """
    log = F.log10(value)
    base = rows.where(F.col(value) > 0).select(*keys, F.coalesce(F.col(units), F.lit("\u0000")).alias("_u"), F.col(value).alias("v"), F.col(seq).alias("s"), F.round((log - 3 * F.floor(log / 3)) * 1e6).cast("long").alias("_b"))
    a = base.select(*keys, "_u", F.col("v").alias("v_a"), F.col("s").alias("seq_a"), F.explode(F.array(F.col("_b") - 1, "_b", F.col("_b") + 1)).alias("_b")).withColumn("_b", F.pmod("_b", F.lit(3_000_000)))
    b = base.select(*keys, "_u", F.col("v").alias("v_b"), F.col("s").alias("seq_b"), F.pmod(F.col("_b"), F.lit(3_000_000)).alias("_b"))
    return a.join(b, [*keys, "_u", "_b"]).where((F.col("seq_a") < F.col("seq_b")) & decade_gap(F.col("v_a"), F.col("v_b"))).select(*keys, "seq_a", "seq_b", "v_a", "v_b")


def potency_lines(scores: DataFrame, entity: str, n_assays: int) -> DataFrame:
    """entity, lines: the sum with its parts in order; how many assays are blank; whether a value is censored. Scores: entity, seq, name, label, bin_score, is_censored; unscored rows add nothing."""
    parts = F.collect_list(F.when(F.col("bin_score").isNotNull(), F.struct("seq", F.concat("name", F.lit(" "), "label", F.lit("→"), F.col("bin_score").cast("string")).alias("t"))))
    one = scores.groupBy(entity).agg(F.array_sort(parts).alias("p"), F.coalesce(F.sum("bin_score"), F.lit(0)).cast("string").alias("total"), F.coalesce(F.bool_or(F.col("is_censored") & F.col("bin_score").isNotNull()), F.lit(False)).alias("censored"))
    few = F.concat(F.lit("scored on "), F.size("p").cast("string"), F.lit(f" of {n_assays} assays; blank cells are omitted, not counted as low"))
    lines = F.array(F.concat(F.lit("potency "), "total", F.lit(" = "), F.array_join(F.transform("p", lambda x: x["t"]), ", ")), F.when(F.size("p") < n_assays, few), F.when(F.col("censored"), F.lit("letter-bin values are censored; efficiency metrics undefined")))
    return one.select(entity, F.array_compact(lines).alias("lines"))


def score_keys(gold: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: scored, correct, skeleton_correct, accuracy, skeleton_accuracy. Gold: id, key; entities: seq, number, local_id, key. Of rows with one id the first with a key counts."""
    ids = entities.select("seq", "key", F.explode(F.array_distinct(F.array_compact(F.array(F.when(F.col("number") != 0, F.col("number").cast("string")), F.nullif(F.col("local_id").cast("string"), F.lit("")))))).alias("id"))
    best = ids.groupBy("id").agg(F.min_by(F.struct("key"), F.struct(F.col("key").isNull(), "seq")).alias("b"))
    both = gold.where("key IS NOT NULL AND key <> ''").select(F.col("id").cast("string").alias("id"), F.col("key").alias("want")).join(best, "id", "left").select("want", F.col("b.key").alias("got"))
    same = F.coalesce(F.col("got") == F.col("want"), F.lit(False))
    frame = F.coalesce(F.substring("got", 1, 14) == F.substring("want", 1, 14), F.lit(False))
    one = both.agg(F.count("*").alias("scored"), F.count_if(same).alias("correct"), F.count_if(~same & frame & (F.col("got") != "")).alias("skeleton_correct"))
    ratio = lambda a: F.coalesce(F.try_divide(a, F.col("scored")), F.lit(0.0))
    return one.withColumns({"accuracy": ratio(F.col("correct")), "skeleton_accuracy": ratio(F.col("correct") + F.col("skeleton_correct"))})


def score_examples(gold: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: scored, correct, skeleton_correct, accuracy of gold keys that any entity has."""
    keys = entities.where("key IS NOT NULL AND key <> ''")
    full, frames = keys.select(F.col("key").alias("_k"), F.lit(True).alias("_f")).distinct(), keys.select(F.substring("key", 1, 14).alias("_s"), F.lit(True).alias("_g")).distinct()
    both = gold.select("key", F.substring("key", 1, 14).alias("_p")).join(full, F.col("key") == F.col("_k"), "left").join(frames, F.col("_p") == F.col("_s"), "left")
    one = both.agg(F.count("*").alias("scored"), F.count("_f").alias("correct"), F.count("_g").alias("skeleton_correct"))
    return one.withColumn("accuracy", F.coalesce(F.try_divide("correct", "scored"), F.lit(0.0)))


def score_join(gold: DataFrame, predicted: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: gold ids with any value, those with any prediction, accuracy, entities whose id was inferred (a hard failure). Gold, predicted: id, value; entities: join_method."""
    want = gold.where("value IS NOT NULL").select("id").distinct()
    have = predicted.where("value IS NOT NULL AND value <> ''").select("id", F.lit(True).alias("_h")).distinct()
    one = want.join(have, "id", "left").agg(F.count("*").alias("gold_ids"), F.count("_h").alias("matched"))
    inferred = entities.agg(F.count_if(F.coalesce(F.col("join_method").isin("interpolated", "inferred_number"), F.lit(False))).alias("interpolated"))
    return one.crossJoin(inferred).withColumn("accuracy", F.coalesce(F.try_divide("matched", "gold_ids"), F.lit(0.0)))


def score_legends(gold: DataFrame, found: DataFrame) -> DataFrame:
    """One row: expected assays, those all of whose labels were found, contradictions found. Gold: assay, label; found: assay, label, discrepancy."""
    have = found.select("assay", "label", F.lit(True).alias("_h")).distinct()
    one = gold.select("assay", "label").distinct().join(have, ["assay", "label"], "left").groupBy("assay").agg(F.bool_and(F.col("_h").isNotNull()).alias("whole"))
    return one.agg(F.count("*").alias("expected"), F.count_if("whole").alias("recovered")).crossJoin(found.agg(F.count("discrepancy").alias("contradictions")))
