"""Links between sources: keyed, by precedence, by name; agreement of two channels."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalized_name, similarity


def last_per_key(rows: DataFrame, key: str, seq: str) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).where("_r = 1").drop("_r")


def link_keyed(left: DataFrame, right: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inner join with the last right row of each key; left rows without one; right rows without a left."""
    last = last_per_key(right, key, seq)
    return left.join(last, key), left.join(last, key, "left_anti"), last.join(left, key, "left_anti")


def precedence_candidates(examples: DataFrame, entities: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(example_seq, entity_seq, method, score): full key, name similarity, skeleton.

    Examples: doc, example_seq, full_key, skeleton, name; entities the same with entity_seq. Names meet only within
    a document and the bounds that a ratio of ``threshold`` implies for lengths, in blocks of length. Both sides grow
    with the input and are merged: Spark's size check takes few columns of a small file for a small table.
    """
    e, n = examples.alias("e"), entities.alias("n")
    pick = lambda method, score, df: df.select("doc", "example_seq", "entity_seq", F.lit(method).alias("method"), score.cast("double").alias("score"))
    full = pick("full", F.lit(1.0), e.join(n.select("doc", "entity_seq", "full_key").hint("merge"), ["doc", "full_key"]))
    skeleton = pick("skeleton", F.lit(1.0), e.join(n.select("doc", "entity_seq", "skeleton").hint("merge"), ["doc", "skeleton"]))
    a = examples.select("doc", "example_seq", normalized_name(F.col("name")).alias("a")).where("a <> ''")
    b = entities.select("doc", "entity_seq", normalized_name(F.col("name")).alias("b")).where("b <> ''")
    low = threshold / (2 - threshold)  # ratio <= 2 * shorter / (both lengths)
    reach = F.expr(f"sequence(cast(ceil(length(a) * {low}) as int), cast(floor(length(a) / {low}) as int))")
    met = a.withColumn("len", F.explode(reach)).join(b.withColumn("len", F.length("b")).hint("merge"), ["doc", "len"])
    # a ratio of ``threshold`` leaves at most this share of both lengths unmatched, and no edit distance is longer
    met = met.where(F.levenshtein("a", "b") <= F.floor((1 - threshold) * (F.length("a") + F.length("b")) + 1e-9))
    named = met.withColumn("score", similarity("a", "b")).where(F.col("score") >= threshold)
    return full.unionByName(pick("name", F.col("score"), named)).unionByName(skeleton)


def claim(candidates: DataFrame) -> DataFrame:
    """Greedy one-to-one links within a document, in the order of the examples: full key before name before skeleton.

    ``agreed``: the methods whose own best pick among the entities still free is the one taken.
    """
    rank = {"full": 0, "name": 1, "skeleton": 2}
    names = ["doc", "example_seq", "entity_seq", "method", "agreed"]
    schema = pa.schema(list(zip(names, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())), strict=True)))

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by document and example, a method's better picks first."""
        now, taken, picks = (None, None), set(), {}

        def pick() -> tuple:
            best = picks[method := min(picks, key=rank.get)]
            taken.add(best)
            return *now, best, method, sorted((m for m, p in picks.items() if p == best), key=rank.get)

        for batch in batches:
            rows = []
            for doc, example, entity, method in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc, example) != now:
                    if picks:
                        rows.append(pick())
                    if doc != now[0]:
                        taken = set()
                    now, picks = (doc, example), {}
                if method not in picks and entity not in taken:
                    picks[method] = entity
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
        if picks:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(pick(), schema, strict=True)], schema=schema)

    dealt = candidates.repartition("doc").sortWithinPartitions("doc", "example_seq", F.desc("score"), "entity_seq")
    return dealt.select("doc", "example_seq", "entity_seq", "method").mapInArrow(greedy, "doc string, example_seq long, entity_seq long, method string, agreed array<string>")


def channels(rows: DataFrame, from_name: str, from_image: str) -> Column:
    """Which channels tell of an entity with an activity row, and whether their keys agree: an array in fixed order."""
    a, b = (F.nullif(F.trim(F.col(c)), F.lit("")) for c in (from_name, from_image))
    both = a.isNotNull() & b.isNotNull()
    how = F.when(both & (a == b), "channels_agree").when(both & (skeleton(a) == skeleton(b)), "channels_agree_skeleton").when(both, "channels_conflict")
    return F.array_compact(F.array(F.lit("compound_number"), F.lit("activity_number"), F.when(a.isNotNull(), "name"), F.when(b.isNotNull(), "image"), how))


def skeleton(key: Column) -> Column:
    """The first fourteen characters of a key; null for a blank one."""
    return F.substring(F.nullif(F.trim(key), F.lit("")), 1, 14)


def full_join(entities: DataFrame, activity: DataFrame, examples: DataFrame, links: DataFrame) -> DataFrame:
    """Every entity with how it was joined, then a row for every example that joined to none.

    Entities: doc, entity_seq, local_id, number, key_from_name, key_from_image; activity: doc, number, seq (the last row of
    a number counts); examples: doc, example_seq, local_id, full_key; links: those of ``claim``. Gives doc, entity_seq,
    local_id, number, full_key, example_id, in_examples, join_method, join_channels; a null number joins nothing. All sides
    grow with the input and are merged.
    """
    active = activity.where("number IS NOT NULL").select("doc", "number").distinct().withColumn("_active", F.lit(True))
    told = examples.select("doc", "example_seq", F.col("local_id").alias("example_id"), F.col("full_key").alias("_example_key"))
    linked = links.join(told.hint("merge"), ["doc", "example_seq"]).select("doc", "entity_seq", "example_id", "method", "agreed")
    rows = entities.join(active.hint("merge"), ["doc", "number"], "left").join(linked.hint("merge"), ["doc", "entity_seq"], "left")
    base = F.when(F.col("_active"), channels(rows, "key_from_name", "key_from_image")).otherwise(F.array().cast("array<string>"))
    more = F.when(F.col("method").isNotNull(), F.concat(F.array(F.lit("example_name")), "agreed", F.when(F.size("agreed") > 1, F.array(F.lit("methods_agree"))).otherwise(F.array().cast("array<string>"))))
    method = F.nullif(F.concat_ws("+", F.when(F.col("_active"), "compound_number"), "method"), F.lit(""))
    joined = rows.select(
        "doc", "entity_seq", "local_id", "number", F.col("key_from_name").alias("full_key"), "example_id", F.col("method").isNotNull().alias("in_examples"), method.alias("join_method"),
        F.concat(base, F.coalesce(more, F.array().cast("array<string>"))).alias("join_channels"),
    )
    rest = examples.join(links.select("doc", "example_seq").hint("merge"), ["doc", "example_seq"], "left_anti")
    null = lambda t: F.lit(None).cast(t)
    tail = rest.select(
        "doc", null("long").alias("entity_seq"), "local_id", null(entities.schema["number"].dataType).alias("number"), "full_key", F.col("local_id").alias("example_id"), F.lit(True).alias("in_examples"),
        F.lit("unjoined_example").alias("join_method"), F.array(F.lit("example_name")).alias("join_channels"),
    )
    return joined.unionByName(tail)


def cross_check(name_key: Column, image_key: Column) -> Column:
    """struct(tier, key, skeleton, source): agreement of two channels and what stands. The name's key stands wherever there is one; in a conflict it is the only source."""
    a, b = (F.nullif(F.trim(c), F.lit("")) for c in (name_key, image_key))
    label = tier(name_key, image_key)
    source = F.when(label.isin("AGREE_FULL", "AGREE_SKELETON"), "name+image").when(a.isNotNull(), "name").when(b.isNotNull(), "image").otherwise("none")
    return F.struct(label.alias("tier"), F.coalesce(a, b).alias("key"), skeleton(F.coalesce(a, b)).alias("skeleton"), source.alias("source"))


def tier(name_key: Column, image_key: Column) -> Column:
    """Agreement of two channels' keys; blanks count as absent."""
    a, b = (F.when(F.trim(c) == "", F.lit(None)).otherwise(F.trim(c)) for c in (name_key, image_key))
    return (
        F.when(a.isNull() & b.isNull(), "NONE").when(a.isNull() | b.isNull(), "SINGLE_SOURCE").when(a == b, "AGREE_FULL")
        .when(F.substring(a, 1, 14) == F.substring(b, 1, 14), "AGREE_SKELETON").otherwise("CONFLICT")
    )
