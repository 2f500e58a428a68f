"""Shared pieces of the training-data operators: staging, Arrow batches, labels of components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of a Python-side slice; an Arrow batch is worked through in slices, so that lists of texts stay small.
SLICE_ROWS = 256
#: Rows are long here: Spark's own bound of 64 MB a batch is held several times by each running task.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; a new temporary one on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not spark.conf.get("evidtable.shared.dir", None):
        spark.conf.set("evidtable.shared.dir", "file://" + tempfile.mkdtemp(prefix="evidtable-"))
    return spark.conf.get("evidtable.shared.dir")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/evidtable/{uuid.uuid4().hex}-{tag}"


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts lineage, survives lost executors.

    Zstandard frees its buffers with each file; Snappy's direct ones stay until the JVM happens to collect them, which adds
    up over many small tasks.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_BYTES, in the JVM and in Python; a row is never cut."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def keep_columns(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` packed into ``row``: what an operator adds beside it can't clash with a name."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _drawn(links: DataFrame) -> DataFrame:
    """Links with the same components as ``links`` (a < b, distinct), drawn together while they far outnumber their larger ends.

    A node keeps the link to its smallest neighbour m below it; a link to another one, a, becomes (m, a). Links never
    grow in number, and where each larger end has one link they are a forest.
    """
    n = links.count()
    while True:
        least = stage(links.groupBy("b").agg(F.min("a").alias("m")), "least")
        if 4 * n <= 5 * least.count():
            return links
        ends = F.explode(F.array("a", "b"))
        drawn = links.join(least, "b").select("m", ends.alias("z")).where("m <> z").select(F.col("m").alias("a"), F.col("z").alias("b")).distinct()
        links, was = stage(drawn, "drawn"), n
        n = links.count()
        if 4 * n > 3 * was:
            return links


def min_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, label) for every node of ``edges`` (a, b: long), label the smallest node reachable.

    First links are drawn to the smallest neighbour, so the rounds join about one link for each node, however many
    there were. Each round takes the smallest label among the neighbours (partial minima before the shuffle), then
    jumps to the label's own label, so the rounds follow the logarithm of a component's diameter. Every round is a
    staged table: a join reads plain scans on both sides, so adaptive execution can split a hot neighbour.
    """
    # both directions from one reading of a link: were links made twice, the two readings could differ in what spans a group
    drawn = _drawn(stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("b").alias("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = stage(drawn.select(ways.alias("e")).select("e.a", "e.b"), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels0")
    for n in range(1, max_rounds + 1):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("was"))
            .union(labels.select("node", "label", F.col("label").alias("was")))
            .groupBy("node").agg(F.min("label").alias("label"), F.max("was").alias("was"))
        )
        near = stage(near, f"near{n}")
        jumped = near.join(near.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", F.least("label", "next").alias("label"), "was")
        labels = stage(jumped, f"labels{n}")
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
