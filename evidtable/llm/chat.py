"""Chat formatting from reply trees.

Messages are nodes with a parent. Iterative self-joins enumerate every root-to-leaf path: in round n a path knows the
nearest 2^n ancestors of its leaf, and the table of jumps is joined with itself, so a tree of depth d takes log2(d)
rounds and the rows made are the rows of the paths. Paths are ranked within their conversation by the sum of their
nodes' scores (ties: the smaller leaf), and each chosen path becomes one formatted conversation with a loss mask.

Template: ``[USER]text[/USER]``, ``[SYSTEM]text[/SYSTEM]``, ``[OUT]text</s>`` for an assistant, and
``[ROLE=role]text[/ROLE]`` for any other role. Inside texts and roles ``&``, ``<``, ``[`` and ``]`` are written as
``&amp;``, ``&lt;``, ``&lsqb;`` and ``&rsqb;``, so that no control string can occur there and reading back is exact.

Defined results: a null text or role is empty; rows with a null conversation id form one conversation with that id;
repeated rows and equal turns are turns each, ordered by turn (nulls first), role and text; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, slices, stage

#: Template marks by role; fixed values.
MARKS = {"user": ("[USER]", "[/USER]"), "system": ("[SYSTEM]", "[/SYSTEM]"), "assistant": ("[OUT]", "</s>")}
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"), ("]", "&rsqb;"))
_TURN = re.compile(r"\[USER\]([^\[]*)\[/USER\]|\[SYSTEM\]([^\[]*)\[/SYSTEM\]|\[OUT\]([^<]*)</s>|\[ROLE=([^\]]*)\]([^\[]*)\[/ROLE\]")


def escape(text: str) -> str:
    for a, b in ESCAPES:
        text = text.replace(a, b)
    return text


def unescape(text: str) -> str:
    for a, b in reversed(ESCAPES):
        text = text.replace(b, a)
    return text


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation as one string, and the spans under the loss mask: what is between an assistant's marks."""
    out, mask, at = [], [], 0
    for role, text in turns:
        a, z = MARKS.get(role) or (f"[ROLE={escape(role)}]", "[/ROLE]")
        body = escape(text)
        if role == "assistant":
            mask.append((at + len(a), at + len(a) + len(body)))
        out += (a, body, z)
        at += len(a) + len(body) + len(z)
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a formatted conversation at {at}")
        at = m.end()
        user, system, assistant, role, text = m.groups()
        turns.append(("user", unescape(user)) if user is not None else ("system", unescape(system)) if system is not None else ("assistant", unescape(assistant)) if assistant is not None else (unescape(role), unescape(text)))
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return turns


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Reply-tree nodes of turn tables: every turn answers the one before it."""
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    numbered = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(w).cast("long"))
    return numbered.select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame) -> DataFrame:
    """(conv, leaf, node, up): each node of each root-to-leaf path, ``up`` steps above the leaf. ``nodes``: conv, node, parent."""
    links = nodes.select("conv", "node", "parent")
    inner = links.where("parent is not null").select("conv", F.col("parent").alias("node")).distinct()
    known = stage(links.join(inner, ["conv", "node"], "left_anti").select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "leaves")
    jumps = links.where("parent is not null").withColumnRenamed("parent", "to")
    step = 1
    while True:
        above = known.join(jumps, ["conv", "node"]).select("conv", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        known = stage(known.union(above), "paths")
        far = jumps.select("conv", "node", F.col("to").alias("mid")).join(jumps.select("conv", F.col("node").alias("mid"), "to"), ["conv", "mid"])
        jumps = stage(far.select("conv", "node", "to"), "jumps")
        step *= 2
        if jumps.isEmpty():
            return known


def format_trees(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """conv_id, leaf, branch (rank of the path in its conversation), formatted, loss (spans). ``branches``: only so many best paths; None: all.

    ``nodes``: conv_id, node, parent (null: a root), role, text, score.
    """
    kind = nodes.schema["conv_id"].dataType.simpleString()
    name = F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string")))
    held = stage(nodes.withColumn("conv", name), "nodes")
    found = paths(held).join(held.select("conv", "node", "conv_id", "role", "text", "score"), ["conv", "node"])
    turn = F.struct((-F.col("up")).alias("at"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = found.groupBy("conv", "leaf").agg(F.first("conv_id").alias("conv_id"), F.sum("score").alias("score"), F.sort_array(F.collect_list(turn)).alias("turns"))
    ranked = told.withColumn("branch", F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf")).cast("long"))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in slices(batches):
            made = [format_turns([(t["role"], t["text"]) for t in x.as_py()]) for x in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x for x, _ in made]), pa.array([[{"start": a, "end": z} for a, z in m] for _, m in made], span)],
                names=["conv_id", "leaf", "branch", "formatted", "loss"],
            )

    return map_arrow(ranked.select("conv_id", "leaf", "branch", "turns"), work, f"conv_id {kind}, leaf long, branch long, formatted string, loss array<struct<start:long,end:long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the formatted text and its mask."""
    import hashlib

    kind = formatted.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in slices(batches):
            rows = []
            for text, mask in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = read_turns(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            cols = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return map_arrow(formatted.select("conv_id", "formatted", "loss"), work, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
