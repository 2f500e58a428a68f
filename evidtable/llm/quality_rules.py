"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once and stores the measurements with a bitmask of the rules that failed;
``apply_policy`` reads a verdict from the mask under a versioned policy; ``ablation`` counts, by bitwise aggregation,
what each rule of a policy rejects and what it alone rejects. Changing a policy never measures a text again.

Defined results: a null text has no words and fails the rules on too few words; rows are judged one by one, so repeated
rows each get a row; an empty table gives an empty ledger; other columns of the table ride along in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]"
WINDOW = 5
#: Measurements as longs, in ledger order.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
#: Rule bits: name and condition of failure.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("shouting", "100 * n_upper > 50 * word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Versioned policies: the mask of the rules that reject.
POLICIES = {"base-1": BASE, "web-1": (1 << len(RULES)) - 1}
DEFAULT_POLICY = "web-1"


def _windows(words: Column, n: Column) -> Column:
    """Structs of ``WINDOW`` words and their start, sorted: equal windows lie side by side."""
    m = F.greatest(n - (WINDOW - 1), F.lit(0))
    return F.sort_array(F.arrays_zip(*[F.slice(words, k + 1, m) for k in range(WINDOW)], F.when(m > 0, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))))


def _repeated_starts(windows: Column) -> Column:
    """Sorted starts of windows that the text has twice or more."""
    m = F.greatest(F.size(windows) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(windows, 1, m), F.slice(windows, 2, m))

    def same(p: Column) -> Column:
        eq = p["0"]["0"] == p["1"]["0"]
        for k in range(1, WINDOW):
            eq = eq & (p["0"][str(k)] == p["1"][str(k)])
        return eq

    at = str(WINDOW)
    return F.sort_array(F.array_distinct(F.flatten(F.transform(F.filter(pairs, same), lambda p: F.array(p["0"][at], p["1"][at])))))


def _covered(starts: Column) -> Column:
    """Positions in the union of the windows that begin at ``starts``."""
    m = F.greatest(F.size(starts) - 1, F.lit(0))
    steps = F.zip_with(F.slice(starts, 1, m), F.slice(starts, 2, m), lambda a, b: F.least(F.lit(WINDOW), b - a))
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(WINDOW), lambda acc, x: acc + x))


def measure(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with the columns of MEASURES for ``text``."""
    own = rows.columns
    t = F.coalesce(text, F.lit(""))
    df = rows.select(*own, t.alias("_t"))
    df = df.select(*own, "_t", F.array_remove(F.split("_t", f"{SPACE}+"), "").alias("_w"), F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_l"))
    df = df.select(
        *own, F.size("_w").alias("_n"), _windows(F.col("_w"), F.size("_w")).alias("_z"), F.size("_l").alias("_nl"), F.size(F.array_distinct("_l")).alias("_dl"),
        F.length(F.regexp_replace("_t", f"{SPACE}+", "")).alias("_c"), F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).alias("_s"), F.length(F.regexp_replace("_t", "[^\\p{Lu}]+", "")).alias("_u"),
    )
    df = df.withColumn("_r", _repeated_starts(F.col("_z")))
    made = {"n_words": "_n", "word_chars": "_c", "n_symbols": "_s", "n_dup_lines": F.col("_nl") - F.col("_dl"), "n_repeat_words": _covered(F.col("_r")), "n_lines": "_nl", "n_upper": "_u"}
    return df.select(*own, *[(F.col(v) if isinstance(v, str) else v).cast("long").alias(k) for k, v in made.items()])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """row (all columns of ``docs``), MEASURES, failed: the mask of the rules that failed."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = measure(packed, F.col("row")[text])
    mask = F.lit(0).cast("long")
    for i, (_, rule) in enumerate(RULES):
        mask = mask.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    entry = F.struct(*[F.col(m) for m in MEASURES], mask.alias("failed"))
    # a generator, so that a later filter on the mask isn't pushed below and every rule and measurement evaluated again for it
    return found.select("row", F.explode(F.array(entry)).alias("entry")).select("row", "entry.*")


def apply_policy(found: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with base_failed and kept under a policy; the base rules always reject."""
    reject = POLICIES[policy] | BASE
    return found.withColumns({"base_failed": F.col("failed").bitwiseAND(F.lit(BASE)) != 0, "kept": F.col("failed").bitwiseAND(F.lit(reject)) == 0})


def ablation(found: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """rule, n_failed, n_only: for each rule of a policy how many documents fail it, and how many only it rejects (leaving it out keeps them).

    Documents are counted by their mask, of which there are at most 2 ** rules; the rules are read from the masks' bits.
    """
    reject = POLICIES[policy] | BASE
    masks = found.groupBy(F.col("failed").bitwiseAND(F.lit(reject)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit")) for name, bit in BIT.items() if reject & bit]))
    # a mask of no documents, so that an empty table tells every rule
    masks = masks.unionByName(masks.sparkSession.range(1).select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("n")))
    each = masks.select("mask", "n", rules.alias("r")).select("mask", "n", "r.*")
    among = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0))).cast("long")
    return each.groupBy("rule").agg(among(F.col("mask").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), among(F.col("mask") == F.col("bit")).alias("n_only"))


def keep(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with the columns of ``docs``."""
    return apply_policy(ledger(docs), policy).where("kept").select("row.*")
