"""Column headers as known endpoints: verbatim, then by alias, then by similarity, else null."""

from __future__ import annotations

import difflib
import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import collapse, fold
from ..functions.values import lookup, normalize_units

#: Type, aliases, BAO id, whether the published value is a logarithm, units where the header has none.
ENDPOINTS = (
    ("IC50", ("IC50", "IC-50", "IC₅₀", "half maximal inhibitory concentration"), "BAO_0000190", False, None),
    ("EC50", ("EC50", "EC-50", "EC₅₀", "half maximal effective concentration"), "BAO_0000188", False, None),
    ("Ki", ("Ki", "K_i", "Ki app", "inhibition constant"), "BAO_0000192", False, None),
    ("Kd", ("Kd", "K_d", "KD", "dissociation constant"), "BAO_0000034", False, None),
    ("XC50", ("XC50",), "BAO_0002146", False, None),
    ("AC50", ("AC50",), "BAO_0000186", False, None),
    ("ED50", ("ED50",), "BAO_0000185", False, None),
    ("GI50", ("GI50",), "BAO_0002993", False, None),
    ("IC50", ("pIC50", "pIC-50", "logIC50", "log IC50"), "BAO_0000190", True, None),
    ("EC50", ("pEC50", "pEC-50", "logEC50", "log EC50"), "BAO_0000188", True, None),
    ("Ki", ("pKi", "logKi", "log Ki"), "BAO_0000192", True, None),
    ("Kd", ("pKd", "logKd", "log Kd"), "BAO_0000034", True, None),
    ("DC50", ("DC50", "DC-50", "degradation concentration 50"), "BAO_0000179", False, None),
    ("Dmax", ("Dmax", "D max", "maximum degradation"), "BAO_0000179", False, "%"),
    ("DC50", ("pDC50", "logDC50"), "BAO_0000179", True, None),
    ("Inhibition", ("% inhibition", "percent inhibition", "inhibition (%)", "% inhibition @ fixed dose"), "BAO_0000201", False, "%"),
    ("Induction", ("% induction", "induction (%)", "induction"), "BAO_0000201", False, "%"),
    ("Degradation", ("% degradation", "degradation (%)"), "BAO_0000179", False, "%"),
    ("Viability", ("% viable cells", "% viability", "cell viability (%)"), "BAO_0002993", False, "%"),
    ("CompoundNumber", ("compound no.", "compound no", "compound number", "cmpd. no.", "cmpd no.", "cmpd. no", "cmpd no", "example no.", "example number", "entry"), None, False, None),
    ("CompoundStructure", ("compound structure", "structure", "chemical structure"), None, False, None),
    ("CompoundName", ("compound name", "iupac name", "chemical name", "name"), None, False, None),
    ("ProcedureReference", ("isoindoline synthesis", "coupling procedure", "synthesis", "synthetic procedure", "procedure", "general procedure", "method"), None, False, None),
)
#: Verbatim header, type, target, units.
HEADERS = (
    ("Compound No.", "CompoundNumber", None, None), ("HbF Induction (%)", "Induction", "HbF", "%"), ("WIZ EC50 (uM)", "EC50", "WIZ", "uM"), ("ZBTB7A EC50 (uM)", "EC50", "ZBTB7A", "uM"), ("Cmpd. No.", "CompoundNumber", None, None),
    ("Compound Structure", "CompoundStructure", None, None), ("Isoindoline synthesis", "ProcedureReference", None, None), ("Coupling procedure", "ProcedureReference", None, None), ("HiBiT DC50 (nM)", "DC50", None, "nM"),
)
ALIAS_CONFIDENCE = 0.95
THRESHOLD = 0.82
PARENTHESIS = r"[(\[]\s*([^()\[\]]{1,24}?)\s*[)\]]\s*$"
LAST_WORD = r"(?:(?<![A-Za-z0-9])([0-9][0-9.,]*)\s*)?(?<![A-Za-z0-9])([A-Za-z%µμ]{1,12})\s*$"
NUMBER_HEADER = r"(?i)comp(?:oun)?d\s*(?:no|number|#)"
DOSE = r"@\s*[0-9.,]+\s*[A-Za-z%µμ]*"

_BAO = {kind: bao for kind, _, bao, log, _ in ENDPOINTS if bao and not log}
#: Everything that can match: (text, type, BAO id, is_log_form, units, target); verbatim headers, then aliases, the longest first.
ENTRIES = [(text, kind, _BAO.get(kind), False, units, target) for text, kind, target, units in HEADERS] + sorted(
    ((alias, kind, bao, log, units, None) for kind, aliases, bao, log, units in ENDPOINTS for alias in aliases), key=lambda e: -len(e[0])
)


@functools.lru_cache(maxsize=1 << 16)
def nearest(cleaned: str, core: str) -> tuple[int, float] | None:
    """The first entry of the highest ratio that reaches the threshold; upper bounds of the ratio are tried before it."""
    best, at = 0.0, None
    for i, entry in enumerate(ENTRIES):
        m = difflib.SequenceMatcher(None, cleaned if i < len(HEADERS) else core, entry[0].lower())
        if m.real_quick_ratio() >= THRESHOLD and m.quick_ratio() >= THRESHOLD:
            ratio = m.ratio()
            if ratio >= THRESHOLD and ratio > best:
                best, at = ratio, i
    return None if at is None else (at, best)


@F.pandas_udf(T.StructType([T.StructField("entry", T.IntegerType()), T.StructField("ratio", T.DoubleType())]))
def similar_entry(cleaned: pd.Series, core: pd.Series) -> pd.DataFrame:
    found = [(nearest(a, b) if a else None) or (None, None) for a, b in zip(cleaned, core, strict=True)]
    return pd.DataFrame({"entry": pd.array([f[0] for f in found], "Int32"), "ratio": pd.array([f[1] for f in found], "Float64")})


def split_units(cleaned: Column) -> tuple[Column, Column]:
    """A header without its units, and the units. A word behind a number is a fixed dose, not a unit."""
    inner, word = F.regexp_extract(cleaned, PARENTHESIS, 1), F.regexp_extract(cleaned, LAST_WORD, 2)
    bracketed = cleaned.rlike(PARENTHESIS)
    units = normalize_units(F.when(bracketed, inner).when(F.regexp_extract(cleaned, LAST_WORD, 1) == "", word))
    core = F.when(units.isNull(), cleaned).when(bracketed, collapse(F.regexp_replace(cleaned, PARENTHESIS, ""))).otherwise(collapse(F.substring(cleaned, F.lit(1), F.length(cleaned) - F.length(word))))
    return core, units


def step(df, **made: Column):  # noqa: ANN001, ANN201
    """``df`` with more columns behind a generator: the optimizer would merge the steps and repeat each expression in every later one."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in made.items()]))))


def match_headers(rows, header: str):  # noqa: ANN001, ANN201
    """``rows`` with ``match``: struct(standard_type, units, target, bao_endpoint, is_log_form, confidence, matched); null for a header that nothing names.

    The lexicon is a fixed table, so verbatim and alias matching are expressions; only what is left reaches the
    similarity, and each different header is compared once per Python worker.
    """
    own = rows.columns
    cleaned = collapse(F.col(header))
    exact = F.when(F.col("_clean") != "", lookup(fold(F.col("_clean")), {text.lower(): i for i, (text, *_) in enumerate(HEADERS)}))
    bounded = lambda alias: rf"(?i)(?<![A-Za-z0-9])\Q{alias}\E(?![A-Za-z0-9])"
    alias = F.coalesce(*[F.when(F.col("_core").rlike(bounded(text)), F.lit(i)) for i, (text, *_) in enumerate(ENTRIES) if i >= len(HEADERS)])
    core, units = split_units(F.col("_clean"))
    out = step(step(rows, _clean=cleaned), _core=core, _units=units, _exact=exact)
    out = step(out, _alias=F.when(F.col("_exact").isNull() & (F.col("_clean") != ""), alias))
    rest = F.col("_exact").isNull() & F.col("_alias").isNull() & (F.col("_clean") != "")
    out = out.withColumn("_near", similar_entry(F.when(rest, fold(F.col("_clean"))), F.when(rest, fold(F.col("_core")))))
    out = step(out, _at=F.coalesce("_exact", "_alias", "_near.entry"))
    entry = F.try_element_at(F.array(*[F.struct(*[F.lit(x).cast(t).alias(n) for x, n, t in zip(e, ("text", "kind", "bao", "log", "unit", "target"), ("string", "string", "string", "boolean", "string", "string"), strict=True)]) for e in ENTRIES]), F.col("_at") + 1)
    out = step(out, _e=entry)
    residual = F.regexp_replace(F.regexp_replace("_core", F.concat(F.lit(r"(?i)\Q"), F.col("_e.text"), F.lit(r"\E")), F.lit(" ")), DOSE, " ")
    residual = F.nullif(F.regexp_replace(collapse(residual), r"^[ \-,;:()\[\]%.]+|[ \-,;:()\[\]%.]+$", ""), F.lit(""))
    confidence = F.when(F.col("_exact").isNotNull(), 1.0).when(F.col("_alias").isNotNull(), ALIAS_CONFIDENCE).otherwise(F.col("_near.ratio"))
    found = F.struct(
        F.col("_e.kind").alias("standard_type"), F.when(~F.col("_e.log"), F.coalesce("_units", "_e.unit")).alias("units"), F.coalesce("_e.target", residual).alias("target"), F.col("_e.bao").alias("bao_endpoint"),
        F.col("_e.log").alias("is_log_form"), confidence.alias("confidence"), F.col("_e.text").alias("matched"),
    )
    return step(out, match=F.when(F.col("_at").isNotNull(), found)).select(*own, "match")
