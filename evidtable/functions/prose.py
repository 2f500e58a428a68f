"""Running text: example headings, terms with their context, publication numbers. What needs a match's place runs in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import collapse

HEADING = r"(?i)\[?[0-9]{0,6}\]?\s*Example\s+([0-9]+[A-Za-z]?)\s*[:.–-]\s*([^\n]{20,400})"
#: Reported term, pattern; words around a hit that make it none.
TERMS = {
    "in vivo": r"(?i)\bin\s+vivo\b", "mouse": r"(?i)\b(?:mouse|mice)\b", "murine": r"(?i)\bmurine\b", "rat": r"(?i)\brats?\b", "xenograft": r"(?i)\bxenograft\w*\b", "pharmacokinetic": r"(?i)\bpharmacokinetic\w*\b",
    "PK": r"\bPK\b", "oral bioavailability": r"(?i)\boral\s+bioavailability\b", "%F": r"%\s?F\b", "AUC": r"\bAUC\b", "Cmax": r"(?i)\bC\s?max\b",
}
EXCLUDED = (
    r"(?i)anti\s*-?\s*human|antibod|monoclonal|\bclone\b|isotype|conjugat|labell?ed\s+\w+\s+anti|flow\s+cytometr|stain(?:ed|ing)|biosciences|biolegend|reagent|imaging|isotop|radiolabel|deuter|tritium|scintigraph"
)
CONTEXT = 120
#: A publication number, its shape, a label before it, offices, characters read for a digit of the kind.
NUMBER = r"(?P<cc>[A-Z]{2})\s?(?P<num>[\d/ ]{6,15})\s?(?P<kind>[A-Z]\d?)"
SHAPE = r"[A-Z]{2}\d{6,13}[A-Z]\d?"
LABEL = r"(?i)\(\s*10\s*\)|publication\s+number|pub\.?\s*no\.?"
OFFICES = frozenset("WO US EP GB DE FR JP CN KR CA AU IN BR RU MX IL ZA SG NZ EA AP OA AR CL TW".split())
DIGITS = {"l": "1", "I": "1", "i": "1", "|": "1", "!": "1", "O": "0", "o": "0"}
LABEL_REACH = 240


def examples(text: Column) -> Column:
    """array of struct(id, name, has_nmr, has_ms): headings, each with what the text up to the next one shows."""
    heads = F.arrays_zip(F.regexp_extract_all(text, F.lit(HEADING), 1).alias("id"), F.regexp_extract_all(text, F.lit(HEADING), 2).alias("name"), F.slice(F.split(text, HEADING), 2, 1 << 30).alias("body"))
    found = lambda h, p: F.coalesce(h["body"], F.lit("")).rlike(p)
    return F.transform(F.filter(heads, lambda h: h["id"].isNotNull()), lambda h: F.struct(h["id"].alias("id"), collapse(h["name"]).alias("name"), found(h, r"(?i)\bNMR\b").alias("has_nmr"), found(h, r"(?i)MS\s*\(?ESI").alias("has_ms")))


@F.pandas_udf(T.ArrayType(T.StringType()))
def in_vivo_terms(text: pd.Series) -> pd.Series:
    """Terms with a hit whose surroundings hold none of the excluded words, in fixed order."""
    terms, excluded = {t: re.compile(p) for t, p in TERMS.items()}, re.compile(EXCLUDED)

    def one(x: str | None) -> list[str]:
        clear = lambda m: not excluded.search(x[max(0, m.start() - CONTEXT) : m.end() + CONTEXT])
        return [t for t, p in terms.items() if any(map(clear, p.finditer(x)))] if x else []

    return text.map(one, na_action=None)


@F.pandas_udf(T.StringType())
def publication_number_in(text: pd.Series) -> pd.Series:
    """The best publication number of a text: 2 for a label before it, 1 for a known office, the first of the best; null where the best has none."""
    number, shape, label = re.compile(NUMBER), re.compile(SHAPE), re.compile(LABEL)

    def rated(x: str) -> list[tuple[int, int, str]]:
        out = []
        for m in number.finditer(x):
            kind = m["kind"] + (DIGITS.get(x[m.end() : m.end() + 1], "") if len(m["kind"]) == 1 else "")
            plain = re.sub(r"[\s/]", "", m["cc"] + m["num"] + kind).upper()
            if x[m.start() - 1 : m.start()] != "/" and shape.fullmatch(plain):
                points = 2 * bool(label.search(x, max(0, m.start() - LABEL_REACH), m.start())) + (m["cc"] in OFFICES)
                out.append((-points, m.start(), plain))
        return out

    def one(x: str | None) -> str | None:
        best = min(rated(x), default=(0, 0, None)) if x else (0, 0, None)
        return best[2] if best[0] else None

    return text.map(one, na_action=None)


def investment_reasons(examples: Column, claims: Column, prose: Column, terms: Column) -> Column:
    """What speaks for an entity beyond its values, in fixed order."""
    told = lambda c, t: F.when(F.coalesce(c, F.lit(False)), t)
    return F.array_compact(F.array(
        told(examples, F.lit("appears in the Examples with full synthesis and NMR/MS characterization")), told(claims, F.lit("named in the claims")), told(prose, F.lit("discussed in prose outside the tables")),
        told(F.size(terms) > 0, F.concat(F.lit("in vivo data reported ("), F.array_join(terms, ", "), F.lit(")"))),
    ))
