"""Units, published cells and standardized values as column expressions. Null is a refusal, never a default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blank cells, relation spellings in matching order, unit words, factors to nanomolar, types with a pChEMBL.
BLANKS = ("", "-", "–", "—", "--")
RELATIONS = ((">=", ">="), ("<=", "<="), ("≥", ">="), ("≤", "<="), (">", ">"), ("<", "<"))
PREFIXES = {"": "M", "m": "mM", "u": "uM", "p": "uM", "n": "nM"}
UNIT_WORDS = {"molar": "M", "millimolar": "mM", "micromolar": "uM", "nanomolar": "nM", "percent": "%", "pct": "%"}
TO_NM = {"M": 1e9, "mM": 1e6, "uM": 1e3, "nM": 1.0}
PCHEMBL_TYPES = ("IC50", "XC50", "EC50", "AC50", "Ki", "Kd", "Potency", "ED50")
INVERTED = {">": "<", "<": ">", ">=": "<=", "<=": ">="}
NUMBER = r"^([-+]?(?:[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"


def lookup(key: Column, table: dict, default: Column | None = None) -> Column:
    """The entry of a fixed table; ``default``, else null, for a key that it doesn't have."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)
    return found if default is None else F.coalesce(found, default)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda v: use(v)), 1)


def normalize_units(raw: Column) -> Column:
    """Canonical unit or null: M, mM, uM, nM, nm, %."""
    t = F.trim(F.regexp_replace(F.trim(F.regexp_replace(F.trim(raw), r"^[()\[\]{}]+|[()\[\]{}]+$", "")), r"[.,;:]+$", ""))

    def known(u: Column) -> Column:
        molar = lookup(F.lower(F.substring(u, F.lit(1), F.greatest(F.length(u) - 1, F.lit(0)))), PREFIXES)
        return F.when(u.isNull() | (u == ""), F.lit(None)).when(u.isin("nm", "%"), u).when(u.endswith("M"), molar).otherwise(lookup(F.lower(u), UNIT_WORDS))

    return let(F.translate(t, "µμ", "uu"), known)


def to_nm(value: Column, units: Column) -> Column:
    """Value in nanomolar; null for anything that isn't molar."""
    return value * lookup(normalize_units(units), TO_NM)


def parse_cell(raw: Column) -> Column:
    """struct(relation, value, text, is_blank) of a published cell."""
    body = F.trim(F.coalesce(raw, F.lit("")))
    leading = "^(" + "|".join(t for t, _ in RELATIONS) + ")"
    sign = F.regexp_extract(body, leading, 1)
    relation = lookup(sign, dict(RELATIONS), F.lit("="))
    rest = F.trim(F.substring(body, F.length(sign) + 1, F.length(body)))
    number = F.regexp_extract(rest, NUMBER, 1)
    value = F.when(number != "", F.replace(number, F.lit(","), F.lit("")).try_cast("double"))  # a cast that fails is slow
    blank = body.isin(*BLANKS)
    return F.struct(
        F.when(blank, F.lit("=")).otherwise(relation).alias("relation"), F.when(~blank, value).alias("value"), F.when(~blank & (number == ""), rest).alias("text"), blank.alias("is_blank")
    )


def pchembl(kind: Column, relation: Column, value: Column, units: Column, comment: Column | None = None) -> Column:
    """9 - log10 of an exact nanomolar value of an eligible type."""
    ok = kind.isin(*PCHEMBL_TYPES) & (relation == "=") & (units == "nM") & (value > 0)
    if comment is not None:
        ok = ok & (comment.isNull() | (F.lower(F.trim(comment)).isin("", "manually validated")))
    return F.when(ok, 9 - F.log10(value))


def pdc50(value: Column, relation: Column) -> Column:
    return F.when((relation == "=") & (value > 0), 9 - F.log10(value))


def standardize(value: Column, relation: Column, units: Column, is_log: Column, canonical: bool = False) -> Column:
    """struct(value, units, relation); a null struct refuses. Log forms flip the relation. Units that are ``canonical`` are not read again."""
    log = F.struct(F.pow(F.lit(10.0), 9 - value).alias("value"), F.lit("nM").alias("units"), lookup(relation, INVERTED, F.lit("=")).alias("relation"))

    def own(unit: Column) -> Column:
        molar = unit.isin(*TO_NM)
        found = F.struct(F.when(molar, value * lookup(unit, TO_NM)).otherwise(value).alias("value"), F.when(molar, F.lit("nM")).otherwise(unit).alias("units"), relation.alias("relation"))
        return F.when((unit == "%") | molar, found)

    return F.when(value.isNull(), F.lit(None)).when(is_log, log).otherwise(own(units) if canonical else let(normalize_units(units), own))


def bin_fields(lower: Column, upper: Column, units: Column) -> Column:
    """struct(lower, upper, units, relation, direction) of an interval; no midpoint is ever made."""
    molar, factor = units.isin(*TO_NM), lookup(units, TO_NM)
    one_upper, one_lower = upper.isNotNull() & lower.isNull(), lower.isNotNull() & upper.isNull()
    return F.struct(
        F.when(molar, lower * factor).otherwise(lower).alias("lower"), F.when(molar, upper * factor).otherwise(upper).alias("upper"), F.when(molar, F.lit("nM")).otherwise(units).alias("units"),
        F.when(one_upper, F.lit("<")).when(one_lower, F.lit(">")).otherwise(F.lit("=")).alias("relation"), F.when(one_upper, F.lit("upper_bound")).when(one_lower, F.lit("lower_bound")).alias("direction"),
    )


def bin_key(text: Column) -> Column:
    """A printed bin letter as its label: trimmed, upper case, one letter repeated counts once; null if empty."""
    key = F.upper(F.regexp_replace(F.trim(text), r"^[.,;:()\[\]]+|[.,;:()\[\]]+$", ""))
    return F.when(key == "", F.lit(None)).when(key.rlike(r"^(.)\1+$"), F.substring(key, 1, 1)).otherwise(key)


def normalize_bin_cell(cell: Column, labels: Column) -> Column:
    """A cell as the one legend letter it holds; verbatim where it holds digits, another capital, or none or several labels."""
    found = F.filter(F.array_distinct(labels), lambda label: F.contains(F.upper(cell), label) & label.rlike(r"^[A-Z]\z"))
    others = F.replace(F.regexp_replace(cell, "[^A-Z]", ""), F.get(found, F.lit(0)), F.lit(""))
    sure = (F.size(labels) > 0) & ~cell.rlike("[0-9]") & (F.size(found) == 1) & (others == "")
    return F.when(sure, F.get(found, F.lit(0))).otherwise(cell)


def decade_gap(a: Column, b: Column) -> Column:
    """True where two positive values differ by exactly three or six decades."""
    gap = F.abs(F.log10(a) - F.log10(b))
    return (a > 0) & (b > 0) & ((F.abs(gap - 3) <= 1e-9) | (F.abs(gap - 6) <= 1e-9))


def outside_typical_range(kind: Column, value: Column, units: Column) -> Column:
    return kind.isin("IC50", "Ki", "EC50") & (units == "nM") & value.isNotNull() & ~value.between(0.01, 1e5)


def meaningful_difference(a: Column, b: Column, floor: float = 0.3) -> Column:
    return F.coalesce((a > 0) & (b > 0) & (F.abs(F.log10(a) - F.log10(b)) > floor), F.lit(False))


def efficiency(p: Column, heavy_atoms: Column, mw: Column, tpsa: Column, clogp: Column) -> Column:
    """struct(le, bei, sei, lle); null where the potency or a denominator is missing or zero."""
    per = lambda k, d: F.when(d != 0, k * p / d)
    return F.struct(per(1.37, heavy_atoms).alias("le"), per(1000.0, mw).alias("bei"), per(100.0, tpsa).alias("sei"), (p - clogp).alias("lle"))
