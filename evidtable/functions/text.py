"""Text functions. ``similarity`` and ``interval_text`` have no built-in equal and run as Arrow functions."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s ]+"


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def fold(c: Column) -> Column:
    """Lower case with ß as ss, so that folded names meet."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def name_key(c: Column) -> Column:
    return F.regexp_replace(fold(c), "[^a-z0-9]", "")


def group_key(source: Column, name: Column) -> Column:
    return F.concat(source, F.lit("::"), F.regexp_replace(F.regexp_replace(fold(name), "[^a-z0-9]+", "-"), "^-+|-+$", ""))


def normalized_name(c: Column) -> Column:
    """A chemical name without stereo descriptors, as letters and digits."""
    plain = F.regexp_replace(fold(c), "[‐-―−]", "-")
    return F.regexp_replace(F.regexp_replace(plain, r"\(?\b[0-9]*(?:r|s|rac|rel|e|z|\+/-|±)\b\)?-?", ""), "[^a-z0-9]", "")


def publication_number(c: Column) -> Column:
    """Without white space, slashes, commas, dots and dashes of any kind, in capitals."""
    return F.upper(F.regexp_replace(c, r"(?U)[\s/,.\-\u2010-\u2015]", ""))


#: Fixed pattern: the file name of a page image.
IMAGE_NAME = r"(?i)^imgf([0-9]{6})_([0-9]{4})\.(?:png|jpe?g|tiff?|gif)$"


def image_page_index(url: Column) -> Column:
    """struct(page, index) of a URL whose file is named imgfNNNNNN_MMMM, whatever its query or fragment; null for other names."""
    name = F.element_at(F.split(F.regexp_replace(url, r"(?s)[?#].*$", ""), "/"), -1)
    part = lambda i: F.regexp_extract(name, IMAGE_NAME, i).cast("int")
    return F.when(name.rlike(IMAGE_NAME), F.struct(part(1).alias("page"), part(2).alias("index")))


def absolute_url(url: Column, base: str) -> Column:
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(url, "^/+", "")))


def page_ranges(c: Column) -> Column:
    """Pages of a text like 3-5,9: sorted, distinct; what isn't a range is left out."""
    parts = F.filter(F.transform(F.split(c, ","), lambda p: F.trim(p)), lambda p: p.rlike("^[0-9]{1,6}( *- *[0-9]{1,6})?$"))
    bounds = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, "^([0-9]+)", 1).cast("int").alias("a"), F.regexp_extract(p, "([0-9]+)$", 1).cast("int").alias("z")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(bounds, lambda b: b["a"] <= b["z"]), lambda b: F.sequence(b["a"], b["z"])))))


def plain_integer(c: Column) -> Column:
    """The first run of digits as a number."""
    return F.when(c.rlike("[0-9]"), F.regexp_extract(c, "([0-9]+)", 1).try_cast("int"))  # a cast that fails is slow


def first_integer(c: Column) -> Column:
    """The first run of digits or of letters read for digits."""
    return F.regexp_extract(F.translate(c, "lI|Oo", "11100"), "([0-9]+)", 1).try_cast("int")


def reconstruct_header(fragments: Column) -> Column:
    """Header fragments joined by spaces; a fragment that ends in a hyphen takes the next one without a space."""
    clean = F.filter(F.transform(fragments, lambda f: collapse(f)), lambda f: f != "")
    return F.aggregate(clean, F.lit(""), lambda acc, f: F.when(acc == "", f).when(acc.endswith("-"), F.concat(F.substring(acc, F.lit(1), F.length(acc) - 1), f)).otherwise(F.concat(acc, F.lit(" "), f)))


def dehyphenate(c: Column) -> Column:
    return F.regexp_replace(c, r"-\s+", "")


def clean_ocr_name(c: Column) -> Column:
    """Line breaks between two letters become a space, all others close up; dashes are one kind."""
    lines = F.regexp_replace(F.regexp_replace(c, "[‐-―−]", "-"), r"[ \t]*\n[ \t\n]*", "\n")
    return F.trim(F.regexp_replace(F.regexp_replace(lines, r"(?<=[A-Za-z])\n(?=[A-Za-z])", " "), "\n", ""))


def split_pair(c: Column) -> Column:
    """struct(first, n) of a name that lists enantiomers with an ampersand."""
    parts = F.filter(F.transform(F.split(c, "&"), lambda p: F.trim(p)), lambda p: p != "")
    return F.struct(F.try_element_at(parts, F.lit(1)).alias("first"), F.size(parts).alias("n"))


def mentioned_ids(c: Column) -> Column:
    """Every id that a text calls ``compound <id>``, distinct."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"\bcompound\s+([a-z0-9]+)\b"), 1))


def cross_references(c: Column) -> Column:
    """Paragraphs (cut before [dddd]) that point to two tables below at least: array of struct(paragraph, tables)."""
    paragraphs = F.split(c, r"(?=\[[0-9]{4,6}\])")
    told = F.transform(paragraphs, lambda p: F.struct(F.regexp_extract(p, r"\[([0-9]{4,6})\]", 1).alias("paragraph"), F.array_distinct(F.regexp_extract_all(p, F.lit(r"[Tt]able\s+([0-9]+)\s+below"), 1)).alias("tables")))
    return F.filter(told, lambda p: F.size(p["tables"]) >= 2)


#: Fragments by which a word is a chemical name's; a locant before a bracket is one too.
FRAGMENTS = (
    "acetamid", "amino", "azetidin", "benzo", "carbox", "chloro", "dione", "dioxo", "ethyl", "fluoro", "hydroxy", "imidazol", "indazol", "indol", "isoindolin", "methoxy", "methyl", "morpholin", "nitril",
    "oxopiperidin", "phenoxy", "phenyl", "piperidin", "pyrazol", "pyridin", "pyrimidin", "pyrrolidin", "quinolin", "sulfon", "triazol", "yl)",
)
TOKEN = r"[A-Za-z0-9][A-Za-z0-9()\[\]'’,.\-]*"
SUBSTITUENT = r"[0-9]+-\("


def ocr_quality(c: Column, vocabulary: list[str]) -> Column:
    """Share of the tokens with three letters or more whose letters are a known word, or that read chemical; 0 without any."""
    chemical = "|".join([*map(re.escape, FRAGMENTS), SUBSTITUENT])
    tokens = F.transform(F.regexp_extract_all(c, F.lit(TOKEN), 0), lambda t: F.struct(F.lower(t).alias("t"), F.regexp_replace(F.lower(t), "[^a-z]", "").alias("w")))
    words = F.filter(tokens, lambda t: F.length(t["w"]) >= 3)
    known = F.filter(words, lambda t: t["w"].isin(*vocabulary) | t["t"].rlike(chemical))
    return F.when(F.size(words) > 0, F.size(known) / F.size(words)).otherwise(F.lit(0.0))


def rotation(osd: Column) -> Column:
    """struct(degrees, confidence) that an orientation report claims; (0, 0.0) where it claims nothing."""
    turn = F.regexp_extract(osd, r"(?m)^Rotate:\s*([0-9]+)", 1).try_cast("int")
    sure = F.regexp_extract(osd, r"(?m)^Orientation confidence:\s*([0-9.]+)", 1).try_cast("double")
    return F.struct(F.coalesce(turn % 360, F.lit(0)).alias("degrees"), F.when(turn.isNotNull(), F.coalesce(sure, F.lit(0.0))).otherwise(F.lit(0.0)).alias("confidence"))


def resolved_rotation(detected: Column, score: Column, opposite: Column, threshold: float = 0.30) -> Column:
    """struct(applied, score, alt_score, uncertain): the detected turn, or its opposite where the first reads badly and the other strictly better.

    ``opposite`` is the score after 180 degrees more, looked at only where ``score`` is under the threshold. How sure the
    detector was plays no part.
    """
    tried, back = score < threshold, (detected + 180) % 360
    turned = tried & (opposite > score)
    alt = F.when(turned, score).when(tried, opposite).otherwise(F.lit(0.0))
    best = F.when(turned, opposite).otherwise(score)
    return F.struct(F.when(turned, back).otherwise(detected % 360).alias("applied"), best.alias("score"), alt.alias("alt_score"), (F.greatest(best, alt) < threshold).alias("uncertain"))


def looks_numeric(c: Column) -> Column:
    """Whether a text begins, commas apart, with a number, a relation before it or not."""
    return F.coalesce(F.replace(c, F.lit(","), F.lit("")).rlike(r"^\s*[<>=~≤≥]*\s*[+-]?[0-9]+(\.[0-9]+)?"), F.lit(False))


@F.pandas_udf(T.DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """difflib's ratio, in this order; 0 where either is empty."""
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(left, right, strict=True)])


@F.pandas_udf(T.StringType())
def short_number(value: pd.Series) -> pd.Series:
    """Six significant digits, exponents for the far ends, no trailing zeros: Spark has no such format."""
    return value.map(lambda x: f"{x:g}", na_action="ignore")


def interval_text(lower: Column, upper: Column, relation: Column | None = None, value: Column | None = None, units: Column | None = None) -> Column:
    """A decoded interval; without one the standardized value with its relation (unless =) and units; empty without either."""
    low, high = short_number(lower), short_number(upper)
    told = F.when(lower.isNotNull() & upper.isNotNull(), F.concat(low, F.lit("-"), high)).when(upper.isNotNull(), F.concat(F.lit("< "), high)).when(lower.isNotNull(), F.concat(F.lit("> "), low))
    if value is None:
        return F.coalesce(told, F.lit(""))
    sign = F.when(relation == "=", F.lit("")).otherwise(F.coalesce(relation, F.lit("")))
    single = F.trim(F.concat(sign, short_number(value), F.lit(" "), F.coalesce(units, F.lit(""))))
    return F.coalesce(told, single, F.lit(""))


def rounded_interval(lower: Column, upper: Column, units: Column) -> Column:
    """The interval for the eye: two decimals and units; null without bounds."""
    two = lambda c: F.regexp_replace(F.format_string("%.2f", c), "0$", "")
    span = F.when(lower.isNotNull() & upper.isNotNull(), F.concat(two(lower), F.lit("–"), two(upper))).when(upper.isNotNull(), F.concat(F.lit("< "), two(upper))).when(lower.isNotNull(), F.concat(F.lit("> "), two(lower)))
    return F.trim(F.concat(span, F.lit(" "), F.coalesce(units, F.lit(""))))
