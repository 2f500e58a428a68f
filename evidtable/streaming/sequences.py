"""Streams: cells standardized as they arrive, with the same expressions as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import parse_cell, standardize


def standardized(cells: DataFrame, raw: str, units: str) -> DataFrame:
    """A stream of published cells with parsed and standardized values; stateless, so any trigger and restart will do."""
    parsed = cells.withColumn("cell", parse_cell(F.col(raw)))
    return parsed.withColumn("standard", standardize(F.col("cell.value"), F.col("cell.relation"), F.col(units), F.lit(False)))
