"""Deterministic ordering helpers.

The marts were specified on an engine that sorts NULLs last in both
directions. These helpers pin that on Spark (hazards H1, H4).
"""

from __future__ import annotations

from pyspark.sql import Column

from touchline.functions.util import col


def asc(c) -> Column:
    return col(c).asc_nulls_last()


def desc(c) -> Column:
    return col(c).desc_nulls_last()
