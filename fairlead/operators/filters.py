"""Filters shared by the models and the analytic queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.schemas import DIRECTIONS


def year_window(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of ``first..last``, both ends kept."""
    return df.where(F.col("ano").between(first, last))


def direction(df: DataFrame, value: str) -> DataFrame:
    if value not in DIRECTIONS:
        raise ValueError(f"unknown direction {value!r}; expected one of {DIRECTIONS}")
    return df.where(F.col("direcao") == value)


def any_of(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose ``column`` is one of ``values``; None or empty means no filter."""
    return df.where(F.col(column).isin(*values)) if values else df
