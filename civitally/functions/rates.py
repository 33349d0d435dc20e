"""Rates and comparisons as Spark columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .choice import first_of


def rate(part: str | Column, total: str | Column) -> Column:
    """part / total, NULL when the total is 0 or NULL."""
    return F.try_divide(_double(part), _double(total))


def per_unit(total: str | Column, label: str | Column, units: Mapping[str, float]) -> Column:
    """Total divided by the label's number of units (hours, months, days); 1 if not listed."""
    name = F.col(label) if isinstance(label, str) else label
    chain = []
    for key, divisor in units.items():
        chain.append((name == key, F.lit(float(divisor))))
    return _double(total) / first_of(chain, F.lit(1.0))


def pct_difference(a: str | Column, b: str | Column) -> Column:
    """(a / b - 1) * 100, NULL when b is 0 or NULL; a NULL counts as 0."""
    return (rate(F.coalesce(_double(a), F.lit(0.0)), b) - 1) * 100


def direction(difference: Column) -> Column:
    """higher / lower; NULL stays NULL."""
    return F.when(difference >= 0, "higher").when(difference < 0, "lower")


def _double(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")
