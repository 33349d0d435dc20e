"""Ordered choice among columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of(tests: Sequence[tuple[Column, object]], default: object) -> Column:
    """Value of the first test that holds, else the default; without tests always the default."""
    chain = None
    for test, value in tests:
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return F.lit(default) if chain is None else chain.otherwise(default)
