"""Numbers of different values that merge: sketches instead of sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers are two to this power; the standard error is 1.04 over the root of their number.
SKETCH_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def sketch_by(df: DataFrame, keys: Sequence[str], column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """keys, ``sketch`` of the column's different values (NULL is none) and the number of rows."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, bits).alias("sketch"), F.count("*").alias("n"))


def merge_by(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches put together by fewer keys; the same as sketching the rows at once."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("n").alias("n"))


def estimate(sketches: DataFrame, name: str = "n_distinct") -> DataFrame:
    """The sketch replaced by its estimate."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
