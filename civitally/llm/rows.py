"""Keys for rows whose ids may be null or repeated, and columns worked out once.

Column names that begin with two underscores are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_KEY = ["__row_key_a", "__row_key_b"]
#: Rows of a narrow table that may be sent to every task.
SMALL = 500_000
#: Rows with whole texts that a Python worker gets at once.
BATCH = 1_000


def with_row_key(df: DataFrame) -> DataFrame:
    """``df`` with a 128-bit hash of the whole row; equal rows have equal keys.

    Nulls are marked, because the hash passes over them. Maps have no hash: their entries are sorted by key,
    and maps inside other columns are read as JSON, in the order they are written in.
    """
    fields = [f for f in df.schema.fields if f.name not in ROW_KEY]
    parts = [part for f in fields for part in (F.col(f"`{f.name}`").isNull(), _hashable(f))]
    return df.withColumns({
        ROW_KEY[0]: F.xxhash64(*parts), ROW_KEY[1]: F.xxhash64(F.lit(1), *parts)})


def _hashable(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
    if isinstance(field.dataType, T.MapType) and "map<" not in field.dataType.valueType.simpleString():
        return F.array_sort(F.map_entries(column))
    return F.to_json(F.struct(column)) if "map<" in kind else column


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after setting the session to send whole texts to Python workers by BATCH rows at most.

    The default of 10,000 rows holds tens of MB of text several times over in a task: in Arrow buffers of both
    processes and as Python objects. The setting is read when a plan runs, so it stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH:
        df.sparkSession.conf.set(name, BATCH)
    return df


def once(expression: str) -> Column:
    """The expression, marked so that no condition on it is moved below, where each use would work it out anew."""
    return F.expr(f"CASE WHEN spark_partition_id() >= 0 THEN {expression} END")


def join_small(rows: DataFrame, other: DataFrame, on: str | list[str], most: int = SMALL) -> DataFrame:
    """``rows`` joined to a stored narrow table, which is broadcast up to ``most`` rows and shuffled beyond."""
    return rows.join(F.broadcast(other) if other.limit(most + 1).count() <= most else other, on)
