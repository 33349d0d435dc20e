"""Column sets of the incident tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the raw file after lower-casing and underscores.
RAW_COLUMNS = (
    "id", "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year",
    "updated_on", "x", "y", "location",
)

# Columns a clean row must have, and columns cleaning removes.
REQUIRED_COLUMNS = ("date", "primary_type", "x", "y")
DROPPED_COLUMNS = (
    "case_number", "block", "iucr", "beat", "district", "ward",
    "fbi_code", "x_coordinate", "y_coordinate", "updated_on", "location",
)

# Fixed value: how dates stand in the raw file.
TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"

CLEAN_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("primary_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("location_description", T.StringType()),
    T.StructField("arrest", T.BooleanType()),
    T.StructField("domestic", T.BooleanType()),
    T.StructField("community_area", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("x", T.StringType()),
    T.StructField("y", T.StringType()),
])

HOLIDAY_SCHEMA = T.StructType([
    T.StructField("holiday_date", T.DateType()),
    T.StructField("holiday_name", T.StringType()),
])


def text_schema(columns: tuple[str, ...] | list[str]) -> T.StructType:
    """Schema with every column a string, so a scan never infers types."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
