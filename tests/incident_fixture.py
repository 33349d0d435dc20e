"""A small incident table with one row for every trap."""

from __future__ import annotations

import gzip

HEADER = ["ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
          "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
          "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
          "Updated On", "X", "Y", "Location"]


def raw_row(id_, date, kind, place, *, arrest="true", domestic="false", area="32", year="2019",
            x="-87.6", y="41.8"):
    return [id_, "HX1", date, "B", "0486", kind, "text", place, arrest, domestic, "1", "2", "3",
            area, "08B", "1", "2", year, "02/10/2018 03:50:01 PM", x, y, "(41.8, -87.6)"]


RAW = [
    raw_row("1", "07/04/2019 11:30:00 PM", "THEFT", "STREET"),
    raw_row("2", "bad", "THEFT", "STREET"),
    raw_row("3", None, "THEFT", "STREET"),
    raw_row("4", "07/04/2019 12:00:00 AM", None, "STREET"),
    raw_row("5", "07/04/2019 12:00:00 AM", "THEFT", None),
    raw_row("6", "07/04/2019 12:00:00 AM", "THEFT", "motor vehicle lot"),
    raw_row("7", "07/04/2019 08:00:00 AM", "BATTERY", "STREET", arrest=" FALSE ", domestic="maybe"),
    raw_row("8", "07/04/2019 08:00:00 AM", "BATTERY", "STREET", x=None),
    # Two copies: the later one has an excluded place, so the id goes away altogether.
    raw_row("9", "07/05/2019 08:00:00 AM", "ASSAULT", "SCOOTER RENTAL"),
    raw_row("9", "07/04/2019 08:00:00 AM", "ASSAULT", "STREET"),
    # Two copies: the later one is kept.
    raw_row("10", "07/05/2019 08:00:00 AM", "ASSAULT", "ALLEY"),
    raw_row("10", "07/04/2019 08:00:00 AM", "ASSAULT", "STREET"),
    raw_row(None, "01/01/2019 08:00:00 AM", "ARSON", "STREET"),
    raw_row(None, "01/02/2019 08:00:00 AM", "ARSON", "ALLEY"),
]


def write_raw(path) -> str:
    file = str(path / "features.csv.gz")
    with gzip.open(file, "wt") as out:
        for line in [HEADER, *RAW]:
            out.write(",".join("" if v is None else f'"{v}"' for v in line) + "\n")
    return file


CLEAN_DDL = ("id string, date timestamp_ntz, primary_type string, description string,"
             " location_description string, arrest boolean, domestic boolean,"
             " community_area string, year string, x string, y string")


def clean_rows(spark, items):
    """Clean table from (date text or None, type, place, area) tuples."""
    from pyspark.sql import functions as F

    data = [(str(i), date, kind, "d", place, True, False, area, "2019", "1", "2")
            for i, (date, kind, place, area) in enumerate(items)]
    ddl = CLEAN_DDL.replace("date timestamp_ntz", "date string")
    df = spark.createDataFrame(data, ddl)
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


TRAPS = [
    (None, "THEFT", "STREET", "32"),
    ("2019-12-24 00:00:00", "THEFT", "WAREHOUSE", "032"),
    ("2019-12-25 07:59:59", "ROBBERY", "RIVERBANK", "32.0"),
    ("2019-12-26 08:00:00", "BURGLARY", "BARBERSHOP", "abc"),
    ("2018-10-31 15:59:59", "ASSAULT", "GAS STATION", ""),
    ("2018-10-31 16:00:00", "BATTERY", "SPORTS ARENA / STADIUM", None),
    ("2018-11-22 23:59:59", "BATTERY", "  A  /  B ", "8"),
    ("2019-11-28 12:00:00", "THEFT", "AIRPORT TERMINAL LOWER LEVEL - NON-SECURE AREA", "1"),
    ("2008-01-01 12:00:00", "KIDNAPPING", "transport hub", "1"),
    ("2008-07-04 12:00:00", None, "STREET", "1"),
    ("2009-06-01 12:00:00", "ARSON", None, "77"),
    ("2009-06-01 12:00:00", "ARSON", "", "77"),
    ("2020-02-27 12:00:00", "THEFT", "ALLEY", "28"),
    ("2020-02-01 12:00:00", "ASSAULT", "ALLEY", "28"),
]
