"""Incident tables read from the test tables.

The test data has no incident table, so one is projected from ``lineitem``, row by row and
without a join: types, places, areas and times of day are picked from lists by the row's
keys. The lists repeat some entries, so a few types and places hold most rows. Dates are
moved to March 2007 ... November 2020, which covers the recession years and the forecast
periods. The same projection exists as SQL for the check tool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitally.sources.readers import holidays_from_dates

TYPES = (
    ["THEFT"] * 12 + ["BATTERY"] * 8 + ["CRIMINAL DAMAGE"] * 4 + ["ASSAULT"] * 3
    + ["NARCOTICS"] * 3 + ["BURGLARY"] * 3 + ["ROBBERY"] * 3 + ["DECEPTIVE PRACTICE"] * 2
    + ["MOTOR VEHICLE THEFT", "OTHER OFFENSE", "WEAPONS VIOLATION", "CRIMINAL TRESPASS",
       "PROSTITUTION", "OFFENSE INVOLVING CHILDREN", "PUBLIC PEACE VIOLATION", "SEX OFFENSE",
       "INTERFERENCE WITH PUBLIC OFFICER", "GAMBLING", "LIQUOR LAW VIOLATION", "ARSON",
       "KIDNAPPING", "STALKING", "INTIMIDATION", "CONCEALED CARRY LICENSE VIOLATION",
       "CRIM SEXUAL ASSAULT", "PUBLIC INDECENCY"]
)

PLACES = (
    ["STREET"] * 30 + ["RESIDENCE"] * 14 + ["APARTMENT"] * 10 + ["SIDEWALK"] * 8
    + [None, "", "RESIDENCE PORCH / HALLWAY", "RESIDENCE - YARD (FRONT / BACK)",
       "RESIDENTIAL YARD (FRONT/BACK)", "RESIDENCE-GARAGE", "CHA APARTMENT", "CHA HALLWAY",
       "DRIVEWAY - RESIDENTIAL", "VEHICLE NON-COMMERCIAL", "VEHICLE - COMMERCIAL",
       "VEHICLE - OTHER RIDE SHARE SERVICE (E.G., UBER, LYFT)", "VEHICLE - DELIVERY TRUCK",
       "OTHER RAILROAD PROP / TRAIN DEPOT", "OTHER RAILROAD PROPERTY / TRAIN DEPOT",
       "AIRPORT TERMINAL LOWER LEVEL - NON-SECURE AREA", "AIRPORT TERMINAL MEZZANINE - NON-SECURE",
       "AIRPORT TERMINAL UPPER LEVEL - SECURE AREA", "AIRPORT BUILDING NON-TERMINAL - SECURE AREA",
       "AIRPORT EXTERIOR - NON-SECURE AREA", "AIRPORT TRANSPORTATION SYSTEM (ATS)",
       "AIRPORT PARKING LOT", "AIRPORT VENDING ESTABLISHMENT", "AIRCRAFT",
       "SCHOOL, PUBLIC, BUILDING", "SCHOOL - PUBLIC BUILDING", "SCHOOL - PUBLIC GROUNDS",
       "SCHOOL - PRIVATE GROUNDS", "COLLEGE / UNIVERSITY - RESIDENCE HALL",
       "COLLEGE/UNIVERSITY RESIDENCE HALL", "DAY CARE CENTER", "SAVINGS AND LOAN",
       "CREDIT UNION", "BANK", "RIVERBANK", "CURRENCY EXCHANGE", "ATM (AUTOMATIC TELLER MACHINE)",
       "COIN OPERATED MACHINE", "NEWSSTAND", "APPLIANCE STORE", "PAWN SHOP", "CLEANING STORE",
       "BARBERSHOP", "CAR WASH", "POOL ROOM", "BOWLING ALLEY", "ATHLETIC CLUB", "CEMETARY",
       "FOREST PRESERVE", "FARM", "KENNEL", "ANIMAL HOSPITAL", "BOAT / WATERCRAFT",
       "FIRE STATION", "JAIL / LOCK-UP FACILITY", "FEDERAL BUILDING",
       "GOVERNMENT BUILDING / PROPERTY", "CTA TRACKS - RIGHT OF WAY", "CTA PLATFORM",
       "CTA GARAGE / OTHER PROPERTY", "CTA TRAIN", "CTA BUS", "CTA BUS STOP", "CTA STATION",
       "VACANT LOT / LAND", "VACANT LOT/LAND", "ABANDONED BUILDING", "OTHER (SPECIFY)", "OTHER",
       "WAREHOUSE", "FACTORY/MANUFACTURING BUILDING", "CONSTRUCTION SITE", "GAS STATION",
       "PARKING LOT / GARAGE (NON RESIDENTIAL)", "SMALL RETAIL STORE", "DEPARTMENT STORE",
       "GROCERY FOOD STORE", "DRUG STORE", "CONVENIENCE STORE", "RESTAURANT", "BAR OR TAVERN",
       "TAVERN/LIQUOR STORE", "HOSPITAL BUILDING / GROUNDS", "NURSING / RETIREMENT HOME",
       "MEDICAL/DENTAL OFFICE", "PARK PROPERTY", "LAKEFRONT / WATERFRONT / RIVERBANK",
       "SPORTS ARENA / STADIUM", "SPORTS ARENA/STADIUM", "sport field", "  SPORTS  /  CLUB  ",
       "TRANSPORT HUB", "HOTEL / MOTEL", "HOTEL/MOTEL", "ALLEY", "HIGHWAY/EXPRESSWAY", "BRIDGE",
       "MOTOR VEHICLE REPAIR", "SCOOTER RENTAL", "NEW STAND", "Street corner"]
)

HOLIDAYS = {
    f"{year}-{day}": name
    for year in range(2007, 2021)
    for day, name in (("01-01", "New Year"), ("07-04", "Independence Day"),
                      ("11-11", "Veterans Day"), ("12-25", "Christmas Day"))
}

# The columns in SQL that both engines read alike; {date}, {types} and {places} differ per engine.
_COLUMNS = {
    "id": "CAST(l_orderkey * 10 + l_linenumber AS {text})",
    "date": "{date}",
    # One of the large types is missing in the first months, before the chosen training start.
    "primary_type": "CASE WHEN {types} = 'NARCOTICS' AND CAST({date} AS DATE) < DATE '2007-06-01'"
                    " THEN 'OTHER OFFENSE' ELSE {types} END",
    "description": "CONCAT('D', CAST(l_partkey % 25 AS {text}))",
    "location_description": "{places}",
    "arrest": "l_returnflag = 'R'",
    "domestic": "l_linestatus = 'O'",
    "community_area": "CASE WHEN l_orderkey % 12 = 0 THEN NULL WHEN l_orderkey % 50 = 1 THEN ''"
                      " WHEN l_orderkey % 50 = 2 THEN CONCAT('0', {area})"
                      " WHEN l_orderkey % 50 = 3 THEN CONCAT({area}, '.0')"
                      " WHEN l_orderkey % 50 = 5 THEN 'abc' ELSE {area} END",
    "year": "CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'"
            " ELSE CAST(2007 + l_orderkey % 14 AS {text}) END",
    "x": "CASE WHEN l_orderkey % 89 = 0 THEN 'west'"
         " ELSE CONCAT('-87.', CAST(5000 + l_partkey % 4000 AS {text})) END",
    "y": "CONCAT('41.', CAST(6000 + l_suppkey % 3000 AS {text}))",
}

# Raw text columns as they stand in an uncleaned file, with unreadable entries.
_RAW_COLUMNS = {
    "ID": "CASE WHEN l_orderkey % 211 = 0 THEN NULL"
          " ELSE CAST(l_orderkey * 10 + l_linenumber AS {text}) END",
    "Case Number": "CONCAT('HX', CAST(l_orderkey AS {text}))",
    "Date": "CASE WHEN l_orderkey % 31 = 0 THEN 'bad' WHEN l_orderkey % 37 = 0 THEN NULL"
            " ELSE {date_text} END",
    "Primary Type": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE {types} END",
    "Description": "CONCAT('D', CAST(l_partkey % 25 AS {text}))",
    "Location Description": "{places}",
    "Arrest": "CASE l_returnflag WHEN 'R' THEN ' TRUE ' WHEN 'A' THEN 'false' ELSE 'maybe' END",
    "Domestic": "CASE l_linestatus WHEN 'O' THEN 'true' ELSE 'FALSE' END",
    "Community Area": "CAST(1 + l_suppkey % 77 AS {text})",
    "Year": "CAST(2007 + l_orderkey % 14 AS {text})",
    "X": "CASE WHEN l_orderkey % 43 = 0 THEN NULL"
         " ELSE CONCAT('-87.', CAST(5000 + l_partkey % 4000 AS {text})) END",
    "Y": "CONCAT('41.', CAST(6000 + l_suppkey % 3000 AS {text}))",
    "Updated On": "'02/10/2018 03:50:01 PM'",
}

_TYPE_SLOT = "(l_partkey * 7 + l_orderkey) % {n}"
_PLACE_SLOT = "(l_suppkey * 13 + l_orderkey * 3 + l_linenumber) % {n}"
_SECOND_OF_DAY = "(l_orderkey * 7919 + l_linenumber * 12347) % 86400"


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _array(values, opening: str, closing: str) -> str:
    return opening + ", ".join(_literal(v) for v in values) + closing


def _parts(engine: str) -> dict[str, str]:
    type_slot = _TYPE_SLOT.format(n=len(TYPES))
    place_slot = _PLACE_SLOT.format(n=len(PLACES))
    text = "STRING" if engine == "spark" else "VARCHAR"
    area = f"CAST(1 + l_suppkey % 77 AS {text})"
    if engine == "spark":
        types = f"{_array(TYPES, 'array(', ')')}[CAST({type_slot} AS INT)]"
        places = f"{_array(PLACES, 'array(', ')')}[CAST({place_slot} AS INT)]"
        date = (f"timestampadd(SECOND, CAST({_SECOND_OF_DAY} AS INT), timestampadd(MONTH,"
                " IF(l_linenumber % 2 = 0, 228, 146), l_shipdate))")
    else:
        types = f"({_array(TYPES, '[', ']')})[CAST({type_slot} AS INT) + 1]"
        places = f"({_array(PLACES, '[', ']')})[CAST({place_slot} AS INT) + 1]"
        date = ("CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate + INTERVAL '228' MONTH"
                f" ELSE l_shipdate + INTERVAL '146' MONTH END + to_seconds({_SECOND_OF_DAY})")
    parts = {"types": types, "places": places, "date": date, "text": text, "area": area}
    parts["date_text"] = (
        f"date_format({date}, 'MM/dd/yyyy hh:mm:ss a')" if engine == "spark"
        else f"strftime({date}, '%m/%d/%Y %I:%M:%S %p')"
    )
    return parts


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean incident table; unused columns are pruned down to the scan."""
    parts = _parts("spark")
    return read(spark, sf_dir, "lineitem").select(*[
        F.expr(sql.format(**parts)).alias(name) for name, sql in _COLUMNS.items()
    ])


def raw_crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw incident table, all text, with its original header."""
    parts = _parts("spark")
    return read(spark, sf_dir, "lineitem").select(*[
        F.expr(sql.format(**parts)).alias(name) for name, sql in _RAW_COLUMNS.items()
    ])


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union of many small results, paired up so that the plan is not analysed once per frame."""
    while len(frames) > 1:
        pairs = [frames[i:i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionByName(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]


def holidays(spark: SparkSession) -> DataFrame:
    return holidays_from_dates(spark, HOLIDAYS)


def _cte(name: str, columns: dict[str, str]) -> str:
    parts = _parts("duckdb")
    listed = ",\n  ".join(f'{sql.format(**parts)} AS "{c}"' for c, sql in columns.items())
    return f"{name} AS (SELECT\n  {listed}\n  FROM lineitem)"


CRIMES = _cte("crimes", _COLUMNS)
RAW_CRIMES = _cte("raw_crimes", _RAW_COLUMNS)
HOLIDAY_LIST = "holidays(holiday_date) AS (VALUES " + ", ".join(
    f"(DATE '{d}')" for d in HOLIDAYS) + ")"
