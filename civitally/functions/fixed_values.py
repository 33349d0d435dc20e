"""Word lists, rule tables, dates and divisors the marts are defined by.

Everything here is data. Order matters in every rule table: the first match wins in
the classifications, and label aliases run one after the other.
"""

from __future__ import annotations

# Hour bands, month bands.
TIME_PERIODS = (("Daytime", range(8, 16)), ("Evening", range(16, 24)))
TIME_PERIOD_DEFAULT = "Overnight"
OVERNIGHT_HOURS = range(0, 8)
SEASONS = (("Summer", (6, 7, 8)), ("Late Winter", (1, 2)))
SEASON_DEFAULT = "Other"

# Hours per period and months per season, for per-hour and per-month rates.
HOURS_PER_PERIOD = {"Overnight": 8, "Daytime": 8, "Evening": 8}
MONTHS_PER_SEASON = {"Summer": 3, "Late Winter": 2, "Other": 7}

# Thanksgiving dates, one per year.
THANKSGIVING_DATES = (
    "2020-11-26", "2019-11-28", "2018-11-22", "2017-11-23", "2016-11-24", "2015-11-26", "2014-11-27",
    "2013-11-28", "2012-11-22", "2011-11-24", "2010-11-25", "2009-11-26", "2008-11-27", "2007-11-22",
    "2006-11-23", "2005-11-24", "2004-11-25", "2003-11-27", "2002-11-28", "2001-11-22", "2000-11-23",
)

# New Year, Independence Day, Christmas Day, Veterans Day as month-day.
FEDERAL_HOLIDAYS = ("01-01", "07-04", "12-25", "11-11")

# Years of the Great Recession.
RECESSION_YEARS = (2007, 2008, 2009)

# Types compared on and off each event.
CHRISTMAS_TYPES = ("THEFT", "BURGLARY", "ROBBERY")
HALLOWEEN_TYPES = ("ASSAULT", "BATTERY", "PUBLIC PEACE VIOLATION")
THANKSGIVING_TYPES = ("BATTERY", "THEFT", "CRIMINAL DAMAGE", "ASSAULT")
AREA_RATE_TYPES = ("THEFT", "ROBBERY")

# Days on and off each event as charted (20 years of 365 days; December alone).
CHART_DAYS = {
    "Holiday": (11 * 20, 365 * 20 - 220),
    "Christmas": (31, 365 - 31),
    "Halloween": (1 * 20, (365 - 1) * 20),
    "Thanksgiving": (1 * 20, (365 - 1) * 20),
}

# Downtown community areas.
DOWNTOWN_AREAS = (32, 8, 33, 28)

# Labels removed by cleaning, and labels removed from the location marts.
CLEANING_EXCLUSIONS = ("FISTS", "MOTOR VEHICLE", "SCOOTER", "NON-VEH", "NEW STAND")
LOCATION_EXCLUSIONS = (
    "FISTS", "MOTOR VEHICLE", "SCOOTER", "NON-VEH", "NON-MOTOR VEHICLE", "NEW STAND",
)

# Venue filter.
SPORT_PATTERN = r"(?i)\bsports?\b"

# Incident types grouped for the venue mart.
TYPE_GROUPS = (
    ("Theft", ("THEFT", "MOTOR VEHICLE THEFT", "BURGLARY")),
    ("Assault & Battery", ("ASSAULT", "BATTERY")),
    ("Robbery & Kidnapping", ("ROBBERY", "KIDNAPPING")),
    ("Violent Crime", ("CRIM SEXUAL ASSAULT", "SEX OFFENSE", "INTIMIDATION", "STALKING")),
    ("Property Damage", ("CRIMINAL DAMAGE", "ARSON")),
    ("Vice & Substances",
     ("NARCOTICS", "LIQUOR LAW VIOLATION", "PUBLIC INDECENCY", "PROSTITUTION")),
    ("Public Order",
     ("CRIMINAL TRESPASS", "PUBLIC PEACE VIOLATION", "INTERFERENCE WITH PUBLIC OFFICER",
      "CONCEALED CARRY LICENSE VIOLATION", "WEAPONS VIOLATION")),
    ("Fraud & Deception", ("DECEPTIVE PRACTICE",)),
    ("Crimes Against Children", ("OFFENSE INVOLVING CHILDREN",)),
)
TYPE_GROUP_DEFAULT = "Other"

# Location categories by contained word, first match wins.
LOCATION_CATEGORIES = (
    ("Residential",
     ("RESIDENCE", "APARTMENT", "HOUSE", "ROOMING", "DRIVEWAY - RES", "RESIDENTIAL YARD",
      "RESIDENCE PORCH", "RESIDENCE-GARAGE", "CHA ")),
    ("Street/Outdoors", ("STREET", "SIDEWALK", "ALLEY", "HIGHWAY", "EXPRESSWAY", "BRIDGE")),
    ("Public Transit", ("CTA ", "TRAIN", "RAILROAD", "TRANSIT", "PLATFORM", "SUBWAY", "BUS")),
    ("Airport", ("AIRPORT", "AIRCRAFT")),
    ("Parking Lot", ("PARKING LOT", "PARKING", "GARAGE")),
    ("Education", ("SCHOOL", "COLLEGE", "UNIVERSITY", "DAY CARE")),
    ("Restraunt Area", ("RESTAURANT", "BAR", "TAVERN", "NIGHT CLUB", "CAFE")),
    ("Retail/Stores",
     ("GROCERY", "DRUG STORE", "DEPARTMENT STORE", "SMALL RETAIL", "RETAIL", "CONVENIENCE",
      "APPLIANCE", "BARBERSHOP")),
    ("Financial", ("BANK", "CURRENCY EXCHANGE", "CREDIT UNION", "SAVINGS", "ATM")),
    ("Medical", ("HOSPITAL", "MEDICAL", "DENTAL", "NURSING", "CLINIC")),
    ("Parks/Recreation",
     ("PARK", "FOREST", "LAKEFRONT", "BEACH", "ATHLETIC", "SPORTS", "STADIUM", "YMCA")),
    ("Hotel/Lodging", ("HOTEL", "MOTEL")),
    ("Vacant/Industrial", ("VACANT", "ABANDONED", "CONSTRUCTION", "WAREHOUSE", "FACTORY")),
)
LOCATION_CATEGORY_DEFAULT = "Other"

# Transit and commercial places, first match wins.
TRANSIT_CATEGORIES = (
    ("Public Transit", ("TRAIN", "BUS", "TRANSIT", "STATION")),
    ("Commercial", ("COMMERCIAL", "STORE", "SHOP", "MARKET")),
)
TRANSIT_DEFAULT = "Other"

# Airport and other places, first match wins.
AIRPORT_CATEGORIES = (
    ("Airport", ("AIRPORT", "AIRCRAFT")),
    ("Commercial", ("COMMERCIAL", "STORE", "SHOP", "MARKET")),
    ("Residential", ("RESIDENTIAL", "HOME", "HOUSE", "NEIGHBORHOOD", "APARTMENT")),
    ("Public Transit", ("TRAIN", "BUS", "TRANSIT", "STATION")),
)
AIRPORT_DEFAULT = "Uncategorized"

# Punctuation rules (pattern, replacement), applied in this order.
LABEL_PUNCTUATION = (
    (r"\s*/\s*", "/"),
    (r"\s*-\s*", "-"),
    (r"\s*\(\s*", " ("),
    (r"\s*\)\s*", ")"),
    (r"\.", ""),
)

# Label aliases (pattern, replacement), applied in this order; a later
# rule may rewrite an earlier result.
LABEL_ALIASES = (
    (r"RESIDENCE PORCH/HALLWAY", "RESIDENCE-PORCH/HALLWAY"),
    (r"RESIDENCE-YARD \(FRONT/BACK\)|RESIDENTIAL YARD \(FRONT/BACK\)", "RESIDENCE-YARD"),
    (r"VEHICLE NON-COMMERCIAL", "VEHICLE-NON-COMMERCIAL"),
    (r"OTHER RAILROAD PROP/TRAIN DEPOT|OTHER RAILROAD PROPERTY/TRAIN DEPOT",
     "OTHER RAILROAD/TRAIN DEPOT"),
    (r"VEHICLE-OTHER RIDE SHARE.*", "VEHICLE-RIDE SHARE"),
    (r"AIRPORT TERMINAL.*NON-SECURE.*|AIRPORT TERMINAL MEZZANINE.*",
     "AIRPORT TERMINAL-NON-SECURE"),
    (r"AIRPORT TERMINAL.*SECURE.*", "AIRPORT TERMINAL-SECURE"),
    (r"AIRPORT BUILDING NON-TERMINAL.*", "AIRPORT BUILDING NON-TERMINAL"),
    (r"AIRPORT EXTERIOR.*|AIRPORT TRANSPORTATION SYSTEM.*", "AIRPORT EXTERIOR"),
    (r"AIRPORT PARKING LOT", "PARKING LOT/GARAGE-NON-RESIDENTIAL"),
    (r"SCHOOL-PUBLIC BUILDING|SCHOOL-PUBLIC GROUNDS", "SCHOOL-PUBLIC"),
    (r"SCHOOL-PRIVATE BUILDING|SCHOOL-PRIVATE GROUNDS", "SCHOOL-PRIVATE"),
    (r"VEHICLE-COMMERCIAL-ENTERTAINMENT/PARTY BUS|VEHICLE-COMMERCIAL-TROLLEY BUS"
     r"|VEHICLE-DELIVERY TRUCK|DELIVERY TRUCK", "VEHICLE-COMMERCIAL-SPECIALTY"),
    (r"SAVINGS AND LOAN|CREDIT UNION", "BANK/CREDIT UNION"),
    (r"^BANK$", "BANK/CREDIT UNION"),
    (r"COIN OPERATED MACHINE|AIRPORT VENDING ESTABLISHMENT|NEWSSTAND",
     "VENDING/COIN MACHINE/NEWSSTAND"),
    (r"APPLIANCE STORE|PAWN SHOP|CLEANING STORE|BARBERSHOP|CAR WASH",
     "SPECIALTY RETAIL/SERVICE"),
    (r"POOL ROOM|BOWLING ALLEY|ATHLETIC CLUB", "RECREATION FACILITY"),
    (r"CEMETARY|FOREST PRESERVE|FARM|KENNEL|ANIMAL HOSPITAL|HORSE STABLE",
     "NATURE/FARM/ANIMAL FACILITY"),
    (r"^BOAT/WATERCRAFT$|^AIRCRAFT$", "BOAT/AIRCRAFT"),
    (r"FIRE STATION|JAIL/LOCK-UP FACILITY|FEDERAL BUILDING|GOVERNMENT BUILDING/PROPERTY",
     "GOVERNMENT FACILITY"),
    (r"DAY CARE CENTER", "SCHOOL-OTHER/DAY CARE"),
    (r"COLLEGE/UNIVERSITY RESIDENCE HALL", "COLLEGE/UNIVERSITY-GROUNDS"),
    (r"CTA TRACKS-RIGHT OF WAY|^CTA PLATFORM$", "CTA PLATFORM/TRACKS"),
    (r"CTA GARAGE/OTHER PROPERTY", "CTA PARKING LOT/GARAGE"),
    (r"DRIVEWAY-RESIDENTIAL", "RESIDENCE-YARD"),
    (r"VACANT LOT/LAND|ABANDONED BUILDING", "ABANDONED BUILDING/VACANT LOT"),
    (r"OTHER \(SPECIFY\)", "OTHER"),
)

# Question routing (answer table, word beginnings, needed type), first match wins.
QUESTION_ROUTES = (
    ("christmas_vs_nonchristmas_by_type", ("christmas", "december"), None),
    ("halloween_vs_nonhalloween_by_type", ("halloween",), None),
    ("thanksgiving_vs_nonthanksgiving_by_type", ("thanksgiving",), None),
    ("holiday_vs_nonholiday", ("holiday",), None),
    ("great_recession_by_type", ("recession", "2008", "2009"), None),
    ("hourly_crimes", ("hour",), None),
    ("time_period_crimes",
     ("morning", "night", "evening", "daytime", "afternoon", "overnight", "time of day"), None),
    ("season_crimes", ("season", "summer", "winter", "spring", "fall", "autumn"), None),
    ("monthly_crimes", ("month",), None),
    ("yearly_crimes",
     ("year", "trend", "over time", "changed", "decade", "decline", "increas", "decreas"), None),
    ("downtown_vs_residential_theft_robbery", ("downtown", "residential"), None),
    ("airport_theft_count_comparison", ("airport",), None),
    ("transit_vs_commercial_robbery_count", ("transit", "cta", "train", "bus", "commercial"), None),
    ("sport_location_crimes", ("stadium", "sport", "wrigley", "soldier field", "arena"), None),
    ("community_area_crimes", ("community", "neighborhood", "neighbourhood", "area"), None),
    ("theft_by_location", ("where", "location", "place"), "THEFT"),
    ("crimes_by_location", ("where", "location", "place"), None),
)

# Incident types looked for in a question, first contained one wins.
QUESTION_TYPES = (
    "motor vehicle theft", "criminal damage", "public peace violation",
    "theft", "burglary", "robbery", "assault", "battery",
)

# Measure and label columns in order of preference.
MEASURE_COLUMNS = ("total_crimes", "crime_count", "count", "total", "value")
LABEL_COLUMNS = (
    "time_period", "month", "year", "community_area", "primary_type", "day_type",
    "location_description",
)

# Forecast set-up.
BACKTEST_TRAIN_END = "2019-02"
BACKTEST_START = "2019-03"
BACKTEST_END = "2020-02"
TRAIN_END = "2020-02"
SHOCK_START = "2020-03"
SHOCK_END = "2020-06"
HORIZON = 12
TRAIN_STARTS = (None, "2012-01")
SEASONAL_TYPES = ("mul", "add")
TOP_TYPES = 8
RANK_YEAR = 2019
HISTORY_START_YEAR = 2016

# Community area, latitude, longitude of its centre.
AREA_CENTROIDS = (
    ("1", 42.011938, -87.665677),
    ("2", 41.999314, -87.697159),
    ("3", 41.965619, -87.64468),
    ("4", 41.974304, -87.694233),
    ("5", 41.946454, -87.687485),
    ("6", 41.944128, -87.646658),
    ("7", 41.921052, -87.636036),
    ("8", 41.897827, -87.620397),
    ("9", 42.008609, -87.815908),
    ("10", 41.982997, -87.809832),
    ("11", 41.984603, -87.771602),
    ("12", 41.996374, -87.765848),
    ("13", 41.981007, -87.718585),
    ("14", 41.969366, -87.718181),
    ("15", 41.956645, -87.768717),
    ("16", 41.954341, -87.716141),
    ("17", 41.947155, -87.810773),
    ("18", 41.930726, -87.799321),
    ("19", 41.927644, -87.766501),
    ("20", 41.922683, -87.73309),
    ("21", 41.938783, -87.704935),
    ("22", 41.923028, -87.696575),
    ("23", 41.901336, -87.717703),
    ("24", 41.901089, -87.672629),
    ("25", 41.896502, -87.771193),
    ("26", 41.876321, -87.730884),
    ("27", 41.878479, -87.705328),
    ("28", 41.877321, -87.662717),
    ("29", 41.86247, -87.716361),
    ("30", 41.837964, -87.71368),
    ("31", 41.850317, -87.663988),
    ("32", 41.881527, -87.618742),
    ("33", 41.858979, -87.612394),
    ("34", 41.841888, -87.634165),
    ("35", 41.83621, -87.616148),
    ("36", 41.822268, -87.600263),
    ("37", 41.809542, -87.632251),
    ("38", 41.812351, -87.619113),
    ("39", 41.809096, -87.590145),
    ("40", 41.7912, -87.61774),
    ("41", 41.794078, -87.584535),
    ("42", 41.777957, -87.58439),
    ("43", 41.762984, -87.559268),
    ("44", 41.739082, -87.614244),
    ("45", 41.744228, -87.587686),
    ("46", 41.744865, -87.540178),
    ("47", 41.727748, -87.596537),
    ("48", 41.729288, -87.571142),
    ("49", 41.710397, -87.62315),
    ("50", 41.704803, -87.598353),
    ("51", 41.694095, -87.571651),
    ("52", 41.711233, -87.529208),
    ("53", 41.668524, -87.636998),
    ("54", 41.661318, -87.606831),
    ("55", 41.661291, -87.550494),
    ("56", 41.800105, -87.767986),
    ("57", 41.808978, -87.726041),
    ("58", 41.818217, -87.697228),
    ("59", 41.828801, -87.674176),
    ("60", 41.835945, -87.645461),
    ("61", 41.808242, -87.660237),
    ("62", 41.792994, -87.723871),
    ("63", 41.795256, -87.697738),
    ("64", 41.779074, -87.773615),
    ("65", 41.770826, -87.72488),
    ("66", 41.772727, -87.699959),
    ("67", 41.778957, -87.663608),
    ("68", 41.775437, -87.641752),
    ("69", 41.765128, -87.616895),
    ("70", 41.744704, -87.707922),
    ("71", 41.742969, -87.654969),
    ("72", 41.712612, -87.679788),
    ("73", 41.719489, -87.649732),
    ("74", 41.695989, -87.713143),
    ("75", 41.688221, -87.66844),
    ("76", 41.978405, -87.883987),
    ("77", 41.98779, -87.657549),
)
