"""Lookup relations: sub-type map, type codes, scoring types, city list.

The values below must equal the source project's lookup data for results
to agree, so they are stated here as data. They become small DataFrames
(S8: inline constant relation); their size is fixed by this file, which is
what makes broadcasting them safe at any data scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import CODE_SCHEMA, TYPE_MAP_SCHEMA

# ---------------------------------------------------------------------------
# FIXED VALUES: sub-type -> common crime type, 99 rows, in file order.
# Keys are matched case-sensitively and untrimmed ("Theft OF Vehicle" is
# Theft Over, "Theft of Vehicle" is Auto Theft).
# ---------------------------------------------------------------------------
CRIME_TYPE_ROWS = [
    ("Robbery - Atm", "Robbery"),
    ("Kidnapping", "Assault"),
    ("Vehicle Stop", "Social Disorder"),
    ("Robbery - Vehicle Jacking", "Robbery"),
    ("Theft Over - Shoplifting", "Theft Over"),
    ("Other Theft", "Petty Crimes"),
    ("Air Gun Or Pistol: Bodily Harm", "Assault"),
    ("Commercial Break & Enter", "Break and Enter"),
    ("Aggravated Assault", "Assault"),
    ("Homicide", "Assault"),
    ("Robbery - Armoured Car", "Robbery"),
    ("Set/Place Trap/Intend Death/Bh", "Assault"),
    ("B&E - M/Veh To Steal Firearm", "Break and Enter"),
    ("Liquor", "Social Disorder"),
    ("Theft OF Vehicle", "Theft Over"),
    ("Theft Over $5000", "Theft Over"),
    ("Robbery", "Robbery"),
    ("Mischief", "Robbery"),
    ("Theft FROM Vehicle", "Theft Over"),
    ("Sexual Assault", "Assault"),
    ("Disarming Peace/Public Officer", "Assault"),
    ("Community Policing", "Assault"),
    ("Aggravated Aslt Peace Officer", "Assault"),
    ("Physical Disorder", "Assault"),
    ("Kidnap", "Missing Person"),
    ("Crim Negligence Bodily Harm", "Assault"),
    ("Discharge Firearm - Recklessly", "Assault"),
    ("Pointing A Firearm", "Assault"),
    ("Traffic", "Social Disorder"),
    ("Other Sexual Offense", "Assault"),
    ("Violence Other (Non-domestic)", "Assault"),
    ("Alarm", "False Alarm"),
    ("Vehicle Collision or Pedestrian Struck (with Fatality)", "Vehicle Collision"),
    ("Theft Of Utilities Over", "Theft Over"),
    ("Discharge Firearm With Intent", "Assault"),
    ("Social Disorder", "Liquor"),
    ("Death", "Assault"),
    ("Robbery - Swarming", "Robbery"),
    ("Theft From Motor Vehicle Over", "Theft Over"),
    ("Break and Enter Residential/Other", "Break and Enter"),
    ("Vehicle Collision or Pedestrian Struck (with Injury)", "Vehicle Collision"),
    ("Weapons Offense", "Assault"),
    ("Theft of Vehicle", "Auto Theft"),
    ("Robbery - Taxi", "Robbery"),
    ("Assault (Non-domestic)", "Assault"),
    ("Theft of Bicycle", "Auto Theft"),
    ("Robbery - Mugging", "Robbery"),
    ("Robbery - Financial Institute", "Robbery"),
    ("Robbery - Business", "Robbery"),
    ("Use Firearm / Immit Commit Off", "Assault"),
    ("Theft Over - Distraction", "Theft Over"),
    ("Theft", "Theft Over"),
    ("Sexual Assaults", "Assault"),
    ("Offence Against a Person", "Assault"),
    ("Assault Peace Officer Wpn/Cbh", "Assault"),
    ("Drugs", "Drugs"),
    ("Theft Over - Bicycle", "Theft Over"),
    ("Commercial Robbery", "Robbery"),
    ("Assault - Resist/ Prevent Seiz", "Assault"),
    ("Unlawfully In Dwelling-House", "Break and Enter"),
    ("Theft Over", "Theft Over"),
    ("Assault with Deadly Weapon", "Assault"),
    ("Arson", "Assault"),
    ("Break and Enter Commercial", "Break and Enter"),
    ("Administering Noxious Thing", "Assault"),
    ("Aggravated Assault Avails Pros", "Assault"),
    ("Fire", "Assault"),
    ("Unlawfully Causing Bodily Harm", "Assault"),
    ("Breaking & Entering", "Break and Enter"),
    ("Assault", "Assault"),
    ("Theft From Vehicle", "Theft Over"),
    ("Robbery - Purse Snatch", "Robbery"),
    ("Traps Likely Cause Bodily Harm", "Assault"),
    ("Other", "Petty Crimes"),
    ("Emergency", "False Alarm"),
    ("Missing Person", "Kidnap"),
    ("Disorder", "Social Disorder"),
    ("Theft - Misapprop Funds Over", "Theft Over"),
    ("Residential Break & Enter", "Break and Enter"),
    ("Assault - Force/Thrt/Impede", "Assault"),
    ("Robbery - Delivery Person", "Robbery"),
    ("B&E Out", "Break and Enter"),
    ("Assault Bodily Harm", "Assault"),
    ("Assault With Weapon", "Assault"),
    ("Robbery With Weapon", "Robbery"),
    ("Theft Of Vehicle", "Auto Theft"),
    ("Theft from Vehicle", "Theft Over"),
    ("Robbery - Home Invasion", "Robbery"),
    ("Property Crime", "Property Crime"),
    ("B&E - To Steal Firearm", "Break and Enter"),
    ("Theft Of Motor Vehicle", "Auto Theft"),
    ("Street Robbery", "Robbery"),
    ("Robbery - Other", "Robbery"),
    ("Assault Peace Officer", "Assault"),
    ("False Alarm", "False Alarm"),
    ("Theft From Mail / Bag / Key", "Theft Over"),
    ("B&E", "Break and Enter"),
    ("Break and Enter", "Break and Enter"),
    ("B&E W'Intent", "Break and Enter"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: common crime type codes, 14 rows.
# ---------------------------------------------------------------------------
CRIME_CODE_ROWS = [
    (1, "Assault"),
    (2, "Drugs"),
    (3, "Robbery"),
    (4, "Theft Over"),
    (5, "Liquor"),
    (6, "Break and Enter"),
    (7, "Vehicle Collision"),
    (8, "Social Disorder"),
    (9, "Missing Person"),
    (10, "Auto Theft"),
    (11, "False Alarm"),
    (12, "Kidnap"),
    (13, "Property Crime"),
    (14, "Petty Crimes"),
]

# FIXED VALUES: codes scored per location (14, Petty Crimes, is trained on
# but not scored by default).
SCORE_CODES = list(range(1, 14))

# FIXED VALUES: supported cities for the location gate (case-sensitive
# substring of the address).
SUPPORTED_CITIES = ["Vancouver", "Ottawa", "Victoria", "Calgary", "Lethbridge", "Edmonton", "Toronto"]

# FIXED VALUES: cities left out of the hour summary (they report no real
# hour) and of the daylight summary (no hour at all).
HOUR_EXCLUDED_CITIES = ["Calgary", "Edmonton"]
DAYLIGHT_EXCLUDED_CITIES = ["Edmonton"]

# FIXED VALUES: summary year window (lo, hi] = 2014..2019 and scoring year.
SUMMARY_YEARS = (2013, 2019)
SCORE_YEAR = 2020


def type_map_df(spark: SparkSession, rows=None) -> DataFrame:
    """Sub-type map as a DataFrame (sub_type, type)."""
    return spark.createDataFrame(rows if rows is not None else CRIME_TYPE_ROWS, TYPE_MAP_SCHEMA)


def code_table_df(spark: SparkSession, rows=None) -> DataFrame:
    """Type code table as a DataFrame (code, type_crime)."""
    return spark.createDataFrame(rows if rows is not None else CRIME_CODE_ROWS, CODE_SCHEMA)


def score_types_df(spark: SparkSession, codes=None) -> DataFrame:
    """Codes scored by the location scorer, with their type name."""
    wanted = set(codes if codes is not None else SCORE_CODES)
    return code_table_df(spark, [r for r in CRIME_CODE_ROWS if r[0] in wanted])
