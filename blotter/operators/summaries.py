"""The five incident summaries (A1-A5) and their shared pre-aggregate.

Every summary is a SUM of ``count`` (or an AVG of such sums), so all of
them can be answered from one compact pre-aggregate at
(city, crime_type, year, month, hour). On the full table that cube has at
most cities x types x years x 13 x 25 rows (months and hours, plus null)
however many incidents there are, so :func:`all_summaries` scans and
shuffles the incident table once and derives the five outputs from a table
that fits anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import daylight, season
from ..lookups import DAYLIGHT_EXCLUDED_CITIES, HOUR_EXCLUDED_CITIES, SUMMARY_YEARS

CUBE_KEYS = ["city", "crime_type", "year", "month", "hour"]

# ``order=True`` sorts a summary for display. It is off by default: the
# outputs are rebuilt whole and written as sets, and a global sort would add
# a sampling job and a range shuffle for nothing.


def _sum_count(col: str = "count", alias: str = "count"):
    return F.sum(F.col(col)).cast("bigint").alias(alias)


def _in_years(years: tuple[int, int]):
    lo, hi = years
    return (F.col("year") <= hi) & (F.col("year") > lo)


def _not_in(col: str, values):
    # SQL NOT IN: a null city is not kept either. An empty list keeps all.
    values = list(values)
    return ~F.col(col).isin(*values) if values else F.lit(True)


def summary_yoy(inc: DataFrame, order: bool = False) -> DataFrame:
    """A1: total count by (city, crime_type, year), all years."""
    out = inc.groupBy("city", "crime_type", "year").agg(_sum_count())
    return out.orderBy("city", "crime_type", "year") if order else out


def summary_by_type(inc: DataFrame, years=SUMMARY_YEARS) -> DataFrame:
    """A2: total count by crime_type for years in (lo, hi]."""
    return inc.filter(_in_years(years)).groupBy("crime_type").agg(_sum_count())


def summary_by_hour(inc: DataFrame, years=SUMMARY_YEARS, exclude=HOUR_EXCLUDED_CITIES,
                    order: bool = False) -> DataFrame:
    """A3: total count by (year, hour), years in range, some cities left out."""
    out = (inc.filter(_not_in("city", exclude) & _in_years(years))
              .groupBy("year", "hour").agg(_sum_count()))
    return out.orderBy("year", "hour") if order else out


def summary_daylight(inc: DataFrame, exclude=DAYLIGHT_EXCLUDED_CITIES, unknown: str | None = None,
                     order: bool = False) -> DataFrame:
    """A4: total count by (city, crime_type, day/night), all years."""
    out = (inc.filter(_not_in("city", exclude))
              .withColumn("daylight", daylight("hour", unknown=unknown))
              .groupBy("city", "crime_type", "daylight").agg(_sum_count()))
    return out.orderBy("daylight") if order else out


def summary_season(inc: DataFrame, years=SUMMARY_YEARS, order: bool = False) -> DataFrame:
    """A5: mean monthly total per season, by (city, crime_type).

    Level 1 sums each calendar month over all years in range; level 2
    averages the months present in the season (absent months are not 0).
    """
    monthly = (inc.filter(_in_years(years))
                  .groupBy("city", "crime_type", "month").agg(_sum_count(alias="sum")))
    out = (monthly.withColumn("seasons", season("month"))
                  .groupBy("city", "crime_type", "seasons")
                  .agg(F.avg("sum").alias("avgsum")))
    return out.orderBy("seasons") if order else out


def summary_cube(inc: DataFrame) -> DataFrame:
    """Pre-aggregate shared by all five summaries (SUM is decomposable)."""
    return inc.groupBy(*CUBE_KEYS).agg(_sum_count())


def signed_cube(added: DataFrame | None, removed: DataFrame | None = None) -> DataFrame:
    """The cube's change by rows that come and rows that go.

    Beside the sums it counts rows (``n``) and rows with a count (``n_counted``),
    so that a group without rows can be told from one whose counts add up to 0.
    """
    def part(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*CUBE_KEYS, (F.col("count").cast("bigint") * sign).alias("count"), F.lit(sign).alias("n"))
    both = [part(rows, sign) for rows, sign in ((added, 1), (removed, -1)) if rows is not None]
    rows = both[0] if len(both) == 1 else both[0].unionByName(both[1])
    return rows.groupBy(*CUBE_KEYS).agg(
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("count"), F.sum("n").cast("bigint").alias("n"),
        F.coalesce(F.sum(F.when(F.col("count").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_counted"))


def add_changes(cube: DataFrame, changes: DataFrame) -> DataFrame:
    """A signed cube with further signed changes summed in; groups without rows go."""
    return (cube.unionByName(changes).groupBy(*CUBE_KEYS)
                .agg(*[F.sum(c).cast("bigint").alias(c) for c in ("count", "n", "n_counted")]).where("n > 0"))


def plain_cube(cube: DataFrame) -> DataFrame:
    """The cube as :func:`summary_cube` gives it."""
    return cube.select(*CUBE_KEYS, F.when(F.col("n_counted") > 0, F.col("count")).alias("count"))


def all_summaries(inc: DataFrame, years=SUMMARY_YEARS, hour_exclude=HOUR_EXCLUDED_CITIES,
                  daylight_exclude=DAYLIGHT_EXCLUDED_CITIES, order: bool = False,
                  cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five summaries from one pass over ``inc``.

    Pass a materialised ``cube`` (checkpointed / written) to share it across
    the five actions; otherwise each output re-derives it from ``inc``.
    Results equal the direct functions above exactly (integer sums).
    """
    c = cube if cube is not None else summary_cube(inc)
    return {
        "crimes_yoy": summary_yoy(c, order=order),
        "crimes_typ": summary_by_type(c, years),
        "crimes_hr": summary_by_hour(c, years, hour_exclude, order=order),
        "crimes_dl": summary_daylight(c, daylight_exclude, order=order),
        "crimes_ss": summary_season(c, years, order=order),
    }
