"""Column -> Column helpers (scalar functions and predicates).

Everything here is a built-in Spark expression, so it stays JVM-side and
inside whole-stage codegen; none of it is a Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- X1: locality text ----------------------------------------------------

def locality(neighbourhood: ColumnOrName, suffix: str = ", Edmonton, Canada") -> Column:
    """``<neighbourhood><suffix>``; null in gives null out (plain concat)."""
    return F.concat(_c(neighbourhood), F.lit(suffix))


# ---- N2 / X2 / X3: safe casts and date parts ------------------------------

def safe_cast(c: ColumnOrName, to: str) -> Column:
    """Cast that yields null on bad input (ANSI mode would throw)."""
    return _c(c).try_cast(to)


def to_ts(c: ColumnOrName) -> Column:
    """String (ISO-8601, with or without ``T``) or timestamp -> timestamp."""
    return _c(c).try_cast("timestamp")


def year_of(c: ColumnOrName) -> Column:
    return F.year(to_ts(c))


def month_of(c: ColumnOrName) -> Column:
    return F.month(to_ts(c))


def hour_of(c: ColumnOrName) -> Column:
    """Hour of day in the session time zone (UTC in blotter sessions)."""
    return F.hour(to_ts(c))


# ---- X4: month name -> number ---------------------------------------------

def month_number(name: ColumnOrName) -> Column:
    """Full English month name ("September") -> 9; unknown or null -> null."""
    return F.month(F.try_to_date(_c(name), "MMMM"))


# ---- X5 / X6: decimal rounding --------------------------------------------

def round_half_up(c: ColumnOrName, digits: int, work_scale: int = 8) -> Column:
    """Round via DECIMAL so the result does not hang on binary noise.

    ``round(double)`` tie handling differs between engines; going through
    DECIMAL(18, work_scale) first gives one exact half-up answer. A value
    that does not fit (or NaN) gives null instead of failing the job.
    """
    return F.round(_c(c).try_cast(f"decimal(18,{work_scale})"), digits).cast("double")


# ---- X7 / X8: daylight and season -----------------------------------------

def daylight(hour: ColumnOrName, first_day_hour: int = 6, last_day_hour: int = 18,
             unknown: str | None = None) -> Column:
    """'day' for first..last hour inclusive, else 'night'.

    A null hour falls to 'night' (the CASE has no null branch); pass
    ``unknown`` to label it separately instead.
    """
    h = _c(hour)
    expr = F.when((h >= first_day_hour) & (h <= last_day_hour), F.lit("day"))
    if unknown is not None:
        expr = expr.when(h.isNull(), F.lit(unknown))
    return expr.otherwise(F.lit("night"))


# FIXED VALUES: month -> season (anything else, null included, is Fall).
SEASON_MONTHS = [("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8))]
SEASON_OTHERWISE = "Fall"


def season(month: ColumnOrName) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASON_MONTHS:
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASON_OTHERWISE))


# ---- F2-F7: coordinate predicates -----------------------------------------

def has_lat(lat: ColumnOrName) -> Column:                       # F2
    return _c(lat).isNotNull()


def not_both_zero(lat: ColumnOrName, lon: ColumnOrName) -> Column:    # F3
    return (_c(lat) != 0) | (_c(lon) != 0)


def neither_zero(lat: ColumnOrName, lon: ColumnOrName) -> Column:     # F4
    return (_c(lat) != 0) & (_c(lon) != 0)


def any_positive(x: ColumnOrName, y: ColumnOrName) -> Column:         # F5
    return (_c(x) > 0) | (_c(y) > 0)


def is_zero(x: ColumnOrName) -> Column:                               # F6
    return _c(x) == 0.0


def both_null(a: ColumnOrName, b: ColumnOrName) -> Column:            # F7
    return F.isnull(_c(a)) & F.isnull(_c(b))


def both_present(a: ColumnOrName, b: ColumnOrName) -> Column:         # F7 negated
    return ~F.isnull(_c(a)) & ~F.isnull(_c(b))


def kept(pred: Column) -> Column:
    """Whether a WHERE clause keeps the row (null counts as not kept)."""
    return F.coalesce(pred, F.lit(False))


# ---- F11: any keyword contained -------------------------------------------

def contains_any(text: ColumnOrName, words: Iterable[str]) -> Column:
    """Case-sensitive substring test OR-ed over a fixed word list."""
    t = _c(text)
    out = None
    for w in words:
        cond = t.contains(w)
        out = cond if out is None else (out | cond)
    return out if out is not None else F.lit(False)


# ---- N3: default for a failed lookup --------------------------------------

def default_zero(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c), F.lit(0.0))


# ---- X9: content hash ------------------------------------------------------

_UNIT_SEP = "\u001f"
_NULL_MARK = "\u0000"


def content_hash(*cols: ColumnOrName) -> Column:
    """SHA-256 hex over the given columns; nulls and separators are unambiguous.

    Portable text digest (same bytes in any engine); for keys inside Spark
    prefer :func:`content_hash128`, which avoids building strings.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(_NULL_MARK)) for c in cols]
    return F.sha2(F.concat_ws(_UNIT_SEP, *parts), 256)


def content_hash128(*cols: ColumnOrName) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of the row content (128 bits together).

    Typed hashing inside codegen, no string building. Spark's hash skips
    nulls, so each column is followed by its null flag: (null, 'a') and
    ('a', null) hash differently.
    """
    args = []
    for c in cols:
        col = _c(c)
        args += [col, col.isNull()]
    h1 = F.xxhash64(F.lit("blotter-h1"), *args)
    h2 = F.xxhash64(F.lit("blotter-h2-salt"), *reversed(args))
    return h1, h2


# ---- X10: UTM -> latitude / longitude -------------------------------------
# Inverse transverse Mercator on WGS84 (Snyder 1987, USGS PP 1395).

_A = 6378137.0
_F = 1 / 298.257223563
_E2 = _F * (2 - _F)
_EP2 = _E2 / (1 - _E2)
_K0 = 0.9996
_E1 = (1 - math.sqrt(1 - _E2)) / (1 + math.sqrt(1 - _E2))
_MU_DEN = _A * (1 - _E2 / 4 - 3 * _E2 ** 2 / 64 - 5 * _E2 ** 3 / 256)
_J1 = 3 * _E1 / 2 - 27 * _E1 ** 3 / 32
_J2 = 21 * _E1 ** 2 / 16 - 55 * _E1 ** 4 / 32
_J3 = 151 * _E1 ** 3 / 96
_J4 = 1097 * _E1 ** 4 / 512


def with_utm_latlon(df, easting: str, northing: str, lat_out: str = "lat", long_out: str = "long",
                   zone: int = 10, northern: bool = True, located: Column | None = None):
    """Add ``lat_out`` / ``long_out`` (degrees) from UTM metres; DataFrame -> DataFrame.

    The series is evaluated in a few stacked projections so every shared
    term (footpoint latitude, its sine / cosine / tangent, radii) is computed
    once per row; Catalyst keeps the stages apart because collapsing them
    would duplicate non-trivial expressions. Each stage is one SQL expression
    string (a single parse instead of hundreds of Column calls). ``located``
    (default: both metres positive) decides which rows get coordinates;
    others get null.
    """
    t = "__utm_"
    e = f"CAST(`{easting}` AS DOUBLE)"
    n = f"CAST(`{northing}` AS DOUBLE)"
    y = n if northern else f"({n} - 10000000.0)"
    ok = located if located is not None else (F.col(easting) > 0) & (F.col(northing) > 0)

    def lit(v: float) -> str:
        return f"CAST('{v!r}' AS DOUBLE)"

    s1 = df.select("*", ok.alias(t + "ok"),
                   F.expr(f"{e} - 500000.0").alias(t + "x"),
                   F.expr(f"{y} / {lit(_K0)} / {lit(_MU_DEN)}").alias(t + "mu"))
    mu = t + "mu"
    s2 = s1.select("*", F.expr(f"{mu} + {lit(_J1)} * sin(2 * {mu}) + {lit(_J2)} * sin(4 * {mu})"
                               f" + {lit(_J3)} * sin(6 * {mu}) + {lit(_J4)} * sin(8 * {mu})").alias(t + "p1"))
    p1 = t + "p1"
    s3 = s2.selectExpr("*", f"sin({p1}) AS {t}sin", f"cos({p1}) AS {t}cos", f"tan({p1}) AS {t}tan")
    sn, cs, tn = t + "sin", t + "cos", t + "tan"
    s4 = s3.selectExpr("*", f"{sn} * {sn} AS {t}s2", f"{lit(_EP2)} * {cs} * {cs} AS {t}cc",
                       f"{tn} * {tn} AS {t}tt")
    s2c, cc, tt = t + "s2", t + "cc", t + "tt"
    s5 = s4.selectExpr("*", f"{lit(_A)} / sqrt(1 - {lit(_E2)} * {s2c}) AS {t}n1",
                       f"{lit(_A * (1 - _E2))} / pow(1 - {lit(_E2)} * {s2c}, 1.5) AS {t}r")
    n1, r = t + "n1", t + "r"
    s6 = s5.selectExpr("*", f"{t}x / ({n1} * {lit(_K0)}) AS {t}d")
    d = t + "d"
    s7 = s6.selectExpr("*", f"{d} * {d} AS {t}d2")
    d2 = t + "d2"
    lat = (f"{p1} - ({n1} * {tn} / {r}) * ({d2} / 2"
           f" - (5 + 3 * {tt} + 10 * {cc} - 4 * {cc} * {cc} - {lit(9 * _EP2)}) * {d2} * {d2} / 24"
           f" + (61 + 90 * {tt} + 298 * {cc} + 45 * {tt} * {tt} - {lit(252 * _EP2)} - 3 * {cc} * {cc})"
           f" * {d2} * {d2} * {d2} / 720)")
    lon = (f"({d} - (1 + 2 * {tt} + {cc}) * {d2} * {d} / 6"
           f" + (5 - 2 * {cc} + 28 * {tt} - 3 * {cc} * {cc} + {lit(8 * _EP2)} + 24 * {tt} * {tt})"
           f" * {d2} * {d2} * {d} / 120) / {cs}")
    central_meridian = float(zone * 6 - 183)
    out = s7.selectExpr("*", f"CASE WHEN {t}ok THEN degrees({lat}) END AS `{lat_out}`",
                        f"CASE WHEN {t}ok THEN degrees({lon}) + {lit(central_meridian)} END AS `{long_out}`")
    return out.drop(*[c for c in out.columns if c.startswith(t)])
