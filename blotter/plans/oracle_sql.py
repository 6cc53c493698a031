"""DuckDB SQL oracles for the query registry.

Written independently of the Spark plans (plain SQL over the driver's
tables), sharing only fixed values: stand-in lookup rows and the WGS84
constants. Each statement returns the same column names and types as its
Spark query.
"""

from __future__ import annotations

from ..functions import columns as K
from ..lookups import CRIME_CODE_ROWS, SCORE_CODES
from . import standins as V


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def R(expr: str, digits: int, scale: int = 8) -> str:
    """Half-up rounding through DECIMAL, as the Spark side does."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,{scale})), {digits}) AS DOUBLE)"


def R4(e):
    return R(e, 4)


def R6(e):
    return R(e, 6, 10)


def D(v: float) -> str:
    """A double literal that parses to exactly ``v``."""
    return f"CAST('{v!r}' AS DOUBLE)"


SUFFIX = "', Edmonton, Canada'"

CTE = {
    "v1": """SELECT n_name AS city, p_type AS crime_type, p_brand AS crimesub_type, p_name AS neighbourhood,
        CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
        CAST(l_orderkey % 24 AS INTEGER) AS hour, CAST(l_quantity AS INTEGER) AS count,
        l_orderkey, l_partkey, l_suppkey
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      JOIN part ON l_partkey = p_partkey""",
    "v1l": """SELECT *,
        CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN 0.0
             ELSE 49.0 + CAST(l_partkey AS DOUBLE) / 7919.0 END AS lat,
        CASE WHEN l_suppkey % 7 = 0 THEN 0.0 WHEN l_partkey % 13 = 0 THEN 0.0
             ELSE -123.0 - CAST(l_partkey AS DOUBLE) / 6073.0 END AS long
      FROM v1""",
    "v2": """SELECT event_id, user_id, ts, value, props, c_name, c_mktsegment, c_acctbal, c_custkey,
        n_name AS city, event_type AS crimesub_type, CAST(year(ts) AS INTEGER) AS year,
        CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour, 1 AS count
      FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "tm_ev": f"SELECT * FROM (VALUES {_values(V.EVENT_TYPE_ROWS)}) AS t(sub_type, type)",
    "tm_pa": f"SELECT * FROM (VALUES {_values(V.PART_TYPE_ROWS)}) AS t(sub_type, type)",
    "codes_pa": f"SELECT * FROM (VALUES {_values(V.PART_CODE_ROWS)}) AS t(code, type_crime)",
    "loc": """SELECT c_custkey AS loc_id, concat_ws(', ', c_name, n_name, 'Canada') AS address,
        49.0 + c_acctbal / 20000.0 AS lat, -123.0 - c_acctbal / 30000.0 AS long
      FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "metres": """SELECT c_custkey, c_name, c_mktsegment,
        CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE CAST(483000 + (c_custkey * 37) % 16000 AS DOUBLE) END AS xm,
        CAST(5449000 + (c_custkey * 53) % 14000 AS DOUBLE) AS ym
      FROM customer""",
    "g": f"""SELECT p_name || {SUFFIX} AS locality,
        CASE WHEN p_name LIKE 'red %' THEN 0.0 ELSE 53.0 + CAST(min(p_size) AS DOUBLE) / 100.0 END AS lat,
        CASE WHEN p_name LIKE 'red %' OR p_name LIKE 'blue %' THEN 0.0
             ELSE -113.0 - CAST(min(p_size) AS DOUBLE) / 100.0 END AS long
      FROM part WHERE p_name NOT LIKE '% gizmo' GROUP BY p_name""",
    "r": f"""SELECT p_name || {SUFFIX} AS locality,
        53.5 + CAST(max(p_size) AS DOUBLE) / 1000.0 AS lat, -113.5 - CAST(max(p_size) AS DOUBLE) / 1000.0 AS long
      FROM part GROUP BY p_name""",
}



def _millionths(expr: str) -> str:
    return f"COALESCE(CAST(CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), 6) * 1000000 AS BIGINT) AS VARCHAR), '-')"


def _text(expr: str) -> str:
    return f"COALESCE(CAST({expr} AS VARCHAR), '-')"


SPLIT = ("CASE WHEN CAST('0x' || substr(md5(" + " || '|' || ".join([_millionths("lat"), _millionths("long"), _text("year"), _text("code"), _text("count")])
         + "), 1, 8) AS BIGINT) % 100 < 60 THEN 'train' ELSE 'validation' END")


def W(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH <named CTEs in order> <extra CTEs> <body>."""
    parts = [f"{n} AS ({CTE[n]})" for n in names]
    parts += [f"{n} AS ({b})" for n, b in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


def utm_ctes(src: str, tag: str) -> list[tuple[str, str]]:
    """CTE chain turning ``xm, ym`` (metres, zone 10 N) of ``src`` into
    ``lat_deg, lon_deg`` (null unless both metres are positive)."""
    A, E2, EP2, K0 = K._A, K._E2, K._EP2, K._K0
    return [
        (f"{tag}a", f"SELECT *, xm - 500000.0 AS ux, ym / {D(K0)} / {D(K._MU_DEN)} AS mu FROM {src}"),
        (f"{tag}b", f"SELECT *, mu + {D(K._J1)} * sin(2 * mu) + {D(K._J2)} * sin(4 * mu)"
                    f" + {D(K._J3)} * sin(6 * mu) + {D(K._J4)} * sin(8 * mu) AS p1 FROM {tag}a"),
        (f"{tag}c", f"SELECT *, sin(p1) * sin(p1) AS s2, {D(EP2)} * cos(p1) * cos(p1) AS cc,"
                    f" tan(p1) * tan(p1) AS tt FROM {tag}b"),
        (f"{tag}d", f"SELECT *, {D(A)} / sqrt(1 - {D(E2)} * s2) AS n1,"
                    f" {D(A * (1 - E2))} / pow(1 - {D(E2)} * s2, 1.5) AS rr FROM {tag}c"),
        (f"{tag}e", f"SELECT *, ux / (n1 * {D(K0)}) AS dd FROM {tag}d"),
        (f"{tag}f", f"SELECT *, dd * dd AS d2 FROM {tag}e"),
        (f"{tag}g", f"""SELECT *,
            CASE WHEN xm > 0 AND ym > 0 THEN degrees(p1 - (n1 * tan(p1) / rr) * (d2 / 2
              - (5 + 3 * tt + 10 * cc - 4 * cc * cc - {D(9 * EP2)}) * d2 * d2 / 24
              + (61 + 90 * tt + 298 * cc + 45 * tt * tt - {D(252 * EP2)} - 3 * cc * cc) * d2 * d2 * d2 / 720)) END
              AS lat_deg,
            CASE WHEN xm > 0 AND ym > 0 THEN degrees((dd - (1 + 2 * tt + cc) * d2 * dd / 6
              + (5 - 2 * cc + 28 * tt - 3 * cc * cc + {D(8 * EP2)} + 24 * tt * tt) * d2 * d2 * dd / 120) / cos(p1))
              + {D(float(10 * 6 - 183))} END AS lon_deg
          FROM {tag}f"""),
    ]


SUM_COUNT = "CAST(SUM(count) AS BIGINT) AS count"
DAYLIGHT = "CASE WHEN hour >= 6 AND hour <= 18 THEN 'day' ELSE 'night' END"
SEASON = ("CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring' "
          "WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")
V1_YEARS = f"year <= {V.V1_YEARS[1]} AND year > {V.V1_YEARS[0]}"
V2_YEARS = f"year <= {V.V2_YEARS[1]} AND year > {V.V2_YEARS[0]}"


def _in_list(vals):
    return ", ".join(f"'{v}'" for v in vals)


def _season_sql(src_cte: str, src_expr: str | None = None) -> str:
    names = ["v1"]
    extra = []
    if src_expr:
        extra.append(("src", src_expr))
        src_cte = "src"
    extra.append(("mon", f"SELECT city, crime_type, month, SUM(count) AS sum FROM {src_cte} "
                         f"WHERE {V1_YEARS} GROUP BY city, crime_type, month"))
    return W(names, f"SELECT city, crime_type, {SEASON} AS seasons, {R4('AVG(sum)')} AS avgsum "
                    f"FROM mon GROUP BY city, crime_type, seasons", extra)


# ---- feed adapters: (cte names, extra ctes, select) -----------------------------

def _feed_vancouver():
    extra = [("van_raw", """SELECT event_type AS subtype, CAST(year(ts) AS INTEGER) AS year,
                CAST(month(ts) AS INTEGER) AS month, CAST(NULLIF(hour(ts), 5) AS INTEGER) AS hour,
                c_mktsegment AS neighbourhood, xm, ym
              FROM events JOIN metres ON user_id = c_custkey""")]
    extra += utm_ctes("van_raw", "vu")
    sel = (f"SELECT t.type AS crime_type, subtype AS crimesub_type, 'Vancouver' AS city, year, month, hour,"
           f" neighbourhood, {R6('lat_deg')} AS lat, {R6('lon_deg')} AS long, 1 AS count"
           f" FROM vug JOIN tm_ev t ON subtype = t.sub_type")
    return ["metres", "tm_ev"], extra, sel


def _calgary_raw():
    return [("cal_raw", """SELECT v2.*, loc.lat AS glat, loc.long AS glong FROM v2 JOIN loc ON c_custkey = loc_id""")]


def _feed_calgary():
    sel = (f"SELECT t.type AS crime_type, crimesub_type, 'Calgary' AS city, year,"
           f" CASE WHEN event_id % 41 = 0 THEN NULL ELSE month END AS month,"
           f" CASE WHEN event_id % 41 = 0 THEN NULL ELSE hour END AS hour,"
           f" c_mktsegment AS neighbourhood,"
           f" CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE {R6('glat')} END AS lat,"
           f" CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE {R6('glong')} END AS long,"
           f" CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id % 3 + 1 AS INTEGER) END AS count"
           f" FROM cal_raw JOIN tm_ev t ON crimesub_type = t.sub_type")
    return ["v2", "loc", "tm_ev"], _calgary_raw(), sel


def _feed_toronto():
    extra = [("tor_raw", """SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, c_mktsegment, lat, long
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN loc ON c_custkey = loc_id""")]
    sel = (f"SELECT o_orderpriority AS crime_type, o_orderstatus AS crimesub_type, 'Toronto' AS city,"
           f" CAST(year(o_orderdate) AS INTEGER) AS year,"
           f" CASE WHEN month(o_orderdate) = 3 THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END AS month,"
           f" CAST(o_orderkey % 24 AS INTEGER) AS hour, c_mktsegment AS neighbourhood,"
           f" {R6('lat')} AS lat, {R6('long')} AS long, 1 AS count FROM tor_raw")
    return ["loc"], extra, sel


def _feed_socrata():
    sel = (f"SELECT t.type AS crime_type, crimesub_type, city, year, month,"
           f" CASE WHEN event_id % 17 = 0 THEN NULL ELSE hour END AS hour, c_name AS neighbourhood,"
           f" CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {R6('loc.lat')} END AS lat,"
           f" {R6('loc.long')} AS long, 1 AS count"
           f" FROM v2 JOIN loc ON c_custkey = loc_id JOIN tm_ev t ON crimesub_type = t.sub_type")
    return ["v2", "loc", "tm_ev"], [], sel


def _socrata_cities(tail: str) -> str:
    """The Socrata incidents with the awkward cities of the catalogue queries, under ``inc``."""
    names, extra, sel = _feed_socrata()
    cols = ("crime_type, crimesub_type, CASE month % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '007' ELSE city END AS city, "
            "year, month, hour, neighbourhood, lat, long, count")
    return W(names, tail, [*extra, ("plain", sel), ("inc", f"SELECT {cols} FROM plain")])


def _edmonton_ctes():
    return [
        ("edm_raw", """SELECT p_name AS neighbourhood, CAST(month(l_shipdate) AS INTEGER) AS month,
              CAST(year(l_shipdate) AS INTEGER) AS year, p_type AS crimesub_type,
              CAST(l_quantity AS INTEGER) AS count
            FROM lineitem JOIN part ON l_partkey = p_partkey"""),
        ("edm_locs", f"SELECT DISTINCT neighbourhood || {SUFFIX} AS locality FROM edm_raw WHERE neighbourhood IS NOT NULL"),
        ("edm_new", """SELECT edm_locs.locality, COALESCE(r.lat, 0.0) AS lat, COALESCE(r.long, 0.0) AS long
            FROM edm_locs LEFT JOIN r ON r.locality = edm_locs.locality
            WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.locality = edm_locs.locality)"""),
        ("edm_g2", "SELECT locality, lat, long FROM g UNION ALL SELECT locality, lat, long FROM edm_new"),
        ("edm_e", f"""SELECT edm_raw.*, edm_g2.lat, edm_g2.long FROM edm_raw
            LEFT JOIN edm_g2 ON edm_raw.neighbourhood || {SUFFIX} = edm_g2.locality"""),
    ]


def _feed_edmonton():
    sel = (f"SELECT t.type AS crime_type, crimesub_type, 'Edmonton' AS city, year, month, 0 AS hour,"
           f" neighbourhood, {R6('lat')} AS lat, {R6('long')} AS long, count"
           f" FROM edm_e JOIN tm_pa t ON crimesub_type = t.sub_type WHERE lat <> 0 AND long <> 0")
    return ["g", "r", "tm_pa"], _edmonton_ctes(), sel


FEEDS = [_feed_vancouver, _feed_calgary, _feed_toronto, _feed_socrata, _feed_edmonton]


def _feed(f) -> str:
    names, extra, sel = f()
    return W(names, sel, extra)


def _union(body_fn) -> str:
    names, extra, sels = [], [], []
    for f in FEEDS:
        n, e, s = f()
        names += [x for x in n if x not in names]
        extra += [x for x in e if x not in extra]
        sels.append(s)
    return W(names, body_fn(" UNION ALL ".join(f"({s})" for s in sels)), extra)


SQL: dict[str, str] = {
    "summary_yoy": W(["v1"], f"SELECT city, crime_type, year, {SUM_COUNT} FROM v1 GROUP BY city, crime_type, year"),
    "summary_by_type": W(["v1"], f"SELECT crime_type, {SUM_COUNT} FROM v1 WHERE {V1_YEARS} GROUP BY crime_type"),
    "summary_by_hour": W(["v1"], f"SELECT year, hour, {SUM_COUNT} FROM v1 WHERE city NOT IN "
                                 f"({_in_list(V.V1_HOUR_EXCLUDED)}) AND {V1_YEARS} GROUP BY year, hour"),
    "summary_by_hour_events": W(["v2"], f"SELECT year, hour, {SUM_COUNT} FROM v2 WHERE city NOT IN "
                                        f"({_in_list(V.V1_HOUR_EXCLUDED)}) AND {V2_YEARS} GROUP BY year, hour"),
    "summary_daylight": W(["v1"], f"SELECT city, crime_type, {DAYLIGHT} AS daylight, {SUM_COUNT} FROM v1 "
                                  f"WHERE city NOT IN ({_in_list(V.V1_DAYLIGHT_EXCLUDED)}) "
                                  f"GROUP BY city, crime_type, daylight"),
    "summary_season": _season_sql("v1"),
    "daylight_null_hour": W(["v2"], f"SELECT city, crime_type, {DAYLIGHT} AS daylight, {SUM_COUNT} FROM "
                                    f"(SELECT city, crimesub_type AS crime_type, NULLIF(hour, 5) AS hour, count FROM v2) "
                                    f"GROUP BY city, crime_type, daylight"),
    "season_null_month": _season_sql("v1", "SELECT city, crime_type, year, NULLIF(month, 7) AS month, count FROM v1"),
    "summary_cube": W(["v1"], f"SELECT city, crime_type, year, month, hour, {SUM_COUNT} FROM v1 "
                              f"GROUP BY city, crime_type, year, month, hour"),
    "classify_left": W(["v2", "tm_ev"], "SELECT event_id, city, crimesub_type, t.type AS crime_type "
                                        "FROM v2 LEFT JOIN tm_ev t ON v2.crimesub_type = t.sub_type"),
    "classify_inner": W(["v2", "tm_ev"], "SELECT event_id, city, crimesub_type, t.type AS crime_type "
                                         "FROM v2 JOIN tm_ev t ON v2.crimesub_type = t.sub_type"),
    "classify_rejects": W(["v2", "tm_ev"], "SELECT city, crimesub_type, COUNT(*) AS count FROM v2 "
                                           "LEFT JOIN tm_ev t ON v2.crimesub_type = t.sub_type "
                                           "WHERE t.type IS NULL GROUP BY city, crimesub_type"),
    "code_join": W(["v1", "codes_pa"], "SELECT l_orderkey, l_partkey, l_suppkey, crime_type, code "
                                       "FROM v1 JOIN codes_pa ON crime_type = type_crime"),
    "join_where_condition": W(
        ["v1", "codes_pa"],
        "SELECT p.year AS year, t.type_crime AS type, CAST(ROUND(AVG(p.prediction), 0) AS INTEGER) AS predictions "
        "FROM predict p, codes_pa t WHERE p.code = t.code GROUP BY p.year, t.type_crime",
        [("predict", "SELECT year, CAST(l_partkey % 5 + 1 AS INTEGER) AS code, "
                     "CAST(count AS DOUBLE) AS prediction FROM v1")]),
    "grid_cross": W(
        ["loc"],
        "SELECT loc_id, CAST(ROUND(CAST(lat AS DECIMAL(18,8)), 3) + k * 0.001 AS DOUBLE) AS lat, "
        "CAST(ROUND(CAST(long AS DECIMAL(18,8)), 3) + k * 0.001 AS DOUBLE) AS long, "
        "2020 AS year, CAST(code AS INTEGER) AS code FROM loc, gk, cd",
        [("gk", "SELECT unnest([" + ", ".join(str(k) for k in V.grid_offsets()) + "]) AS k"),
         ("cd", "SELECT unnest(range(1, 14)) AS code")]),
    "score_linear": W(
        ["loc"],
        "SELECT loc_id, 2020 AS year, type, CAST(ROUND(AVG(code * 10 + CAST(ROUND(CAST(lat AS DECIMAL(18,8)), 3) + k * 0.001 AS DOUBLE) "
        "+ CAST(0.0003 AS DOUBLE)), 0) AS INTEGER) AS predictions FROM loc, gk, cd WHERE lat IS NOT NULL AND long IS NOT NULL "
        "GROUP BY loc_id, type",
        [("gk", "SELECT unnest([" + ", ".join(str(k) for k in V.grid_offsets()) + "]) AS k"),
         ("cd", "SELECT * FROM (VALUES " + ", ".join(f"({c}, '{t}')" for c, t in CRIME_CODE_ROWS if c in SCORE_CODES) + ") AS t(code, type)")]),
    "locality_concat": W(["v1"], f"SELECT DISTINCT neighbourhood || {SUFFIX} AS locality FROM v1 "
                                 f"WHERE neighbourhood IS NOT NULL"),
    "distinct_neighbourhoods": W(["v1"], "SELECT DISTINCT city, neighbourhood FROM v1"),
    "gazetteer_build": W(["v1", "g"], "SELECT l.locality, COALESCE(g.lat, 0.0) AS lat, COALESCE(g.long, 0.0) AS long "
                                      f"FROM (SELECT DISTINCT neighbourhood || {SUFFIX} AS locality FROM v1 "
                                      "WHERE neighbourhood IS NOT NULL) l LEFT JOIN g ON g.locality = l.locality"),
    "gazetteer_left": W(["v1", "g"], "SELECT l_orderkey, l_partkey, l_suppkey, neighbourhood, g.lat AS lat, "
                                     f"g.long AS long FROM v1 LEFT JOIN g ON v1.neighbourhood || {SUFFIX} = g.locality "
                                     "WHERE g.lat <> 0 AND g.long <> 0"),
    "gazetteer_missing": W(["v1", "g"], f"SELECT neighbourhood || {SUFFIX} AS locality, COUNT(*) AS n_incidents "
                                        f"FROM v1 WHERE neighbourhood IS NOT NULL AND NOT EXISTS "
                                        f"(SELECT 1 FROM g WHERE g.locality = v1.neighbourhood || {SUFFIX}) "
                                        f"GROUP BY 1"),
    "gazetteer_upsert": W(
        ["v1", "g", "r"],
        "SELECT locality, lat, long FROM g WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.locality = g.locality) "
        "UNION ALL SELECT locality, lat, long FROM nw",
        [("locs", f"SELECT DISTINCT neighbourhood || {SUFFIX} AS locality FROM v1 WHERE neighbourhood IS NOT NULL"),
         ("need", "SELECT locality FROM locs WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.locality = locs.locality) "
                  "UNION ALL SELECT locs.locality FROM locs JOIN g ON g.locality = locs.locality "
                  "WHERE g.lat = 0 AND g.long = 0"),
         ("nw", "SELECT need.locality, COALESCE(r.lat, 0.0) AS lat, COALESCE(r.long, 0.0) AS long "
                "FROM need LEFT JOIN r ON r.locality = need.locality")]),
    "utm_to_latlon": W(["metres"], f"SELECT c_custkey, {R6('lat_deg')} AS lat, {R6('lon_deg')} AS long FROM ug",
                       utm_ctes("metres", "u")),
    "na_fill_zero": "SELECT event_id, event_type, COALESCE(CAST(NULLIF(hour(ts), 5) AS INTEGER), 0) AS hour, "
                    "COALESCE(CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END, 0.0) AS value FROM events",
    "zero_coord_filters": W(
        ["v1", "v1l"],
        "SELECT l_orderkey, l_partkey, l_suppkey, COALESCE(lat IS NOT NULL, false) AS keep_f2, "
        "COALESCE((lat <> 0) OR (long <> 0), false) AS keep_f3, "
        "COALESCE((lat <> 0) AND (long <> 0), false) AS keep_f4, "
        "COALESCE((lat > 0) OR (long > 0), false) AS keep_f5, "
        "COALESCE(long = 0.0, false) AS keep_f6, "
        "COALESCE(lat IS NULL AND long IS NULL, false) AS keep_f7 FROM v1l"),
    "month_name_to_number": "SELECT o_orderkey, CASE WHEN monthname(o_orderdate) = 'March' THEN NULL "
                            "ELSE monthname(o_orderdate) END AS month_name, CASE WHEN monthname(o_orderdate) = 'March' "
                            "THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END AS month FROM orders",
    "iso_string_parts": "SELECT event_id, "
                        "CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(year(ts) AS INTEGER) END AS year, "
                        "CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(month(ts) AS INTEGER) END AS month, "
                        "CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS hour, "
                        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value, "
                        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS hour_of_day "
                        "FROM events",
    "nested_struct_fields": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
                            "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_map FROM events",
    "round_coordinates": f"SELECT c_custkey, {R4('c_acctbal / 7.0')} AS lat, {R('c_acctbal / 100.0', 3)} AS long "
                         f"FROM customer",
    "any_city_gate": W(["loc"], "SELECT loc_id, address, COALESCE("
                                + " OR ".join(f"contains(address, '{c}')" for c in V.GATE_CITIES)
                                + ", false) AS supported FROM loc"),
    "training_features": W(
        ["v1", "v1l", "codes_pa"],
        "SELECT lat, long, year, code, count FROM f JOIN codes_pa ON crime_type = type_crime "
        "WHERE lat IS NOT NULL AND (lat <> 0 OR long <> 0)",
        [("f", f"SELECT {R4('lat')} AS lat, {R4('long')} AS long, year, crime_type, count FROM v1l")]),
    "content_split": W(
        ["v1", "v1l", "codes_pa"],
        f"SELECT *, {SPLIT} AS split FROM (SELECT lat, long, year, code, count FROM f JOIN codes_pa ON crime_type = type_crime "
        "WHERE lat IS NOT NULL AND (lat <> 0 OR long <> 0)) AS feats",
        [("f", f"SELECT {R4('lat')} AS lat, {R4('long')} AS long, year, crime_type, count FROM v1l")]),
    # every threshold of every feature: the split of the least squared error, its two means and their error
    "gbt_stump": W(
        ["v1", "v1l", "codes_pa"],
        f"SELECT {R6('prediction')} AS prediction, COUNT(*) AS n, (SELECT {R6('sqrt(avg((count - prediction) * (count - prediction)))')} FROM told) AS rmse "
        "FROM told GROUP BY prediction",
        [("f", f"SELECT {R('lat', 0)} AS lat, {R('long', 0)} AS long, year, crime_type, count FROM v1l"),
         ("feats", "SELECT lat, long, year, code, count FROM f JOIN codes_pa ON crime_type = type_crime WHERE lat IS NOT NULL AND (lat <> 0 OR long <> 0)"),
         ("train", f"SELECT * FROM feats WHERE {SPLIT} = 'train' AND long IS NOT NULL AND count IS NOT NULL"),
         ("cells", "SELECT name, x, COUNT(*) AS n, SUM(count) AS s FROM (SELECT count, unnest(['lat', 'long', 'year', 'code']) AS name, "
                   "unnest([lat, long, CAST(year AS DOUBLE), CAST(code AS DOUBLE)]) AS x FROM train) AS t GROUP BY name, x"),
         ("cum", "SELECT name, x, SUM(n) OVER (PARTITION BY name ORDER BY x) AS nl, SUM(s) OVER (PARTITION BY name ORDER BY x) AS sl, "
                 "SUM(n) OVER (PARTITION BY name) AS n, SUM(s) OVER (PARTITION BY name) AS s FROM cells"),
         ("best", "SELECT name, x, sl / nl AS ml, (s - sl) / (n - nl) AS mr FROM cum WHERE nl < n "
                  "ORDER BY CAST(sl AS DOUBLE) * sl / nl + CAST(s - sl AS DOUBLE) * (s - sl) / (n - nl) DESC LIMIT 1"),
         ("told", "SELECT t.count, CASE WHEN (CASE b.name WHEN 'lat' THEN lat WHEN 'long' THEN long WHEN 'year' THEN year ELSE code END) <= b.x "
                  "THEN b.ml ELSE b.mr END AS prediction FROM train t, best b")]),
    "ordered_summary": W(["v1"], f"SELECT *, row_number() OVER (ORDER BY city, crime_type, year) AS position FROM "
                                 f"(SELECT city, crime_type, year, {SUM_COUNT} FROM v1 GROUP BY city, crime_type, year) AS y"),
    "case_insensitive_names": W(["loc"], f"SELECT loc_id, {R6('lat')} AS lat, {R6('long')} AS long FROM loc WHERE lat > 49.1"),
    "content_key_differing": W(["v1"], "SELECT content, COUNT(*) AS n, CAST(0 AS BIGINT) AS first, COUNT(*) - 1 AS last, COUNT(*) AS n_keys FROM "
                                       "(SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE crime_type || '-' || l_partkey END AS content FROM v1) AS c GROUP BY content"),
    "rmse_metric": W(["v1"], "SELECT " + R6("sqrt(avg((CAST(count AS DOUBLE) * 0.5 + 3.0 - CAST(count AS DOUBLE)) * "
                                            "(CAST(count AS DOUBLE) * 0.5 + 3.0 - CAST(count AS DOUBLE))))")
                     + " AS rmse, COUNT(*) AS n FROM v1"),
    "key_split": W(["v1"], "SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_orderkey % 100 < 60 "
                           "THEN 'train' ELSE 'validation' END AS split FROM v1"),
    "content_key_occurrence": W(
        ["v1"], "SELECT city, crime_type, crimesub_type, neighbourhood, year, month, hour, count, "
                "CAST(row_number() OVER (PARTITION BY city, crime_type, crimesub_type, neighbourhood, year, month, "
                "hour, count) - 1 AS INTEGER) AS occurrence FROM v1"),
    "upsert_by_key": W(
        ["v1"],
        "SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.l_orderkey = old.l_orderkey AND "
        "nw.l_partkey = old.l_partkey AND nw.l_suppkey = old.l_suppkey) UNION ALL SELECT * FROM nw",
        [("vv", "SELECT l_orderkey, l_partkey, l_suppkey, year, count FROM v1"),
         ("old", "SELECT * FROM vv WHERE year <= 1998"),
         ("nw0", "SELECT l_orderkey, l_partkey, l_suppkey, year, count * 2 AS count FROM vv WHERE year >= 1997"),
         # a keyed store holds one row per key: the greatest (year, count) wins
         ("nw", "SELECT DISTINCT ON (l_orderkey, l_partkey, l_suppkey) * FROM nw0 "
                "ORDER BY l_orderkey, l_partkey, l_suppkey, year DESC, count DESC")]),
    "feed_vancouver": _feed(_feed_vancouver),
    "feed_calgary": _feed(_feed_calgary),
    "feed_calgary_rejects": W(["v2", "loc", "tm_ev"],
                              "SELECT 'Calgary' AS city, crimesub_type, COUNT(*) AS count FROM cal_raw "
                              "LEFT JOIN tm_ev t ON crimesub_type = t.sub_type WHERE t.type IS NULL "
                              "GROUP BY crimesub_type", _calgary_raw()),
    "feed_toronto": _feed(_feed_toronto),
    "feed_socrata": _feed(_feed_socrata),
    "feed_socrata_rejects": W(["v2", "loc", "tm_ev"],
                              "SELECT 'unmapped_type' AS reason, crimesub_type, CAST(COUNT(*) AS BIGINT) AS count FROM v2 "
                              "JOIN loc ON c_custkey = loc_id LEFT JOIN tm_ev t ON crimesub_type = t.sub_type "
                              "WHERE t.type IS NULL GROUP BY crimesub_type"),
    "type_map_csv": "SELECT p_partkey, p_type AS crimesub_type, 'T ' || p_type AS crime_type FROM part",
    "catalog_merge": _socrata_cities("SELECT * FROM inc"),
    "catalog_city_reload": _socrata_cities("SELECT * FROM inc WHERE city IS DISTINCT FROM '007' OR month <= 6"),
    "summaries_incremental": _socrata_cities(f"SELECT city, crime_type, year, {SUM_COUNT} FROM inc "
                                             f"GROUP BY city, crime_type, year"),
    "stored_by_type": _socrata_cities(f"SELECT crime_type, {SUM_COUNT} FROM inc WHERE {V2_YEARS} GROUP BY crime_type"),
    "stored_by_hour": _socrata_cities(f"SELECT year, hour, {SUM_COUNT} FROM inc WHERE city NOT IN ('007') AND {V2_YEARS} GROUP BY year, hour"),
    "stored_daylight": _socrata_cities(f"SELECT city, crime_type, {DAYLIGHT} AS daylight, {SUM_COUNT} FROM inc "
                                       "WHERE city NOT IN ('NATION_4') GROUP BY city, crime_type, daylight"),
    "stored_season": _socrata_cities(
        f"SELECT city, crime_type, {SEASON} AS seasons, {R4('AVG(total)')} AS avgsum FROM (SELECT city, crime_type, month, "
        f"CAST(SUM(count) AS BIGINT) AS total FROM inc WHERE {V2_YEARS} GROUP BY city, crime_type, month) AS m GROUP BY city, crime_type, seasons"),
    "feed_edmonton": _feed(_feed_edmonton),
    "feed_edmonton_rejects": W(
        ["g", "r", "tm_pa"],
        "SELECT reason, crimesub_type, CAST(SUM(count) AS BIGINT) AS count FROM rej GROUP BY reason, crimesub_type",
        _edmonton_ctes() + [("rej", "SELECT 'unmapped_type' AS reason, crimesub_type, count FROM edm_e "
                                    "LEFT JOIN tm_pa t ON crimesub_type = t.sub_type "
                                    "WHERE (lat <> 0 AND long <> 0) AND t.type IS NULL "
                                    "UNION ALL SELECT 'no_location' AS reason, crimesub_type, count FROM edm_e "
                                    "WHERE NOT COALESCE(lat <> 0 AND long <> 0, false)")]),
    "union_feeds": _union(lambda u: u),
    "incidents_summary_yoy": _union(lambda u: f"SELECT city, crime_type, year, {SUM_COUNT} FROM ({u}) AS inc "
                                              f"GROUP BY city, crime_type, year"),
}
