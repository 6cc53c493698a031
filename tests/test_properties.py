"""Property tests: the five summaries against a plain-Python brute force on
random small incident tables (nulls, excluded cities, year edges)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter.operators import summaries as S

CITIES = [None, "Calgary", "Edmonton", "Ottawa", "Toronto"]
TYPES = [None, "Assault", "Robbery"]
row = st.tuples(st.sampled_from(CITIES), st.sampled_from(TYPES),
                st.one_of(st.none(), st.integers(2012, 2021)),
                st.one_of(st.none(), st.integers(1, 12)),
                st.one_of(st.none(), st.integers(0, 23)),
                st.one_of(st.none(), st.integers(0, 5)))
SCHEMA = "city string, crime_type string, year int, month int, hour int, count int"


def _in_years(y):
    return y is not None and 2013 < y <= 2019


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) if vals else None


def _season(m):
    return {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
            6: "Summer", 7: "Summer", 8: "Summer"}.get(m, "Fall")


def brute(rows):
    yoy, typ, hr, dl, mon = (defaultdict(list) for _ in range(5))
    for city, t, y, m, h, c in rows:
        yoy[(city, t, y)].append(c)
        if _in_years(y):
            typ[t].append(c)
            mon[(city, t, m)].append(c)
            if city is not None and city not in ("Calgary", "Edmonton"):
                hr[(y, h)].append(c)
        if city is not None and city != "Edmonton":
            dl[(city, t, "day" if h is not None and 6 <= h <= 18 else "night")].append(c)
    ss = defaultdict(list)
    for (city, t, m), cs in mon.items():
        ss[(city, t, _season(m))].append(_sum(cs))
    avg = {k: (sum(x for x in v if x is not None) / len([x for x in v if x is not None])
               if any(x is not None for x in v) else None) for k, v in ss.items()}
    return {
        "crimes_yoy": {k + (_sum(v),) for k, v in yoy.items()},
        "crimes_typ": {(k, _sum(v)) for k, v in typ.items()},
        "crimes_hr": {k + (_sum(v),) for k, v in hr.items()},
        "crimes_dl": {k + (_sum(v),) for k, v in dl.items()},
        "crimes_ss": {k + (None if v is None else round(v, 9),) for k, v in avg.items()},
    }


@settings(max_examples=15, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=40))
def test_summaries_match_brute_force(spark, rows):
    inc = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    direct = {"crimes_yoy": S.summary_yoy(inc), "crimes_typ": S.summary_by_type(inc),
              "crimes_hr": S.summary_by_hour(inc), "crimes_dl": S.summary_daylight(inc),
              "crimes_ss": S.summary_season(inc)}
    via_cube = S.all_summaries(inc)
    for name, df in direct.items():
        for got_df in (df, via_cube[name]):
            got = {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in got_df.collect()}
            assert got == want[name], name
