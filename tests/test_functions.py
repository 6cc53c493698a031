import math

from pyspark.sql import functions as F

from blotter import functions as X


def test_utm_sample_point(spark):
    df = spark.createDataFrame([(491000.0, 5459000.0)], "E double, N double")
    r = X.with_utm_latlon(df, "E", "N").first()
    assert round(r["lat"], 6) == 49.283686
    assert round(r["long"], 6) == -123.123752


def test_utm_round_trip_against_forward_projection(spark):
    # forward transverse Mercator (Krueger series) as an independent check
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    A = a / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    al = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    e = math.sqrt(f * (2 - f))

    def forward(lat, lon):
        phi, lam = math.radians(lat), math.radians(lon - (-123.0))
        t = math.sinh(math.atanh(math.sin(phi)) - 2 * math.sqrt(n) / (1 + n) * math.atanh(
            2 * math.sqrt(n) / (1 + n) * math.sin(phi)))
        xi, eta = math.atan(t / math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
        E = 500000 + 0.9996 * A * (eta + sum(al[j] * math.cos(2 * (j + 1) * xi) * math.sinh(2 * (j + 1) * eta)
                                             for j in range(3)))
        N = 0.9996 * A * (xi + sum(al[j] * math.sin(2 * (j + 1) * xi) * math.cosh(2 * (j + 1) * eta)
                                   for j in range(3)))
        return E, N

    pts = [(49.0 + i * 0.05, -123.3 + j * 0.04) for i in range(12) for j in range(10)]
    rows = [(lat, lon) + forward(lat, lon) for lat, lon in pts]
    assert e > 0
    df = spark.createDataFrame(rows, "lat0 double, lon0 double, E double, N double")
    out = X.with_utm_latlon(df, "E", "N").collect()
    worst = max(max(abs(r["lat"] - r["lat0"]), abs(r["long"] - r["lon0"])) for r in out)
    assert worst < 1e-8
    # southern hemisphere, same zone: false northing of 10,000,000 m
    south = [(-33.0 - i * 0.05, -123.3 + j * 0.04) for i in range(6) for j in range(5)]
    srows = [(lat, lon, E, N + 10000000.0) for lat, lon in south for E, N in [forward(lat, lon)]]
    sdf = spark.createDataFrame(srows, "lat0 double, lon0 double, E double, N double")
    sout = X.with_utm_latlon(sdf, "E", "N", northern=False,
                             located=F.col("E") > 0).collect()
    worst = max(max(abs(r["lat"] - r["lat0"]), abs(r["long"] - r["lon0"])) for r in sout)
    assert worst < 1e-8


def test_utm_non_positive_is_null(spark):
    df = spark.createDataFrame([(0.0, 5459000.0), (-5.0, -1.0)], "E double, N double")
    assert all(r["lat"] is None and r["long"] is None for r in X.with_utm_latlon(df, "E", "N").collect())


def test_month_number(spark):
    df = spark.createDataFrame([("September",), ("January",), ("bogus",), (None,)], "m string")
    assert [r[0] for r in df.select(X.month_number("m")).collect()] == [9, 1, None, None]


def test_daylight_edges_and_null(spark):
    df = spark.createDataFrame([(5,), (6,), (18,), (19,), (None,)], "h int")
    assert [r[0] for r in df.select(X.daylight("h")).collect()] == ["night", "day", "day", "night", "night"]
    assert df.select(X.daylight("h", unknown="unknown")).collect()[-1][0] == "unknown"


def test_season_edges_and_null(spark):
    months = [2, 3, 5, 6, 8, 9, 11, 12, None]
    df = spark.createDataFrame([(m,) for m in months], "m int")
    got = [r[0] for r in df.select(X.season("m")).collect()]
    assert got == ["Winter", "Spring", "Spring", "Summer", "Summer", "Fall", "Fall", "Winter", "Fall"]


def test_iso_parts_and_bad_casts(spark):
    df = spark.createDataFrame([("2017-12-31T23:10:00.000", "45.42", "23"), ("not a date", "abc", "x")],
                               "d string, lat string, h string")
    r = df.select(X.year_of("d"), X.month_of("d"), X.hour_of("d"), X.safe_cast("lat", "double"),
                  X.safe_cast("h", "int")).collect()
    assert tuple(r[0]) == (2017, 12, 23, 45.42, 23)
    assert tuple(r[1]) == (None, None, None, None, None)


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.00005,), (49.12345,)], "x double")
    got = [r[0] for r in df.select(X.round_half_up("x", 0)).collect()]
    assert got[:2] == [3.0, -3.0]
    assert df.select(X.round_half_up("x", 4)).collect()[3][0] == 49.1235


def test_predicates_three_valued(spark):
    rows = [(None, 1.0), (0.0, 0.0), (53.5, 0.0), (53.5, -113.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    f3 = [r[0] for r in df.select(X.kept(X.not_both_zero("lat", "lon"))).collect()]
    f4 = [r[0] for r in df.select(X.kept(X.neither_zero("lat", "lon"))).collect()]
    assert f3 == [True, False, True, True]
    assert f4 == [False, False, False, True]


def test_contains_any_is_case_sensitive_substring(spark):
    df = spark.createDataFrame([("12 Main St, Vancouver, BC",), ("vancouver",), ("Surrey",)], "a string")
    got = [r[0] for r in df.select(X.contains_any("a", ["Vancouver", "Ottawa"])).collect()]
    assert got == [True, False, False]


def test_content_hash_null_safe(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a")], "x string, y string")
    hs = [r[0] for r in df.select(X.content_hash("x", "y")).collect()]
    assert len(set(hs)) == 3


def test_locality_concat_null(spark):
    df = spark.createDataFrame([("Downtown",), (None,)], "n string")
    assert [r[0] for r in df.select(X.locality("n")).collect()] == ["Downtown, Edmonton, Canada", None]
