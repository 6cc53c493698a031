"""Model chain: no oracle; fit on a small deterministic table, check shapes,
save/load, RMSE formula and the scoring grid."""

import pytest
from pyspark.sql import functions as F

from blotter.lookups import CRIME_CODE_ROWS, SCORE_CODES, code_table_df
from blotter.operators import model as M


@pytest.fixture(scope="module")
def incidents(spark):
    rows = []
    types = [t for _, t in CRIME_CODE_ROWS]
    for i in range(400):
        rows.append((types[i % len(types)], 49.0 + (i % 20) * 0.01, -123.0 - (i % 17) * 0.01,
                     2014 + i % 6, 1 + (i * 7) % 5))
    rows += [("Assault", None, -123.0, 2015, 1), ("Assault", 0.0, 0.0, 2015, 1), ("Nope", 49.1, -123.1, 2015, 1)]
    return spark.createDataFrame(rows, "crime_type string, lat double, long double, year int, count int")


def test_features_filters_and_codes(spark, incidents):
    f = M.training_features(incidents, code_table_df(spark))
    assert f.columns == ["uuid", "lat", "long", "year", "code", "count"]
    assert f.count() == 400
    assert f.select("uuid").distinct().count() == 400
    fc = M.training_features(incidents, code_table_df(spark), key="content")
    assert fc.select("uuid").distinct().count() == 400


def test_fit_score_save_load(spark, incidents, tmp_path):
    f = M.training_features(incidents, code_table_df(spark))
    train, val = M.content_split(f, 60)
    assert train.count() + val.count() == 400
    model = M.fit(train, max_iter=5)
    pred = model.transform(val)
    r1 = M.evaluate_rmse(pred)
    r2 = M.rmse_frame(pred).first()["rmse"]
    assert r1 == pytest.approx(r2, rel=1e-9)
    path = str(tmp_path / "model")
    M.save_model(model, path)
    again = M.load_model(path).transform(val)
    a = sorted(r[0] for r in pred.select("prediction").collect())
    b = sorted(r[0] for r in again.select("prediction").collect())
    assert a == b
    locs = spark.createDataFrame([(1, "1 Main St, Vancouver, BC", 49.2827, -123.1207),
                                  (2, "Main St, Springfield", 40.0, -89.0)],
                                 "loc_id int, address string, lat double, long double")
    gated = M.gate_locations(locs)
    assert [r["supported"] for r in gated.orderBy("loc_id").collect()] == [True, False]
    rows = [r for r in CRIME_CODE_ROWS if r[0] in SCORE_CODES]
    scored = M.score_locations(gated.filter("supported"), model, rows)
    out = scored.collect()
    assert len(out) == 13 and {r["year"] for r in out} == {2020}
    assert all(isinstance(r["predictions"], int) for r in out)


def test_grid_shape(spark):
    locs = spark.createDataFrame([(1, 49.2827, -123.1207)], "loc_id int, lat double, long double")
    g = M.neighbourhood_grid(locs)
    pts = sorted((r["lat"], r["long"]) for r in g.collect())
    assert len(pts) == 20
    assert (49.284, -123.12) in pts and (49.273, -123.131) in pts      # exact decimal steps
    assert (49.283, -123.121) not in pts                  # the centre is not scored
    rows = [r for r in CRIME_CODE_ROWS if r[0] in SCORE_CODES]
    assert M.with_codes(g, rows).count() == 20 * 13


def test_split_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = M.key_split(df, "k", 60)[0].select("k")
    b = M.key_split(df.repartition(7), "k", 60)[0].select("k")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    n = a.count()
    assert 500 < n < 700


def test_fit_is_partitioning_independent(spark, incidents):
    f = M.training_features(incidents, code_table_df(spark))
    m1 = M.fit(f.repartition(3), max_iter=4)
    m2 = M.fit(f.repartition(7).orderBy(F.rand(3)), max_iter=4)
    a = sorted(r[0] for r in m1.transform(f).select("prediction").collect())
    b = sorted(r[0] for r in m2.transform(f).select("prediction").collect())
    assert a == b


def test_pipeline_stages_and_parameters(spark):
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    stages = M.build_pipeline().getStages()
    assert [type(s) for s in stages] == [SQLTransformer, VectorAssembler, GBTRegressor]
    assert stages[0].getStatement() == "select * from __THIS__"
    assert stages[1].getInputCols() == ["lat", "long", "year", "code"]
    assert stages[1].getHandleInvalid() == "skip"
    g = stages[2]
    assert (g.getMaxDepth(), g.getMaxIter(), g.getSeed(), g.getStepSize(), g.getLabelCol()) == (5, 100, 50, 0.1, "count")


def test_case_insensitive_columns_in_scoring(spark):
    # locations arriving with capitalised Lat / Long resolve to lat / long
    locs = spark.createDataFrame([(1, 49.2827, -123.1207)], "loc_id int, Lat double, Long double")
    g = M.neighbourhood_grid(locs.select("loc_id", "lat", "long"))
    assert g.columns == ["loc_id", "lat", "long"] and g.count() == 20


def test_content_split_is_deterministic(spark, incidents):
    a = M.training_features(incidents, code_table_df(spark))
    b = M.training_features(incidents.repartition(5), code_table_df(spark))
    ta = sorted(tuple(r) for r in M.content_split(a, 60)[0].drop("uuid").collect())
    tb = sorted(tuple(r) for r in M.content_split(b, 60)[0].drop("uuid").collect())
    assert ta == tb and 0 < len(ta) < 400


def test_weighted_fit_collapses_duplicates(spark, incidents):
    f = M.training_features(incidents, code_table_df(spark), key="none")
    dup = f.unionByName(f).unionByName(f)                  # every row three times
    per_row = M.fit(dup, max_iter=5)
    weighted = M.fit(dup, max_iter=5, weighted=True)
    r1 = M.rmse_frame(per_row.transform(f)).first()["rmse"]
    r2 = M.rmse_frame(weighted.transform(f)).first()["rmse"]
    assert abs(r1 - r2) <= 0.2 * max(r1, r2) + 1e-9


def test_fit_layout_follows_the_rows(spark, incidents, monkeypatch):
    """The fit has as many partitions as its rows fill, at most those of the session."""
    seen = []

    class Estimator:
        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.count()))
    monkeypatch.setattr(M, "build_pipeline", lambda **params: Estimator())
    f = M.training_features(incidents, code_table_df(spark), key="none")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        M.fit(f)
        monkeypatch.setattr(M, "FIT_ROWS", 30)
        M.fit(f)
        M.fit(f, partitions=3)
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        M.fit(f)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert seen == [(8, 400), (14, 400), (3, 400), (5, 400)]


def test_scoring_deals_the_locations_out(spark, monkeypatch):
    """Locations of one partition are scored in tasks of SCORE_ROWS, not in one."""
    parts = []

    class Model:
        def transform(self, df):
            parts.append(df.rdd.getNumPartitions())
            return df.withColumn("prediction", F.col("code") * 10 + F.col("lat"))
    monkeypatch.setattr(M, "SCORE_ROWS", 10)
    locs = spark.createDataFrame([(i % 40, 10.0 + i % 40, -20.0) for i in range(95)], "loc_id int, lat double, long double").coalesce(1)
    out = M.score_locations(locs, Model(), [(1, "a"), (2, "b")], steps=3)
    assert sorted((r.loc_id, r.type, r.predictions) for r in out.collect()) == sorted((i, t, 10 * c + 10 + i) for i in range(40) for c, t in ((1, "a"), (2, "b")))
    assert parts == [10]
    assert M.score_locations(locs.where("false"), Model(), [(1, "a")]).count() == 0


def many_incidents(spark, n, label="cast(1 + pmod(hash(id, 2), 9) + id % 5 as int)"):
    """``n`` rows of features, many of which share their bins."""
    return spark.range(n).selectExpr("49 + pmod(hash(id), 4001) * 0.0003 as lat", "-123 - pmod(hash(id, 1), 3001) * 0.0007 as long",
                                     "cast(2014 + id % 6 as int) as year", "cast(id % 5 as int) as code", f"{label} as count")


def plain_pipeline(**params):
    """MLlib's own pipeline of the same stages, fitted on the rows."""
    from pyspark.ml import Pipeline
    return Pipeline(stages=BUILD(**params).getStages())


BUILD = M.build_pipeline


def test_rounds_run_over_cells(spark, monkeypatch):
    """MLlib's rounds are given the cells of features and labels, however many rows there are; of many labels two a cell."""
    from pyspark.ml.regression import GBTRegressor

    from blotter.operators import cells as C
    given, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, df, *a: given.append(df.count()) or fit(self, df, *a))
    f = many_incidents(spark, 60_000).withColumns({"lat": F.round("lat", 1), "long": F.round("long", 1), "year": F.lit(2014)})
    M.fit(f, max_iter=2)
    assert 0 < given[0] <= f.select(*M.FEATURES, "count").distinct().count() < 25_000
    monkeypatch.setattr(C, "MOST_CELLS", 100)
    M.fit(f, max_iter=2)
    assert 0 < given[1] <= 2 * f.select(*M.FEATURES).distinct().count() < 5_000 and given[1] < given[0]


@pytest.mark.parametrize("label", ["cast(1 + pmod(hash(id, 2), 9) + id % 5 as int)", "pmod(hash(id, 2), 1000) / 7.0"])
def test_cells_give_the_trees_of_the_rows(spark, monkeypatch, label):
    from blotter.operators import cells as C
    f = many_incidents(spark, 30_000, label)                 # more than MLlib samples for its cut points
    for weighted, most in ((False, C.MOST_CELLS), (True, 100)):
        monkeypatch.setattr(C, "MOST_CELLS", most)
        monkeypatch.setattr(M, "build_pipeline", BUILD)
        of_cells = M.fit(f, max_iter=5, weighted=weighted)
        monkeypatch.setattr(M, "build_pipeline", plain_pipeline)
        of_rows = M.fit(f, max_iter=5, weighted=weighted)
        assert [type(s) for s in of_cells.stages] == [type(s) for s in of_rows.stages]
        a, b = (m.transform(f).orderBy(*M.FEATURES, "count").select(*M.FEATURES, "count", "prediction").collect() for m in (of_cells, of_rows))
        assert len(a) == 30_000 and [r[:5] for r in a] == [r[:5] for r in b]
        assert max(abs(x["prediction"] - y["prediction"]) for x, y in zip(a, b)) < 1e-9
        trees = [[x for x in m.stages[-1].toDebugString.splitlines() if "If" in x or "Else" in x] for m in (of_cells, of_rows)]
        assert trees[0] == trees[1] and len(trees[0]) > 100


def test_scoring_looks_cells_up(spark, monkeypatch, tmp_path):
    """Each row is told what the model tells it: values on a cut, between, outside, null, NaN."""
    from blotter.operators import cells as C
    model = M.fit(many_incidents(spark, 3_000), max_iter=5)
    cuts = C.thresholds(model.stages[-1], 4)
    edge = [(t, u, 2014 + i % 8, i % 7) for i, (t, u) in enumerate(zip(cuts[0] * 2, cuts[1] * 2))]
    odd = [(0.0, -0.0, 2016, 1), (-90.0, 180.0, 1900, -3), (float("inf"), float("-inf"), 3000, 99), (None, -123.0, 2015, 1),
           (float("nan"), -123.0, 2015, 1), (49.1, None, 2015, 1), (49.1, -123.1, None, 1), (49.1, -123.1, 2015, None)]
    rows = spark.createDataFrame(edge + odd, "lat double, long double, year int, code int").withColumn("id", F.monotonically_increasing_id())
    rows = rows.unionByName(many_incidents(spark, 500).drop("count").withColumn("id", F.lit(-1).cast("long")))
    M.save_model(model, str(tmp_path / "m"))

    def told(df):
        return sorted(map(tuple, df.select("id", "lat", "long", "year", "code", "prediction").collect()))
    want, asked = told(model.transform(rows)), []
    assert len(want) == len(edge) + 3 + 500
    for m in (model, M.load_model(str(tmp_path / "m"))):
        monkeypatch.setattr(type(m), "transform", lambda self, df, real=type(m).transform: asked.append(df.columns) or real(self, df))
        assert told(C.predicted(m, rows)) == want
        monkeypatch.undo()
    assert asked and all("__cell" in columns for columns in asked)
    monkeypatch.setattr(C, "MOST_CELLS", 5)                    # too many cells: row by row
    assert told(C.predicted(model, rows)) == want
