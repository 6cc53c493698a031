"""Versioned models: a pinned read, parallel saves, and ordered output."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from blotter.operators import model as M
from blotter.sources.ordered import read_ordered, write_ordered


def _model(df, n):
    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, {n} AS prediction FROM __THIS__")]).fit(df)


def _says(model, df):
    return model.transform(df).first()["prediction"]


def test_scoring_while_a_model_is_saved(spark, tmp_path, monkeypatch):
    df, path = spark.range(1), str(tmp_path / "m")
    assert M.save_model(_model(df, 1), path) == 1
    seen = []
    commit = M.CommitLog.commit

    def before_commit(self, change):
        seen.append(_says(M.load_model(path), df))     # the new model is written, not yet committed
        return commit(self, change)
    monkeypatch.setattr(M.CommitLog, "commit", before_commit)
    assert M.save_model(_model(df, 2), path, rmse=0.5) == 2
    assert seen == [1] and _says(M.load_model(path), df) == 2 and _says(M.load_model(path, 1), df) == 1


def test_two_saves_at_the_same_time_are_two_versions(spark, tmp_path):
    df, path = spark.range(1), str(tmp_path / "m")
    with ThreadPoolExecutor(3) as pool:
        versions = [f.result() for f in [pool.submit(M.save_model, _model(df, n), path) for n in (1, 2, 3)]]
    assert sorted(versions) == [1, 2, 3]
    assert {_says(M.load_model(path, v), df) for v in versions} == {1, 2, 3}


def test_plain_model_folder_is_read(spark, tmp_path):
    df = spark.range(1)
    _model(df, 4).write().save(str(tmp_path / "plain"))
    assert isinstance(M.load_model(str(tmp_path / "plain")), PipelineModel)


def test_ordered_files(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df, str(tmp_path / "o"), "g", F.desc("k"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "o").glob("part-*.parquet"))) > 2
    got = [(r["g"], r["k"]) for r in sorted(read_ordered(spark, str(tmp_path / "o")).collect(), key=lambda r: r["position"])]
    want = sorted(((r["g"], r["k"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert got == want
    assert sorted(r["position"] for r in read_ordered(spark, str(tmp_path / "o")).collect()) == list(range(1, 5001))
    write_ordered(df.limit(0), str(tmp_path / "none"), "k")
    assert read_ordered(spark, str(tmp_path / "none")).count() == 0
