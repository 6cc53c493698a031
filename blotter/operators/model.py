"""Features, split, GBT pipeline, evaluation and location scoring.

Training is MLlib's distributed GBT, on counted cells of the rows (:mod:`.cells`);
the driver only steers iterations.
Long iteration lineage is cut with checkpoints in the session's shared
``spark.checkpoint.dir`` (``checkpointInterval``).
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import contains_any, has_lat, not_both_zero, round_half_up
from ..lookups import SCORE_YEAR, SUPPORTED_CITIES
from ..session import ensure_checkpoint_dir
from ..sources.commits import CommitLog
from .cells import SAME_ROWS, CellPipeline, predicted
from .joins import lookup_side, unique_lookup
from .keys import numbered_rows, with_content_key, with_random_key

FEATURES = ["lat", "long", "year", "code"]
FIT_ROWS, FIT_PARTS = 100_000, 8   # rows of a partition of the fit, and its least partitions
SCORE_ROWS = 10_000      # locations that one task scores


# ---- M1: feature table -------------------------------------------------------

def training_features(incidents: DataFrame, codes: DataFrame, digits: int = 4,
                      key: str = "random", broadcast: str = "planner") -> DataFrame:
    """(uuid, lat, long, year, code, count) from located, coded incidents.

    ``uuid`` is a row key for a table that is rebuilt whole, so the default
    is a random v4 UUID (no shuffle); ``key="content"`` gives idempotent
    content keys. Neither is needed for a deterministic split or fit, which
    hash the feature values (:func:`content_split_label`).

    Coordinates are rounded to ``digits``; null latitude and (0, 0) rows are
    dropped; the type -> code join is an inner join against the broadcast
    code table (policy ``broadcast``, see :func:`joins.lookup_side`).
    """
    df = (incidents
          .withColumn("lat", round_half_up(F.col("lat").cast("double"), digits))
          .withColumn("long", round_half_up(F.col("long").cast("double"), digits))
          .filter(has_lat("lat"))
          .filter(not_both_zero("lat", "long"))
          .select("lat", "long", "year", "crime_type", "count"))
    c = codes.select("code", "type_crime")
    c = lookup_side(c if broadcast == "fixed" else unique_lookup(c, "type_crime"), broadcast)
    out = df.join(c, df["crime_type"] == c["type_crime"], "inner").select("lat", "long", "year", "code", "count")
    if key == "content":
        out = with_content_key(out)
    elif key == "random":
        out = with_random_key(out)
    cols = (["uuid"] if key != "none" else []) + ["lat", "long", "year", "code", "count"]
    return out.select(*cols)


# ---- M2: deterministic split -------------------------------------------------

def split_label(key: str, train_pct: int = 60, hashed: bool = True) -> F.Column:
    """'train' / 'validation' from a key, independent of partitioning.

    ``hashed`` buckets ``xxhash64(key)``; otherwise an integral key is
    bucketed as is (``key mod 100``).
    """
    bucket = F.pmod(F.xxhash64(F.col(key)) if hashed else F.col(key), F.lit(100))
    return F.when(bucket < train_pct, F.lit("train")).otherwise(F.lit("validation"))


def key_split(df: DataFrame, key: str, train_pct: int = 60, hashed: bool = True):
    lab = split_label(key, train_pct, hashed)
    return df.filter(lab == "train"), df.filter(lab == "validation")


def content_hash_col(cols: list[str]) -> F.Column:
    """64-bit hash of the given columns' values (null-aware)."""
    args = []
    for c in cols:
        args += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*args)


SPLIT_DIGITS = 6     # decimals of a number that its canonical text holds


def canonical_text(schema: T.StructType, cols: list[str]) -> F.Column:
    """A row's values as text that any engine can write: fractions as whole numbers
    of millionths, null as ``-``, all joined by ``|``."""
    parts = []
    for c in cols:
        v, kind = F.col(f"`{c}`"), schema[c].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            v = (F.round(v.try_cast("decimal(28,8)"), SPLIT_DIGITS) * 10 ** SPLIT_DIGITS).cast("bigint")
        parts.append(F.coalesce(v.cast("string"), F.lit("-")))
    return F.concat_ws("|", *parts)


def content_split_label(schema: T.StructType, cols: list[str], train_pct: int = 60) -> F.Column:
    """'train' / 'validation' from the first eight hex digits of the MD5 of the row's
    canonical text: the same data always splits the same way, in any engine, with no
    key, shuffle or partition dependence (identical rows go to the same side)."""
    digits = F.conv(F.substring(F.md5(canonical_text(schema, cols).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.when(digits % 100 < train_pct, F.lit("train")).otherwise(F.lit("validation"))


def content_split(df: DataFrame, train_pct: int = 60, label: str = "count"):
    lab = content_split_label(df.schema, FEATURES + [label], train_pct)
    return df.filter(lab == "train"), df.filter(lab == "validation")


# ---- M3-M6: pipeline ----------------------------------------------------------

def build_pipeline(max_depth: int = 5, max_iter: int = 100, seed: int = 50, step_size: float = 0.1,
                   label: str = "count", checkpoint_interval: int = 10,
                   weight_col: str | None = None) -> Pipeline:
    identity = SQLTransformer(statement=SAME_ROWS)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="input_features", handleInvalid="skip")
    gbt = GBTRegressor(featuresCol="input_features", labelCol=label, maxDepth=max_depth,
                       maxIter=max_iter, seed=seed, stepSize=step_size,
                       checkpointInterval=checkpoint_interval)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return CellPipeline(stages=[identity, assemble, gbt])


def fit(train: DataFrame, label: str = "count", deterministic: bool = True,
        partitions: int | None = None, weighted: bool = False, **params) -> PipelineModel:
    """Fit on rows with a label and complete features (GBT rejects null labels).

    With ``deterministic`` the rows get a fixed layout before the fit --
    hash-partitioned by their values and their number among equal rows and
    sorted within the partitions (identical rows are interchangeable) -- so the seeded
    split finding and boosting see the same data order on every run, whatever
    the upstream partitioning or row keys were. Unless ``partitions`` is given, there are
    as many partitions as the session shuffles into, but no more than the rows fill
    with ``FIT_ROWS`` each (``FIT_PARTS`` at least). The cut points of the bins come from
    these rows; the rounds, some 500 jobs of two stages, run over their cells.

    ``weighted`` (off by default) collapses identical (features, label) rows
    into one row weighted by their number -- a map-side-combined aggregate
    that can shrink the boosting input by orders of magnitude when many
    incidents share a block and year. The loss is the same as on the
    duplicated rows, but MLlib picks split thresholds from a sample of rows,
    so the model can differ slightly from the per-row fit.
    """
    clean = train.filter(F.col(label).isNotNull())
    for c in FEATURES:
        clean = clean.filter(F.col(c).isNotNull())
    if weighted:
        clean = clean.groupBy(*FEATURES, label).agg(F.count(F.lit(1)).cast("double").alias("__weight"))
        params["weight_col"] = "__weight"
    estimator = build_pipeline(label=label, **params)
    if not deterministic:
        return estimator.fit(clean)
    order = FEATURES + [label]
    rest = ["__weight"] if weighted else []
    ensure_checkpoint_dir(clean.sparkSession)
    clean = clean.select(*order, *rest).checkpoint(eager=True)   # the joins before it run once
    most = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or min(most, max(FIT_PARTS, -(-clean.count() // FIT_ROWS)))
    clean = numbered_rows(clean, "__occ")  # equal rows spread by their number
    clean = (clean.withColumn("__h", F.xxhash64(content_hash_col(order), "__occ"))
                  .repartition(n, "__h").sortWithinPartitions("__h", *order).drop("__h", "__occ"))
    clean.persist(StorageLevel.MEMORY_AND_DISK)   # MLlib reads its input several times before the first round
    try:
        return estimator.fit(clean)
    finally:
        clean.unpersist()


# ---- M7 / M8 / A9: predict and evaluate ---------------------------------------

def evaluate_rmse(predictions: DataFrame, label: str = "count", prediction: str = "prediction") -> float:
    return RegressionEvaluator(predictionCol=prediction, labelCol=label, metricName="rmse").evaluate(predictions)


def rmse_frame(df: DataFrame, label: str = "count", prediction: str = "prediction") -> DataFrame:
    """RMSE as a one-row DataFrame: sqrt(avg((p - l)^2)), plus the row count."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def _models(path: str) -> CommitLog:
    return CommitLog(SparkSession.active(), f"{path.rstrip('/')}/_commits")


def save_model(model: PipelineModel, path: str, **note) -> int:  # K4
    """Save as a new version under ``path``; it counts once its commit is published.

    Earlier versions stay, so a job that scores with one is not disturbed.
    """
    folder = f"{path.rstrip('/')}/models/{uuid.uuid4().hex}"
    model.write().save(folder)
    return _models(path).commit(lambda now: {"model": folder, "note": note})["version"]


def load_model(path: str, version: int | None = None) -> PipelineModel:   # S9
    """The newest committed version (or the one named); a plain model folder is read as it is."""
    log = _models(path)
    found = log.versions()
    if not found:
        return PipelineModel.load(path)
    return PipelineModel.load(log.read(version or found[-1])["model"])


# ---- G5 / G4 / M9: location scoring -------------------------------------------

def gate_locations(locations: DataFrame, address_col: str = "address",
                   cities=SUPPORTED_CITIES) -> DataFrame:
    """Adds ``supported``: the address names one of the cities.

    Rejected locations stay visible with ``supported = false``.
    """
    return locations.withColumn("supported", F.coalesce(contains_any(address_col, cities), F.lit(False)))


def neighbourhood_grid(locations: DataFrame, lat: str = "lat", long: str = "long", steps: int = 10,
                       step: str = "0.001", digits: int = 3) -> DataFrame:
    """``2*steps`` points on the diagonal through each location.

    The location is rounded to ``digits``; point k (k = -steps..steps, not 0)
    is (lat + k*step, long + k*step), computed in DECIMAL so that points
    are exact. One generator row per point: no join, no pairs.
    """
    ks = [k for k in range(-steps, steps + 1) if k != 0]
    st = F.lit(Decimal(step))
    base_lat = F.round(F.col(lat).cast("decimal(18,8)"), digits)
    base_long = F.round(F.col(long).cast("decimal(18,8)"), digits)
    return (locations
            .withColumn("__k", F.explode(F.array(*[F.lit(k) for k in ks])))
            .withColumn(lat, (base_lat + F.col("__k") * st).cast("double"))
            .withColumn(long, (base_long + F.col("__k") * st).cast("double"))
            .drop("__k"))


def with_codes(grid: DataFrame, code_rows: list[tuple[int, str]], year: int = SCORE_YEAR) -> DataFrame:
    """Every grid point once per scored code (J7), via a fixed generator."""
    codes = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(t).alias("type")) for c, t in code_rows])
    return (grid.withColumn("__c", F.explode(codes))
                .select("*", F.col("__c.code").alias("code"), F.col("__c.type").alias("type"))
                .drop("__c")
                .withColumn("year", F.lit(year)))


def score_locations(locations: DataFrame, model: PipelineModel, code_rows: list[tuple[int, str]],
                    id_col: str = "loc_id", year: int = SCORE_YEAR, steps: int = 10) -> DataFrame:
    """M9: mean prediction per (location, year, type), rounded to an int.

    Batch form of the per-request scorer: grid -> codes -> transform ->
    average (:func:`cells.predicted`). Each location contributes 2*steps*len(codes) rows, so the work
    is linear in the number of locations and no group is unbounded. Locations are
    dealt out evenly before they multiply, ``SCORE_ROWS`` a task: a file of them is
    small and would be one task, whose table of averages grows with the file.
    """
    places = locations.select(id_col, "lat", "long")
    places = places.repartition(max(1, -(-places.count() // SCORE_ROWS)))
    grid = with_codes(neighbourhood_grid(places, steps=steps), code_rows, year)
    scored = predicted(model, grid.select(id_col, "lat", "long", "year", "code", "type"))
    return (scored.groupBy(id_col, "year", "type")
                  .agg(F.round(F.avg("prediction"), 0).cast("int").alias("predictions")))
