"""Boosted trees fitted on counted cells of rows instead of on the rows (M5, M6).

MLlib cuts each feature into ``maxBins`` bins once before the first round; from then
on it sees a row only through its bins, so rows of equal bins (a cell) end in the same
leaf of every tree. A fit of 100 rounds passes over its input some 600 times, so rows
of equal bins and label are given to it as one, weighted by their number: sums of counts
and of whole labels are exact, others round in another order.

Labels of many values (weighted rows beyond ``MOST_CELLS``) are counted further: with
squared loss the residuals are linear in the label and variances are made of count, sum
and sum of squares, so of a cell's labels nothing else counts. Two labels with half of
the cell's weight each, one standard deviation below and above its mean, have the same.
Cells are at most ``maxBins`` to the power of the features, however many rows.

The cut points are MLlib's own, from all rows in the order given; the model has
them as thresholds and is an ordinary pipeline model.

The same holds for scoring: values between two neighbouring thresholds of a feature
meet the same leaves, so a model tells one row of each cell, and rows look theirs up.
"""

from __future__ import annotations

import math
import re

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import fixed_broadcast

SAME_ROWS = "select * from __THIS__"
CELL_ROWS = 25_000       # weighted rows of a partition
MOST_CELLS = 1 << 20     # weighted rows of a cell and a label each; cells that rows to be scored are looked up in (32 bins of 4 features)


def _module(name: str):
    """A Scala object of MLlib."""
    package, _, name = f"org.apache.spark.{name}".rpartition(".")
    at = SparkContext._active_spark_context._jvm
    for part in package.split("."):
        at = getattr(at, part)
    return getattr(getattr(at, f"{name}$"), "MODULE$")


def _takes_cells(gbt: GBTRegressor, categorical) -> bool:
    """Whether nothing but count, sum and sum of squares of a cell's labels decides the fit."""
    return (gbt.getLossType() == "squared" and gbt.getSubsamplingRate() == 1.0 and gbt.getMinInstancesPerNode() == 1
            and gbt.getMinWeightFractionPerNode() == 0.0 and not gbt.isSet(gbt.validationIndicatorCol) and categorical.isEmpty())


def _cut_points(gbt: GBTRegressor, rows: DataFrame, categorical) -> list[list[float]]:
    """The thresholds between the bins of each feature, as MLlib finds them in ``rows``."""
    java, extract, forest = gbt._java_obj, _module("ml.util.DatasetUtils"), _module("ml.tree.impl.RandomForest")
    instances = extract.extractInstances(java, rows._jdf, getattr(extract, "extractInstances$default$3")())
    algo = _module("mllib.tree.configuration.Algo").Regression()
    strategy = java.getOldBoostingStrategy(categorical, algo).treeStrategy()
    metadata = _module("ml.tree.impl.DecisionTreeMetadata").buildMetadata(instances, strategy, 1, gbt.getFeatureSubsetStrategy())
    return [[s.threshold() for s in feature] for feature in forest.findSplits(instances, metadata, gbt.getSeed())]


def with_bins(rows: DataFrame, features: list[str], cuts: list[list[float]]) -> DataFrame:
    """``rows`` plus the number of the bin of each feature, from 1, in ``__bin<i>``; a value equal to a cut is below it."""
    cut = [i for i, at in enumerate(cuts) if at]
    if cut:
        values = {f"__value{i}": F.col(f"`{features[i]}`").cast("double") for i in cut}
        ends = [[-math.inf, *(math.nextafter(t, math.inf) for t in cuts[i]), math.inf] for i in cut]
        rows = Bucketizer(splitsArray=ends, inputCols=[*values], outputCols=[f"__bin{i}" for i in cut]).transform(rows.withColumns(values)).drop(*values)
    return rows.withColumns({f"__bin{i}": (F.col(f"__bin{i}") + 1).cast("int") if at else F.lit(1) for i, at in enumerate(cuts)})


def counted_cells(rows: DataFrame, features: list[str], cuts: list[list[float]], label: str, weight: str | None = None) -> DataFrame:
    """The bins of ``features`` in ``__bin<i>``, ``__label``, and the rows (their weight) of both in ``__weight``."""
    bins, w = [f"__bin{i}" for i in range(len(features))], F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    rows = with_bins(rows, features, cuts).select(*bins, F.col(f"`{label}`").cast("double").alias("__label"), w.alias("__w"))
    return rows.groupBy(*bins, "__label").agg(F.sum("__w").alias("__weight"))


def two_labels(cells: DataFrame) -> DataFrame:
    """Of :func:`counted_cells` one row for a cell of one label, else two with the count, sum and sum of squares of all its labels."""
    bins, w, y = cells.columns[:-2], F.col("__weight"), F.col("__label")
    cells = cells.groupBy(*bins).agg(F.sum(w).alias("__n"), F.sum(w * y).alias("__s"), F.sum(w * y * y).alias("__q"),
                                     F.min(y).alias("__lo"), F.max(y).alias("__hi"))
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    off = F.sqrt(F.greatest(n * q - s * s, F.lit(0.0))) / n
    labels = F.when(F.col("__lo") == F.col("__hi"), F.array("__lo")).otherwise(F.array(s / n - off, s / n + off))
    return (cells.withColumn("__labels", labels)
                 .select(*bins, F.explode("__labels").alias("__label"), (n / F.size("__labels")).alias("__weight")))


def _with_cut_points(gbt: GBTRegressor, coded: GBTRegressionModel, cuts: list[list[float]]) -> GBTRegressionModel:
    """The model of bins as one of values: a split after bin ``b`` gets the threshold above ``b``."""
    sc, old = SparkContext._active_spark_context, coded._java_obj
    ml = sc._jvm.org.apache.spark.ml
    splits = [[ml.tree.ContinuousSplit(i, t) for t in at] for i, at in enumerate(cuts)]

    def moved(node):
        if node.subtreeDepth() == 0:
            return node
        at = node.split()
        split = splits[at.featureIndex()][math.ceil(at.threshold()) - 2]   # midway between two bins that have rows
        return ml.tree.InternalNode(node.prediction(), node.impurity(), node.gain(), moved(node.leftChild()),
                                    moved(node.rightChild()), split, node.impurityStats())
    of = ml.regression.DecisionTreeRegressionModel
    trees = [of(t.uid(), moved(t.rootNode()), t.numFeatures()) for t in old.trees()]
    array = sc._gateway.new_array(of, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    java = ml.regression.GBTRegressionModel(gbt.uid, array, old.treeWeights(), old.numFeatures())
    java = gbt._java_obj.copyValues(java.setParent(gbt._java_obj), ml.param.ParamMap())
    return gbt._copyValues(gbt._create_model(java))


def fit_on_cells(gbt: GBTRegressor, rows: DataFrame, features: list[str]) -> GBTRegressionModel:
    """``gbt.fit(rows)``, whose feature vector holds ``features``, on the cells of the rows."""
    gbt._transfer_params_to_java()
    field = rows._jdf.schema().apply(gbt.getFeaturesCol())
    categorical = _module("ml.util.MetadataUtils").getCategoricalFeatures(field)
    if not _takes_cells(gbt, categorical):
        return gbt.fit(rows)
    cuts = _cut_points(gbt, rows, categorical)
    weight = gbt.getWeightCol() if gbt.isSet(gbt.weightCol) else None
    counted = cells = counted_cells(rows, features, cuts, gbt.getLabelCol(), weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if (n := cells.count()) > MOST_CELLS:
            cells = two_labels(counted).persist(StorageLevel.MEMORY_AND_DISK)
            n = cells.count()
        bins = cells.columns[:-2]
        laid = (VectorAssembler(inputCols=bins, outputCol="__bins").transform(cells)
                .repartition(max(1, -(-n // CELL_ROWS)), *bins).sortWithinPartitions(*bins, "__label"))
        # MLlib looks at maxBins squared rows to cut features: all of them here, so that each bin stays one
        whole = {gbt.featuresCol: "__bins", gbt.labelCol: "__label", gbt.weightCol: "__weight",
                 gbt.maxBins: max(gbt.getMaxBins(), math.isqrt(n) + 1)}
        coded = gbt.copy(whole).fit(laid)
    finally:
        counted.unpersist()
        cells.unpersist()
    return _with_cut_points(gbt, coded, cuts)


class CellPipeline(Pipeline):
    """A pipeline that ends in a VectorAssembler and a GBTRegressor, fitted on cells."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        *before, gbt = self.getStages()
        for stage in before:
            dataset = stage.transform(dataset)
        return PipelineModel([*before, fit_on_cells(gbt, dataset, before[-1].getInputCols())])


# ---- scoring ---------------------------------------------------------------

def thresholds(model, features: int) -> list[list[float]]:
    """The values at which a tree model of continuous features splits each of them, in order."""
    found = [set() for _ in range(features)]
    for i, t in re.findall(r"If \(feature (\d+) <= (\S+)\)", model.toDebugString):
        found[int(i)].add(float(t))
    return [sorted(at) for at in found]


def _looked_up(model, rows: DataFrame) -> bool:
    """Whether ``model`` is a pipeline as :func:`model.build_pipeline` makes it, whose rows fall into cells."""
    stages = getattr(model, "stages", None) or []
    return ([type(s) for s in stages] == [SQLTransformer, VectorAssembler, GBTRegressionModel] and stages[0].getStatement() == SAME_ROWS
            and stages[1].getHandleInvalid() == "skip" and stages[2].getPredictionCol() == "prediction"
            and " in {" not in stages[2].toDebugString and not {"prediction", "__cell"} & set(rows.columns))


def predicted(model, rows: DataFrame) -> DataFrame:
    """``rows`` with the ``prediction`` that ``model.transform(rows)`` gives them.

    A pipeline of boosted trees tells one row of each cell between its thresholds, if they
    are at most ``MOST_CELLS``; each of ``rows`` takes that of its cell."""
    if not _looked_up(model, rows):
        return model.transform(rows)
    features = model.stages[1].getInputCols()
    cuts = thresholds(model.stages[2], len(features))
    sizes = [len(at) + 1 for at in cuts]
    if math.prod(sizes) > MOST_CELLS:
        return model.transform(rows)
    cell, place = F.lit(0), F.col("__cell")
    cells = rows.sparkSession.range(math.prod(sizes)).select(F.col("id").cast("int").alias("__cell"))
    for i, size in enumerate(sizes):
        cell = cell * size + F.col(f"__bin{i}") - 1
    for c, at, size in reversed([*zip(features, cuts, sizes)]):
        inside = [*at, math.nextafter(at[-1], math.inf) if at else 0.0]     # a value of each bin
        cells = cells.withColumn(c, F.array(*[F.lit(v) for v in inside])[place % size])
        place = F.floor(place / size).cast("int")
    ensure_checkpoint_dir(rows.sparkSession)
    told = model.transform(cells).select("__cell", "prediction").checkpoint(eager=True)
    placed = with_bins(rows.dropna(subset=features), features, cuts).withColumn("__cell", F.coalesce(cell, F.lit(-1)))
    return placed.join(fixed_broadcast(told), "__cell").select(*rows.columns, "prediction")
