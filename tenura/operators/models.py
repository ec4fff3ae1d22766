"""Classifiers, calibration and out-of-fold scores with Spark ML.

A model frame holds ``customer_id``, ``label`` (0.0/1.0), ``features`` and,
where folds are needed, ``fold``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tenura.operators.sampling import stratified_folds
from tenura.sources.workspace import store

ID = "customer_id"
WEIGHT = "weight"
MARGIN = "rawPrediction"
PROBABILITY = "probability"
PARALLEL_FITS = 4  # independent fits that run side by side; one alone leaves cores idle
MAX_TREE_DEPTH = 30  # Spark's limit; stands for unlimited depth


@dataclass(frozen=True)
class Candidate:
    """A classifier to fit: how to build it for a number of rows, and what to calibrate."""

    name: str
    build: Callable[[int], Estimator]
    score: str = PROBABILITY
    balanced: bool = False
    params: dict = field(default_factory=dict)


def heuristic_score(flag: Column) -> Column:
    """The rule of thumb as a risk: 1.0 where the flag is set, else 0.0."""
    return flag.cast("double")


def logistic_regression(
    C: float = 1.0,
    l1_ratio: float = 0.0,
    balanced: bool = False,
    max_iter: int = 100,
    tol: float = 1e-6,
) -> Candidate:
    """C is the inverse penalty on summed losses, so the mean-loss penalty is 1 / (C n)."""

    def build(n: int) -> Estimator:
        return LogisticRegression(
            regParam=1.0 / (C * n),
            elasticNetParam=l1_ratio,
            standardization=False,
            maxIter=max_iter,
            tol=tol,
        )

    params = {"C": C, "l1_ratio": l1_ratio, "balanced": balanced}
    return Candidate("logistic_regression", build, MARGIN, balanced, params)


def random_forest(
    trees: int = 100,
    depth: int | None = None,
    min_leaf: int = 1,
    features: str = "sqrt",
    balanced: bool = False,
    seed: int = 42,
) -> Candidate:
    def build(n: int) -> Estimator:
        return RandomForestClassifier(
            numTrees=trees,
            maxDepth=MAX_TREE_DEPTH if depth is None else depth,
            minInstancesPerNode=min_leaf,
            featureSubsetStrategy=features,
            seed=seed,
        )

    params = {
        "trees": trees,
        "depth": depth,
        "min_leaf": min_leaf,
        "features": features,
        "balanced": balanced,
    }
    return Candidate("random_forest", build, PROBABILITY, balanced, params)


def boosted_trees(
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    row_share: float = 1.0,
    column_share: float = 1.0,
    min_leaf: int = 1,
    balanced: bool = False,
    seed: int = 42,
) -> Candidate:
    def build(n: int) -> Estimator:
        return GBTClassifier(
            maxIter=trees,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=row_share,
            featureSubsetStrategy="all" if column_share >= 1 else repr(column_share),
            minInstancesPerNode=min_leaf,
            seed=seed,
        )

    params = {
        "trees": trees,
        "depth": depth,
        "rate": rate,
        "row_share": row_share,
        "column_share": column_share,
        "min_leaf": min_leaf,
        "balanced": balanced,
    }
    return Candidate("boosted_trees", build, PROBABILITY, balanced, params)


def model_frame(df: DataFrame) -> DataFrame:
    """Write the rows in an order that their ids decide, so repeated fits see the same partitions."""
    return store(df.repartition(ID).sortWithinPartitions(ID), "model")


def in_parallel(tasks: Sequence[Callable], threads: int | None = None) -> list:
    """Results of independent fits, a few at a time, in the order of the tasks."""
    with ThreadPool(min(threads or PARALLEL_FITS, max(1, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(t) for t in tasks])


def label_counts(frame: DataFrame, label: str = "label") -> dict[float, int]:
    """Rows per class; a label has two, so a third is enough to see that it is none."""
    return {r[0]: r[1] for r in frame.groupBy(label).count().limit(3).collect()}


def fold_counts(frame: DataFrame, folds: int, label: str = "label") -> list[dict[float, int]]:
    """For every fold the rows per class outside it, all from one aggregation."""
    rows = frame.groupBy("fold", label).count().collect()
    out: list[dict[float, int]] = [{} for _ in range(folds)]
    for f in range(folds):
        for row in rows:
            if row[0] != f:
                out[f][row[1]] = out[f].get(row[1], 0) + row[2]
    return out


def class_weights(
    df: DataFrame, label: str = "label", counts: dict[float, int] | None = None
) -> dict[float, float]:
    """Rows over twice the rows of the class, per class."""
    counts = label_counts(df, label) if counts is None else counts
    if len(counts) != 2:
        raise ValueError(f"{label} must have two classes, got {sorted(counts)}")
    total = sum(counts.values())
    return {value: total / (2.0 * n) for value, n in counts.items()}


def with_weight(df: DataFrame, weights: dict[float, float], label: str = "label") -> DataFrame:
    chosen = F.lit(None).cast("double")
    for value, weight in weights.items():
        chosen = F.when(F.col(label) == value, F.lit(weight)).otherwise(chosen)
    return df.withColumn(WEIGHT, chosen)


def fit(
    candidate: Candidate, frame: DataFrame, counts: dict[float, int] | None = None
) -> Model:
    """Fit on all rows of ``frame``; ``counts`` are its rows per class, if known."""
    counts = label_counts(frame) if counts is None else counts
    estimator = candidate.build(sum(counts.values()))
    if candidate.balanced:
        frame = with_weight(frame, class_weights(frame, counts=counts))
        estimator = estimator.setWeightCol(WEIGHT)
    return _without_summary(estimator.fit(frame), frame.sparkSession)


def _without_summary(model: Model, spark: SparkSession) -> Model:
    """The model without the summary of its training.

    The summary refers to the session, which travels with the model to every task and cannot, once something has
    been observed in that session.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(spark.sparkContext._jvm.scala.Option.empty())
    return model


def first_order(
    model: Model,
    frame: DataFrame,
    C: float,
    names: Sequence[str],
    present: Mapping[str, int] | None = None,
) -> DataFrame:
    """How near a ridge logistic fit is to its optimum: ``feature, coefficient, observed, fitted``.

    At the optimum of summed losses plus ``|w|^2 / (2 C)`` the mean of every feature over the positives,
    ``observed``, equals ``fitted``, its mean under the fitted probabilities plus the pull of the penalty; their
    difference is the gradient. Both are moments of one pass over the frame. The intercept, which has no
    penalty, is the feature ``(intercept)``. ``present`` has the rows with a value of features that some rows
    lack: there the entry is 0, and both sides are means over the rows with a value.
    """
    p = F.col("_p")
    scored = model.transform(frame).select("features", "label", positive(PROBABILITY).alias("_p"))

    def moments(weight: Column) -> Column:
        return Summarizer.metrics("mean").summary(F.col("features"), weight)["mean"]

    row = scored.agg(
        moments(F.col("label")).alias("seen"),
        moments(p).alias("fitted"),
        F.avg("label").alias("rate"),
        F.avg(p).alias("p"),
        F.count("*").alias("n"),
    ).first()
    out = [("(intercept)", float(model.intercept), row.rate, row.p)]
    for i, name in enumerate(names):
        w = float(model.coefficients[i])
        pull = w / (C * row.n)
        share = (present or {}).get(name, row.n) / row.n
        observed, fitted = float(row.seen[i]) * row.rate, float(row.fitted[i]) * row.p + pull
        out.append((name, w, observed / share, fitted / share))
    columns = "feature STRING, coefficient DOUBLE, observed DOUBLE, fitted DOUBLE"
    return frame.sparkSession.createDataFrame(out, columns)


def positive(vector: str) -> Column:
    """The entry of the positive class."""
    return vector_to_array(F.col(vector))[1]


def predict(model: Model, frame: DataFrame, keep: Sequence[str], what: str = PROBABILITY):
    return model.transform(frame).select(*keep, positive(what).alias("score"))


@dataclass(frozen=True)
class Sigmoid:
    """p = 1 / (1 + exp(-(slope * score + intercept)))."""

    slope: float
    intercept: float

    def __call__(self, score: Column) -> Column:
        z = F.lit(self.slope) * score + F.lit(self.intercept)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_sigmoid(scored: DataFrame) -> Sigmoid:
    """Sigmoid calibration of ``(label, score)`` rows with smoothed targets.

    Each row enters twice, as positive with weight t and as negative with weight 1 - t.
    """
    counts = scored.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    positives, negatives = counts.p, counts.n - counts.p
    high = (positives + 1.0) / (positives + 2.0)
    low = 1.0 / (negatives + 2.0)
    t = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
    sides = F.array(
        F.struct(F.lit(1.0).alias("side"), t.alias(WEIGHT)),
        F.struct(F.lit(0.0).alias("side"), (1 - t).alias(WEIGHT)),
    )
    rows = scored.select("score", F.inline(sides))
    vectors = VectorAssembler(inputCols=["score"], outputCol="x").transform(rows)
    model = LogisticRegression(
        featuresCol="x", labelCol="side", weightCol=WEIGHT, regParam=0.0
    ).fit(vectors)
    return Sigmoid(float(model.coefficients[0]), float(model.intercept))


class CalibratedMean(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The mean of calibrated scores, as a stage that saves and loads with the models."""

    inputCols = Param(Params._dummy(), "inputCols", "score vectors", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "mean probability", TypeConverters.toString)
    slopes = Param(Params._dummy(), "slopes", "slopes", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "intercepts", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, slopes=None, intercepts=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        calibrated = [
            Sigmoid(a, b)(positive(c))
            for c, a, b in zip(
                self.getOrDefault(self.inputCols),
                self.getOrDefault(self.slopes),
                self.getOrDefault(self.intercepts),
                strict=True,
            )
        ]
        mean = reduce(lambda x, y: x + y, calibrated) / len(calibrated)
        return dataset.withColumn(self.getOrDefault(self.outputCol), mean)


def fit_calibrated(candidate: Candidate, frame: DataFrame, folds: int) -> PipelineModel:
    """One model per fold, fitted on the other folds and calibrated on its own.

    The result averages the calibrated models; nothing is fitted on all rows.
    """
    counts = fold_counts(frame, folds)

    def one(f: int):
        model = fit(candidate, frame.where(F.col("fold") != f), counts[f])
        held_out = predict(model, frame.where(F.col("fold") == f), ["label"], candidate.score)
        return model, fit_sigmoid(held_out)

    stages, vectors, slopes, intercepts = [], [], [], []
    fitted = in_parallel([partial(one, f) for f in range(folds)])
    for f, (model, sigmoid) in enumerate(fitted):
        model.setRawPredictionCol(f"_raw_{f}").setProbabilityCol(f"_prob_{f}")
        model.setPredictionCol(f"_pred_{f}")
        stages.append(model)
        vectors.append(f"_raw_{f}" if candidate.score == MARGIN else f"_prob_{f}")
        slopes.append(sigmoid.slope)
        intercepts.append(sigmoid.intercept)
    stages.append(
        CalibratedMean(
            inputCols=vectors, outputCol="churn_probability", slopes=slopes, intercepts=intercepts
        )
    )
    return PipelineModel(stages=stages)


def calibrated_scores(model: PipelineModel, frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(frame).select(*keep, F.col("churn_probability").alias("score"))


def out_of_fold_scores(
    candidate: Candidate, frame: DataFrame, folds: int, inner_folds: int | None = None, seed: int = 42
) -> DataFrame:
    """Every row scored by a model that never saw it: ``customer_id, fold, y, score``.

    With ``inner_folds`` the model of each fold is a calibrated ensemble, over the frame's ``inner`` folds if it
    has as many.
    """
    keep = [ID, "fold", F.col("label").cast("int").alias("y")]
    counts = fold_counts(frame, folds)

    def one(f: int) -> DataFrame:
        train, held_out = frame.where(F.col("fold") != f), frame.where(F.col("fold") == f)
        if inner_folds:
            if inner_folds == folds and "inner" in frame.columns:
                inner = train.withColumn("fold", F.col("inner")[f]).drop("inner")
            else:
                outer = train.withColumnRenamed("fold", "outer_fold")
                inner = stratified_folds(outer, ID, "label", inner_folds, seed)
            return calibrated_scores(fit_calibrated(candidate, inner, inner_folds), held_out, keep)
        return predict(fit(candidate, train, counts[f]), held_out, keep)

    # Each calibrated model fits its own folds side by side already.
    threads = 1 if inner_folds else None
    return reduce(
        DataFrame.unionByName, in_parallel([partial(one, f) for f in range(folds)], threads)
    )


def fixed_logistic_score(coefficients: dict[str, float], intercept: float) -> Column:
    """The probability of a logistic model with known coefficients, as an expression."""
    z = reduce(
        lambda a, b: a + b,
        [F.col(c).cast("double") * F.lit(w) for c, w in coefficients.items()],
        F.lit(intercept),
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
