"""Fits whose result SQL can state: models of one flag.

With the month-to-month flag as its only feature a model can tell two groups apart. Without a penalty its
probabilities are the groups' rates, calibration gives the groups' mean targets, and boosting follows a
recursion per group. The operators are those of the large models; only the features differ.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import functions as F

from catalog.modeling import FOLDS, prepared
from catalog.registry import query, r5
from catalog.sql import FEATURE_SQL, evaluation_sql, hash_sql, r5_sql, split_sql
from tenura.operators import encoding, metrics, models
from tenura.operators.models import ID, MARGIN, PROBABILITY, Candidate
from tenura.plans import training
from tenura.sources.workspace import new_path, store

FLAG = "contract=Month-to-Month"


LOGISTIC = Candidate(
    "flag_logistic",
    lambda n: LogisticRegression(regParam=0.0, standardization=False, tol=1e-14, maxIter=1000),
    MARGIN,
)
#: Trees over all rows and features, so that each holds the groups' rates; with balanced classes, as Spark joins
#: leaves again that predict the same class.
FOREST = Candidate(
    "flag_forest",
    lambda n: RandomForestClassifier(numTrees=5, bootstrap=False, featureSubsetStrategy="all", seed=42),
    PROBABILITY,
    balanced=True,
)
BOOSTED = models.boosted_trees()


def _ready(spark, sf_dir):
    """The prepared training rows, and a slicer that leaves the flag alone."""
    ready = prepared(spark, sf_dir)
    place = encoding.feature_names(ready.preprocessor).index(FLAG)
    return ready, VectorSlicer(inputCol="features", outputCol="flag", indices=[place])


def _only_flag(slicer, frame):
    return slicer.transform(frame).drop("features").withColumnRenamed("flag", "features")


def _test(ready, slicer):
    labelled = ready.part("test").withColumn("label", F.col(encoding.TARGET).cast("double"))
    keep = [ID, "label", "is_month_to_month"]
    return _only_flag(slicer, encoding.assemble(ready.preprocessor, labelled, keep))


_ROWS = f"""WITH RECURSIVE {FEATURE_SQL}, {split_sql("feat")},
own AS (SELECT customer_id, is_month_to_month AS flag, CAST(is_voluntary_churn AS DOUBLE) AS y, part
  FROM split),
test AS (SELECT * FROM own WHERE part = 'test'),
train AS (SELECT *, CAST((row_number() OVER w - 1) * {FOLDS} // count(*) OVER (PARTITION BY y) AS INTEGER)
  AS fold FROM own WHERE part = 'train'
  WINDOW w AS (PARTITION BY y ORDER BY {hash_sql("customer_id", 42)}, customer_id)),
rates AS (SELECT flag, avg(y) AS rate, avg(2 * y - 1) AS mean FROM train GROUP BY flag),
folds AS (SELECT CAST(range AS INTEGER) AS f FROM range({FOLDS})),
out_of_fold AS (SELECT f AS fold, flag, avg(y) AS rate FROM train, folds WHERE fold <> f GROUP BY f, flag),
targets AS (SELECT fold, (sum(y) + 1) / (sum(y) + 2) AS high, 1 / (count(*) - sum(y) + 2) AS low
  FROM train GROUP BY fold),
calibrated AS (SELECT fold, flag, avg(CASE WHEN y = 1 THEN high ELSE low END) AS p
  FROM train JOIN targets USING (fold) GROUP BY fold, flag),
ensemble AS (SELECT flag, avg(p) AS p FROM calibrated GROUP BY flag)"""

_BY_RATE = _ROWS + f"""
SELECT customer_id, {r5_sql("rate")} AS score FROM test JOIN rates USING (flag)"""


def _scores_of(candidate):
    def run(spark, sf_dir):
        ready, slicer = _ready(spark, sf_dir)
        model = models.fit(candidate, _only_flag(slicer, ready.frame))
        return models.predict(model, _test(ready, slicer), [ID]).select(ID, r5("score").alias("score"))

    return run


query("flag_probability", _BY_RATE)(_scores_of(LOGISTIC))
query(
    "flag_forest",
    _ROWS
    + f""",
classes AS (SELECT sum(y) AS ones, count(*) - sum(y) AS zeros FROM train),
balanced AS (SELECT flag, (sum(y) / max(ones)) / (sum(y) / max(ones) + (count(*) - sum(y)) / max(zeros))
  AS rate FROM train, classes GROUP BY flag)
SELECT customer_id, {r5_sql("rate")} AS score FROM test JOIN balanced USING (flag)""",
)(_scores_of(FOREST))
query(
    "flag_boosted",
    _ROWS
    + f""",
steps AS (
  SELECT flag, rate, 0 AS step, mean AS margin FROM rates
  UNION ALL
  SELECT flag, rate, step + 1, margin + {BOOSTED.params["rate"]!r}::DOUBLE * 4
    * (rate / (1 + exp(2 * margin)) - (1 - rate) / (1 + exp(-2 * margin)))
  FROM steps WHERE step < {BOOSTED.params["trees"] - 1})
SELECT customer_id, {r5_sql("1 / (1 + exp(-2 * margin))")} AS score
FROM test JOIN steps USING (flag) WHERE step = {BOOSTED.params["trees"] - 1}""",
)(_scores_of(BOOSTED))


@query(
    "flag_calibration",
    _ROWS
    + f"""
SELECT customer_id, y AS label, {r5_sql("p")} AS calibrated FROM train JOIN calibrated USING (fold, flag)
WHERE fold = 0""",
)
def flag_calibration(spark, sf_dir):
    """Calibrated probability of one fold's held-out rows."""
    ready, slicer = _ready(spark, sf_dir)
    frame = _only_flag(slicer, ready.frame)
    model = models.fit(LOGISTIC, frame.where("fold <> 0"))
    margins = store(models.predict(model, frame.where("fold = 0"), [ID, "label"], MARGIN), "margins")
    sigmoid = models.fit_sigmoid(margins)
    return margins.select(ID, "label", r5(sigmoid(F.col("score"))).alias("calibrated"))


@query(
    "flag_ensemble",
    _ROWS + f"\nSELECT customer_id, {r5_sql('p')} AS score FROM test JOIN ensemble USING (flag)",
)
def flag_ensemble(spark, sf_dir):
    """Held-out scores of the mean of five calibrated models, saved and loaded in between."""
    ready, slicer = _ready(spark, sf_dir)
    fitted = models.fit_calibrated(LOGISTIC, _only_flag(slicer, ready.frame), FOLDS)
    path = new_path(spark, "flag_model")
    fitted.write().save(path)
    scored = models.calibrated_scores(PipelineModel.load(path), _test(ready, slicer), [ID])
    return scored.select(ID, r5("score").alias("score"))


_OUT_OF_FOLD = f"""scored AS (SELECT customer_id AS id, fold, CAST(y AS INTEGER) AS y,
  {r5_sql("rate")} AS score FROM train JOIN out_of_fold USING (fold, flag))"""


def _out_of_fold(spark, sf_dir):
    ready, slicer = _ready(spark, sf_dir)
    scored = models.out_of_fold_scores(LOGISTIC, _only_flag(slicer, ready.frame), FOLDS)
    return scored.withColumn("score", r5("score"))


@query(
    "flag_out_of_fold",
    _ROWS + f", {_OUT_OF_FOLD} SELECT id AS customer_id, fold, y, score FROM scored",
)
def flag_out_of_fold(spark, sf_dir):
    return _out_of_fold(spark, sf_dir).select(ID, "fold", "y", "score")


@query(
    "flag_cv_metrics",
    _ROWS
    + f""", {_OUT_OF_FOLD.replace("SELECT customer_id", "SELECT 'model' AS candidate, customer_id", 1)},
{evaluation_sql("[0.10]")}
SELECT k_frac AS k, n_rows AS training_rows, {r5_sql("tp::DOUBLE / k")} AS precision_at_k,
  {r5_sql("(tp::DOUBLE / k) / (positives / n_rows)")} AS lift_at_k, {r5_sql("pr_auc")} AS pr_auc,
  {r5_sql("brier_score")} AS brier_score
FROM at_k JOIN precision USING (candidate)""",
)
def flag_cv_metrics(spark, sf_dir):
    """The record of a training run, from out-of-fold scores."""
    record = training.training_metrics(store(_out_of_fold(spark, sf_dir), "oof"))
    values = ["precision_at_k", "lift_at_k", "pr_auc", "brier_score"]
    row = spark.createDataFrame(
        [(record["k"], record["training_rows"], *(record[v] for v in values))],
        "k DOUBLE, training_rows BIGINT, " + ", ".join(f"{v} DOUBLE" for v in values),
    )
    return row.select("k", "training_rows", *[r5(v).alias(v) for v in values])


@query(
    "flag_holdout_evaluation",
    _ROWS
    + f""",
scored AS (
  SELECT 'flag_logistic' AS candidate, customer_id AS id, CAST(y AS INTEGER) AS y, p AS score
  FROM test JOIN ensemble USING (flag)
  UNION ALL
  SELECT '{training.HEURISTIC}', customer_id, CAST(y AS INTEGER), CAST(flag AS DOUBLE) FROM test),
{evaluation_sql("[0.05, 0.10, 0.15, 0.20, 0.25]")}
SELECT candidate, k_frac, k, tp, {r5_sql("tp::DOUBLE / k")} AS precision,
  {r5_sql("tp / positives")} AS recall, {r5_sql("(tp::DOUBLE / k) / (positives / n_rows)")} AS lift,
  {r5_sql("pr_auc")} AS pr_auc, {r5_sql("brier_score")} AS brier_score
FROM at_k JOIN precision USING (candidate)""",
)
def flag_holdout_evaluation(spark, sf_dir):
    """A calibrated model and the heuristic on the held-out part."""
    ready, slicer = _ready(spark, sf_dir)
    fitted = models.fit_calibrated(LOGISTIC, _only_flag(slicer, ready.frame), FOLDS)
    scored = models.calibrated_scores(fitted, _test(ready, slicer), [ID, "label", "is_month_to_month"])
    rows = scored.select(
        F.lit(LOGISTIC.name).alias("candidate"), F.col(ID).alias("id"), F.col("label").cast("int").alias("y"), "score"
    ).unionByName(training.heuristic_rows(scored))
    evaluation = metrics.evaluate(store(rows, "held_out"))
    values = ["precision", "recall", "lift", "pr_auc", "brier_score"]
    return evaluation.select("candidate", "k_frac", "k", "tp", *[r5(c).alias(c) for c in values])
