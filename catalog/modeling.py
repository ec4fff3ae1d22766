"""Models on the derived feature table: five folds, full fits, and searches of a few draws."""

from __future__ import annotations

from datetime import datetime, timezone
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from catalog.preparation import FEATURES, INPUTS, encoded_sql, features, kind, schema_sql
from catalog.registry import query, r5, r6
from catalog.sql import (
    FEATURE_SQL,
    RECORD_SQL,
    TARGET_SQL,
    evaluation_sql,
    print_sql,
    split_sql,
    sums_sql,
)
from tenura.functions import run_id_of
from tenura.operators import encoding, metrics, models, nodes, quality, sampling, selection, tuning
from tenura.plans import scoring, training
from tenura.plans.prepare import ID
from tenura.sources import outputs, registry
from tenura.sources.workspace import new_path, store

TRAINED = datetime(2026, 1, 1, tzinfo=timezone.utc)
SCORED = datetime(2026, 1, 2, tzinfo=timezone.utc)
RUN_ID = run_id_of(TRAINED)
FOLDS = 5

LOGISTIC = models.logistic_regression()
FOREST = models.random_forest()
BOOSTED = models.boosted_trees()


def prepared(spark, sf_dir, folds=FOLDS):
    return training.prepare(features(spark, sf_dir), folds=folds)


@query(
    "heuristic_score",
    f"""WITH {FEATURE_SQL}
SELECT customer_id, is_month_to_month, CAST(is_month_to_month AS DOUBLE) AS score FROM feat""",
)
def heuristic_score(spark, sf_dir):
    flag = F.col("is_month_to_month")
    return features(spark, sf_dir).select(
        ID, flag, models.heuristic_score(flag).alias("score")
    )


_WEIGHTS = {"tenure_in_months": -0.05, "num_addon_services": -0.25, "is_month_to_month": 0.75}


@query(
    "fixed_logistic_score",
    f"""WITH {FEATURE_SQL}
SELECT customer_id, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(1.5::DOUBLE
  + CAST(tenure_in_months AS DOUBLE) * -0.05::DOUBLE
  + CAST(num_addon_services AS DOUBLE) * -0.25::DOUBLE
  + CAST(is_month_to_month AS DOUBLE) * 0.75::DOUBLE))), 6) AS score FROM feat""",
)
def fixed_logistic_score(spark, sf_dir):
    score = models.fixed_logistic_score(_WEIGHTS, 1.5)
    return features(spark, sf_dir).select(ID, r6(score).alias("score"))


#: Added before means are rounded to three places, so that no share of a few thousand rows lies on the edge.
MEAN_SHIFT = 0.000123456


def r3(column):
    return F.round(F.col(column) + F.lit(MEAN_SHIFT), 3) + F.lit(0.0)


def _moments_sql() -> str:
    cells = ["{'feature': '(intercept)', 'observed': avg(y)}"]
    cells += [
        f"{{'feature': '{name}', 'observed': avg(f{i:02d} * y)}}"
        for i, name in enumerate(FEATURES, start=1)
    ]
    return f"""WITH {FEATURE_SQL}, {split_sql("feat")}, {encoded_sql("({})")},
own AS (SELECT e.*, CAST(s.is_voluntary_churn AS DOUBLE) AS y FROM encoded e
  JOIN split s USING (customer_id) WHERE e.part = 'train'),
moments AS (SELECT unnest([{", ".join(cells)}]) AS m FROM own)
SELECT m.feature AS feature, round(m.observed + {MEAN_SHIFT}::DOUBLE, 3) + 0.0 AS observed,
  round(m.observed + {MEAN_SHIFT}::DOUBLE, 3) + 0.0 AS fitted FROM moments"""


@query("logistic_regression", _moments_sql())
def logistic_regression(spark, sf_dir):
    """The fit on all features: at its optimum, the fitted moments are those of the rows."""
    ready = prepared(spark, sf_dir)
    model = models.fit(models.logistic_regression(max_iter=1000, tol=1e-12), ready.frame)
    names = encoding.feature_names(ready.preprocessor)
    optional = [s.name for s in ready.schema if s.nullable and s.name in names]
    present = {}
    if optional:
        present = ready.part("train").agg(*[F.count(c).alias(c) for c in optional]).first().asDict()
    moments = models.first_order(model, ready.frame, 1.0, names, present)
    return moments.select("feature", r3("observed").alias("observed"), r3("fitted").alias("fitted"))


def _agrees(scored, walked):
    """Scored rows whose score the walk over the node rows gives as well."""
    same = (F.abs(F.col("score") - F.col("walked")) < 1e-9).alias("same")
    walked = walked.select(ID, F.col("score").alias("walked"))
    return scored.join(walked, ID).select(ID, "label", same)


def _label_sql(part: str) -> str:
    return f"""WITH {TARGET_SQL}, {split_sql("tgt")}
SELECT customer_id, CAST(is_voluntary_churn AS DOUBLE) AS label, true AS same
FROM split WHERE part = '{part}'"""


def _fit_and_walk(candidate):
    """Fit on all training rows; their scores by the model and by its node rows."""

    def run(spark, sf_dir):
        frame = prepared(spark, sf_dir).frame
        model = models.fit(candidate, frame)
        table = nodes.node_table(model)
        walked = nodes.walk(table, frame, [ID], nodes.is_boosted(model), model.getMaxDepth())
        return _agrees(models.predict(model, frame, [ID, "label"]), walked)

    return run


query("random_forest", _label_sql("train"))(_fit_and_walk(FOREST))
query("boosted_trees", _label_sql("train"))(_fit_and_walk(BOOSTED))


@query("predict_probability")
def predict_probability(spark, sf_dir):
    """Held-out rows scored by a model of the training rows."""
    ready = prepared(spark, sf_dir)
    model = models.fit(LOGISTIC, ready.frame)
    test = encoding.assemble(ready.preprocessor, ready.part("test"), [ID])
    return models.predict(model, test, [ID]).select(ID, r6("score").alias("score"))


def _results(found: tuning.Search):
    return found.results.select("search", "config", "fold", r6("score").alias("score"))


def _search(draw, budget=2, folds=FOLDS):
    def run(spark, sf_dir):
        frame = prepared(spark, sf_dir, folds).frame
        return _results(tuning.search(frame, draw, budget=budget, folds=folds))

    return run


DRAW_LOGISTIC = tuning.draw_logistic

# All parameters are drawn from their full ranges. Thirty draws of hundreds of trees take hours
# of job overhead on one machine, so the two tree searches draw twice.
query("tune_logistic")(_search(DRAW_LOGISTIC, budget=30))
query("tune_forest")(_search(tuning.draw_forest))


@query("tune_boosted")
def tune_boosted(spark, sf_dir):
    """The first two fits of the search of 30 draws by five folds; a call with the same table goes on with the next."""
    frame = prepared(spark, sf_dir).frame
    path = new_path(spark, "boosted_search")
    return _results(tuning.resumable_search(frame, tuning.draw_boosted, path, fits=2))


@query(
    "resumed_search",
    "SELECT CAST(range // 2 AS INTEGER) AS config, CAST(range % 2 AS INTEGER) AS fold, true AS same FROM range(8)",
)
def resumed_search(spark, sf_dir):
    """A search that is stopped twice and goes on, beside one that is not stopped."""
    frame = prepared(spark, sf_dir, 2).frame
    path = new_path(spark, "resumed_search")
    for fits in (3, 2, None):
        resumed = tuning.resumable_search(frame, DRAW_LOGISTIC, path, budget=4, folds=2, fits=fits)
    whole = tuning.search(frame, DRAW_LOGISTIC, budget=4, folds=2)
    unbroken = whole.results.select("config", "fold", F.col("score").alias("unbroken"))
    best = F.lit(resumed.best.params == whole.best.params)
    same = (F.abs(F.col("score") - F.col("unbroken")) < 1e-9) & best
    return resumed.results.join(unbroken, ["config", "fold"]).select("config", "fold", same.alias("same"))




@query(
    "class_balance_weight",
    f"""WITH {TARGET_SQL}, {split_sql("tgt")}
SELECT customer_id, CAST(is_voluntary_churn AS DOUBLE) AS label,
  round(count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY is_voluntary_churn)), 6)
    AS weight
FROM split WHERE part = 'train'""",
)
def class_balance_weight(spark, sf_dir):
    from catalog.sampling import split

    train = split(spark, sf_dir).where("part = 'train'")
    labelled = store(train.selectExpr(ID, "CAST(is_voluntary_churn AS DOUBLE) AS label"), "labels")
    weighted = models.with_weight(labelled, models.class_weights(labelled))
    return weighted.select(ID, "label", r6("weight").alias("weight"))


@query("platt_calibration")
def platt_calibration(spark, sf_dir):
    """Raw and calibrated probability of one fold's held-out rows."""
    frame = prepared(spark, sf_dir).frame
    model = models.fit(LOGISTIC, frame.where("fold <> 0"))
    margins = store(
        models.predict(model, frame.where("fold = 0"), [ID, "label"], models.MARGIN), "margins"
    )
    sigmoid = models.fit_sigmoid(margins)
    return margins.select(
        ID, "label", r6("score").alias("margin"), r6(sigmoid(F.col("score"))).alias("calibrated")
    )


@query("calibrated_ensemble", _label_sql("test"))
def calibrated_ensemble(spark, sf_dir):
    """Held-out scores of five calibrated forests, by the models and by their node rows."""
    ready = prepared(spark, sf_dir)
    model = models.fit_calibrated(FOREST, ready.frame, FOLDS)
    labelled = ready.part("test").withColumn("label", F.col(encoding.TARGET).cast("double"))
    test = store(encoding.assemble(ready.preprocessor, labelled, [ID, "label"]), "test")
    walked = nodes.walk_calibrated(model, test, ID, models.MAX_TREE_DEPTH)
    return _agrees(models.calibrated_scores(model, test, [ID, "label"]), walked)


@query("out_of_fold_scores")
def out_of_fold_scores(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    scored = models.out_of_fold_scores(LOGISTIC, ready.frame, FOLDS)
    return scored.select(ID, "fold", "y", r6("score").alias("score"))


@query("refit_per_fold_scores")
def refit_per_fold_scores(spark, sf_dir):
    """Out-of-fold scores with the preprocessor fitted inside the fold."""
    scored = training.refit_scores(prepared(spark, sf_dir), LOGISTIC)
    return scored.select(ID, "fold", "y", r6("score").alias("score"))


@query("train_cv_metrics")
def train_cv_metrics(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    scores = store(models.out_of_fold_scores(LOGISTIC, ready.frame, FOLDS, FOLDS), "oof")
    record = training.training_metrics(scores)
    rows = [(k, str(v)) for k, v in record.items()]
    return spark.createDataFrame(rows, "name STRING, value STRING")


@query("compare_out_of_fold")
def compare_out_of_fold(spark, sf_dir):
    """Models and heuristic compared on out-of-fold scores of the training rows."""
    candidates = [LOGISTIC, FOREST, BOOSTED]
    evaluation = training.compare_out_of_fold(prepared(spark, sf_dir), candidates)
    compared = metrics.compare(evaluation, training.HEURISTIC)
    values = ["precision", "lift", "precision_delta", "lift_delta", "pr_auc", "brier_score"]
    return compared.select("candidate", "k_frac", *[r6(c).alias(c) for c in values])


@query("tuning_evidence")
def tuning_evidence(spark, sf_dir):
    """Score spread and plateau of a real search."""
    found = tuning.search(
        prepared(spark, sf_dir).frame, DRAW_LOGISTIC, budget=30, folds=FOLDS
    )
    evidence = selection.search_evidence(found.results)
    plateau = selection.search_plateau(found.results)
    values = ["best_score", "score_std_at_best", "top_spread", "best_minus_median"]
    return evidence.join(plateau, "search").select(
        "search", "best_config", *[r6(c).alias(c) for c in values]
    )


@query("holdout_evaluation")
def holdout_evaluation(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    model = models.fit_calibrated(BOOSTED, ready.frame, FOLDS)
    evaluation = training.evaluate_held_out(ready, model, BOOSTED.name)
    values = ["precision", "recall", "lift", "pr_auc", "brier_score"]
    return evaluation.select("candidate", "k_frac", "k", "tp", *[r6(c).alias(c) for c in values])


@query("model_save_load", _label_sql("test"))
def model_save_load(spark, sf_dir):
    """Held-out scores of the model in memory and of the saved and loaded one."""
    ready = prepared(spark, sf_dir)
    fitted = models.fit_calibrated(LOGISTIC, ready.frame, FOLDS)
    whole = PipelineModel(stages=[*ready.preprocessor.stages, *fitted.stages])
    path = new_path(spark, "saved_model")
    whole.write().overwrite().save(path)
    test = ready.part("test").withColumn("label", F.col(encoding.TARGET).cast("double")).drop(encoding.TARGET)

    def scores(model, name):
        return model.transform(test).select(ID, "label", F.col("churn_probability").alias(name))

    both = scores(whole, "score").join(scores(PipelineModel.load(path), "loaded").drop("label"), ID)
    return both.select(ID, "label", (F.col("score") == F.col("loaded")).alias("same"))


RECORDED = ["precision_at_k", "lift_at_k", "pr_auc", "brier_score"]


def example_record():
    """A record for tests."""
    return dict.fromkeys(RECORDED, 0.5) | {
        "k": 0.1,
        "training_rows": 1,
        "estimate_type": quality.ESTIMATE_TYPE,
    }


_PRINTED = [f"CAST(floor({c} * 10000) AS BIGINT)" if kind(c) == "decimal" else c for c in INPUTS]


@query(
    "model_registry_row",
    f"""WITH {FEATURE_SQL},
s AS ({schema_sql("feat")}),
l AS (SELECT CAST(to_json([allowed, "column", kind, CAST(nullable AS VARCHAR),
  CAST(position AS VARCHAR), reserved]) AS VARCHAR) AS line FROM s),
h AS (SELECT md5({print_sql(_PRINTED)}) AS h FROM feat),
scored AS (SELECT 'model' AS candidate, customer_id AS id, CAST(is_voluntary_churn AS INTEGER) AS y,
  CAST(is_month_to_month AS DOUBLE) AS score FROM feat),
{evaluation_sql("[0.10]")},
record AS (SELECT {RECORD_SQL} FROM at_k JOIN precision USING (candidate))
SELECT '{RUN_ID}' AS run_id, (SELECT precision_at_k FROM record) AS precision_at_k,
  (SELECT lift_at_k FROM record) AS lift_at_k, (SELECT pr_auc FROM record) AS pr_auc,
  (SELECT brier_score FROM record) AS brier_score,
  (SELECT sha256(string_agg(line, chr(10) ORDER BY line)) FROM l) AS input_schema_hash,
  '100' AS trees, '0.1' AS k, CAST(count(*) AS VARCHAR) AS n_rows,
  {sums_sql()}, true AS complete FROM h""",
)
def model_registry_row(spark, sf_dir):
    """A registry row; its metrics are those of the rule of thumb, its hashes those of the feature table."""
    view = store(features(spark, sf_dir), "features")
    rule = training.heuristic_rows(view, encoding.TARGET).withColumnRenamed("id", ID)
    record = training.training_metrics(store(rule.select(ID, "y", "score"), "rule"))
    categories = encoding.fit_categories(
        encoding.fill_sentinels(view), encoding.CATEGORICAL_COLUMNS
    )
    specs = encoding.input_schema(view, categories)
    exact = view.withColumns(
        {c: F.floor(F.col(c) * 10000) for c in INPUTS if kind(c) == "decimal"}
    )
    fingerprint = registry.table_fingerprint(exact, INPUTS).first()
    row = registry.model_row(
        spark,
        TRAINED,
        "models/" + RUN_ID,
        specs,
        BOOSTED.params,
        record,
        "not evaluated",
        fingerprint.asDict(),
    )
    path = new_path(spark, "registry")
    registry.append_rows(row, path)
    return registry.read_registry(spark, path, registry.MODEL_ROW).select(
        "run_id",
        *[r5(F.col("training_cv_metrics")[m].cast("double")).alias(m) for m in RECORDED],
        "input_schema_hash",
        F.col("hyperparameters")["trees"].alias("trees"),
        F.col("training_cv_metrics")["k"].alias("k"),
        F.col("fingerprints")["n_rows"].alias("n_rows"),
        *[F.col("fingerprints")[f"sum_{i}"].alias(f"sum_{i}") for i in range(1, 5)],
        "complete",
    )


@query("train_pipeline")
def train_pipeline(spark, sf_dir):
    """A whole training run; its registry row beside the recorded metrics."""
    folder = new_path(spark, "published")
    training.train_and_publish(
        features(spark, sf_dir),
        TRAINED,
        f"{folder}/models",
        f"{folder}/registry",
        f"{folder}/runs",
        draw=DRAW_LOGISTIC,
        budget=2,
        folds=FOLDS,
        inner_folds=FOLDS,
    )
    runs = registry.read_registry(spark, f"{folder}/registry", registry.MODEL_ROW)
    recorded = registry.read_registry(spark, f"{folder}/runs", registry.RUN_ROW)
    return runs.join(recorded, "run_id").select(
        "run_id",
        "run_type",
        F.to_json("metrics").alias("metrics"),
        (F.to_json("metrics") == F.to_json("training_cv_metrics")).alias("same_metrics"),
        "complete",
    )


def _published(spark, sf_dir):
    ready = prepared(spark, sf_dir)
    fitted = models.fit_calibrated(LOGISTIC, ready.frame, FOLDS)
    whole = PipelineModel(stages=[*ready.preprocessor.stages, *fitted.stages])
    return ready, whole, scoring.scoring_population(ready.features, ready.schema)


@query("score_batch")
def score_batch(spark, sf_dir):
    ready, model, population = _published(spark, sf_dir)
    ranked = scoring.score_batch(population, model, ready.schema, 0.10)
    return ranked.withColumn("churn_probability", r6("churn_probability"))


def _score_run(spark, model, specs, population, record):
    """Publish the model, score with the latest published run, and read the list back."""
    folder = new_path(spark, "run")
    training.publish(
        model,
        specs,
        LOGISTIC.params,
        record,
        {},
        TRAINED,
        f"{folder}/models",
        f"{folder}/registry",
        "not evaluated",
    )
    run = registry.load_run(spark, f"{folder}/registry")
    scoring.score_run(
        population, run, SCORED, f"{folder}/list", f"{folder}/summary", f"{folder}/runs"
    )
    recorded = registry.read_registry(spark, f"{folder}/runs", registry.RUN_ROW)
    flagged = recorded.select(F.col("metrics")["customers_flagged"].cast("bigint")).scalar()
    listed = outputs.read_list(spark, f"{folder}/list")
    health = spark.read.json(f"{folder}/summary").select("model_health.training_cv_metrics.*")
    stated = {m: r5(health.select(m).scalar()) for m in RECORDED}
    return listed.withColumn("churn_probability", r6("churn_probability")).withColumns(
        {"customers_flagged": flagged, **stated}
    )


@query("score_run")
def score_run(spark, sf_dir):
    ready, model, population = _published(spark, sf_dir)
    scores = store(models.out_of_fold_scores(LOGISTIC, ready.frame, FOLDS), "oof")
    record = training.training_metrics(scores, folds=FOLDS)
    return _score_run(spark, model, ready.schema, population, record)


_FIXED = "1.5D - 0.0625D * tenure_in_months - 0.25D * num_addon_services + 0.75D * is_mtm"
_FIXED_SQL = f"""WITH {FEATURE_SQL}, {split_sql("feat")},
p AS (
  SELECT customer_id, part, is_voluntary_churn, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(1.5::DOUBLE
    - 0.0625::DOUBLE * tenure_in_months - 0.25::DOUBLE * num_addon_services
    + 0.75::DOUBLE * CAST(is_month_to_month AS INTEGER)))) AS churn_probability
  FROM split),
fixed AS (
  SELECT customer_id, round(churn_probability, 6) AS churn_probability,
    row_number() OVER w AS rank, row_number() OVER w
      <= greatest(1, CAST(round_even(count(*) OVER () * 0.1::DOUBLE, 0) AS BIGINT)) AS in_top_k
  FROM p WHERE part = 'test' WINDOW w AS (ORDER BY p.churn_probability DESC, customer_id))
"""


def _fixed_model(spark, sf_dir):
    """A saved-model stand-in with known coefficients, and the population it scores."""
    view = sampling.stratified_split(
        store(features(spark, sf_dir), "features"), ID, encoding.TARGET
    )
    train = view.where("part = 'train'").drop("part")
    categories = encoding.fit_categories(
        encoding.fill_sentinels(train), encoding.CATEGORICAL_COLUMNS
    )
    specs = encoding.input_schema(train, categories)
    labelled = train.select(ID, F.col(encoding.TARGET).cast("int").alias("y"), "tenure_in_months",
                            "num_addon_services", "is_month_to_month")
    z = _FIXED.replace("is_mtm", "CAST(is_month_to_month AS INT)")
    model = PipelineModel(
        stages=[
            SQLTransformer(
                statement=f"SELECT *, 1.0D / (1.0D + exp(-({z}))) AS churn_probability FROM __THIS__"
            )
        ]
    )
    scores = model.transform(labelled).select(ID, "y", F.col("churn_probability").alias("score"))
    return model, specs, scoring.scoring_population(view, specs), scores


@query("score_batch_fixed", _FIXED_SQL + "SELECT * FROM fixed")
def score_batch_fixed(spark, sf_dir):
    model, specs, population, _ = _fixed_model(spark, sf_dir)
    ranked = scoring.score_batch(population, model, specs, 0.10)
    return ranked.withColumn("churn_probability", r6("churn_probability"))


@query(
    "score_run_fixed",
    _FIXED_SQL
    + f""", scored AS (SELECT 'model' AS candidate, customer_id AS id,
  CAST(is_voluntary_churn AS INTEGER) AS y, churn_probability AS score FROM p WHERE part = 'train'),
{evaluation_sql("[0.10]")}
SELECT customer_id, churn_probability, rank, CASE WHEN in_top_k THEN 'True' ELSE 'False' END AS in_top_k,
  count(*) FILTER (WHERE in_top_k) OVER () AS customers_flagged, record.*
FROM fixed, (SELECT {RECORD_SQL} FROM at_k JOIN precision USING (candidate)) AS record""",
)
def score_run_fixed(spark, sf_dir):
    """Scored with known coefficients; the summary repeats their metrics on the training rows."""
    model, specs, population, scores = _fixed_model(spark, sf_dir)
    return _score_run(spark, model, specs, population, training.training_metrics(store(scores, "scores")))
