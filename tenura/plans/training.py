"""Training: split, preprocess, tune, check, calibrate, measure, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions import run_id_of
from tenura.operators import encoding, metrics, models, sampling, tuning
from tenura.operators.models import ID, Candidate
from tenura.operators.quality import ESTIMATE_TYPE, InputColumn
from tenura.operators.selection import require_equal_parameters
from tenura.sources import registry
from tenura.sources.workspace import store

HEURISTIC = "business_heuristic"
RECORDED_FOLDS = 5


class SearchUnfinished(RuntimeError):
    """A training run whose search goes on in a later call."""


@dataclass(frozen=True)
class Prepared:
    """The split features, the fitted preprocessor and schema, and the training frame."""

    features: DataFrame
    preprocessor: PipelineModel
    schema: list[InputColumn]
    frame: DataFrame
    folds: int

    def part(self, name: str) -> DataFrame:
        return self.features.where(F.col("part") == name)


def prepare(
    features: DataFrame, fraction: float = 0.2, folds: int = 5, seed: int = 42
) -> Prepared:
    """Split the feature table, fit the preprocessor on its training rows, assign the folds."""
    # Written once; the part is an expression over the id, so it is not stored.
    table = sampling.stratified_split(
        store(features, "features"), ID, encoding.TARGET, fraction, seed
    )
    train = table.where("part = 'train'").drop("part")
    preprocessor = encoding.fit_preprocessor(train)
    lacking = encoding.lacking_columns(table, encoding.input_columns(features))
    schema = encoding.input_schema(
        train, encoding.fitted_categories(preprocessor), lacking=lacking
    )
    labelled = train.withColumn("label", F.col(encoding.TARGET).cast("double"))
    encoded = encoding.assemble(preprocessor, labelled, [ID, "label", "is_month_to_month"])
    # The folds, and in the same pass the inner folds of all of them.
    frame = models.model_frame(
        sampling.fold_matrix(encoded, ID, "label", folds, folds, seed)
    )
    return Prepared(table, preprocessor, schema, frame, folds)


def refit_scores(
    prepared: Prepared, candidate: Candidate, seed: int = 42
) -> DataFrame:
    """Out-of-fold scores with the preprocessor fitted again inside every fold."""
    train = prepared.part("train").drop("part")
    labelled = train.withColumn("label", F.col(encoding.TARGET).cast("double"))
    folded = sampling.stratified_folds(labelled, ID, "label", prepared.folds, seed)
    parts = None
    for f in range(prepared.folds):
        rest = folded.where(F.col("fold") != f)
        own = encoding.fit_preprocessor(rest.drop("fold", "label"))
        frame = models.model_frame(encoding.assemble(own, rest, [ID, "label"]))
        held_out = encoding.assemble(own, folded.where(F.col("fold") == f), [ID, "label", "fold"])
        scored = models.predict(
            models.fit(candidate, frame),
            held_out,
            [ID, "fold", F.col("label").cast("int").alias("y")],
        )
        parts = scored if parts is None else parts.unionByName(scored)
    return parts


def heuristic_rows(frame: DataFrame, label: str = "label") -> DataFrame:
    """The rule of thumb as a candidate; it never passes through the preprocessor."""
    return frame.select(
        F.lit(HEURISTIC).alias("candidate"),
        F.col(ID).alias("id"),
        F.col(label).cast("int").alias("y"),
        models.heuristic_score(F.col("is_month_to_month")).alias("score"),
    )


def compare_out_of_fold(
    prepared: Prepared, candidates: list[Candidate], inner_folds: int | None = None, seed: int = 42
) -> DataFrame:
    """All candidates and the heuristic, scored out of fold on the training rows only."""
    rows = heuristic_rows(prepared.frame)
    for candidate in candidates:
        scored = models.out_of_fold_scores(
            candidate, prepared.frame, prepared.folds, inner_folds, seed
        )
        rows = rows.unionByName(
            scored.select(F.lit(candidate.name).alias("candidate"), F.col(ID).alias("id"), "y", "score")
        )
    return metrics.evaluate(store(rows, "scores"))


def training_metrics(
    scores: DataFrame, k: float = metrics.DEFAULT_K, folds: int = RECORDED_FOLDS
) -> dict:
    """The headline record of out-of-fold scores ``(customer_id, y, score)``.

    The record says that five folds were used, so scores of other folds are refused.
    """
    if folds != RECORDED_FOLDS:
        raise ValueError(f"the record states {RECORDED_FOLDS} folds, the scores have {folds}")
    named = metrics.require_complete(scores).select(
        F.lit("model").alias("candidate"), F.col(ID).alias("id"), "y", "score"
    )
    row = metrics.evaluate(named, [k]).first()
    return {
        "k": float(k),
        "training_rows": int(row.n_rows),
        "estimate_type": ESTIMATE_TYPE,
        "precision_at_k": row.precision,
        "lift_at_k": row.lift,
        "pr_auc": row.pr_auc,
        "brier_score": row.brier_score,
    }


def evaluate_held_out(prepared: Prepared, model: PipelineModel, name: str) -> DataFrame:
    """The chosen model and the heuristic on the held-out part, in one evaluation."""
    if name == HEURISTIC:
        raise ValueError("the heuristic is the yardstick, not a model to evaluate")
    test = prepared.part("test").withColumn("label", F.col(encoding.TARGET).cast("double"))
    encoded = encoding.assemble(prepared.preprocessor, test, [ID, "label", "is_month_to_month"])
    scored = models.calibrated_scores(
        model, encoded, [ID, "label", "is_month_to_month"]
    )
    rows = scored.select(
        F.lit(name).alias("candidate"),
        F.col(ID).alias("id"),
        F.col("label").cast("int").alias("y"),
        "score",
    ).unionByName(heuristic_rows(scored))
    return metrics.evaluate(store(rows, "held_out"))


def parameter_frame(spark, params: Mapping[str, object]) -> DataFrame:
    rows = [(k, None if v is None else repr(v)) for k, v in params.items()]
    return spark.createDataFrame(rows, "name STRING, value STRING")


def publish(
    model: PipelineModel,
    specs: Sequence[InputColumn],
    params: Mapping[str, object],
    record: Mapping[str, object],
    fingerprints: Mapping[str, object],
    instant: datetime,
    models_dir: str,
    registry_path: str,
    held_out_reference: str,
) -> str:
    """Save the model, then register it: a run that is not registered does not exist."""
    spark = SparkSession.getActiveSession()
    run_id = run_id_of(instant)
    registry.require_new_run(spark, registry_path, run_id, registry.MODEL_ROW)
    path = f"{models_dir.rstrip('/')}/{run_id}"
    row = registry.model_row(
        spark, instant, path, specs, params, record, held_out_reference, fingerprints
    )
    model.write().save(path)
    registry.append_rows(row, registry_path)
    return run_id


def train_and_publish(
    features: DataFrame,
    instant: datetime,
    models_dir: str,
    registry_path: str,
    runs_path: str,
    draw: Callable = tuning.draw_boosted,
    budget: int = 30,
    folds: int = 5,
    inner_folds: int | None = 5,
    reference: Mapping[str, object] | None = None,
    held_out_reference: str = "not evaluated",
    seed: int = 42,
    search_path: str | None = None,
    fits: int | None = None,
) -> str:
    """Train on the feature table, publish the model, record the run's metrics last.

    With ``search_path`` the search keeps its fits there and makes at most ``fits`` in this call; if some are
    left, the call ends with ``SearchUnfinished`` before anything is published, and a later call goes on.

    ``reference`` holds the parameters that the search must find again; any
    difference stops the run before anything is published.
    """
    spark = features.sparkSession
    run_id = run_id_of(instant)
    registry.require_new_run(spark, registry_path, run_id, registry.MODEL_ROW)
    prepared = prepare(features, folds=folds, seed=seed)
    if search_path is None:
        found = tuning.search(prepared.frame, draw, budget, folds, seed)
    else:
        found = tuning.resumable_search(prepared.frame, draw, search_path, budget, folds, seed, fits)
        if found.best is None:
            raise SearchUnfinished(f"{found.left} fits are left; call again with the same search_path")
    if reference is not None:
        require_equal_parameters(
            parameter_frame(spark, found.best.params), parameter_frame(spark, reference)
        )
    model = models.fit_calibrated(found.best, prepared.frame, folds)
    scores = store(
        models.out_of_fold_scores(found.best, prepared.frame, folds, inner_folds, seed), "oof"
    )
    record = training_metrics(scores, folds=folds)
    fingerprint = registry.table_fingerprint(
        prepared.features, [ID, "part", *encoding.input_columns(features)]
    ).first()
    publish(
        PipelineModel(stages=[*prepared.preprocessor.stages, *model.stages]),
        prepared.schema,
        found.best.params,
        record,
        fingerprint.asDict(),
        instant,
        models_dir,
        registry_path,
        held_out_reference,
    )
    registry.append_run_metrics(spark, runs_path, run_id, "train", record)
    return run_id
