"""Run and model registries as Parquet tables, and fingerprints of tables and schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import __version__
from tenura.functions import is_run_id, require_run_id, run_id_of
from tenura.operators.encoding import schema_frame, schema_from_text, schema_text
from tenura.operators.quality import InputColumn, check_metrics, metrics_from_texts
from tenura.sources.workspace import exists

# What a model run leaves behind: how to load it, what it accepts, how it was made.
MODEL_ROW = (
    "run_id STRING, trained_at_utc STRING, package_version STRING, model_path STRING, "
    "input_schema STRING, input_schema_hash STRING, hyperparameters MAP<STRING, STRING>, "
    "training_cv_metrics MAP<STRING, STRING>, held_out_results_reference STRING, "
    "fingerprints MAP<STRING, STRING>, complete BOOLEAN"
)
# The headline numbers of a run of any type, written once and last.
RUN_ROW = "run_id STRING, run_type STRING, metrics MAP<STRING, STRING>"


def append_rows(rows: DataFrame, path: str) -> None:
    """Add the rows to the registry table at ``path``."""
    rows.write.mode("append").parquet(path)


def read_registry(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def require_new_run(spark: SparkSession, path: str, run_id: str, schema) -> None:
    """An error if the registry already has the run."""
    require_run_id(run_id)
    if exists(spark, path):
        rows = read_registry(spark, path, schema).where(F.col("run_id") == run_id)
        if not rows.isEmpty():
            raise ValueError(f"run {run_id} is already in {path}")


def _texts(values: Mapping[str, object]) -> dict:
    return {k: None if v is None else str(v) for k, v in values.items()}


def model_row(
    spark: SparkSession,
    instant: datetime,
    model_path: str,
    specs: Sequence[InputColumn],
    hyperparameters: Mapping[str, object],
    metrics: Mapping[str, object],
    held_out_reference: str,
    fingerprints: Mapping[str, object],
) -> DataFrame:
    """One row that describes a published model; id and training time are one instant."""
    check_metrics(metrics)
    run_id = run_id_of(instant)
    return spark.createDataFrame(
        [
            (
                run_id,
                instant.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
                __version__,
                model_path,
                schema_text(specs),
                schema_hash(spark, specs),
                _texts(hyperparameters),
                _texts(metrics),
                held_out_reference,
                _texts(fingerprints),
                True,
            )
        ],
        MODEL_ROW,
    )


def append_run_metrics(
    spark: SparkSession, path: str, run_id: str, run_type: str, metrics: Mapping[str, object]
) -> None:
    """Record a finished run; a run is recorded once."""
    require_new_run(spark, path, run_id, RUN_ROW)
    append_rows(spark.createDataFrame([(run_id, run_type, _texts(metrics))], RUN_ROW), path)


@dataclass(frozen=True)
class LoadedRun:
    """A published run, ready to score."""

    run_id: str
    model: PipelineModel
    specs: list[InputColumn]
    health: dict


def load_run(spark: SparkSession, registry_path: str, run_id: str | None = None) -> LoadedRun:
    """The requested run or the latest usable one, with its schema checked against its hash."""
    if not exists(spark, registry_path):
        raise LookupError(f"no registry at {registry_path}")
    runs = read_registry(spark, registry_path, MODEL_ROW)
    lost: list[str] = []
    while True:  # newest first, until a run still has its model
        chosen = select_run(runs, run_id, lost)
        rows = runs.where((F.col("run_id") == chosen) & F.col("complete")).limit(2).collect()
        if len(rows) > 1:
            raise ValueError(f"run {chosen} is registered more than once")
        row = rows[0]
        if exists(spark, f"{row.model_path}/metadata"):
            break
        lost.append(chosen)
    specs = schema_from_text(row.input_schema)
    if schema_hash(spark, specs) != row.input_schema_hash:
        raise ValueError(f"the input schema of run {chosen} does not match its hash")
    health = {
        "trained_at_utc": row.trained_at_utc,
        "package_version": row.package_version,
        "training_cv_metrics": metrics_from_texts(row.training_cv_metrics),
        "held_out_results_reference": row.held_out_results_reference,
    }
    return LoadedRun(chosen, PipelineModel.load(row.model_path), specs, health)


def run_problem(lost: Sequence[str] = ()) -> Column:
    """Why a registry row ``(run_id, complete)`` is not a usable run, or NULL.

    ``lost`` names runs whose model files are gone.
    """
    problem = F.when(~is_run_id(F.col("run_id")), "not a run id").when(
        ~F.coalesce(F.col("complete"), F.lit(False)), "incomplete"
    )
    return problem.when(F.col("run_id").isin(list(lost)), "model gone") if lost else problem


def run_report(registry: DataFrame) -> DataFrame:
    """Rows and the highest id per problem; NULL is the group of the usable runs."""
    return registry.groupBy(run_problem().alias("problem")).agg(
        F.count("*").alias("runs"), F.max("run_id").alias("highest_id")
    )


def latest_valid_run(
    registry: DataFrame, run_id: str | None = None, lost: Sequence[str] = ()
) -> DataFrame:
    """One row: the requested run, or the highest usable id; never another than requested."""
    usable = registry.where(run_problem(lost).isNull())
    if run_id is not None:
        usable = usable.where(F.col("run_id") == run_id)
    return usable.agg(F.max("run_id").alias("run_id"), F.count("*").alias("usable_rows"))


def select_run(
    registry: DataFrame, run_id: str | None = None, lost: Sequence[str] = ()
) -> str:
    found = latest_valid_run(registry, run_id, lost).first().run_id
    if found is None:
        raise LookupError(f"no usable run {run_id!r}" if run_id else "no usable run")
    return found


def table_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows and four order-insensitive sums over a hash of every row.

    Every value enters with its length, a NULL without one, so no two rows share a text.
    """
    cells = []
    for c in columns:
        text = F.col(c).cast("string")
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N")))
    hashed = df.select(F.md5(F.concat_ws(";", *cells)).alias("h"))

    def part(i):
        number = F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("string").alias(f"sum_{i + 1}")

    return hashed.agg(F.count("*").alias("n_rows"), *[part(i) for i in range(4)])


def schema_fingerprint(schema: DataFrame) -> DataFrame:
    """One row: a hash of the schema that does not depend on the order of its rows.

    The schema has one row per column, so its text fits in one value.
    """
    line = F.to_json(
        F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(schema.columns)])
    )
    lines = F.array_join(F.sort_array(F.collect_list(line)), "\n")
    return schema.agg(F.count("*").alias("columns"), F.sha2(lines, 256).alias("schema_hash"))


def schema_hash(spark: SparkSession, specs: Sequence[InputColumn]) -> str:
    return schema_fingerprint(schema_frame(spark, specs)).first().schema_hash
