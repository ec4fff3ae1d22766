"""The two published outputs of a scoring run: the ranked list and the run summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions import check_fraction, count_where, require_run_id
from tenura.operators.quality import check_metrics

# The columns of the list and the texts of the summary.
LIST_COLUMNS = ["customer_id", "churn_probability", "rank", "in_top_k"]
LIST_SCHEMA = "customer_id STRING, churn_probability DOUBLE, rank BIGINT, in_top_k STRING"
CONTRACT_VERSION = "1"
SNAPSHOT_NOTICE = (
    "Historical snapshot: this list scores the held-out test split for demonstration. "
    "It is not a live outreach list."
)
HEALTH_KEYS = [
    "trained_at_utc",
    "package_version",
    "training_cv_metrics",
    "held_out_results_reference",
]


def write_list(ranked: DataFrame, path: str) -> None:
    """Write the list as CSV parts in ascending rank, flags as True or False."""
    flag = F.when(F.col("in_top_k"), "True").otherwise("False")
    (
        ranked.select("customer_id", "churn_probability", "rank", flag.alias("in_top_k"))
        .repartitionByRange("rank")
        .sortWithinPartitions("rank")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


def read_list(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(LIST_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def check_health(health: dict) -> None:
    """The training facts that the summary repeats: exact keys, usable values."""
    if set(health) != set(HEALTH_KEYS):
        raise ValueError(f"model health must have the keys {HEALTH_KEYS}, got {sorted(health)}")
    datetime.strptime(health["trained_at_utc"], "%Y-%m-%dT%H:%M:%SZ")
    for key in ("package_version", "held_out_results_reference"):
        if not health[key]:
            raise ValueError(f"{key} must not be empty")
    check_metrics(health["training_cv_metrics"])


def run_summary(
    ranked: DataFrame, fraction: float, model_run_id: str, scoring_run_id: str, health: dict
) -> DataFrame:
    """One row: how many customers were scored and flagged, by which model, and its health."""
    counts = ranked.agg(
        F.count("*").alias("customers_scored"),
        count_where(F.col("in_top_k")).alias("customers_flagged"),
    )
    return summary_of(counts, fraction, model_run_id, scoring_run_id, health)


def summary_of(
    counts: DataFrame, fraction: float, model_run_id: str, scoring_run_id: str, health: dict
) -> DataFrame:
    """The same from a row ``customers_scored, customers_flagged`` that is known already."""
    require_run_id(model_run_id)
    require_run_id(scoring_run_id)
    check_health(health)
    metrics = F.struct(
        *[F.lit(v).alias(k) for k, v in health["training_cv_metrics"].items()]
    )
    return counts.select(
        F.lit(CONTRACT_VERSION).alias("contract_version"),
        F.lit(check_fraction(fraction)).alias("k"),
        "customers_scored",
        "customers_flagged",
        F.lit(model_run_id).alias("model_run_id"),
        F.lit(scoring_run_id).alias("scoring_run_id"),
        F.lit(SNAPSHOT_NOTICE).alias("snapshot_notice"),
        F.struct(
            F.lit(health["trained_at_utc"]).alias("trained_at_utc"),
            F.lit(health["package_version"]).alias("package_version"),
            metrics.alias("training_cv_metrics"),
            F.lit(health["held_out_results_reference"]).alias("held_out_results_reference"),
        ).alias("model_health"),
    )


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)
