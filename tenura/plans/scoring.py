"""Scoring: validate, predict, check, rank, flag, publish."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tenura.functions import count_where, run_id_of
from tenura.operators import quality
from tenura.operators.metrics import DEFAULT_K
from tenura.operators.models import ID
from tenura.operators.quality import InputColumn
from tenura.operators.ranking import flag_top
from tenura.sources import outputs, registry
from tenura.sources.registry import LoadedRun
from tenura.sources.workspace import store

PROBABILITY = "churn_probability"


def scoring_population(split: DataFrame, specs: Sequence[InputColumn]) -> DataFrame:
    """The held-out rows with id and model inputs only; no label is read."""
    return split.where(F.col("part") == "test").select(ID, *[s.name for s in specs])


def rank_customers(scored: DataFrame, fraction: float) -> DataFrame:
    """Id, probability, rank (ties by id as text) and flag."""
    return flag_top(scored.select(ID, PROBABILITY), PROBABILITY, ID, fraction).select(
        *quality.RANKED_COLUMNS
    )


def outreach_list(ranked: DataFrame) -> DataFrame:
    """The flagged customers."""
    return ranked.where("in_top_k")


def score_batch(
    df: DataFrame, model: PipelineModel, specs: Sequence[InputColumn], fraction: float
) -> DataFrame:
    """Validate the table, score it, check the probabilities, rank and flag.

    The input is read once: rows and broken rules are observed while the scores of the clean rows are
    written, the probabilities behind the model. Only repeated ids need a shuffle, of the written ids. What an
    observation finds ends the call before anything is written for the reader; the report that names
    the rule reads the input again.
    """
    names = [s.name for s in specs]
    if quality.column_problems(df.columns, [ID, *names]):
        quality.require_valid(df, ID, specs)
    seen, made = Observation("input"), Observation("scores")
    broken = quality.breaks_a_rule(df, ID, specs)
    clean = (
        df.select(ID, *names, broken.alias("_broken"))
        .observe(seen, F.count("*").alias("n_rows"), count_where(F.col("_broken")).alias("broken"))
        .where("NOT _broken")
        .drop("_broken")
    )
    scores = model.transform(clean).select(ID, PROBABILITY)
    scored = store(scores.observe(made, *quality.probability_sums(ID, PROBABILITY)), "scored")
    rows, found = seen.get, made.get
    repeated = scored.groupBy(ID).count().where("count > 1")
    if not rows["n_rows"] or rows["broken"] or not repeated.isEmpty():
        quality.require_valid(df, ID, specs)
    if found["bad"] or found["n_rows"] != rows["n_rows"]:
        raise ValueError(
            f"{found['bad']} unusable probabilities, first {found['first_id']!r}; "
            f"{found['n_rows']} rows scored of {rows['n_rows']}"
        )
    return rank_customers(scored, fraction)


def _ranked_sums() -> list[Column]:
    """What a ranked table that is being written must add up to, and its counts."""
    p, missing = F.col(PROBABILITY), F.lit(False)
    for c in quality.RANKED_COLUMNS:
        missing = missing | F.col(c).isNull()
    return [
        F.count("*").alias("customers_scored"),
        count_where(F.col("in_top_k")).alias("customers_flagged"),
        F.max("rank").alias("last"),
        F.sum(F.col("rank").cast("decimal(38,0)")).alias("ranks"),
        F.max(F.when(F.col("in_top_k"), F.col("rank"))).alias("last_flagged"),
        count_where(missing | ~F.coalesce(p.between(0.0, 1.0), F.lit(False))).alias("unusable"),
    ]


def score_run(
    population: DataFrame,
    run: LoadedRun,
    instant: datetime,
    list_path: str,
    summary_path: str,
    runs_path: str,
    fraction: float = DEFAULT_K,
) -> DataFrame:
    """Score the population with a published run: the ranked list, its summary, the run record.

    The list's counts and sums are observed while it is stored; a list whose cells, ranks or flags do not add up
    is not published.
    """
    spark = population.sparkSession
    run_id = run_id_of(instant)
    registry.require_new_run(spark, runs_path, run_id, registry.RUN_ROW)
    written = Observation("list")
    ranked = score_batch(population, run.model, run.specs, fraction).observe(written, *_ranked_sums())
    ranked = store(ranked, "ranked_list")
    sums = written.get
    n = sums["customers_scored"]
    flags = (sums["last_flagged"] or 0) == sums["customers_flagged"]
    if sums["unusable"] or sums["last"] != n or int(sums["ranks"]) != n * (n + 1) // 2 or not flags:
        wrong = quality.ranked_table_report(ranked).where("offending > 0").collect()
        raise ValueError(f"the ranked table is not usable: {[w.check for w in wrong]}, {sums}")
    counts = {k: sums[k] for k in ("customers_scored", "customers_flagged")}
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} BIGINT" for k in counts))
    summary = outputs.summary_of(row, fraction, run.run_id, run_id, run.health)
    outputs.write_list(ranked, list_path)
    outputs.write_summary(summary, summary_path)
    registry.append_run_metrics(
        spark,
        runs_path,
        run_id,
        "score",
        {"k": fraction, **counts, "model_run_id": run.run_id},
    )
    return ranked
