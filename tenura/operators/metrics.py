"""Ranking quality of scored rows ``(candidate, id, y, score)``.

``y`` is 0 or 1. Rows are ranked once; every K and every metric is then a
conditional sum over the ranks, in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions import check_fraction, count_where, log_loss_term, ratio, top_k_count
from tenura.operators.ranking import quantile_bins, rank_scores, running_totals
from tenura.sources.workspace import store

CANDIDATE = "candidate"

# The operating point and the sweep of outreach capacities.
DEFAULT_K = 0.10
K_SWEEP = (0.05, 0.10, 0.15, 0.20, 0.25)


def incomplete_rows(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """One row: how many rows lack the label, the score, or hold a NaN score."""
    return df.agg(
        F.count("*").alias("n_rows"),
        count_where(F.col(label).isNull()).alias("label_missing"),
        count_where(F.col(score).isNull()).alias("score_missing"),
        count_where(F.isnan(F.col(score).cast("double"))).alias("score_nan"),
    )


def require_complete(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """The frame itself, or an error when labels and scores do not pair up."""
    found = incomplete_rows(df, label, score).first()
    if found.label_missing or found.score_missing or found.score_nan:
        raise ValueError(
            f"labels and scores must pair up: {found.label_missing} label(s) and "
            f"{found.score_missing} score(s) missing, {found.score_nan} score(s) NaN"
        )
    return df


def counts_at_k(
    ranked: DataFrame, fractions: Sequence[float], group: Sequence[str] = (CANDIDATE,)
) -> DataFrame:
    """One row per group and K, in the order given: rows, positives, k and hits.

    ``ranked`` holds ``y``, ``score``, ``rank`` and ``n_rows``.
    """
    sums = [
        F.max("n_rows").alias("n_rows"),
        F.sum("y").cast("bigint").alias("positives"),
        F.avg((F.col("score") - F.col("y")) ** 2).alias("brier_score"),
    ]
    for i, fraction in enumerate(fractions):
        inside = F.col("rank") <= top_k_count(F.col("n_rows"), fraction)
        sums.append(count_where(inside & (F.col("y") == 1)).alias(f"_hits_{i}"))
    wide = ranked.groupBy(*group).agg(*sums)
    sweep = F.array(
        *[
            F.struct(
                F.lit(i).alias("k_order"),
                F.lit(check_fraction(fraction)).alias("k_frac"),
                top_k_count(F.col("n_rows"), fraction).alias("k"),
                F.col(f"_hits_{i}").alias("tp"),
            )
            for i, fraction in enumerate(fractions)
        ]
    )
    return wide.select(
        *group, "n_rows", "positives", "brier_score", F.inline(sweep)
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """The confusion counts and the rates that follow from them."""
    tp, k, positives = F.col("tp"), F.col("k"), F.col("positives")
    precision = ratio(tp, k)
    recall = F.coalesce(ratio(tp, positives), F.lit(0.0))
    return counts.withColumns(
        {
            "fp": k - tp,
            "fn": positives - tp,
            "tn": F.col("n_rows") - k - positives + tp,
            "precision": precision,
            "recall": recall,
            "f1": F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0)),
            "lift": ratio(precision, ratio(positives, F.col("n_rows"))),
        }
    )


def average_precision(
    df: DataFrame, label: str = "y", score: str = "score", group: Sequence[str] = (CANDIDATE,)
) -> DataFrame:
    """One row per group: average precision over distinct scores; NULL without positives."""
    by_score = df.groupBy(*group, score).agg(
        F.count("*").alias("n"), F.sum(label).cast("bigint").alias("pos")
    )
    steps = running_totals(by_score, F.col(score).desc(), ["n", "pos"], group)
    gain = F.col("pos") * ratio(F.col("cum_pos"), F.col("cum_n"))
    return steps.groupBy(*group).agg(
        ratio(F.sum(gain), F.max("all_pos")).alias("pr_auc")
    )


def average_precision_of_ranked(
    ranked: DataFrame, group: Sequence[str] = (CANDIDATE,)
) -> DataFrame:
    """The same from ranked rows: the last rank of a score is its cumulative row count.

    Only scores that some positive holds go on to the cumulative sum; a group
    without positives has no row.
    """
    by_score = (
        ranked.groupBy(*group, "score")
        .agg(F.max("rank").alias("cum_n"), F.sum("y").cast("bigint").alias("pos"))
        .where("pos > 0")
    )
    steps = running_totals(by_score, F.col("score").desc(), ["pos"], group)
    gain = F.col("pos") * ratio(F.col("cum_pos"), F.col("cum_n"))
    return steps.groupBy(*group).agg(ratio(F.sum(gain), F.max("all_pos")).alias("pr_auc"))


def evaluate(
    df: DataFrame,
    fractions: Sequence[float] = K_SWEEP,
    id_column: str = "id",
) -> DataFrame:
    """All metrics of every candidate: one row per candidate and K."""
    scored = df.select(CANDIDATE, id_column, "y", "score")
    ranked = rank_scores(scored, "score", id_column, [CANDIDATE])
    rates = with_rates(counts_at_k(ranked, fractions))
    # A few rows that later steps read several times, so they are computed once.
    return store(
        rates.join(average_precision_of_ranked(ranked), CANDIDATE, "left"), "evaluation"
    )


def sensitivity(df: DataFrame, fractions: Sequence[float], id_column: str = "id") -> DataFrame:
    """The rates of one candidate for a list of K, numbered in the order given."""
    ranked = rank_scores(df.select(id_column, "y", "score"), "score", id_column)
    return with_rates(counts_at_k(ranked, fractions, ()))


def compare(evaluation: DataFrame, baseline: str) -> DataFrame:
    """Every candidate beside the baseline at the same K; no delta for the baseline."""
    base = evaluation.where(F.col(CANDIDATE) == baseline).select(
        "k_order",
        F.col("precision").alias("_precision"),
        F.col("lift").alias("_lift"),
    )
    other = F.col(CANDIDATE) != baseline
    return evaluation.join(base, "k_order").select(
        CANDIDATE,
        "k_order",
        "k_frac",
        "precision",
        "lift",
        F.when(other, F.col("precision") - F.col("_precision")).alias("precision_delta"),
        F.when(other, F.col("lift") - F.col("_lift")).alias("lift_delta"),
        "pr_auc",
        "brier_score",
    )


def comparison_lines(comparison: DataFrame) -> DataFrame:
    """The comparison as text cells: four decimals, signed deltas, n/a for the baseline."""

    def signed(name):
        return F.coalesce(F.format_string("%+.4f", F.col(name)), F.lit("n/a"))

    def plain(name):
        return F.format_string("%.4f", F.col(name))

    def delta(name):
        return F.when(F.col(name).isNull(), F.lit("n/a")).otherwise(signed(name))

    return comparison.select(
        CANDIDATE,
        "k_order",
        F.format_string("%.0f%%", F.col("k_frac") * 100).alias("k"),
        plain("precision").alias("precision_at_k"),
        plain("lift").alias("lift_at_k"),
        delta("precision_delta").alias("precision_delta"),
        delta("lift_delta").alias("lift_delta"),
        plain("pr_auc").alias("pr_auc"),
        plain("brier_score").alias("brier"),
    ).orderBy(CANDIDATE, "k_order")


def log_loss(df: DataFrame, group: Sequence[str] = (CANDIDATE,)) -> DataFrame:
    return df.groupBy(*group).agg(
        F.avg(log_loss_term(F.col("y"), F.col("score"))).alias("log_loss")
    )


def per_fold_losses(df: DataFrame, raw: str, calibrated: str) -> DataFrame:
    """Brier score and log loss of both arms in every fold, and whether the second is worse."""
    y = F.col("y")
    sums = []
    for arm, score in (("raw", raw), ("calibrated", calibrated)):
        sums.append(F.avg((F.col(score) - y) ** 2).alias(f"brier_{arm}"))
        sums.append(F.avg(log_loss_term(y, F.col(score))).alias(f"log_loss_{arm}"))
    return df.groupBy("fold").agg(F.count("*").alias("n_rows"), *sums).withColumns(
        {
            "brier_worse": F.col("brier_calibrated") > F.col("brier_raw"),
            "log_loss_worse": F.col("log_loss_calibrated") > F.col("log_loss_raw"),
        }
    )


def folds_worse(losses: DataFrame) -> DataFrame:
    """In how many folds calibration made each loss worse."""
    return losses.agg(
        F.count("*").alias("folds"),
        count_where(F.col("brier_worse")).alias("brier_worse_folds"),
        count_where(F.col("log_loss_worse")).alias("log_loss_worse_folds"),
    )


def reliability(df: DataFrame, id_column: str = "id", bins: int = 10) -> DataFrame:
    """Rows, mean score and observed rate in bins of equal row counts, lowest scores first."""
    ranked = rank_scores(df.select(id_column, "y", "score"), "score", id_column)
    lowest_first = ranked.withColumn("rank", F.col("n_rows") - F.col("rank") + 1)
    return (
        lowest_first.withColumn("bin", quantile_bins(lowest_first, bins))
        .groupBy("bin")
        .agg(
            F.count("*").alias("n_rows"),
            F.avg("score").alias("mean_score"),
            F.avg(F.col("y").cast("double")).alias("observed_rate"),
        )
    )


def gain_table(df: DataFrame, id_column: str = "id", bins: int = 10) -> DataFrame:
    """Share of the positives reached by each decile of the ranking and up to it."""
    ranked = rank_scores(df.select(id_column, "y", "score"), "score", id_column)
    deciles = (
        ranked.withColumn("decile", quantile_bins(ranked, bins))
        .groupBy("decile")
        .agg(F.count("*").alias("n_rows"), F.sum("y").cast("bigint").alias("positives"))
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    return deciles.select(
        "decile",
        "n_rows",
        "positives",
        F.sum("positives").over(upto).alias("cum_positives"),
        ratio(F.sum("positives").over(upto), F.sum("positives").over(whole)).alias("cum_share"),
    )
