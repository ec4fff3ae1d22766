import pytest
from pyspark.sql import functions as F

from tenura.functions import top_k_count
from tenura.operators import metrics

Y = [1, 0, 0, 1, 0, 1, 0, 0]
SCORE = [8, 7, 3, 6, 1, 2, 5, 4]


def frame(spark, y, score, candidate="m"):
    rows = [(candidate, i, a, float(b)) for i, (a, b) in enumerate(zip(y, score, strict=True))]
    return spark.createDataFrame(rows, "candidate STRING, id BIGINT, y INT, score DOUBLE")


def test_rates_at_half(spark):
    row = metrics.sensitivity(frame(spark, Y, SCORE), [0.5]).first()
    assert (row.precision, row.lift) == (0.5, pytest.approx(4 / 3))
    assert (row.tp, row.fp, row.tn, row.fn) == (2, 2, 3, 1)
    assert row.recall == pytest.approx(2 / 3)
    assert row.f1 == pytest.approx(4 / 7)


def test_order_of_k_is_kept(spark):
    rows = metrics.sensitivity(frame(spark, Y, SCORE), [0.25, 0.75, 0.5]).orderBy("k_order")
    assert [r.k_frac for r in rows.collect()] == [0.25, 0.75, 0.5]


def test_k_is_at_least_one_row(spark):
    row = metrics.sensitivity(frame(spark, [0, 1, 0], [2, 7, 4]), [0.2]).first()
    assert (row.k, row.precision) == (1, 1.0)


@pytest.mark.parametrize("fraction", [0, -0.5, 2, True])
def test_bad_k(spark, fraction):
    with pytest.raises(ValueError):
        metrics.sensitivity(frame(spark, Y, SCORE), [fraction])


@pytest.mark.parametrize(
    ("n", "fraction", "k"),
    [
        (1500, 0.10, 150),
        (333, 0.10, 33),
        (35, 0.10, 4),
        (45, 0.10, 4),
        (1, 0.20, 1),
        (2, 0.20, 1),
        (8, 1.0, 8),
        (6, 0.25, 2),
    ],
)
def test_top_k_count(spark, n, fraction, k):
    assert spark.range(1).select(top_k_count(F.lit(n), fraction)).first()[0] == k


def test_brier(spark):
    df = frame(spark, [0, 1, 1, 0, 1], [0.2, 0.7, 0.5, 0.1, 1.0])
    assert metrics.evaluate(df, [0.5]).first().brier_score == pytest.approx(0.078)


def test_average_precision_by_hand_with_ties(spark):
    # Groups by score: 0.9 -> 1 of 1; 0.5 -> 1 of 2; 0.1 -> 1 of 1.
    df = frame(spark, [1, 1, 0, 1], [0.9, 0.5, 0.5, 0.1])
    expected = (1 * 1 / 1 + 1 * 2 / 3 + 1 * 3 / 4) / 3
    assert metrics.average_precision(df).first().pr_auc == pytest.approx(expected)


def test_no_positives(spark):
    row = metrics.evaluate(frame(spark, [0, 0], [1, 2]), [0.5]).first()
    assert row.lift is None and row.pr_auc is None
    assert (row.recall, row.f1) == (0.0, 0.0)


def test_missing_and_nan_scores_are_an_error(spark):
    rows = [("m", 1, 1, None), ("m", 2, 0, float("nan")), ("m", 3, None, 0.5)]
    df = spark.createDataFrame(rows, "candidate STRING, id BIGINT, y INT, score DOUBLE")
    found = metrics.incomplete_rows(df).first()
    assert (found.label_missing, found.score_missing, found.score_nan) == (1, 1, 1)
    with pytest.raises(ValueError, match="pair up"):
        metrics.require_complete(df)


def test_baseline_has_no_delta(spark):
    both = frame(spark, Y, SCORE).unionByName(frame(spark, Y, SCORE[::-1], "base"))
    compared = metrics.compare(metrics.evaluate(both, [0.5]), "base")
    rows = {r.candidate: r for r in compared.collect()}
    assert rows["base"].precision_delta is None
    assert rows["m"].precision_delta == pytest.approx(0.5 - rows["base"].precision)
    lines = {r.candidate: r for r in metrics.comparison_lines(compared).collect()}
    assert lines["base"].lift_delta == "n/a"
    assert lines["m"].precision_delta.startswith("+")


def test_average_precision_from_ranks_is_the_same(spark):
    df = spark.range(5_000).selectExpr(
        "IF(id % 3 = 0, 'a', 'b') AS candidate", "id", "CAST(hash(id) % 7 = 0 AS INT) AS y",
        "CAST(pmod(hash(id, 1), IF(id % 3 = 0, 2, 900)) AS DOUBLE) AS score",
    )
    direct = {r.candidate: r.pr_auc for r in metrics.average_precision(df).collect()}
    from_ranks = {r.candidate: r.pr_auc for r in metrics.evaluate(df, [0.1]).collect()}
    assert from_ranks == pytest.approx(direct)
