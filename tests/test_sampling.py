import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenura.functions import hash_order
from tenura.operators import sampling


def people(spark, n=20_000):
    return spark.range(n).selectExpr("CAST(id AS STRING) AS id", "id % 4 = 0 AS y")


def brute_force(df, seed):
    order = [hash_order(F.col("id"), seed), F.col("id")]
    return df.withColumn("nth", F.row_number().over(Window.partitionBy("y").orderBy(*order)))


def test_split_is_exact_and_equals_a_full_sort(spark):
    df = people(spark)
    split = sampling.stratified_split(df, "id", "y", 0.2, 42)
    counts = {(r.y, r.part): r["count"] for r in split.groupBy("y", "part").count().collect()}
    assert counts[(True, "test")] == 1_000 and counts[(False, "test")] == 3_000
    expected = brute_force(split, 42).withColumn(
        "expected", F.when(F.col("nth") <= F.when(F.col("y"), 1000).otherwise(3000), "test")
        .otherwise("train"),
    )
    assert expected.where("part <> expected").count() == 0


def test_split_does_not_depend_on_partitions(spark):
    df = people(spark, 3_000)
    a = sampling.stratified_split(df, "id", "y")
    b = sampling.stratified_split(df.repartition(13), "id", "y")
    assert a.exceptAll(b).count() == 0
    other = sampling.stratified_split(df, "id", "y", seed=7)
    assert a.exceptAll(other).count() > 0


def test_total_of_the_split_rounds_up():
    assert sum(sampling.quotas({False: 5174, True: 1863}, 0.2).values()) == 1408
    assert sampling.quotas({False: 5, True: 5}, 0.1) == {False: 1, True: 0}


def test_label_without_quota_trains(spark):
    df = spark.createDataFrame([(str(i), i == 0) for i in range(10)], "id STRING, y BOOLEAN")
    split = sampling.stratified_split(df, "id", "y", 0.2)
    assert split.where("y AND part = 'test'").count() == 0
    assert split.where("part = 'test'").count() == 2


def test_folds_equal_a_full_sort(spark):
    df = people(spark, 10_003)
    folded = sampling.stratified_folds(df, "id", "y", 5, 42)
    n = F.count("*").over(Window.partitionBy("y"))
    expected = brute_force(folded, 42).withColumn(
        "expected", F.floor((F.col("nth") - 1) * 5 / n)
    )
    assert expected.where("fold <> expected").count() == 0
    sizes = [r["count"] for r in folded.groupBy("y", "fold").count().collect()]
    assert len(sizes) == 10
    for label in (True, False):
        per_fold = [
            r["count"] for r in folded.where(F.col("y") == label).groupBy("fold").count().collect()
        ]
        assert max(per_fold) - min(per_fold) <= 1


def test_too_few_rows_for_the_folds(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "id STRING, y BOOLEAN")
    with pytest.raises(ValueError, match="at least 5"):
        sampling.stratified_folds(df, "id", "y", 5)


def test_rows_without_a_label_are_an_error(spark):
    df = spark.createDataFrame([("a", True), ("b", None)], "id STRING, y BOOLEAN")
    with pytest.raises(ValueError, match="without a label"):
        sampling.stratified_split(df, "id", "y")


def test_repeats_shuffle_differently(spark):
    folded = sampling.repeated_folds(people(spark, 500), "id", "y", 5, 2)
    assert folded.count() == 1_000
    both = folded.groupBy("id").pivot("repeat", [0, 1]).agg(F.first("fold"))
    assert 0 < both.where("`0` <> `1`").count() < 500


def test_the_assignment_needs_no_shuffle(spark):
    split = sampling.stratified_split(people(spark, 1_000), "id", "y")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert math.isclose(split.where("part = 'test'").count(), 200)


def test_fold_matrix_holds_the_inner_folds_of_every_fold(spark):
    draw = random.Random(4)
    rows = [(f"id{i}", draw.random() < 0.3) for i in range(137)]
    df = spark.createDataFrame(rows, "id STRING, y BOOLEAN")
    for folds, inner_folds in ((5, 5), (3, 4)):
        found = {r.id: r for r in sampling.fold_matrix(df, "id", "y", folds, inner_folds, 7).collect()}
        plain = {r.id: r.fold for r in sampling.stratified_folds(df, "id", "y", folds, 7).collect()}
        assert {k: r.fold for k, r in found.items()} == plain
        for f in range(folds):
            others = df.where(F.col("id").isin([k for k, v in plain.items() if v != f]))
            inner = {r.id: r.fold for r in sampling.stratified_folds(others, "id", "y", inner_folds, 7).collect()}
            assert {k: r.inner[f] for k, r in found.items() if r.fold != f} == inner
            assert all(r.inner[f] is None for r in found.values() if r.fold == f)
    with pytest.raises(ValueError, match="too few rows"):
        sampling.fold_matrix(df.limit(4), "id", "y")
