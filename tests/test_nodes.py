"""Ensembles as rows: walked by Spark, by joins and by DuckDB; first-order check of a logistic fit."""

import random

import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.operators import models, nodes


@pytest.fixture(scope="module")
def frame(spark):
    draw = random.Random(8)
    rows = []
    for i in range(400):
        a, b, c = draw.random(), draw.gauss(0, 1), float(draw.random() < 0.4)
        y = float(draw.random() < 1 / (1 + 2.7 ** -(3 * a - 2 + b * c)))
        rows.append((f"c{i:03d}", a, b, c, y))
    df = spark.createDataFrame(rows, "customer_id STRING, a DOUBLE, b DOUBLE, c DOUBLE, label DOUBLE")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return models.model_frame(vectors.drop("a", "b", "c").withColumn("fold", F.hash("customer_id") % 2))


CANDIDATES = [
    models.random_forest(trees=7, depth=6),
    models.random_forest(trees=3),
    models.boosted_trees(trees=6, depth=3),
]


@pytest.mark.parametrize("candidate", CANDIDATES, ids=lambda c: f"{c.name}-{c.params['depth']}")
def test_walks_agree_with_the_model(frame, candidate):
    model = models.fit(candidate, frame)
    table, boosted = nodes.node_table(model), nodes.is_boosted(model)
    wanted = {r[0]: r[1] for r in models.predict(model, frame, ["customer_id"]).collect()}
    folded = nodes.walk(table, frame, ["customer_id"], boosted, model.getMaxDepth())
    assert {r[0]: r[1] for r in folded.collect()} == pytest.approx(wanted, abs=1e-12)
    if model.getMaxDepth() <= 6:
        joined = nodes.walk(table, frame, ["customer_id"], boosted, model.getMaxDepth(), carried=0)
        assert {r[0]: r[1] for r in joined.collect()} == pytest.approx(wanted, abs=1e-12)
    # DuckDB walks the same rows recursively.
    duck = duckdb.connect()
    node_rows = table.select("tree", "node", "feature", "cut", "left", "right", "value", "weight").toPandas()
    inputs = frame.select("customer_id", vector_to_array("features").alias("x")).toPandas()
    duck.register("node_rows", node_rows)
    duck.register("inputs", inputs)
    margin = "1 / (1 + exp(-2 * sum(weight * value)))" if boosted else "sum(weight * value) / sum(weight)"
    walked = duck.execute(f"""
        WITH RECURSIVE reached AS (
          SELECT customer_id, x, tree, 0 AS node FROM inputs, (SELECT DISTINCT tree FROM node_rows)
          UNION ALL
          SELECT customer_id, x, tree, CASE WHEN x[CAST(feature AS INT) + 1] <= cut THEN n."left" ELSE n."right" END
          FROM reached JOIN node_rows n USING (tree, node) WHERE n."left" >= 0)
        SELECT customer_id, {margin} FROM reached JOIN node_rows n USING (tree, node) WHERE n."left" < 0
        GROUP BY customer_id""").fetchall()
    assert dict(walked) == pytest.approx(wanted, abs=1e-12)


def test_calibrated_forests_are_walked(frame):
    model = models.fit_calibrated(CANDIDATES[0], frame, 2)
    wanted = {r[0]: r[1] for r in models.calibrated_scores(model, frame, ["customer_id"]).collect()}
    walked = nodes.walk_calibrated(model, frame, "customer_id", 6)
    assert {r[0]: r[1] for r in walked.collect()} == pytest.approx(wanted, abs=1e-12)


def test_split_on_categories(spark):
    """A set of categories goes left, whatever their order."""
    table = spark.createDataFrame(
        [
            (0, 0, 0, None, [2.0, 0.0], 1, 2, 0.5, 1.0, 4),
            (0, 1, None, None, None, -1, -1, 0.25, 1.0, 2),
            (0, 2, None, None, None, -1, -1, 0.75, 1.0, 2),
        ],
        "tree INT, node INT, feature INT, cut DOUBLE, categories ARRAY<DOUBLE>, left INT, right INT, "
        "value DOUBLE, weight DOUBLE, n_rows BIGINT",
    )
    rows = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 2.0)], "customer_id STRING, v DOUBLE")
    rows = VectorAssembler(inputCols=["v"], outputCol="features").transform(rows)
    for carried in (0, 10):
        got = dict(map(tuple, nodes.walk(table, rows, ["customer_id"], False, 1, carried=carried).collect()))
        assert got == {"a": 0.25, "b": 0.75, "c": 0.25}


def test_first_order(frame):
    names = ["a", "b", "c"]
    tight = models.fit(models.logistic_regression(max_iter=1000, tol=1e-12), frame)
    for row in models.first_order(tight, frame, 1.0, names).collect():
        assert row.observed == pytest.approx(row.fitted, abs=1e-6)
    loose = models.fit(models.logistic_regression(max_iter=1), frame)
    gaps = [abs(r.observed - r.fitted) for r in models.first_order(loose, frame, 1.0, names).collect()]
    assert max(gaps) > 1e-3
