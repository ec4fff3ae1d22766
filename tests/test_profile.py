"""Sums per column, long crosstabs and dictionaries of categories."""

import random
from collections import Counter

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tenura.operators import encoding, models, profile


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    pick = lambda values: draw.choice(values)
    return [
        (pick(["x", "y", None]), pick([1, 2, 3, None]), pick(["", "x"]), pick([True, False, None])) for _ in range(500)
    ]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "a STRING, b INT, _c1 STRING, hit BOOLEAN").repartition(5)


def test_rates_per_value_of_each_column(frame, rows):
    wanted = {}
    for place, column in enumerate(("a", "b", "_c1")):
        for value in {r[place] for r in rows} - {None}:
            hits = [r[3] for r in rows if r[place] == value and r[3] is not None]
            wanted[column, str(value)] = (len(hits), 100 * sum(hits) / len(hits))
    got = profile.rates_by_value(frame, ["a", "b", "_c1"], "hit").collect()
    assert {(r.feature, r.value): r.n_rows for r in got} == {k: n for k, (n, _) in wanted.items()}
    assert {(r.feature, r.value): r.rate_pct for r in got} == pytest.approx({k: p for k, (_, p) in wanted.items()})
    counts = profile.distinct_values(frame, ["a", "b"]).collect()
    assert {(r.column, r.value): r.n_rows for r in counts} == Counter(
        (c, str(r[i])) for r in rows for i, c in enumerate("ab") if r[i] is not None
    )
    assert profile.distinct_values(frame.limit(0), ["a"]).count() == 0


def test_crosstab_is_complete(frame, rows):
    got = {(r.a, r.b): r.n_rows for r in profile.crosstab(frame.where("a IS NULL OR b <> 3"), "a", "b").collect()}
    kept = Counter((r[0], r[1]) for r in rows if r[0] is None or r[1] not in (3, None))
    assert set(got) == {(a, b) for a in ("x", "y", None) for b in (1, 2, 3)}
    assert got == {k: kept.get(k, 0) for k in got} and got["x", 3] == 0


def test_dictionary_numbers_values_in_order(spark):
    values = [f"v{i}" for i in range(20_000)] + ["é", "", "Z"]
    wide = spark.createDataFrame([(v,) for v in values], "w STRING").withColumn("n", F.length("w"))
    dictionary = encoding.category_dictionary(wide.union(wide.limit(50)), ["w", "n"])
    found = {r.value: r["index"] for r in dictionary.where("column = 'w'").collect()}
    order = sorted(values, key=lambda v: v.encode())
    assert found == {v: i for i, v in enumerate(order)}
    new = spark.createDataFrame([("v7", 2), ("unknown", 99), (None, None)], "w STRING, n INT")
    for carried in (0, 10**6):
        got = encoding.encode_categories(new, dictionary, ["w", "n"], carried).collect()
        assert {(r.w, r.w_index is not None, r.n_index is not None) for r in got} == {
            ("v7", True, True), ("unknown", False, False), (None, False, False)
        }
        assert next(r.w_index for r in got if r.w == "v7") == found["v7"]


def test_models_score_in_a_session_that_has_observed(spark):
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3}
    df = spark.range(60).selectExpr("CAST(id AS STRING) AS customer_id", "CAST(id % 7 AS DOUBLE) AS x",
                                    "CAST(id % 2 AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    for candidate in (models.logistic_regression(), models.random_forest(trees=2, depth=2)):
        assert models.predict(models.fit(candidate, df), df, ["customer_id"]).count() == 60
