"""Numbers that some rows lack, as customers with orders but no lines do: they are rare, so large tables have them."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from catalog.preparation import features
from tenura.operators import encoding, models, profile
from tenura.plans import scoring, training

ID = "customer_id"


def pearson(pairs):
    n = len(pairs)
    x, y = (sum(p[i] for p in pairs) / n for i in (0, 1))
    xy = sum((a - x) * (b - y) for a, b in pairs)
    return xy / math.sqrt(sum((a - x) ** 2 for a, _ in pairs) * sum((b - y) ** 2 for _, b in pairs))


@pytest.fixture(scope="module")
def numbers():
    rows = [(float(i), float(i * i % 7), float((i * 5) % 11), 4.0) for i in range(30)]
    rows = [(a, None if i % 4 == 1 else b, None if i in (1, 2, 8) else c, d) for i, (a, b, c, d) in enumerate(rows)]
    return rows


def test_pairs_are_correlated_over_the_rows_with_both(spark, numbers, monkeypatch):
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(*r, None) for r in numbers], ", ".join(f"{n} DOUBLE" for n in names))
    vector = array_to_vector(F.array(*[F.coalesce(n, F.lit(float("nan"))) for n in names]))
    for at_once in (1, 3, 100):
        monkeypatch.setattr(profile, "_PAIRS_AT_ONCE", at_once)
        for found in (
            profile.correlations(df.repartition(3), names),
            profile.vector_correlations(df.select(vector.alias("v")), "v", names),
        ):
            got = {(r.a, r.b): r.r for r in found.collect()}
            assert len(got) == 10
            for pair, r in got.items():
                i, j = map(names.index, pair)
                if {"d", "e"} & set(pair):  # constant, and without any value
                    assert r is None
                else:
                    both = [(x[i], x[j]) for x in numbers if x[i] is not None and x[j] is not None]
                    assert r == pytest.approx(pearson(both), abs=1e-12)


def test_scaler_leaves_missing_numbers_out(spark):
    df = spark.createDataFrame([(1.0, 2.0, True), (None, 4.0, None), (4.0, 9.0, True)], "x DOUBLE, y DOUBLE, b BOOLEAN")
    scaler = encoding.fit_scaler(df, ["x", "y", "b"], missing="skip")
    assert scaler["x"] == pytest.approx((2.5, 1.5)) and scaler["b"] == (1.0, 1.0)
    assert scaler["y"] == encoding.fit_scaler(df, ["y"])["y"]
    assert [r.x for r in encoding.scale(df, scaler, []).collect()] == [-1.0, None, 1.0]
    with pytest.raises(ValueError, match="no values"):
        encoding.fit_scaler(df.withColumn("x", F.lit(None).cast("double")), ["x"], missing="skip")


@pytest.fixture(scope="module")
def lacking(spark, sf_dir):
    """The feature table with every ninth age missing."""
    key = F.col(ID).cast("int")
    return features(spark, sf_dir).withColumn("age", F.when(key % 9 != 2, F.col("age")))


@pytest.fixture(scope="module")
def ready(lacking):
    return training.prepare(lacking, folds=2)


def test_a_missing_number_counts_as_the_mean(ready):
    place = encoding.feature_names(ready.preprocessor).index("age")
    train = ready.part("train").drop("part")
    rows = encoding.assemble(ready.preprocessor, train, [ID, "age", encoding.ENCODED]).collect()
    ages = [r.age for r in rows if r.age is not None]
    mean = sum(ages) / len(ages)
    deviation = math.sqrt(sum((a - mean) ** 2 for a in ages) / len(ages))
    assert 0 < len(ages) < len(rows)
    for r in rows:
        own, filled = r[encoding.ENCODED][place], r.features[place]
        assert filled == 0.0 and math.isnan(own) if r.age is None else own == filled
        assert r.age is None or own == pytest.approx((r.age - mean) / deviation)


def test_models_are_fitted_and_score_rows_that_lack_a_number(ready):
    assert [s.name for s in ready.schema if s.nullable] == ["age", "offer", "internet_type"]
    fitted = models.fit_calibrated(models.logistic_regression(max_iter=10), ready.frame, 2)
    whole = PipelineModel(stages=[*ready.preprocessor.stages, *fitted.stages])
    population = scoring.scoring_population(ready.features, ready.schema)
    assert not population.where("age IS NULL").isEmpty()
    scored = scoring.score_batch(population, whole, ready.schema, 0.1)
    assert scored.count() == population.count()


def test_first_order_is_over_the_rows_with_a_value(ready):
    model = models.fit(models.logistic_regression(max_iter=1000, tol=1e-12), ready.frame)
    names = encoding.feature_names(ready.preprocessor)
    train = ready.part("train")
    present = {"age": train.where("age IS NOT NULL").count()}
    row = models.first_order(model, ready.frame, 1.0, names, present).where("feature = 'age'").first()
    labelled = train.withColumn("y", F.col(encoding.TARGET).cast("double")).drop("part")
    own = encoding.assemble(ready.preprocessor, labelled, ["age", "y"]).where("age IS NOT NULL").collect()
    place = names.index("age")
    assert row.observed == pytest.approx(sum(r.features[place] * r.y for r in own) / len(own), abs=1e-12)
    assert row.fitted == pytest.approx(row.observed, abs=1e-6)
