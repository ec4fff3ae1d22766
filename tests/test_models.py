import math
import random
from datetime import datetime, timezone

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog.modeling import example_record
from tenura.operators import encoding, metrics, models, profile, quality, sampling, selection, tuning
from tenura.plans import scoring, training
from tenura.sources import outputs, registry

RUN, LATER = "20260101T000000Z", "20260102T000000Z"
FIRST = datetime(2026, 1, 1, tzinfo=timezone.utc)
SECOND = datetime(2026, 1, 2, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def ready(spark, sf_dir):
    from catalog.preparation import features

    return training.prepare(features(spark, sf_dir), folds=2)


@pytest.fixture(scope="module")
def published(ready):
    fitted = models.fit_calibrated(models.logistic_regression(max_iter=10), ready.frame, 2)
    return PipelineModel(stages=[*ready.preprocessor.stages, *fitted.stages])


def test_one_hot_keeps_all_levels_and_ignores_unknown(spark):
    train = spark.createDataFrame(
        [("1", "a", 1.0, True), ("2", "b", 3.0, False), ("3", None, 5.0, True)],
        "customer_id STRING, offer STRING, x DOUBLE, is_voluntary_churn BOOLEAN",
    )
    model = encoding.fit_preprocessor(train, ["offer"])
    new = train.unionByName(
        spark.createDataFrame([("4", "zzz", 1.0, True)], train.schema)
    )
    rows = {
        r.customer_id: r.features.toArray().tolist()
        for r in encoding.assemble(model, new, ["customer_id"]).collect()
    }
    z = (1.0 - 3.0) / math.sqrt(8 / 3)  # population deviation
    assert rows["1"][:3] == [0, 1, 0] and rows["3"][:3] == [1, 0, 0]  # No Offer sorts first
    assert rows["4"][:3] == [0, 0, 0]
    assert rows["1"][3] == pytest.approx(z)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(7.0,), (7.0,)], "x DOUBLE")
    scaler = encoding.fit_scaler(df, ["x"])
    assert [r.x for r in encoding.scale(df, scaler, []).collect()] == [0.0, 0.0]


def test_scaler_equals_the_population_moments(spark):
    values = [0.0, 0.0, 1.5, -2.0, 7.25, 0.0, 3.0]
    df = spark.createDataFrame([(v, i % 2 == 0) for i, v in enumerate(values)], "x DOUBLE, b BOOLEAN")
    scaler = encoding.fit_scaler(df.repartition(3), ["x", "b"])
    mean = sum(values) / 7
    assert scaler["x"] == pytest.approx((mean, math.sqrt(sum((v - mean) ** 2 for v in values) / 7)))
    assert scaler["b"] == pytest.approx((4 / 7, math.sqrt(4 / 7 * 3 / 7)))
    with pytest.raises(Exception, match="null"):
        encoding.fit_scaler(spark.createDataFrame([(None,), (1.0,)], "x DOUBLE"), ["x"])


def test_untyped_input_is_an_error(spark):
    df = spark.range(1).selectExpr("'1' AS customer_id", "current_date() AS d")
    with pytest.raises(ValueError, match="no input kind"):
        encoding.input_schema(df, {})


def test_split_and_frame(ready):
    assert len(ready.schema) == 42
    train = ready.part("train")
    assert ready.frame.count() == train.count()
    assert ready.frame.select("customer_id").exceptAll(train.select("customer_id")).count() == 0


def test_sigmoid_minimises_the_smoothed_loss(spark):
    rng = random.Random(1)
    rows = [(float(rng.random() < 0.3 + 0.4 * (s > 0)), s) for s in
            [rng.uniform(-2, 2) for _ in range(400)]]
    found = models.fit_sigmoid(spark.createDataFrame(rows, "label DOUBLE, score DOUBLE"))
    n1 = sum(y for y, _ in rows)
    n0 = len(rows) - n1

    def loss(a, b):
        total = 0.0
        for y, s in rows:
            t = (n1 + 1) / (n1 + 2) if y else 1 / (n0 + 2)
            p = 1 / (1 + math.exp(-(a * s + b)))
            total -= t * math.log(p) + (1 - t) * math.log(1 - p)
        return total

    best = loss(found.slope, found.intercept)
    for da, db in [(0.05, 0), (-0.05, 0), (0, 0.05), (0, -0.05)]:
        assert best < loss(found.slope + da, found.intercept + db)


@pytest.mark.parametrize(
    "candidate",
    [
        models.logistic_regression(max_iter=10),
        models.random_forest(trees=5, depth=3),
        models.boosted_trees(trees=3, depth=2, row_share=0.8),
    ],
    ids=lambda c: c.name,
)
def test_two_fits_give_the_same_scores(ready, candidate):
    def scores():
        found = models.predict(models.fit(candidate, ready.frame), ready.frame, ["customer_id"])
        return {r.customer_id: r.score for r in found.collect()}

    a, b = scores(), scores()
    assert a == pytest.approx(b, abs=1e-9)
    assert all(0 <= p <= 1 for p in a.values())


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "label DOUBLE")
    assert models.class_weights(df) == {1.0: 2.0, 0.0: 4 / 6}


def test_out_of_fold_scores_cover_every_row_once(ready):
    scored = models.out_of_fold_scores(models.logistic_regression(max_iter=5), ready.frame, 2, 2)
    assert scored.count() == scored.select("customer_id").distinct().count() == ready.frame.count()


def test_search(ready):
    found = tuning.search(ready.frame, tuning.draw_logistic, budget=2, folds=2, seed=3)
    again = tuning.search(ready.frame, tuning.draw_logistic, budget=2, folds=2, seed=3)
    assert found.best.params == again.best.params
    assert found.results.count() == 4
    evidence = selection.search_evidence(found.results).first()
    assert found.candidates[evidence.best_config] is found.best
    with pytest.raises(ValueError, match="unsupported objective"):
        tuning.search(ready.frame, tuning.draw_logistic, objective="roc_auc")


def test_a_stopped_search_goes_on(ready, tmp_path, monkeypatch):
    whole = tuning.search(ready.frame, tuning.draw_logistic, budget=3, folds=2, seed=3)
    path, made, fit = str(tmp_path / "fits"), [], tuning.fit

    def failing(candidate, frame, counts):
        made.append(candidate)
        if len(made) == 4:
            raise KeyboardInterrupt("stopped")
        return fit(candidate, frame, counts)

    monkeypatch.setattr(tuning, "fit", failing)
    monkeypatch.setattr(tuning, "in_parallel", lambda tasks: [task() for task in tasks])
    args = (ready.frame, tuning.draw_logistic, path, 3, 2, 3)
    with pytest.raises(KeyboardInterrupt):
        tuning.resumable_search(*args)
    some = tuning.resumable_search(*args, fits=1)
    assert (some.left, some.best, some.results.count()) == (2, None, 4)
    done = tuning.resumable_search(*args)
    assert len(made) == 7 and done.left == 0  # three, the lost one, one, two: none twice
    assert done.best.params == whole.best.params
    scores = {(r.config, r.fold): r.score for r in whole.results.collect()}
    assert {(r.config, r.fold): r.score for r in done.results.collect()} == pytest.approx(scores)
    again = tuning.resumable_search(*args)
    assert len(made) == 7 and again.best.params == whole.best.params
    # Rows of other data are not taken for done.
    other = ready.frame.withColumn("label", 1 - F.col("label"))
    assert tuning.resumable_search(other, *args[1:], fits=0).left == 6


def test_training_goes_on_with_its_search(spark, sf_dir, tmp_path):
    from catalog.preparation import features

    def train(fits):
        return training.train_and_publish(
            features(spark, sf_dir), FIRST, *(f"{tmp_path}/{d}" for d in ("models", "registry", "runs")),
            draw=lambda rng: tuning.draw_logistic(rng, max_iter=5), budget=2, inner_folds=None,
            search_path=f"{tmp_path}/search", fits=fits,
        )

    with pytest.raises(training.SearchUnfinished, match="3 fits"):
        train(7)
    assert train(None) == RUN


def test_search_spaces():
    rng = random.Random(0)
    for _ in range(50):
        logistic = tuning.draw_logistic(rng).params
        assert 1e-3 <= logistic["C"] <= 1e2 and logistic["l1_ratio"] in (0.0, 1.0)
        forest = tuning.draw_forest(rng).params
        assert 100 <= forest["trees"] <= 499 and forest["depth"] in (None, 5, 10, 20)
        boosted = tuning.draw_boosted(rng).params
        assert 3 <= boosted["depth"] <= 9 and 0.01 <= boosted["rate"] <= 0.3
        assert 0.6 <= boosted["row_share"] <= 1 and 1 <= boosted["min_leaf"] <= 9


def test_parameters_must_be_equal(spark):
    reference = training.parameter_frame(spark, {"a": 1, "b": 2.0})
    selection.require_equal_parameters(reference, reference)
    other = training.parameter_frame(spark, {"a": True, "c": 1})
    with pytest.raises(ValueError, match="a different.*b missing.*c unexpected"):
        selection.require_equal_parameters(other, reference)


def test_heuristic_is_not_a_model_to_evaluate(ready, published):
    with pytest.raises(ValueError, match="yardstick"):
        training.evaluate_held_out(ready, published, training.HEURISTIC)


def test_saved_model_scores_the_same(spark, ready, published, tmp_path):
    published.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    population = scoring.scoring_population(ready.features, ready.schema)
    a = scoring.score_batch(population, published, ready.schema, 0.1)
    b = scoring.score_batch(population, loaded, ready.schema, 0.1)
    assert a.exceptAll(b).count() == 0
    assert a.columns == quality.RANKED_COLUMNS
    n = population.count()
    assert a.where("in_top_k").count() == max(1, round(n * 0.1))


def test_bad_input_is_not_scored(ready, published):
    population = scoring.scoring_population(ready.features, ready.schema)
    with pytest.raises(quality.InputError, match="null_not_allowed in age"):
        scoring.score_batch(
            population.withColumn("age", F.lit(None).cast("int")), published, ready.schema, 0.1
        )
    with pytest.raises(quality.InputError, match="missing_column in age"):
        scoring.score_batch(population.drop("age"), published, ready.schema, 0.1)


def test_bad_probabilities_are_not_ranked(spark):
    rows = [("a", 0.5), ("b", float("nan")), ("c", 1.5), ("d", None), ("e", float("inf"))]
    df = spark.createDataFrame(rows, "customer_id STRING, churn_probability DOUBLE")
    found = quality.probability_counts(df, "customer_id", "churn_probability").first()
    assert (found.n_rows, found.bad, found.first_id) == (5, 4, "b")


def test_publish_load_and_score(spark, ready, published, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("models", "registry", "list", "summary", "runs")}

    def publish(instant):
        return training.publish(
            published, ready.schema, {"C": 1.0}, example_record(), {}, instant,
            paths["models"], paths["registry"], "none",
        )

    assert publish(FIRST) == RUN
    with pytest.raises(ValueError, match="already"):
        publish(FIRST)
    run = registry.load_run(spark, paths["registry"])
    assert (run.run_id, run.specs) == (RUN, ready.schema)
    assert run.health["training_cv_metrics"] == example_record()

    population = scoring.scoring_population(ready.features, ready.schema)
    outs = [paths["list"], paths["summary"], paths["runs"]]
    ranked = scoring.score_run(population, run, SECOND, *outs)
    listed = outputs.read_list(spark, paths["list"]).collect()
    assert {(r.customer_id, r.churn_probability, r.rank, r.in_top_k == "True") for r in listed} == {
        tuple(r) for r in ranked.collect()
    }
    summary = spark.read.json(paths["summary"]).first()
    assert summary.customers_scored == len(listed)
    assert (summary.model_run_id, summary.scoring_run_id) == (RUN, LATER)
    record = registry.read_registry(spark, paths["runs"], registry.RUN_ROW).first()
    assert record.run_type == "score" and record.metrics["model_run_id"] == RUN
    with pytest.raises(ValueError, match="already"):
        scoring.score_run(population, run, SECOND, *outs)


def test_no_registry(spark, tmp_path):
    with pytest.raises(LookupError):
        registry.load_run(spark, str(tmp_path / "none"))


def test_list_files_are_in_rank_order(spark, tmp_path):
    df = spark.range(5_000).selectExpr(
        "CAST(id AS STRING) AS customer_id", "1 - id / 5000 AS churn_probability",
        "id + 1 AS rank", "id < 10 AS in_top_k",
    )
    outputs.write_list(df.repartition(7, "customer_id"), str(tmp_path / "l"))
    ranks = []
    for part in sorted((tmp_path / "l").glob("part-*.csv")):
        lines = part.read_text().splitlines()
        assert lines[0] == "customer_id,churn_probability,rank,in_top_k"
        ranks += [int(line.split(",")[2]) for line in lines[1:]]
    assert ranks == list(range(1, 5_001))


def test_registry(spark, tmp_path):
    record = example_record()
    path = str(tmp_path / "registry")

    def row(instant, metrics):
        return registry.model_row(spark, instant, "m", [], {"depth": None}, metrics, "none", {})

    for instant in (SECOND, FIRST):
        registry.append_rows(row(instant, record), path)
    runs = registry.read_registry(spark, path, registry.MODEL_ROW)
    assert registry.select_run(runs) == LATER
    assert registry.select_run(runs, RUN) == RUN
    for absent in ("20260103T000000Z", "latest", "20260231T000000Z"):
        with pytest.raises(LookupError):
            registry.select_run(runs, absent)
    unfinished = runs.withColumn("complete", F.col("run_id") == RUN)
    assert registry.select_run(unfinished) == RUN
    for bad in ("latest", "20260231T000000Z", "20260101T000000", None):
        with pytest.raises(ValueError, match="not a run id"):
            registry.require_new_run(spark, path, bad, registry.MODEL_ROW)
    for change in ({"k": float("nan")}, {"training_rows": 1.5}, {"estimate_type": "x"}, {"z": 1}):
        with pytest.raises(ValueError):
            row(FIRST, {**record, **change})


def test_fingerprints_do_not_depend_on_order(spark):
    df = spark.range(1_000).selectExpr("id", "id % 7 AS g")
    a = registry.table_fingerprint(df, ["id", "g"]).first()
    b = registry.table_fingerprint(df.repartition(5).orderBy("g"), ["id", "g"]).first()
    c = registry.table_fingerprint(df.where("id <> 3"), ["id", "g"]).first()
    assert a == b and a != c


def test_fingerprints_tell_rows_and_schemas_apart(spark):
    kind = "a STRING, b STRING"
    prints = {
        tuple(registry.table_fingerprint(spark.createDataFrame([row], kind), ["a", "b"]).first())
        for row in [("x|y", "z"), ("x", "y|z"), (None, "z"), ("N", "z"), ("\\N", "z"), ("x;1:y", "z")]
    }
    assert len(prints) == 6
    lists = [("a", "b"), ("a|b",), ('a","b',)]
    specs = [[quality.InputColumn("c", quality.CATEGORICAL, False, v)] for v in lists]
    assert len({registry.schema_hash(spark, s) for s in specs}) == 3


def test_parameters_are_compared_by_value(spark):
    def frame(**values):
        return training.parameter_frame(spark, values)

    selection.require_equal_parameters(frame(a=1, b=0.5), frame(a=1.0, b=0.50))
    for other in (frame(a=True, b=0.5), frame(a=2, b=0.5), frame(a=1)):
        with pytest.raises(ValueError):
            selection.require_equal_parameters(frame(a=1, b=0.5), other)


def test_more_labels_and_classes_than_any_limit(spark):
    df = spark.range(7_000).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 70 AS INT) AS label")
    parts = sampling.stratified_split(df, "id", "label", 0.2).groupBy("label", "part").count()
    assert {(r.part, r["count"]) for r in parts.collect()} == {("test", 20), ("train", 80)}
    folds = sampling.stratified_folds(df, "id", "label", 5).groupBy("label", "fold").count()
    assert {r["count"] for r in folds.collect()} == {20}
    wide = spark.range(4_500).selectExpr("CAST(id % 1500 AS STRING) AS c", "id AS v")
    bins = profile.histogram(wide, "v", 3, "c").groupBy("class").sum("n_rows").collect()
    assert len(bins) == 1500 and {r[1] for r in bins} == {3}
    many = spark.range(5_000).selectExpr("concat('v', id) AS c")
    assert len(encoding.fit_categories(many, ["c"])["c"]) == 5000


def test_dominance(spark):
    def evaluation(rows):
        return spark.createDataFrame(
            rows, "candidate STRING, k_order INT, precision DOUBLE, pr_auc DOUBLE, brier_score DOUBLE"
        )

    winner = evaluation([("base", 0, 0.9, 0.9, 0.0), ("a", 0, 0.8, 0.7, 0.1), ("b", 0, 0.5, 0.6, 0.2)])
    assert selection.select_by_dominance(winner, "base").first().selected == "a"
    split = evaluation([("base", 0, 0.9, 0.9, 0.0), ("a", 0, 0.8, 0.7, 0.3), ("b", 0, 0.5, 0.6, 0.2)])
    assert selection.select_by_dominance(split, "base").first().selected == selection.TIE


def test_training_metrics_reject_incomplete_scores(spark):
    df = spark.createDataFrame([("a", 1, None)], "customer_id STRING, y INT, score DOUBLE")
    with pytest.raises(ValueError, match="pair up"):
        training.training_metrics(df)
    assert metrics.DEFAULT_K == 0.10


def test_tuning_evidence_draws_the_whole_budget(monkeypatch, spark, sf_dir):
    from catalog import modeling

    class Asked(Exception):
        pass

    def search(frame, draw, budget, folds):
        raise Asked(budget)

    monkeypatch.setattr(modeling.tuning, "search", search)
    with pytest.raises(Asked) as asked:
        modeling.tuning_evidence(spark, sf_dir)
    assert asked.value.args == (30,)
