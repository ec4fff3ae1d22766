from pyspark.sql import Window
from pyspark.sql import functions as F

from tenura.operators.ranking import flag_top, rank_scores, running_totals, with_rank


def plain_rank(df, *order, group=()):
    return df.withColumn(
        "expected", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )


def test_rank_equals_row_number_with_ties_and_a_hot_score(spark):
    # A third of all rows share one score.
    df = spark.range(30_000).selectExpr(
        "id", "IF(id % 3 = 0, 0.5D, CAST(pmod(hash(id), 97) AS DOUBLE) / 97) AS score"
    )
    ranked = rank_scores(df, "score", "id")
    both = plain_rank(ranked, F.col("score").desc(), F.col("id"))
    assert both.where("rank <> expected").count() == 0
    assert ranked.select("n_rows").distinct().collect()[0][0] == 30_000


def test_rank_in_groups_of_very_different_size(spark):
    df = spark.range(20_000).selectExpr(
        "id", "IF(id < 9, 'few', IF(id % 2 = 0, 'a', 'b')) AS g", "(id * 7919) % 1000 AS score"
    )
    ranked = rank_scores(df, "score", "id", ["g"])
    both = plain_rank(ranked, F.col("score").desc(), F.col("id"), group=["g"])
    assert both.where("rank <> expected").count() == 0
    sizes = {r.g: r.n_rows for r in ranked.select("g", "n_rows").distinct().collect()}
    assert sizes == {r.g: r["count"] for r in df.groupBy("g").count().collect()}


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id BIGINT, g STRING")
    ranked = with_rank(df, [F.col("id")], ["g"]).collect()
    assert {(r.id, r.rank, r.n_rows) for r in ranked} == {(1, 1, 2), (2, 2, 2), (3, 1, 1)}


def test_rows_are_never_sent_to_one_partition(spark):
    df = spark.range(10_000).selectExpr("id", "id % 10 AS score")
    plan = rank_scores(df, "score", "id")._jdf.queryExecution().executedPlan().toString()
    # Only the table with one row per partition is brought together.
    scan = plan[plan.index("FileScan") :] if "SinglePartition" not in plan else plan
    assert "BroadcastHashJoin" in plan
    assert scan.count("SinglePartition") <= 1


def test_text_ids_break_ties_in_code_point_order(spark):
    ids = ["plum-9", "Plum-2", "plum-10", "éclair", "~end", "Zebra", "plum"]
    df = spark.createDataFrame([(i, 0.25) for i in ids], "customer_id STRING, p DOUBLE")
    ranked = rank_scores(df, "p", "customer_id").orderBy("rank").collect()
    assert [r.customer_id for r in ranked] == sorted(ids)


def test_a_tie_across_the_cut_does_not_change_the_count(spark):
    scores = [0.8] * 2 + [0.6] * 9 + [0.1] * 5
    df = spark.createDataFrame(
        [(f"k{(7 * i) % 16:02d}", p) for i, p in enumerate(scores)], "customer_id STRING, p DOUBLE"
    )
    flagged = {r.customer_id for r in flag_top(df, "p", "customer_id", 0.25).where("in_top_k").collect()}
    tied = sorted(f"k{(7 * i) % 16:02d}" for i in range(2, 11))
    assert flagged == {"k00", "k07", *tied[:2]}  # a quarter of 16, two of them by id among nine


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "customer_id STRING, p DOUBLE")
    assert rank_scores(df, "p", "customer_id").count() == 0


def test_running_totals_equal_a_plain_window(spark):
    df = spark.range(5_000).selectExpr("id AS score", "id % 13 AS n", "id % 3 AS g")
    totals = running_totals(df, F.col("score").desc(), ["n"], ["g"])
    window = Window.partitionBy("g").orderBy(F.col("score").desc())
    wrong = totals.withColumn("expected", F.sum("n").over(window)).where("cum_n <> expected")
    assert wrong.count() == 0
