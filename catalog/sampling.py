"""Splits and folds of the labelled customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.preparation import outcome
from catalog.registry import query, r6
from catalog.sql import TARGET_SQL, hash_sql, split_sql
from tenura.operators import sampling
from tenura.plans.prepare import ID, TARGET


def labelled(spark, sf_dir):
    return outcome(spark, sf_dir).select(ID, TARGET)


def split(spark, sf_dir):
    return sampling.stratified_split(labelled(spark, sf_dir), ID, TARGET)


_SPLIT = f"WITH {TARGET_SQL}, {split_sql('tgt')}\n"


@query("stratified_split", _SPLIT + "SELECT customer_id, is_voluntary_churn, part FROM split")
def stratified_split(spark, sf_dir):
    return split(spark, sf_dir)


@query(
    "stratified_kfold",
    f"WITH {TARGET_SQL}\n"
    + " UNION ALL ".join(
        f"""SELECT customer_id, is_voluntary_churn, CAST({r} AS INTEGER) AS "repeat",
  CAST((row_number() OVER w - 1) * 5 // count(*) OVER (PARTITION BY is_voluntary_churn) AS INTEGER)
    AS fold
FROM tgt WINDOW w AS (PARTITION BY is_voluntary_churn
  ORDER BY {hash_sql("customer_id", 42 + r)}, customer_id)"""
        for r in range(2)
    ),
)
def stratified_kfold(spark, sf_dir):
    return sampling.repeated_folds(labelled(spark, sf_dir), ID, TARGET, folds=5, repeats=2)


@query(
    "fold_matrix",
    f"""WITH {TARGET_SQL},
outer_folds AS (SELECT customer_id, is_voluntary_churn, {hash_sql("customer_id", 42)} AS h,
  CAST((row_number() OVER w - 1) * 5 // count(*) OVER (PARTITION BY is_voluntary_churn) AS INTEGER) AS fold
  FROM tgt WINDOW w AS (PARTITION BY is_voluntary_churn ORDER BY {hash_sql("customer_id", 42)}, customer_id)),
inner_folds AS (SELECT customer_id, f, CAST((row_number() OVER w - 1) * 5
    // count(*) OVER (PARTITION BY f, is_voluntary_churn) AS INTEGER) AS inner_fold
  FROM outer_folds, (SELECT unnest(range(5)) AS f) WHERE fold <> f
  WINDOW w AS (PARTITION BY f, is_voluntary_churn ORDER BY h, customer_id))
SELECT customer_id, is_voluntary_churn, fold,
  string_agg(CAST(inner_fold AS VARCHAR), ',' ORDER BY f) AS inner_folds
FROM outer_folds JOIN inner_folds USING (customer_id) GROUP BY ALL""",
)
def fold_matrix(spark, sf_dir):
    """Folds, and the folds of the other rows inside of each, listed without the row's own."""
    rows = sampling.fold_matrix(labelled(spark, sf_dir), ID, TARGET)
    return rows.select(ID, TARGET, "fold", F.array_join("inner", ",").alias("inner_folds"))


@query(
    "split_report",
    _SPLIT
    + """SELECT part, count(*) AS n_rows, count(*) FILTER (WHERE is_voluntary_churn) AS positives,
  round(avg(CAST(is_voluntary_churn AS DOUBLE)), 6) AS positive_rate,
  abs(avg(CAST(is_voluntary_churn AS DOUBLE))
    - (SELECT avg(CAST(is_voluntary_churn AS DOUBLE)) FROM split)) <= 0.01 AS within_tolerance
FROM split GROUP BY part""",
)
def split_report(spark, sf_dir):
    report = sampling.split_report(split(spark, sf_dir), TARGET)
    return report.withColumn("positive_rate", r6("positive_rate"))


@query(
    "split_disjoint_check",
    _SPLIT
    + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE part = 'train') AS n_train,
  count(*) FILTER (WHERE part = 'test') AS n_test,
  (SELECT count(*) FROM (SELECT customer_id FROM split WHERE part = 'test' INTERSECT
    SELECT customer_id FROM split WHERE part = 'train')) AS shared_ids,
  count(*) = count(*) FILTER (WHERE part = 'train') + count(*) FILTER (WHERE part = 'test')
    AS sizes_add_up FROM split""",
)
def split_disjoint_check(spark, sf_dir):
    return sampling.disjoint_check(split(spark, sf_dir), ID)
