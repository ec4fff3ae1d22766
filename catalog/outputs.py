"""Sinks, registries and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.modeling import example_record
from catalog.preparation import features, fitted_schema, schema_sql
from catalog.ranking import CUSTOMERS_SQL, candidates, customers_scored
from catalog.registry import query, r6
from catalog.sql import CANDIDATES_SQL, FEATURE_SQL, print_sql, sums_sql
from catalog.tables import table
from tenura.operators import metrics
from tenura.plans import scoring
from tenura.sources import outputs, registry
from tenura.sources.workspace import new_path, store


@query(
    "ranked_export",
    f"""WITH {CUSTOMERS_SQL}
SELECT customer_id, churn_probability, rank, CASE WHEN in_top_k THEN 'True' ELSE 'False' END
  AS in_top_k FROM outreach""",
)
def ranked_export(spark, sf_dir):
    path = new_path(spark, "list")
    outputs.write_list(scoring.rank_customers(customers_scored(spark, sf_dir), 0.10), path)
    return outputs.read_list(spark, path)


@query(
    "run_summary",
    f"""WITH {CUSTOMERS_SQL}
SELECT '1' AS contract_version, CAST(0.1 AS DOUBLE) AS k, count(*) AS customers_scored,
  count(*) FILTER (WHERE in_top_k) AS customers_flagged, '20260101T000000Z' AS model_run_id,
  '20260102T000000Z' AS scoring_run_id, '{outputs.SNAPSHOT_NOTICE}' AS snapshot_notice,
  '2026-01-01T00:00:00Z' AS trained_at_utc, CAST(0.5 AS DOUBLE) AS pr_auc,
  'not evaluated' AS held_out_results_reference
FROM outreach""",
)
def run_summary(spark, sf_dir):
    ranked = scoring.rank_customers(customers_scored(spark, sf_dir), 0.10)
    health = {
        "trained_at_utc": "2026-01-01T00:00:00Z",
        "package_version": "1",
        "training_cv_metrics": example_record(),
        "held_out_results_reference": "not evaluated",
    }
    summary = outputs.run_summary(ranked, 0.10, "20260101T000000Z", "20260102T000000Z", health)
    path = new_path(spark, "summary")
    outputs.write_summary(summary, path)
    back = spark.read.schema(summary.schema).json(path)
    return back.select(
        "contract_version",
        "k",
        "customers_scored",
        "customers_flagged",
        "model_run_id",
        "scoring_run_id",
        "snapshot_notice",
        "model_health.trained_at_utc",
        "model_health.training_cv_metrics.pr_auc",
        "model_health.held_out_results_reference",
    )


_RUN_METRICS = ["candidate", "k", "n_rows", "precision", "lift", "pr_auc", "brier_score"]


@query(
    "run_metrics_append",
    f"""WITH {CANDIDATES_SQL}
SELECT candidate, k, n_rows, round(precision, 6) AS precision, round(lift, 6) AS lift,
  round(pr_auc, 6) AS pr_auc, round(brier_score, 6) AS brier_score
FROM c_eval WHERE k_order = 1""",
)
def run_metrics_append(spark, sf_dir):
    """A run per candidate appends its metrics to one table."""
    evaluated = metrics.evaluate(candidates(spark, sf_dir), [metrics.DEFAULT_K])
    path = new_path(spark, "runs")
    rows = store(evaluated.select(*_RUN_METRICS), "evaluated")
    for name in sorted(r.candidate for r in rows.select("candidate").distinct().collect()):
        registry.append_rows(rows.where(F.col("candidate") == name), path)
    back = registry.read_registry(spark, path, rows.schema)
    return back.select(
        "candidate", "k", "n_rows", *[r6(c).alias(c) for c in _RUN_METRICS[3:]]
    )


_REGISTRY_SQL = """registry AS (
  SELECT CASE o_orderkey % 7 WHEN 1 THEN concat('.tmp-', o_orderkey)
      WHEN 2 THEN concat(strftime(o_orderdate, '%Y'), '0230T000000Z')
      WHEN 3 THEN concat(strftime(o_orderdate, '%Y%m%d'), 'T250000Z')
      ELSE concat(strftime(o_orderdate, '%Y%m%d'), 'T', lpad(CAST(o_orderkey % 24 AS VARCHAR), 2,
        '0'), '0000Z') END AS run_id,
    o_orderstatus = 'F' AS complete FROM orders),
problems AS (
  SELECT run_id, CASE WHEN NOT regexp_full_match(run_id, '[0-9]{8}T[0-9]{6}Z')
      OR try_strptime(run_id, '%Y%m%dT%H%M%SZ') IS NULL THEN 'not a run id'
    WHEN NOT complete THEN 'incomplete' END AS problem FROM registry)"""


def run_registry(spark, sf_dir):
    day = "date_format(o_orderdate, 'yyyyMMdd')"
    return table(spark, sf_dir, "orders").selectExpr(
        f"""CASE o_orderkey % 7 WHEN 1 THEN concat('.tmp-', o_orderkey)
          WHEN 2 THEN concat(date_format(o_orderdate, 'yyyy'), '0230T000000Z')
          WHEN 3 THEN concat({day}, 'T250000Z')
          ELSE concat({day}, 'T', lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), '0000Z')
          END AS run_id""",
        "o_orderstatus = 'F' AS complete",
    )


@query(
    "latest_valid_run",
    f"""WITH {_REGISTRY_SQL}
SELECT max(run_id) AS run_id, count(*) AS usable_rows FROM problems WHERE problem IS NULL""",
)
def latest_valid_run(spark, sf_dir):
    return registry.latest_valid_run(run_registry(spark, sf_dir))


@query(
    "skipped_runs",
    f"""WITH {_REGISTRY_SQL}
SELECT problem, count(*) AS runs, max(run_id) AS highest_id FROM problems GROUP BY problem""",
)
def skipped_runs(spark, sf_dir):
    return registry.run_report(run_registry(spark, sf_dir))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


@query(
    "table_fingerprint",
    f"""WITH o AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
h AS (SELECT md5({print_sql([*_ORDER_COLUMNS, "price"])}) AS h FROM o)
SELECT count(*) AS n_rows, {sums_sql()} FROM h""",
)
def table_fingerprint(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "price", F.col("o_totalprice").cast("decimal(18,2)")
    )
    return registry.table_fingerprint(orders, [*_ORDER_COLUMNS, "price"])


@query(
    "schema_fingerprint",
    f"""WITH {FEATURE_SQL},
s AS ({schema_sql("feat")}),
l AS (SELECT CAST(to_json([allowed, "column", kind, CAST(nullable AS VARCHAR),
  CAST(position AS VARCHAR), reserved]) AS VARCHAR) AS line FROM s)
SELECT count(*) AS columns, sha256(string_agg(line, chr(10) ORDER BY line)) AS schema_hash FROM l""",
)
def schema_fingerprint(spark, sf_dir):
    return registry.schema_fingerprint(fitted_schema(spark, features(spark, sf_dir)))
