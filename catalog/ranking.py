"""Ranks and ranking metrics; events are the scored rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.registry import query, r6
from catalog.sql import CANDIDATES_SQL, RANKED_SQL, SCORED_SQL
from catalog.tables import table
from tenura.functions import top_k_count
from tenura.operators import metrics, quality, selection
from tenura.operators.ranking import flag_top, rank_scores
from tenura.plans import scoring
from tenura.sources.workspace import store

BASELINE = "business_heuristic"


def scored(spark, sf_dir, where="true"):
    return table(spark, sf_dir, "events").where(where).selectExpr(
        "event_id AS id",
        "CAST(event_type = 'purchase' AS INT) AS y",
        "least(value / 500.0D, 1.0D) + 0.0D AS score",
    )


def candidates(spark, sf_dir):
    """Four candidates scored on the same events, in one scan."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "CAST(event_type = 'purchase' AS INT) AS y",
        """inline(array(
          struct('business_heuristic' AS candidate,
            CAST(CAST(user_id % 3 = 0 OR value > 200 AS INT) AS DOUBLE) AS score),
          struct('logistic_regression' AS candidate,
            least(value / 500.0D, 1.0D) + 0.0D AS score),
          struct('random_forest' AS candidate, (user_id % 10) / 10.0D AS score),
          struct('boosted_trees' AS candidate, 1.0D / (1.0D + abs(value) / 100.0D) AS score)))""",
    )


def customers_scored(spark, sf_dir):
    """Customers with a text id and a probability with many ties."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "(c_nationkey * 5 + c_custkey % 4) / 128.0D AS churn_probability",
    )


CUSTOMERS_SQL = """
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    (c_nationkey * 5 + c_custkey % 4) / 128.0::DOUBLE AS churn_probability FROM customer),
ranked_customers AS (
  SELECT *, row_number() OVER (ORDER BY churn_probability DESC, customer_id) AS rank,
    count(*) OVER () AS n FROM customers),
outreach AS (
  SELECT customer_id, churn_probability, rank,
    rank <= greatest(1, CAST(round_even(n * 0.1::DOUBLE, 0) AS BIGINT)) AS in_top_k
  FROM ranked_customers)"""


@query("rank_customers", f"WITH {CUSTOMERS_SQL} SELECT * FROM outreach")
def rank_customers(spark, sf_dir):
    return scoring.rank_customers(customers_scored(spark, sf_dir), 0.10)


@query("outreach_list", f"WITH {CUSTOMERS_SQL} SELECT * FROM outreach WHERE in_top_k")
def outreach_list(spark, sf_dir):
    return scoring.outreach_list(scoring.rank_customers(customers_scored(spark, sf_dir), 0.10))


_K_TABLES = ["customer", "orders", "lineitem", "events", "documents"]


@query(
    "top_k_count",
    """WITH c AS ("""
    + " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in _K_TABLES)
    + """)
SELECT t AS table_name, n AS n_rows, CAST(f AS DOUBLE) AS k_frac,
  greatest(1, CAST(round_even(n * CAST(f AS DOUBLE), 0) AS BIGINT)) AS k
FROM c CROSS JOIN (VALUES (0.00001), (0.05), (0.10), (0.15), (0.20), (0.25), (1.0)) AS s(f)""",
)
def top_k_count_(spark, sf_dir):
    from tenura.sources.tables import row_counts

    counts = row_counts({t: table(spark, sf_dir, t) for t in _K_TABLES})
    rows = [
        F.struct(F.lit(f).alias("k_frac"), top_k_count(F.col("n_rows"), f).alias("k"))
        for f in (0.00001, 0.05, 0.10, 0.15, 0.20, 0.25, 1.0)
    ]
    return counts.select("table_name", "n_rows", F.inline(F.array(*rows)))


@query(
    "top_k_flag",
    f"""WITH {RANKED_SQL}
SELECT id, y, score, rank,
  rank <= greatest(1, CAST(round_even(n_rows * 0.1::DOUBLE, 0) AS BIGINT)) AS in_top_k
FROM ranked""",
)
def top_k_flag(spark, sf_dir):
    return flag_top(scored(spark, sf_dir), "score", "id", 0.10)


_SWEEP = [0.05, 0.10, 0.15, 0.20, 0.25]
_AT_K = f"""WITH {RANKED_SQL},
ks(k_order, f) AS (VALUES (0, 0.05), (1, 0.10), (2, 0.15), (3, 0.20), (4, 0.25)),
counts AS (
  SELECT CAST(k_order AS INTEGER) AS k_order, CAST(f AS DOUBLE) AS k_frac,
    max(n_rows) AS n_rows, CAST(sum(y) AS BIGINT) AS positives,
    greatest(1, CAST(round_even(max(n_rows) * CAST(f AS DOUBLE), 0) AS BIGINT)) AS k,
    count(*) FILTER (WHERE y = 1 AND rank <=
      greatest(1, CAST(round_even(n_rows * CAST(f AS DOUBLE), 0) AS BIGINT))) AS tp
  FROM ranked CROSS JOIN ks GROUP BY k_order, f),
rates AS (
  SELECT *, k - tp AS fp, positives - tp AS fn, n_rows - k - positives + tp AS tn,
    tp::DOUBLE / k AS precision, coalesce(tp::DOUBLE / nullif(positives, 0), 0.0) AS recall,
    (tp::DOUBLE / k) / nullif(positives::DOUBLE / n_rows, 0) AS lift FROM counts)
"""


def _at_k(spark, sf_dir, fractions):
    return metrics.sensitivity(scored(spark, sf_dir), fractions)


@query(
    "precision_at_k",
    _AT_K + "SELECT k_frac, k, tp, round(precision, 6) AS precision FROM rates",
)
def precision_at_k(spark, sf_dir):
    return _at_k(spark, sf_dir, _SWEEP).select(
        "k_frac", "k", "tp", r6("precision").alias("precision")
    )


@query("lift_at_k", _AT_K + "SELECT k_frac, positives, round(lift, 6) AS lift FROM rates")
def lift_at_k(spark, sf_dir):
    return _at_k(spark, sf_dir, _SWEEP).select("k_frac", "positives", r6("lift").alias("lift"))


@query(
    "pr_auc",
    f"""WITH {SCORED_SQL},
g AS (SELECT score, count(*) AS n, sum(y) AS p FROM scored GROUP BY score),
c AS (SELECT p, sum(n) OVER w AS cn, sum(p) OVER w AS cp, sum(p) OVER () AS tp FROM g
  WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(p * cp::DOUBLE / cn) / max(tp), 6) AS pr_auc FROM c""",
)
def pr_auc(spark, sf_dir):
    return metrics.average_precision(scored(spark, sf_dir), group=()).select(
        r6("pr_auc").alias("pr_auc")
    )


@query(
    "brier_score",
    f"""WITH {SCORED_SQL}
SELECT round(avg(power(score - y, 2)), 6) AS brier_score FROM scored""",
)
def brier_score(spark, sf_dir):
    return scored(spark, sf_dir).agg(
        r6(F.avg((F.col("score") - F.col("y")) ** 2)).alias("brier_score")
    )


_F1 = (
    "coalesce(round(2 * precision * recall / nullif(precision + recall, 0), 6), 0.0)"
)


@query(
    "confusion_at_k",
    _AT_K
    + f"""SELECT k_frac, tp, fp, tn, fn, round(precision, 6) AS precision,
  round(recall, 6) AS recall, {_F1} AS f1 FROM rates WHERE k_order = 1""",
)
def confusion_at_k(spark, sf_dir):
    rates = ["precision", "recall", "f1"]
    return _at_k(spark, sf_dir, [0.10]).select(
        "k_frac", "tp", "fp", "tn", "fn", *[r6(c).alias(c) for c in rates]
    )


@query(
    "sensitivity_report",
    _AT_K
    + f"""SELECT CAST(CASE k_order WHEN 4 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS INTEGER) AS k_order,
  k_frac, n_rows, positives, k, tp, fp, fn, tn, round(precision, 6) AS precision,
  round(recall, 6) AS recall, {_F1} AS f1, round(lift, 6) AS lift
FROM rates WHERE k_order IN (4, 0, 2)""",
)
def sensitivity_report(spark, sf_dir):
    rates = ["precision", "recall", "f1", "lift"]
    return _at_k(spark, sf_dir, [0.25, 0.05, 0.15]).select(
        "k_order",
        "k_frac",
        "n_rows",
        "positives",
        "k",
        "tp",
        "fp",
        "fn",
        "tn",
        *[r6(c).alias(c) for c in rates],
    )


_EVALUATION = """candidate, k_order, k_frac, n_rows, positives, k, tp,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(lift, 6) AS lift,
  round(pr_auc, 6) AS pr_auc, round(brier_score, 6) AS brier_score"""


def _evaluation(df):
    rates = ["precision", "recall", "lift", "pr_auc", "brier_score"]
    return df.select(
        "candidate",
        "k_order",
        "k_frac",
        "n_rows",
        "positives",
        "k",
        "tp",
        *[r6(c).alias(c) for c in rates],
    )


@query(
    "evaluate_candidate",
    f"""WITH {CANDIDATES_SQL}
SELECT {_EVALUATION} FROM c_eval WHERE candidate = 'boosted_trees'""",
)
def evaluate_candidate(spark, sf_dir):
    one = candidates(spark, sf_dir).where("candidate = 'boosted_trees'")
    return _evaluation(metrics.evaluate(one))


@query("evaluate_candidates", f"WITH {CANDIDATES_SQL} SELECT {_EVALUATION} FROM c_eval")
def evaluate_candidates(spark, sf_dir):
    return _evaluation(metrics.evaluate(candidates(spark, sf_dir)))


_COMPARED = f"""WITH {CANDIDATES_SQL},
compared AS (
  SELECT c.candidate, c.k_order, c.k_frac, c.precision, c.lift,
    CASE WHEN c.candidate <> '{BASELINE}' THEN c.precision - b.precision END AS precision_delta,
    CASE WHEN c.candidate <> '{BASELINE}' THEN c.lift - b.lift END AS lift_delta,
    c.pr_auc, c.brier_score
  FROM c_eval c JOIN c_eval b ON b.k_order = c.k_order AND b.candidate = '{BASELINE}')
"""


@query(
    "compare_candidates",
    _COMPARED
    + """SELECT candidate, k_order, k_frac, round(precision, 6) AS precision,
  round(lift, 6) AS lift, round(precision_delta, 6) + 0.0 AS precision_delta,
  round(lift_delta, 6) + 0.0 AS lift_delta, round(pr_auc, 6) AS pr_auc,
  round(brier_score, 6) AS brier_score FROM compared""",
)
def compare_candidates(spark, sf_dir):
    compared = metrics.compare(metrics.evaluate(candidates(spark, sf_dir)), BASELINE)
    values = ["precision", "lift", "precision_delta", "lift_delta", "pr_auc", "brier_score"]
    return compared.select("candidate", "k_order", "k_frac", *[r6(c).alias(c) for c in values])


@query(
    "comparison_rows",
    _COMPARED
    + """SELECT candidate, k_order, printf('%.0f%%', k_frac * 100) AS k,
  printf('%.4f', precision) AS precision_at_k, printf('%.4f', lift) AS lift_at_k,
  coalesce(printf('%+.4f', precision_delta), 'n/a') AS precision_delta,
  coalesce(printf('%+.4f', lift_delta), 'n/a') AS lift_delta,
  printf('%.4f', pr_auc) AS pr_auc, printf('%.4f', brier_score) AS brier FROM compared""",
)
def comparison_rows(spark, sf_dir):
    return metrics.comparison_lines(
        metrics.compare(metrics.evaluate(candidates(spark, sf_dir)), BASELINE)
    )


@query(
    "length_and_nan_checks",
    """SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality IS NULL) AS label_missing,
  count(*) FILTER (WHERE n_chars IS NULL) AS score_missing, CAST(0 AS BIGINT) AS score_nan
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def length_and_nan_checks(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return metrics.incomplete_rows(labelled, "quality", "n_chars")


_CLIPPED = "greatest(1e-15::DOUBLE, least(1.0::DOUBLE - 1e-15::DOUBLE, {0}))"


def _loss(score):
    p = _CLIPPED.format(score)
    return f"avg(-CASE WHEN y = 1 THEN ln({p}) ELSE ln(1.0::DOUBLE - {p}) END)"


@query(
    "log_loss",
    f"""WITH {CANDIDATES_SQL}
SELECT candidate, round({_loss("score")}, 6) AS log_loss FROM candidates GROUP BY candidate""",
)
def log_loss(spark, sf_dir):
    return metrics.log_loss(candidates(spark, sf_dir)).select(
        "candidate", r6("log_loss").alias("log_loss")
    )


_FOLDS = f"""WITH f AS (
  SELECT CAST(event_id % 5 AS INTEGER) AS fold, CAST(event_type = 'purchase' AS INTEGER) AS y,
    least(value / 500.0::DOUBLE, 1.0::DOUBLE) + 0.0::DOUBLE AS raw,
    0.05::DOUBLE + 0.2::DOUBLE * ((event_id % 7) / 7.0::DOUBLE) AS calibrated FROM events),
losses AS (
  SELECT fold, count(*) AS n_rows, avg(power(raw - y, 2)) AS brier_raw,
    avg(power(calibrated - y, 2)) AS brier_calibrated, {_loss("raw")} AS log_loss_raw,
    {_loss("calibrated")} AS log_loss_calibrated FROM f GROUP BY fold)
"""


def _two_arms(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id % 5 AS INT) AS fold",
        "CAST(event_type = 'purchase' AS INT) AS y",
        "least(value / 500.0D, 1.0D) + 0.0D AS raw",
        "0.05D + 0.2D * ((event_id % 7) / 7.0D) AS calibrated",
    )


@query(
    "per_fold_metrics",
    _FOLDS
    + """SELECT fold, n_rows, round(brier_raw, 6) AS brier_raw,
  round(brier_calibrated, 6) AS brier_calibrated, round(log_loss_raw, 6) AS log_loss_raw,
  round(log_loss_calibrated, 6) AS log_loss_calibrated,
  brier_calibrated > brier_raw AS brier_worse,
  log_loss_calibrated > log_loss_raw AS log_loss_worse FROM losses""",
)
def per_fold_metrics(spark, sf_dir):
    losses = metrics.per_fold_losses(_two_arms(spark, sf_dir), "raw", "calibrated")
    values = ["brier_raw", "brier_calibrated", "log_loss_raw", "log_loss_calibrated"]
    return losses.select(
        "fold", "n_rows", *[r6(c).alias(c) for c in values], "brier_worse", "log_loss_worse"
    )


@query(
    "folds_worse",
    _FOLDS
    + """SELECT count(*) AS folds,
  count(*) FILTER (WHERE brier_calibrated > brier_raw) AS brier_worse_folds,
  count(*) FILTER (WHERE log_loss_calibrated > log_loss_raw) AS log_loss_worse_folds
FROM losses""",
)
def folds_worse(spark, sf_dir):
    return metrics.folds_worse(
        metrics.per_fold_losses(_two_arms(spark, sf_dir), "raw", "calibrated")
    )


@query(
    "reliability_bins",
    f"""WITH {RANKED_SQL}
SELECT CAST((n_rows - rank) * 10 // n_rows + 1 AS INTEGER) AS bin, count(*) AS n_rows,
  round(avg(score), 6) AS mean_score, round(avg(CAST(y AS DOUBLE)), 6) AS observed_rate
FROM ranked GROUP BY ALL""",
)
def reliability_bins(spark, sf_dir):
    bins = metrics.reliability(scored(spark, sf_dir))
    return bins.select(
        "bin",
        "n_rows",
        r6("mean_score").alias("mean_score"),
        r6("observed_rate").alias("observed_rate"),
    )


@query(
    "gain_decile_table",
    f"""WITH {RANKED_SQL},
d AS (SELECT CAST((rank - 1) * 10 // n_rows + 1 AS INTEGER) AS decile, count(*) AS n_rows,
  CAST(sum(y) AS BIGINT) AS positives FROM ranked GROUP BY ALL)
SELECT decile, n_rows, positives,
  CAST(sum(positives) OVER (ORDER BY decile) AS BIGINT) AS cum_positives,
  round(sum(positives) OVER (ORDER BY decile)::DOUBLE / sum(positives) OVER (), 6) AS cum_share
FROM d""",
)
def gain_decile_table(spark, sf_dir):
    gains = metrics.gain_table(scored(spark, sf_dir))
    return gains.select(
        "decile", "n_rows", "positives", "cum_positives", r6("cum_share").alias("cum_share")
    )


@query(
    "select_by_dominance",
    f"""WITH {CANDIDATES_SQL},
v AS (
  SELECT candidate, concat('precision@', k_order) AS metric, precision AS value FROM c_eval
  UNION ALL SELECT candidate, 'pr_auc', pr_auc FROM c_eval WHERE k_order = 0
  UNION ALL SELECT candidate, 'brier', -brier_score FROM c_eval WHERE k_order = 0),
firsts AS (
  SELECT candidate, count(*) AS firsts FROM (
    SELECT *, rank() OVER (PARTITION BY metric ORDER BY value DESC) AS place
    FROM v WHERE candidate <> '{BASELINE}') WHERE place = 1 GROUP BY candidate)
SELECT CASE WHEN max(firsts) = 7 AND count(*) = 1 THEN arg_max(candidate, firsts)
    ELSE '{selection.TIE}' END AS selected,
  CAST(7 AS BIGINT) AS metrics, max(firsts) AS best_firsts, count(*) AS leaders FROM firsts""",
)
def select_by_dominance(spark, sf_dir):
    return selection.select_by_dominance(
        metrics.evaluate(candidates(spark, sf_dir)), BASELINE
    )


@query(
    "tuned_vs_untuned",
    f"""WITH {CANDIDATES_SQL},
a AS (SELECT *, CASE WHEN id % 2 = 0 THEN 'untuned' ELSE 'tuned' END AS arm FROM candidates),
g AS (SELECT candidate, arm, score, count(*) AS n, sum(y) AS p FROM a GROUP BY ALL),
s AS (SELECT candidate, arm, p, sum(n) OVER w AS cn, sum(p) OVER w AS cp,
  sum(p) OVER (PARTITION BY candidate, arm) AS tp FROM g
  WINDOW w AS (PARTITION BY candidate, arm ORDER BY score DESC)),
m AS (SELECT candidate, arm, sum(p * cp::DOUBLE / cn) / max(tp) AS value FROM s GROUP BY ALL)
SELECT b.candidate, round(b.value, 6) AS before, round(t.value, 6) AS after,
  round(t.value - b.value, 6) + 0.0 AS change, t.value < b.value AS regressed
FROM m b JOIN m t ON t.candidate = b.candidate AND b.arm = 'untuned' AND t.arm = 'tuned'""",
)
def tuned_vs_untuned(spark, sf_dir):
    arm = F.when(F.col("id") % 2 == 0, "untuned").otherwise("tuned")
    arms = candidates(spark, sf_dir).withColumn("arm", arm)
    values = metrics.average_precision(arms, group=["candidate", "arm"]).withColumnRenamed(
        "pr_auc", "value"
    )
    sides = selection.before_and_after(values, "untuned", "tuned")
    numbers = ["before", "after", "change"]
    return sides.select("candidate", *[r6(c).alias(c) for c in numbers], "regressed")


def search_results(spark, sf_dir):
    """A results frame as a search leaves it: fold scores and fit times per configuration."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("search"),
            (F.col("user_id") % 30).cast("int").alias("config"),
            (F.col("event_id") % 5).cast("int").alias("fold"),
        )
        .agg(
            F.round(F.avg("value") / 1000, 6).alias("score"),
            F.round(F.avg(F.col("user_id").cast("double")), 6).alias("fit_s"),
        )
    )


_RESULTS = """WITH results AS (
  SELECT event_type AS search, CAST(user_id % 30 AS INTEGER) AS config,
    CAST(event_id % 5 AS INTEGER) AS fold, round(avg(value) / 1000, 6) AS score,
    round(avg(CAST(user_id AS DOUBLE)), 6) AS fit_s FROM events GROUP BY ALL),
means AS (
  SELECT search, config, avg(score) AS mean_score, stddev_pop(score) AS std_score,
    avg(fit_s) AS mean_fit_s FROM results GROUP BY search, config),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY search ORDER BY mean_score DESC, config) AS nth,
    avg(mean_fit_s) OVER (PARTITION BY search) AS all_fit_s FROM means)
"""


@query(
    "search_evidence",
    _RESULTS
    + """SELECT search, config AS best_config, round(mean_score, 6) AS best_score,
  round(std_score, 6) AS score_std_at_best, round(mean_fit_s, 6) AS fit_s_at_best,
  round(all_fit_s, 6) AS mean_fit_s FROM placed WHERE nth = 1""",
)
def search_evidence(spark, sf_dir):
    found = selection.search_evidence(search_results(spark, sf_dir))
    values = ["best_score", "score_std_at_best", "fit_s_at_best", "mean_fit_s"]
    return found.select("search", "best_config", *[r6(c).alias(c) for c in values])


@query(
    "search_plateau",
    _RESULTS
    + """SELECT search, count(*) AS configs,
  round(max(mean_score) FILTER (WHERE nth <= 5) - min(mean_score) FILTER (WHERE nth <= 5), 6)
    AS top_spread,
  round(max(mean_score) - median(mean_score), 6) AS best_minus_median
FROM placed GROUP BY search""",
)
def search_plateau(spark, sf_dir):
    found = selection.search_plateau(search_results(spark, sf_dir))
    return found.select(
        "search",
        "configs",
        r6("top_spread").alias("top_spread"),
        r6("best_minus_median").alias("best_minus_median"),
    )


@query(
    "reference_param_check",
    """WITH m AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS name, count(*) FILTER (WHERE l_returnflag = 'A') AS a,
    count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'N') AS n
  FROM lineitem GROUP BY ALL),
f AS (SELECT name, a AS value FROM m WHERE a >= n),
r AS (SELECT name, r AS value FROM m WHERE r >= n)
SELECT name, CASE WHEN f.name IS NULL THEN 'missing' WHEN r.name IS NULL THEN 'unexpected'
  ELSE 'different' END AS problem, CAST(f.value AS VARCHAR) AS found,
  CAST(r.value AS VARCHAR) AS reference
FROM f FULL JOIN r USING (name) WHERE f.value IS DISTINCT FROM r.value""",
)
def reference_param_check(spark, sf_dir):
    """Monthly counts under two return flags, each only where it is at least the third one."""

    def parameters(flag):
        counts = [F.count_if(F.col("l_returnflag") == f).alias(f) for f in ("A", "R", "N")]
        return (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("name"))
            .agg(*counts)
            .where(F.col(flag) >= F.col("N"))
            .select("name", F.col(flag).cast("string").alias("value"))
        )

    return selection.compare_parameters(parameters("A"), parameters("R"))


_FAULTS = """CASE WHEN rank % 500 = 0 THEN rank - 1 ELSE rank END AS r,
  CASE WHEN id % 1000 = 7 THEN 1.5 WHEN id % 1000 = 11 THEN NULL ELSE score END AS p,
  id % 1000 IN (11, 13) AS missing, id % 1000 = 17 AS blank, id % 1000 = 7 AS outside"""


@query(
    "dq_ranked_table",
    f"""WITH {RANKED_SQL},
f AS (SELECT rank, n_rows, {_FAULTS} FROM ranked),
u AS (SELECT r, min(p) AS low, max(p) AS high FROM f GROUP BY r),
rises AS (SELECT count(*) AS n FROM (SELECT high, lag(low) OVER (ORDER BY r) AS before FROM u)
  WHERE high > before)
SELECT 'cells' AS "case", c AS "check", CAST(n AS BIGINT) AS offending FROM (
  SELECT 'missing_value' AS c, count(*) FILTER (WHERE missing) AS n FROM f
  UNION ALL SELECT 'id_blank', count(*) FILTER (WHERE blank) FROM f
  UNION ALL SELECT 'probability_range', count(*) FILTER (WHERE outside) FROM f
  UNION ALL SELECT 'rank_repeated', count(*) - count(DISTINCT r) FROM f
  UNION ALL SELECT 'rank_gap', count(*) FILTER (WHERE rank % 500 = 0 AND rank < n_rows) FROM f
  UNION ALL SELECT 'probability_rises', n FROM rises)
UNION ALL SELECT 'types', c, (SELECT count(*) FROM scored) FROM (
  SELECT unnest(['id_not_text', 'rank_not_integer', 'flag_not_boolean', 'probability_range']) AS c)
UNION ALL SELECT 'empty', 'no_rows', 1""",
)
def dq_ranked_table(spark, sf_dir):
    """Checks that fail on a table with faulty cells, on one of other types, and on an empty one."""
    ranked = store(rank_scores(scored(spark, sf_dir), "score", "id"), "ranked")
    moved = F.when(F.col("rank") % 500 == 0, F.col("rank") - 1).otherwise(F.col("rank"))
    turn = F.col("id") % 1000
    p = F.when(turn == 7, 1.5).when(turn != 11, F.col("score"))
    broken = ranked.select(
        F.when(turn == 17, " ").otherwise(F.col("id").cast("string")).alias("customer_id"),
        p.alias("churn_probability"),
        moved.alias("rank"),
        F.when(turn != 13, F.col("rank") <= 10).alias("in_top_k"),
    )
    typed = ranked.select(
        F.col("id").alias("customer_id"),
        F.col("score").cast("string").alias("churn_probability"),
        F.col("rank").cast("double").alias("rank"),
        (F.col("rank") <= 10).cast("string").alias("in_top_k"),
    )
    cases = {"cells": broken, "types": typed, "empty": broken.limit(0)}
    reports = [
        quality.ranked_table_report(df).where("offending > 0").select(F.lit(name).alias("case"), "check", "offending")
        for name, df in cases.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), reports)
