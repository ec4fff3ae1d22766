"""Common table expressions of the checking SQL."""

from __future__ import annotations

from catalog.tables import STAGED_SQL
from tenura.plans.prepare import ADDON_COLUMNS, VIEW_COLUMNS, YES_NO_COLUMNS


def _flags(columns):
    return ", ".join(
        f"CASE {c} WHEN 'Yes' THEN true WHEN 'No' THEN false END AS {c}" for c in columns
    )


def _cleaned(name):
    columns = YES_NO_COLUMNS[name]
    return (
        f"cln_{name} AS (SELECT * REPLACE ({_flags(columns)}) FROM stg_{name})"
    )


TARGET_SQL = (
    STAGED_SQL
    + ",\n"
    + ",\n".join(_cleaned(n) for n in YES_NO_COLUMNS)
    + """,
tgt AS (
  SELECT customer_id, customer_status, churn_category, churn_reason,
    customer_status = 'Churned' AS is_voluntary_churn
  FROM cln_status WHERE churn_reason IS DISTINCT FROM 'Deceased')"""
)

VIEW_SQL = (
    TARGET_SQL
    + f""",
mv AS (
  SELECT {", ".join(VIEW_COLUMNS)}
  FROM tgt JOIN cln_demographics USING (customer_id) JOIN stg_location USING (customer_id)
  LEFT JOIN stg_population USING (zip_code) JOIN cln_services USING (customer_id))"""
)

FEATURE_SQL = (
    VIEW_SQL
    + f""",
feat AS (
  SELECT *, {" + ".join(f"CAST({c} AS INTEGER)" for c in ADDON_COLUMNS)} AS num_addon_services,
    contract = 'Month-to-Month' AS is_month_to_month,
    internet_service AND NOT online_security AS internet_without_security,
    internet_service AND num_addon_services = 0 AS no_addons_despite_internet,
    tenure_in_months = 72 AS is_tenure_censored
  FROM mv)"""
)


def hash_sql(key: str, salt: int) -> str:
    return f"('0x' || substr(md5(concat({key}, '|{salt}')), 1, 8))::BIGINT"


def split_sql(source: str, salt: int = 42, share: str = "0.2") -> str:
    """``split`` adds the part to ``source`` by exact quotas in hash order."""
    return f"""
split_n AS (
  SELECT is_voluntary_churn, count(*) AS n_label,
    CAST(ceil(round(sum(count(*)) OVER () * {share}::DOUBLE, 9)) AS BIGINT) AS total,
    sum(count(*)) OVER () AS n_all
  FROM {source} GROUP BY is_voluntary_churn),
split_q AS (
  SELECT *, CAST(floor(n_label * total::DOUBLE / n_all) AS BIGINT) AS base,
    n_label * total::DOUBLE / n_all - floor(n_label * total::DOUBLE / n_all) AS rest FROM split_n),
split_r AS (
  SELECT *, total - sum(base) OVER () AS left_over,
    row_number() OVER (ORDER BY rest DESC, is_voluntary_churn) AS turn FROM split_q),
split AS (
  SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.is_voluntary_churn
      ORDER BY {hash_sql("customer_id", salt)}, customer_id)
    <= base + CASE WHEN turn <= left_over THEN 1 ELSE 0 END THEN 'test' ELSE 'train' END AS part
  FROM {source} s JOIN split_r USING (is_voluntary_churn))"""


SCORED_SQL = """
scored AS (
  SELECT event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS y,
    least(value / 500.0::DOUBLE, 1.0::DOUBLE) + 0.0::DOUBLE AS score FROM events)"""

RANKED_SQL = (
    SCORED_SQL
    + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank, count(*) OVER () AS n_rows
  FROM scored)"""
)

CANDIDATES_SQL = """
candidates AS (
  SELECT candidate, event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS y,
    CASE candidate
      WHEN 'business_heuristic' THEN CAST(CAST(user_id % 3 = 0 OR value > 200 AS INTEGER) AS DOUBLE)
      WHEN 'logistic_regression' THEN least(value / 500.0::DOUBLE, 1.0::DOUBLE) + 0.0::DOUBLE
      WHEN 'random_forest' THEN (user_id % 10) / 10.0::DOUBLE
      ELSE 1.0::DOUBLE / (1.0::DOUBLE + abs(value) / 100.0::DOUBLE) END AS score
  FROM events, (VALUES ('business_heuristic'), ('logistic_regression'), ('random_forest'),
    ('boosted_trees')) AS c(candidate)),
c_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY score DESC, id) AS rank,
    count(*) OVER (PARTITION BY candidate) AS n_rows
  FROM candidates),
sweep AS (
  SELECT CAST(k_order AS INTEGER) AS k_order, CAST(k_frac AS DOUBLE) AS k_frac
  FROM (VALUES (0, 0.05), (1, 0.10), (2, 0.15), (3, 0.20), (4, 0.25)) AS s(k_order, k_frac)),
c_counts AS (
  SELECT candidate, k_order, k_frac, max(n_rows) AS n_rows, CAST(sum(y) AS BIGINT) AS positives,
    avg(power(score - y, 2)) AS brier_score,
    greatest(1, CAST(round_even(max(n_rows) * k_frac, 0) AS BIGINT)) AS k,
    count(*) FILTER (WHERE y = 1
      AND rank <= greatest(1, CAST(round_even(n_rows * k_frac, 0) AS BIGINT))) AS tp
  FROM c_ranked CROSS JOIN sweep GROUP BY candidate, k_order, k_frac),
c_groups AS (
  SELECT candidate, score, count(*) AS n, sum(y) AS p FROM candidates GROUP BY candidate, score),
c_steps AS (
  SELECT candidate, p, sum(n) OVER w AS cn, sum(p) OVER w AS cp,
    sum(p) OVER (PARTITION BY candidate) AS tp
  FROM c_groups WINDOW w AS (PARTITION BY candidate ORDER BY score DESC)),
c_ap AS (
  SELECT candidate, sum(p * cp::DOUBLE / cn) / max(tp) AS pr_auc FROM c_steps GROUP BY candidate),
c_eval AS (
  SELECT *, tp::DOUBLE / k AS precision, coalesce(tp::DOUBLE / nullif(positives, 0), 0) AS recall,
    (tp::DOUBLE / k) / nullif(positives::DOUBLE / n_rows, 0) AS lift
  FROM c_counts JOIN c_ap USING (candidate))"""


def print_sql(columns) -> str:
    """The text of a row that the fingerprint hashes."""
    cells = [
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'N')" for c in columns
    ]
    return f"concat_ws(';', {', '.join(cells)})"


def sums_sql(h: str = "h") -> str:
    return ", ".join(
        f"CAST(sum(('0x' || substr({h}, {8 * i + 1}, 8))::BIGINT) AS VARCHAR) AS sum_{i + 1}"
        for i in range(4)
    )


#: Added before rounding to five places, so that no rate of few rows lies on the edge.
SHIFT = 1.7e-6


def r5_sql(value: str) -> str:
    return f"round({value} + {SHIFT!r}::DOUBLE, 5) + 0.0"


def evaluation_sql(fractions: str) -> str:
    """Metrics of ``scored (candidate, id, y, score)`` per candidate and K."""
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY score DESC, id) AS rank,
  count(*) OVER (PARTITION BY candidate) AS n, sum(y) OVER (PARTITION BY candidate) AS positives FROM scored),
sweep AS (SELECT unnest({fractions})::DOUBLE AS k_frac),
at_k AS (SELECT candidate, k_frac, greatest(1, CAST(round_even(max(n) * k_frac, 0) AS BIGINT)) AS k,
    max(n) AS n_rows, max(positives)::DOUBLE AS positives, avg(power(score - y, 2)) AS brier_score,
    count(*) FILTER (WHERE y = 1 AND rank <= greatest(1, CAST(round_even(n * k_frac, 0) AS BIGINT))) AS tp
  FROM ranked, sweep GROUP BY candidate, k_frac),
groups AS (SELECT candidate, score, count(*) AS n, sum(y) AS p FROM scored GROUP BY candidate, score),
totals AS (SELECT candidate, p, sum(n) OVER w AS cn, sum(p) OVER w AS cp,
  sum(p) OVER (PARTITION BY candidate) AS tp FROM groups WINDOW w AS (PARTITION BY candidate ORDER BY score DESC)),
precision AS (SELECT candidate, sum(p * cp::DOUBLE / cn) / max(tp) AS pr_auc FROM totals GROUP BY candidate)"""


#: The record of a training run from ``at_k`` and ``precision``, as rows of one candidate.
RECORD_SQL = f"""{r5_sql("tp::DOUBLE / k")} AS precision_at_k,
  {r5_sql("(tp::DOUBLE / k) / (positives / n_rows)")} AS lift_at_k, {r5_sql("pr_auc")} AS pr_auc,
  {r5_sql("brier_score")} AS brier_score"""
