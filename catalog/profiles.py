"""Profiles of the derived and given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.preparation import INPUTS, features, outcome
from catalog.registry import query, r6
from catalog.sql import FEATURE_SQL, TARGET_SQL
from catalog.tables import raw_status, table
from tenura.operators import encoding, integrity, profile
from tenura.plans import prepare
from tenura.plans.prepare import TARGET


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}{select}" if select.lstrip().startswith(",") else f"WITH {ctes}\n{select}"


@query(
    "duplicate_keys",
    " UNION ALL ".join(
        f"SELECT '{t}.{k}' AS key_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, "
        f"count(*) - count(DISTINCT {k}) AS duplicates FROM {t}"
        for t, k in [
            ("customer", "c_custkey"),
            ("orders", "o_custkey"),
            ("lineitem", "l_orderkey"),
            ("events", "user_id"),
        ]
    ),
)
def duplicate_keys(spark, sf_dir):
    out = None
    for t, k in [
        ("customer", "c_custkey"),
        ("orders", "o_custkey"),
        ("lineitem", "l_orderkey"),
        ("events", "user_id"),
    ]:
        found = integrity.duplicate_keys(table(spark, sf_dir, t), k).select(
            F.lit(f"{t}.{k}").alias("key_name"), "n_rows", "n_keys", "duplicates"
        )
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "constant_column_check",
    """
SELECT 'l_linestatus' AS checked, l_linestatus AS value, count(*) AS n_rows,
  (SELECT count(DISTINCT l_linestatus) FROM lineitem) AS distinct_values,
  (SELECT count(DISTINCT l_linestatus) = 1 FROM lineitem) AS is_constant
FROM lineitem GROUP BY l_linestatus
UNION ALL
SELECT 'quarter', 'Q3', count(DISTINCT o_custkey), 1, true FROM orders""",
)
def constant_column_check(spark, sf_dir):
    status = prepare.stage(raw_status(spark, sf_dir))
    line = integrity.constant_column(table(spark, sf_dir, "lineitem"), "l_linestatus")
    quarter = integrity.constant_column(status, "quarter")
    return line.select(F.lit("l_linestatus").alias("checked"), "*").unionByName(
        quarter.select(F.lit("quarter").alias("checked"), "*")
    )


@query(
    "value_counts_pct",
    _with(
        TARGET_SQL,
        """SELECT is_voluntary_churn AS value, count(*) AS n_rows,
  round(100.0::DOUBLE * (count(*)::DOUBLE / sum(count(*)) OVER ()), 2) AS percent
FROM tgt GROUP BY is_voluntary_churn""",
    ),
)
def value_counts_pct(spark, sf_dir):
    return profile.value_counts(outcome(spark, sf_dir), TARGET)


@query(
    "overall_rate",
    _with(
        TARGET_SQL,
        """SELECT count(*) AS n_rows,
  round(100.0::DOUBLE * avg(CAST(is_voluntary_churn AS DOUBLE)), 6) AS rate_pct FROM tgt""",
    ),
)
def overall_rate(spark, sf_dir):
    rate = profile.overall_rate(outcome(spark, sf_dir), TARGET)
    return rate.select("n_rows", r6("rate_pct").alias("rate_pct"))


def _rates_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows,
  round(100.0::DOUBLE * avg(CAST(is_voluntary_churn AS DOUBLE)), 6) AS rate_pct
FROM feat WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in columns
    )


def _rates(df):
    return df.select("feature", "value", "n_rows", r6("rate_pct").alias("rate_pct"))


_CATEGORIES = ["contract", "internet_type", "payment_method"]
_DERIVED = ["num_addon_services", "is_month_to_month"]


@query("rate_by_category", _with(FEATURE_SQL, _rates_sql(_CATEGORIES)))
def rate_by_category(spark, sf_dir):
    rates = profile.rates_by_value(features(spark, sf_dir), _CATEGORIES, TARGET)
    return _rates(rates).orderBy("feature", F.col("rate_pct").desc())


@query("rate_by_feature", _with(FEATURE_SQL, _rates_sql(_DERIVED)))
def rate_by_feature(spark, sf_dir):
    return _rates(profile.rates_by_value(features(spark, sf_dir), _DERIVED, TARGET))


@query(
    "subgroup_vs_overall",
    _with(
        FEATURE_SQL,
        """SELECT internet_without_security, count(*) AS n_rows,
  round(100.0::DOUBLE * avg(CAST(is_voluntary_churn AS DOUBLE)), 6) AS rate_pct
FROM feat WHERE internet_service AND internet_without_security IS NOT NULL
GROUP BY ROLLUP (internet_without_security)""",
    ),
)
def subgroup_vs_overall(spark, sf_dir):
    rates = profile.subgroup_rates(
        features(spark, sf_dir), F.col("internet_service"), "internet_without_security", TARGET
    )
    return rates.select("internet_without_security", "n_rows", r6("rate_pct").alias("rate_pct"))


@query(
    "reach_fraction",
    _with(
        FEATURE_SQL,
        """SELECT count(*) AS positives, count(*) FILTER (WHERE is_month_to_month) AS reached,
  round(100.0::DOUBLE * (count(*) FILTER (WHERE is_month_to_month)::DOUBLE / count(*)), 6)
    AS reach_pct
FROM feat WHERE is_voluntary_churn""",
    ),
)
def reach_fraction(spark, sf_dir):
    reached = profile.reach(features(spark, sf_dir), F.col("is_month_to_month"), TARGET)
    return reached.select("positives", "reached", r6("reach_pct").alias("reach_pct"))


@query(
    "crosstab",
    """WITH r AS (SELECT DISTINCT o_orderpriority FROM orders),
c AS (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL)
SELECT r.o_orderpriority, c.o_orderstatus, (SELECT count(*) FROM orders o
  WHERE o.o_orderpriority IS NOT DISTINCT FROM r.o_orderpriority AND o.o_orderstatus = c.o_orderstatus) AS n_rows
FROM r, c""",
)
def crosstab(spark, sf_dir):
    return profile.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    "non_null_by_group",
    _with(
        TARGET_SQL,
        """SELECT customer_status, count(churn_reason) AS non_null_count, count(*) AS total_count
FROM stg_status GROUP BY customer_status""",
    ),
)
def non_null_by_group(spark, sf_dir):
    status = prepare.stage(raw_status(spark, sf_dir))
    return profile.present_by_group(status, "customer_status", "churn_reason")


_ALLOWED = ["gender", "contract", "payment_method", "internet_type", "offer"]


@query(
    "distinct_allowed_values",
    _with(
        FEATURE_SQL,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n_rows
FROM feat WHERE {c} IS NOT NULL GROUP BY {c}"""
            for c in _ALLOWED
        ),
    ),
)
def distinct_allowed_values(spark, sf_dir):
    return profile.distinct_values(features(spark, sf_dir), _ALLOWED)


_HISTOGRAM = """
h_range AS (SELECT class, min(v) AS lo, max(v) AS hi, count(*) AS total FROM h GROUP BY class),
h_bin AS (
  SELECT class, CAST(least(floor((v - lo) * 30 / (hi - lo)), 29) AS INTEGER) AS bin,
    count(*) AS n FROM h JOIN h_range USING (class) GROUP BY ALL),
h_all AS (
  SELECT class, CAST(bin AS INTEGER) AS bin, lo, hi, total, coalesce(n, 0) AS n
  FROM (SELECT *, unnest(range(30)) AS bin FROM h_range) LEFT JOIN h_bin USING (class, bin))"""
_EDGES = """bin, round(lo + bin * ((hi - lo) / 30), 6) + 0.0 AS lower,
  round(lo + (bin + 1) * ((hi - lo) / 30), 6) + 0.0 AS upper, n AS n_rows"""


@query(
    "histogram",
    f"""WITH h AS (SELECT '' AS class, l_extendedprice AS v FROM lineitem), {_HISTOGRAM}
SELECT {_EDGES} FROM h_all""",
)
def histogram(spark, sf_dir):
    bins = profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return bins.select("bin", r6("lower").alias("lower"), r6("upper").alias("upper"), "n_rows")


@query(
    "histogram_by_class_density",
    _with(
        FEATURE_SQL,
        f""", h AS (SELECT CAST(is_voluntary_churn AS VARCHAR) AS class, monthly_charge AS v
  FROM feat), {_HISTOGRAM}
SELECT class, {_EDGES}, round(n / (total * ((hi - lo) / 30)), 9) AS density FROM h_all""",
    ),
)
def histogram_by_class_density(spark, sf_dir):
    view = features(spark, sf_dir).select("monthly_charge", TARGET)
    bins = profile.histogram(view, "monthly_charge", by=TARGET)
    return bins.select(
        "class",
        "bin",
        r6("lower").alias("lower"),
        r6("upper").alias("upper"),
        "n_rows",
        F.round("density", 9).alias("density"),
    )


@query(
    "rule_metrics",
    _with(
        FEATURE_SQL,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS flagged,
  count(*) FILTER (WHERE ({rule}) AND is_voluntary_churn) AS hits,
  round(count(*) FILTER (WHERE {rule})::DOUBLE / count(*), 6) AS flagged_share,
  round(count(*) FILTER (WHERE ({rule}) AND is_voluntary_churn)::DOUBLE
    / nullif(count(*) FILTER (WHERE {rule}), 0), 6) AS precision,
  round(coalesce(count(*) FILTER (WHERE ({rule}) AND is_voluntary_churn)::DOUBLE
    / nullif(count(*) FILTER (WHERE is_voluntary_churn), 0), 0), 6) AS recall
FROM feat"""
            for name, rule in [
                ("month_to_month", "is_month_to_month"),
                ("either", "is_month_to_month OR internet_without_security"),
                ("rare", "no_addons_despite_internet"),
            ]
        ),
    ),
)
def rule_metrics(spark, sf_dir):
    monthly, unsafe = F.col("is_month_to_month"), F.col("internet_without_security")
    found = profile.rule_metrics(
        features(spark, sf_dir),
        {
            "month_to_month": monthly,
            "either": monthly | unsafe,
            "rare": F.col("no_addons_despite_internet"),
        },
        TARGET,
    )
    rates = ["flagged_share", "precision", "recall"]
    return found.select("rule", "flagged", "hits", *[r6(c).alias(c) for c in rates])


@query(
    "leakage_separation_screen",
    _with(
        TARGET_SQL,
        ", feat AS (SELECT s.*, is_voluntary_churn FROM tgt JOIN cln_status s USING (customer_id)) "
        "SELECT *, rate_pct IN (0, 100) AS separates FROM ("
        + _rates_sql(prepare.FORBIDDEN_COLUMNS)
        + ")",
    ),
)
def leakage_separation_screen(spark, sf_dir):
    status = prepare.cleaned_tables({"status": raw_status(spark, sf_dir)})["status"]
    suspects = list(prepare.FORBIDDEN_COLUMNS)
    labelled = prepare.target(status).select(prepare.ID, TARGET).join(
        status.select(prepare.ID, *suspects), prepare.ID
    )
    screen = profile.separation_screen(labelled, suspects, TARGET)
    return screen.select(
        "feature", "value", "n_rows", r6("rate_pct").alias("rate_pct"), "separates"
    )


_CORRELATED = [c for c in INPUTS if c not in encoding.CATEGORICAL_COLUMNS]
_PAIRS = [(a, b) for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1 :]]


@query(
    "feature_correlation",
    _with(
        FEATURE_SQL,
        ", p AS (SELECT unnest(["
        + ", ".join(
            f"{{'a': '{a}', 'b': '{b}', 'r': corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))}}"
            for a, b in _PAIRS
        )
        + "]) AS p FROM feat), found AS (SELECT p.a AS a, p.b AS b, "
        "CASE WHEN isfinite(p.r) THEN p.r END AS r FROM p) "
        "SELECT a, b, round(r, 6) + 0.0 AS r, coalesce(abs(r) >= 0.6, false) AS strong, "
        "coalesce(abs(r) >= 1 - 1e-9, false) AS exact FROM found",
    ),
)
def feature_correlation(spark, sf_dir):
    pairs = profile.correlations(features(spark, sf_dir), _CORRELATED)
    return pairs.select("a", "b", r6("r").alias("r"), "strong", "exact")


@query(
    "category_reason_crosstab",
    _with(
        TARGET_SQL,
        """, churned AS (SELECT churn_category, churn_reason FROM cln_status WHERE customer_status = 'Churned'),
r AS (SELECT DISTINCT churn_category FROM churned),
c AS (SELECT DISTINCT churn_reason FROM churned WHERE churn_reason IS NOT NULL),
n AS (SELECT churn_category, churn_reason, count(*) AS n_rows FROM churned GROUP BY ALL)
SELECT r.churn_category, c.churn_reason, coalesce(n.n_rows, 0) AS n_rows FROM r CROSS JOIN c
LEFT JOIN n ON n.churn_category IS NOT DISTINCT FROM r.churn_category AND n.churn_reason = c.churn_reason""",
    ),
)
def category_reason_crosstab(spark, sf_dir):
    churned = prepare.stage(raw_status(spark, sf_dir)).where("customer_status = 'Churned'")
    return profile.crosstab(churned, "churn_category", "churn_reason")


@query(
    "label_consistency",
    _with(
        TARGET_SQL,
        """, c AS (SELECT customer_status, churn_label, churn_value, count(*) AS n_rows
  FROM cln_status GROUP BY ALL)
SELECT *, (SELECT max(n) = 1 FROM (SELECT count(*) AS n FROM c GROUP BY customer_status))
  AND (SELECT max(n) = 1 FROM (SELECT count(*) AS n FROM c GROUP BY churn_label))
  AND (SELECT max(n) = 1 FROM (SELECT count(*) AS n FROM c GROUP BY churn_value)) AS one_to_one
FROM c""",
    ),
)
def label_consistency(spark, sf_dir):
    status = prepare.cleaned_tables({"status": raw_status(spark, sf_dir)})["status"]
    return profile.label_combinations(status, ["customer_status", "churn_label", "churn_value"])
