"""Data-quality rules on orders turned into scoring input with known faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.ranking import scored
from catalog.registry import query
from catalog.sql import SCORED_SQL
from catalog.tables import table
from tenura.operators import quality
from tenura.operators.quality import BOOLEAN, CATEGORICAL, DECIMAL, INTEGER, InputColumn

ID = "customer_id"
SPECS = [
    InputColumn("opted_in", BOOLEAN),
    InputColumn("visits", INTEGER),
    InputColumn("balance", DECIMAL),
    InputColumn("tier", CATEGORICAL, allowed=("Silver", "Gold")),
    InputColumn("device", CATEGORICAL, True, ("Phone", "Tablet"), ("No Device",)),
]
SPEC = {s.name: s for s in SPECS}

_INPUT = {
    ID: "CASE WHEN k % 997 = 5 THEN NULL WHEN k % 997 = 6 THEN '  ' WHEN k % 997 = 7 THEN 'K1' "
    "ELSE concat('K', CAST(k AS {text})) END",
    "opted_in": "CAST(CASE WHEN k % 499 = 1 THEN 2 WHEN k % 499 = 2 THEN NULL ELSE k % 2 END AS {int})",
    "visits": "CASE WHEN k % 601 = 1 THEN o_custkey + CAST(0.5 AS DOUBLE) "
    "WHEN k % 601 = 2 THEN CAST('NaN' AS DOUBLE) "
    "WHEN k % 601 = 3 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END",
    "balance": "CASE WHEN k % 701 = 1 THEN NULL WHEN k % 701 = 2 THEN CAST('-Infinity' AS DOUBLE) "
    "ELSE o_totalprice END",
    "tier": "CASE WHEN k % 809 = 1 THEN 'Bronze' WHEN k % 809 = 2 THEN NULL WHEN k % 2 = 0 "
    "THEN 'Silver' ELSE 'Gold' END",
    "device": "CASE WHEN k % 907 = 1 THEN 'No Device' WHEN k % 907 = 2 THEN 'Laptop' "
    "WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'Phone' ELSE 'Tablet' END",
}
_ORDERS = "(SELECT *, o_orderkey AS k FROM orders)"
INPUT_SQL = "input AS (SELECT " + ", ".join(
    e.format(text="VARCHAR", int="INTEGER") + f' AS "{n}"' for n, e in _INPUT.items()
) + f" FROM {_ORDERS})"


def scoring_input(spark, sf_dir, columns=tuple(_INPUT)):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k")
    return orders.selectExpr(
        *[_INPUT[c].format(text="STRING", int="INT") + f" AS `{c}`" for c in columns]
    )


def typed_input(spark, sf_dir):
    """The same table with columns of the wrong types."""
    wrong = {
        ID: "k",
        "opted_in": "CAST(k % 2 AS STRING)",
        "visits": "CAST(o_custkey AS STRING)",
        "balance": "o_totalprice > 1000",
        "tier": "k % 2",
        "device": "IF(k % 3 = 0, NULL, o_totalprice)",
    }
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k")
    return orders.selectExpr(*[f"{e} AS `{c}`" for c, e in wrong.items()])


def _offending(rule, column, where, id_sql=ID):
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", count(*) AS offending,
  min({id_sql}) AS first_id FROM input WHERE {where}"""


_WHERE = {
    ("id_missing", ID): f"{ID} IS NULL",
    ("id_blank", ID): f"trim({ID}) = ''",
    ("null_not_allowed", "opted_in"): "opted_in IS NULL",
    ("bad_boolean", "opted_in"): "opted_in NOT IN (0, 1)",
    ("nan", "visits"): 'isnan("visits")',
    ("infinite", "visits"): 'isinf("visits")',
    ("not_whole", "visits"): 'NOT isnan("visits") AND NOT isinf("visits") AND "visits" <> floor("visits")',
    ("null_not_allowed", "balance"): "balance IS NULL",
    ("infinite", "balance"): "isinf(balance)",
    ("null_not_allowed", "tier"): "tier IS NULL",
    ("unseen_category", "tier"): "tier NOT IN ('Silver', 'Gold')",
    ("sentinel", "device"): "device = 'No Device'",
    ("unseen_category", "device"): "device NOT IN ('Phone', 'Tablet', 'No Device')",
}
_DUPLICATE = f"""SELECT 'id_duplicate' AS rule, '{ID}' AS "column",
  CAST(sum(n) AS BIGINT) AS offending, min({ID}) AS first_id
FROM (SELECT {ID}, count(*) - 1 AS n FROM input WHERE {ID} IS NOT NULL GROUP BY {ID})
WHERE n > 0"""


def _rule_query(name, rule, columns):
    keys = [k for k in _WHERE if k[0] == rule and k[1] in columns]
    sql = f"WITH {INPUT_SQL} " + " UNION ALL ".join(_offending(*k, _WHERE[k]) for k in keys)

    @query(name, sql)
    def run(spark, sf_dir):
        used = [c for c in columns if c != ID]
        df = scoring_input(spark, sf_dir, (ID, *used))
        return quality.value_report(df, ID, [SPEC[c] for c in used]).where(
            F.col("rule") == rule
        )


_rule_query("dq_id_missing", "id_missing", [ID])
_rule_query("dq_id_blank", "id_blank", [ID])
_rule_query("dq_null_not_allowed", "null_not_allowed", ["opted_in", "balance", "tier"])
_rule_query("dq_nan", "nan", ["visits"])
_rule_query("dq_infinite", "infinite", ["visits", "balance"])
_rule_query("dq_sentinel", "sentinel", ["device"])
_rule_query("dq_unseen_category", "unseen_category", ["tier", "device"])
_rule_query("dq_not_whole", "not_whole", ["visits"])
_rule_query("dq_bool_domain", "bad_boolean", ["opted_in"])


@query(
    "dq_columns",
    """SELECT rule, "column", count(*) AS n_rows FROM orders, (VALUES
  ('missing_column', 'tier'), ('extra_column', 'is_voluntary_churn'),
  ('duplicate_column', 'balance')) AS p(rule, "column") GROUP BY ALL""",
)
def dq_columns(spark, sf_dir):
    df = scoring_input(spark, sf_dir)
    wrong = df.select(
        ID, "visits", "opted_in", "balance", "balance", "device", F.lit(True).alias("is_voluntary_churn")
    )
    problems = quality.column_problems(wrong.columns, [ID, *SPEC])
    rows = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column")) for r, c in problems]
    return wrong.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(F.array(*rows)))


_REPORT_RULES = [
    (rule, column)
    for column in [ID, *SPEC]
    for rule in (quality.ID_RULES if column == ID else quality.VALUE_RULES)
]
_PRECEDENCE = " ".join(
    f"WHEN rule = '{r}' AND \"column\" = '{c}' THEN {i}"
    for i, (r, c) in enumerate(_REPORT_RULES, start=10)
)


def _report_sql(source):
    found = " UNION ALL ".join([_offending(*k, w) for k, w in _WHERE.items()] + [_DUPLICATE])
    return f"""WITH {source},
found AS ({found}),
placed AS (SELECT CAST(CASE {_PRECEDENCE} END AS INTEGER) AS precedence, * FROM found
  WHERE offending > 0)
SELECT *, precedence = min(precedence) OVER () AS is_first FROM placed"""


@query("dq_report", _report_sql(INPUT_SQL))
def dq_report(spark, sf_dir):
    return quality.report(scoring_input(spark, sf_dir), ID, SPECS)


@query(
    "dq_empty_table",
    """SELECT CAST(3 AS INTEGER) AS precedence, 'empty_table' AS rule,
  CAST(NULL AS VARCHAR) AS "column", count(*) AS offending, CAST(NULL AS VARCHAR) AS first_id,
  true AS is_first FROM orders WHERE o_totalprice < 0 HAVING count(*) = 0""",
)
def dq_empty_table(spark, sf_dir):
    none_left = scoring_input(spark, sf_dir).where("balance < 0 AND balance > -1e300")
    return quality.report(none_left, ID, SPECS)


@query(
    "dq_id_not_text",
    f"""SELECT 'id_not_text' AS rule, '{ID}' AS "column", count(*) AS offending,
  min(CAST(o_orderkey AS VARCHAR)) AS first_id FROM orders""",
)
def dq_id_not_text(spark, sf_dir):
    return quality.value_report(typed_input(spark, sf_dir), ID, []).where("rule = 'id_not_text'")


@query("dq_id_duplicate", f"WITH {INPUT_SQL} {_DUPLICATE}")
def dq_id_duplicate(spark, sf_dir):
    return quality.duplicate_report(scoring_input(spark, sf_dir, (ID,)), ID)


def _typed_sql(rule, column, where="true"):
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", count(*) AS offending,
  min(CAST(o_orderkey AS VARCHAR)) AS first_id FROM orders WHERE {where}"""


@query(
    "dq_category_not_text",
    _typed_sql("category_not_text", "tier")
    + " UNION ALL "
    + _typed_sql("category_not_text", "device", "o_orderkey % 3 <> 0"),
)
def dq_category_not_text(spark, sf_dir):
    return quality.value_report(
        typed_input(spark, sf_dir), ID, [SPEC["tier"], SPEC["device"]]
    ).where("rule = 'category_not_text'")


@query(
    "dq_text_for_number",
    " UNION ALL ".join(
        [
            _typed_sql("text_for_number", "visits"),
            _typed_sql("bad_boolean", "opted_in"),
            _typed_sql("boolean_for_number", "balance"),
        ]
    ),
)
def dq_text_for_number(spark, sf_dir):
    return quality.value_report(
        typed_input(spark, sf_dir), ID, [SPEC["opted_in"], SPEC["visits"], SPEC["balance"]]
    ).where("rule <> 'id_not_text'")


@query(
    "dq_probabilities",
    f"""WITH {SCORED_SQL},
out_rows AS (
  SELECT CASE WHEN id % 613 = 1 THEN -id ELSE id END AS id,
    CASE WHEN id % 701 = 1 THEN 'NaN'::DOUBLE WHEN id % 701 = 2 THEN 1.5::DOUBLE
      WHEN id % 701 = 3 THEN 'Infinity'::DOUBLE ELSE score END AS p
  FROM scored JOIN events ON event_id = id WHERE event_type <> 'signup'),
sides AS (SELECT id, has_s IS NOT NULL AS has_in, has_o IS NOT NULL AS has_out, p
  FROM (SELECT id, 1 AS has_s FROM scored) FULL JOIN (SELECT *, 1 AS has_o FROM out_rows)
    USING (id)),
rules AS (
  SELECT id, CASE WHEN NOT has_out THEN 'not_scored' WHEN NOT has_in THEN 'unknown_id'
    WHEN isnan(p) OR isinf(p) THEN 'not_finite' WHEN p < 0 OR p > 1 THEN 'out_of_range' END AS rule
  FROM sides)
SELECT rule, count(*) AS offending, min(id) AS first_id FROM rules WHERE rule IS NOT NULL
GROUP BY rule""",
)
def dq_probabilities(spark, sf_dir):
    """Sign-ups are not scored; some outputs have a wrong id or an unusable number."""
    inputs = scored(spark, sf_dir)
    outputs = scored(spark, sf_dir, "event_type <> 'signup'").selectExpr(
        "IF(id % 613 = 1, -id, id) AS id",
        """CASE WHEN id % 701 = 1 THEN CAST('NaN' AS DOUBLE) WHEN id % 701 = 2 THEN 1.5D
          WHEN id % 701 = 3 THEN CAST('Infinity' AS DOUBLE) ELSE score END AS p""",
    )
    return quality.probability_report(inputs, outputs, "id", "p")


@query(
    "dq_metrics_record",
    """WITH r AS (
  SELECT user_id AS record, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS p,
    count(*) FILTER (WHERE event_type = 'click') AS c FROM events GROUP BY user_id),
rows_ AS (
  SELECT record, name, CASE
      WHEN name = 'estimate_type' THEN CASE WHEN record % 5 = 1 THEN ' ' ELSE '"""
    + quality.ESTIMATE_TYPE
    + """' END
      WHEN name = 'training_rows' AND record % 6 = 1 THEN concat(CAST(n AS VARCHAR), '.5')
      WHEN name = 'pr_auc' AND record % 4 = 1 THEN 'NaN'
      WHEN name = 'lift_at_k' AND record % 8 = 1 THEN 'high'
      ELSE CAST(n AS VARCHAR) END AS value
  FROM r, (VALUES ('k'), ('training_rows'), ('estimate_type'), ('precision_at_k'), ('lift_at_k'),
    ('pr_auc'), ('brier_score'), ('accuracy')) AS names(name)
  , unnest(CASE WHEN name = 'k' AND record % 7 = 2 THEN [1, 2] ELSE [1] END) AS t(copy)
  WHERE (name <> 'brier_score' OR p <= c) AND (name <> 'accuracy' OR p < c)
    AND (record % 11 <> 3 OR name = 'accuracy'))
SELECT record, name, CASE WHEN name = 'accuracy' THEN 'unexpected'
    WHEN name = 'estimate_type' THEN 'wrong_text'
    WHEN name = 'training_rows' THEN 'not_whole' ELSE 'not_finite' END AS problem
FROM rows_ WHERE name = 'accuracy' OR (name = 'estimate_type' AND value = ' ')
  OR (name = 'training_rows' AND value LIKE '%.5') OR value IN ('NaN', 'high')
UNION ALL SELECT record, name, 'repeated' FROM rows_ WHERE name <> 'accuracy'
  GROUP BY record, name HAVING count(*) > 1
UNION ALL SELECT record, name, 'missing' FROM (SELECT DISTINCT record FROM rows_), (VALUES ('k'),
  ('training_rows'), ('estimate_type'), ('precision_at_k'), ('lift_at_k'), ('pr_auc'),
  ('brier_score')) AS names(name)
  WHERE (record, name) NOT IN (SELECT (record, name) FROM rows_)""",
)
def dq_metrics_record(spark, sf_dir):
    names = ", ".join(f"'{n}'" for n in [*quality.METRIC_KEYS, "accuracy"])
    records = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("record"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("event_type") == "purchase").alias("p"),
            F.count_if(F.col("event_type") == "click").alias("c"),
        )
        .selectExpr("record", "n", "p", "c", f"explode(array({names})) AS name")
        .where("(name <> 'brier_score' OR p <= c) AND (name <> 'accuracy' OR p < c)")
        .where("record % 11 <> 3 OR name = 'accuracy'")
        .selectExpr("*", "explode(IF(name = 'k' AND record % 7 = 2, array(1, 2), array(1)))")
        .selectExpr(
            "record",
            "name",
            f"""CASE WHEN name = 'estimate_type' THEN IF(record % 5 = 1, ' ', '{quality.ESTIMATE_TYPE}')
              WHEN name = 'training_rows' AND record % 6 = 1 THEN concat(n, '.5')
              WHEN name = 'pr_auc' AND record % 4 = 1 THEN 'NaN'
              WHEN name = 'lift_at_k' AND record % 8 = 1 THEN 'high'
              ELSE CAST(n AS STRING) END AS value""",
        )
    )
    return quality.metrics_record_report(records)
