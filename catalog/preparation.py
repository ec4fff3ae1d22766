"""Sources, preparation, joins and features on the derived tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.registry import query, r6
from catalog.sql import FEATURE_SQL, TARGET_SQL, VIEW_SQL, split_sql
from catalog.tables import (
    STAGED_SQL,
    raw_demographics,
    raw_location,
    raw_population,
    raw_services,
    raw_status,
    raw_tables,
    table,
)
from tenura.functions import yes_no
from tenura.operators import encoding, integrity, profile, quality, sampling
from tenura.plans import prepare
from tenura.sources import tables as sources
from tenura.sources.workspace import new_path, read_table, replace_table, store


def features(spark, sf_dir):
    return prepare.feature_table(raw_tables(spark, sf_dir))


def split_features(spark, sf_dir, columns=None):
    """Features with their part; written once, as the fits below read them again."""
    view = features(spark, sf_dir)
    if columns:
        view = view.select(prepare.ID, prepare.TARGET, *columns)
    return sampling.stratified_split(store(view, "features"), prepare.ID, prepare.TARGET)


def outcome(spark, sf_dir):
    status = prepare.stage(raw_status(spark, sf_dir))
    return prepare.target(prepare.clean(status, prepare.YES_NO_COLUMNS["status"]))


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}{select}" if select.lstrip().startswith(",") else f"WITH {ctes}\n{select}"


_CSV = """
SELECT "Customer ID", "Count", "Gender", "Age", "Under 30", "Senior Citizen", "Married",
  "Dependents", "Number of Dependents" FROM (
SELECT customer_id AS "Customer ID", CAST(1 AS BIGINT) AS "Count", gender AS "Gender",
  age AS "Age", under_30 AS "Under 30", senior_citizen AS "Senior Citizen", married AS "Married",
  dependents AS "Dependents", number_of_dependents AS "Number of Dependents"
FROM stg_demographics)"""


@query("scan_csv_typed", _with(STAGED_SQL, _CSV))
def scan_csv_typed(spark, sf_dir):
    path = new_path(spark, "csv")
    raw_demographics(spark, sf_dir).write.option("header", True).csv(path)
    return sources.scan_csv(spark, path, sources.source_schema("demographics"))


@query("table_materialize", _with(TARGET_SQL, "SELECT * FROM tgt"))
def table_materialize(spark, sf_dir):
    """A table that exists is replaced from a plan that reads it."""
    path, rows = new_path(spark, "target"), outcome(spark, sf_dir)
    replace_table(rows.where("NOT is_voluntary_churn"), path)
    return replace_table(read_table(spark, path).unionByName(rows.where("is_voluntary_churn")), path)


@query(
    "source_shape_check",
    """
SELECT * FROM (
  SELECT 'orders' AS source, 'row_count' AS problem, '7043' AS expected,
    CAST(count(*) AS VARCHAR) AS actual FROM orders
  UNION ALL SELECT 'customer', 'row_count', '7043', CAST(count(*) AS VARCHAR) FROM customer
  UNION ALL SELECT 'events', 'row_count', '7043', CAST(count(*) AS VARCHAR) FROM events)
WHERE expected <> actual
UNION ALL VALUES
  ('invoices', 'absent', 'present', 'absent'),
  ('customer', 'column_count', '4', '5'),
  ('customer', 'missing_columns', 'c_phone', ''),
  ('customer', 'unexpected_columns', '', 'c_nationkey, c_acctbal'),
  ('events', 'column_order', 'ts, event_id, user_id, event_type, value, props',
   'event_id, ts, user_id, event_type, value, props')""",
)
def source_shape_check(spark, sf_dir):
    expected = {
        "orders": [
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        ],
        "customer": ["c_custkey", "c_name", "c_phone", "c_mktsegment"],
        "events": ["ts", "event_id", "user_id", "event_type", "value", "props"],
        "invoices": ["id"],
    }
    present = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "events")}
    return sources.shape_report(present, expected, dict.fromkeys(expected, 7043))


@query(
    "table_row_counts",
    _with(
        FEATURE_SQL,
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}"
            for n, t in [
                ("demographics", "cln_demographics"),
                ("location", "stg_location"),
                ("population", "stg_population"),
                ("services", "cln_services"),
                ("status", "cln_status"),
                ("target", "tgt"),
                ("view", "mv"),
                ("features", "feat"),
            ]
        ),
    ),
)
def table_row_counts(spark, sf_dir):
    cleaned = prepare.cleaned_tables(raw_tables(spark, sf_dir))
    done = prepare.target(cleaned["status"])
    view = prepare.modeling_view(done, *[cleaned[n] for n in list(cleaned)[:4]])
    return sources.row_counts(
        {**cleaned, "target": done, "view": view, "features": prepare.add_features(view)}
    )


@query("stage_rename", _with(STAGED_SQL, "SELECT * FROM stg_services"))
def stage_rename(spark, sf_dir):
    return prepare.stage(raw_services(spark, sf_dir))


@query(
    "drop_constant_artifact",
    _with(STAGED_SQL, "SELECT * EXCLUDE (lat_long) FROM stg_location"),
)
def drop_constant_artifact(spark, sf_dir):
    return prepare.stage(raw_location(spark, sf_dir), ("Count", "Lat Long"))


@query(
    "yes_no_to_boolean",
    """
WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No'
  ELSE 'Maybe' END AS answer FROM orders)
SELECT o_orderkey, answer, CASE answer WHEN 'Yes' THEN true WHEN 'No' THEN false END AS flag
FROM t""",
)
def yes_no_to_boolean(spark, sf_dir):
    status = F.col("o_orderstatus")
    answer = F.when(status == "F", "Yes").when(status == "O", "No").otherwise("Maybe")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", answer.alias("answer"))
    return orders.withColumn("flag", yes_no("answer"))


@query("clean_services", _with(TARGET_SQL, "SELECT * FROM cln_services"))
def clean_services(spark, sf_dir):
    return prepare.cleaned_tables({"services": raw_services(spark, sf_dir)})["services"]


@query(
    "null_safe_exclude",
    _with(
        STAGED_SQL,
        """SELECT customer_id, churn_reason FROM stg_status
WHERE churn_reason IS DISTINCT FROM 'Deceased'""",
    ),
)
def null_safe_exclude(spark, sf_dir):
    return outcome(spark, sf_dir).select("customer_id", "churn_reason")


@query("target_label", _with(TARGET_SQL, "SELECT * FROM tgt"))
def target_label(spark, sf_dir):
    return outcome(spark, sf_dir)


_ALLOWED = {
    "demographics": prepare.DEMOGRAPHIC_FEATURES,
    "location": prepare.LOCATION_FEATURES,
    "services": prepare.SERVICE_FEATURES,
}


@query(
    "modeling_allow_list",
    _with(
        TARGET_SQL,
        f"""SELECT customer_id, is_voluntary_churn, {", ".join(c for cs in _ALLOWED.values() for c in cs)}
FROM tgt JOIN cln_demographics USING (customer_id) JOIN stg_location USING (customer_id)
  JOIN cln_services USING (customer_id)""",
    ),
)
def modeling_allow_list(spark, sf_dir):
    """Of all customer tables the columns that a model may see; the others are never selected."""
    cleaned = prepare.cleaned_tables(raw_tables(spark, sf_dir))
    allowed = outcome(spark, sf_dir).select(prepare.ID, prepare.TARGET)
    for name, columns in _ALLOWED.items():
        allowed = allowed.join(cleaned[name].select(prepare.ID, *columns), prepare.ID)
    return allowed


@query(
    "leakage_absent_check",
    _with(
        TARGET_SQL,
        """
SELECT 'status' AS table_name, 'churn_category' AS "column", count(churn_category) AS non_null
  FROM cln_status
UNION ALL SELECT 'status', 'churn_reason', count(churn_reason) FROM cln_status
UNION ALL SELECT 'status', 'churn_label', count(churn_label) FROM cln_status
UNION ALL SELECT 'status', 'churn_value', count(churn_value) FROM cln_status
UNION ALL SELECT 'status', 'churn_score', count(churn_score) FROM cln_status
UNION ALL SELECT 'status', 'cltv', count(cltv) FROM cln_status
UNION ALL SELECT 'status', 'customer_status', count(customer_status) FROM cln_status
UNION ALL SELECT 'status', 'satisfaction_score', count(satisfaction_score) FROM cln_status
UNION ALL SELECT 'target', 'customer_status', count(customer_status) FROM tgt
UNION ALL SELECT 'target', 'churn_category', count(churn_category) FROM tgt
UNION ALL SELECT 'target', 'churn_reason', count(churn_reason) FROM tgt""",
    ),
)
def leakage_absent_check(spark, sf_dir):
    cleaned = prepare.cleaned_tables(raw_tables(spark, sf_dir))
    done = prepare.target(cleaned["status"])
    view = prepare.modeling_view(done, *[cleaned[n] for n in list(cleaned)[:4]])
    tables = {"status": cleaned["status"], "target": done, "view": view}
    return integrity.forbidden_columns(tables, prepare.FORBIDDEN_COLUMNS)


INPUTS = [
    c
    for c in [*prepare.VIEW_COLUMNS, "num_addon_services", "is_month_to_month"]
    + ["internet_without_security", "no_addons_despite_internet", "is_tenure_censored"]
    if c not in (*encoding.EXCLUDED_COLUMNS, prepare.TARGET)
]


@query(
    "select_model_columns",
    _with(
        FEATURE_SQL,
        f"""SELECT customer_id, CAST(is_voluntary_churn AS DOUBLE) AS label, {", ".join(INPUTS)}
FROM feat""",
    ),
)
def select_model_columns(spark, sf_dir):
    return encoding.select_model_columns(features(spark, sf_dir))


@query(
    "scoring_population",
    _with(
        FEATURE_SQL + "," + split_sql("feat"),
        f"SELECT customer_id, {', '.join(INPUTS)} FROM split WHERE part = 'test'",
    ),
)
def scoring_population(spark, sf_dir):
    split = split_features(spark, sf_dir)
    return split.where("part = 'test'").select(prepare.ID, *INPUTS)


@query(
    "range_invariants",
    _with(
        FEATURE_SQL,
        """
SELECT 'monthly_charge_negative' AS rule, count(*) FILTER (WHERE monthly_charge < 0) AS violations
  FROM cln_services
UNION ALL SELECT 'tenure_negative', count(*) FILTER (WHERE tenure_in_months < 0) FROM cln_services
UNION ALL SELECT 'tenure_missing', count(*) FILTER (WHERE tenure_in_months IS NULL)
  FROM cln_services
UNION ALL SELECT 'security_missing', count(*) FILTER (WHERE online_security IS NULL)
  FROM cln_services
UNION ALL SELECT 'score_out_of_range', count(*) FILTER (WHERE satisfaction_score NOT BETWEEN 1 AND 4)
  FROM cln_status
UNION ALL SELECT 'value_not_binary', count(*) FILTER (WHERE churn_value NOT IN (0, 1))
  FROM cln_status""",
    ),
)
def range_invariants(spark, sf_dir):
    cleaned = prepare.cleaned_tables(
        {"services": raw_services(spark, sf_dir), "status": raw_status(spark, sf_dir)}
    )
    services = quality.invariant_report(
        cleaned["services"],
        {
            "monthly_charge_negative": F.col("monthly_charge") < 0,
            "tenure_negative": F.col("tenure_in_months") < 0,
            "tenure_missing": F.col("tenure_in_months").isNull(),
            "security_missing": F.col("online_security").isNull(),
        },
    )
    status = quality.invariant_report(
        cleaned["status"],
        {
            "score_out_of_range": ~F.col("satisfaction_score").between(1, 4),
            "value_not_binary": ~F.col("churn_value").isin(0, 1),
        },
    )
    return services.unionByName(status)


@query(
    "describe_types",
    """
SELECT 1 AS position, 'o_orderkey' AS "column", 'bigint' AS type, count(o_orderkey) AS non_null
  FROM orders
UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def describe_types(spark, sf_dir):
    return integrity.column_types(table(spark, sf_dir, "orders"))


@query(
    "inner_join_chain",
    _with(
        TARGET_SQL,
        """SELECT customer_id, is_voluntary_churn, gender, age, city, zip_code, contract, offer
FROM tgt JOIN cln_demographics USING (customer_id) JOIN stg_location USING (customer_id)
JOIN cln_services USING (customer_id)""",
    ),
)
def inner_join_chain(spark, sf_dir):
    cleaned = prepare.cleaned_tables(raw_tables(spark, sf_dir))
    return (
        outcome(spark, sf_dir)
        .join(cleaned["demographics"], prepare.ID)
        .join(cleaned["location"], prepare.ID)
        .join(cleaned["services"], prepare.ID)
        .select(
            prepare.ID, prepare.TARGET, "gender", "age", "city", "zip_code", "contract", "offer"
        )
    )


def _some_population(spark, sf_dir):
    """The lookup without one region, so that some zip codes have no match."""
    return prepare.stage(raw_population(spark, sf_dir, "n_regionkey <> 3"))


_SOME_POPULATION = (
    "(SELECT p.* FROM stg_population p JOIN nation ON id = n_nationkey + 1 WHERE n_regionkey <> 3)"
)


@query(
    "left_lookup_join",
    _with(
        STAGED_SQL,
        f"""SELECT customer_id, zip_code, population
FROM stg_location LEFT JOIN {_SOME_POPULATION} USING (zip_code)""",
    ),
)
def left_lookup_join(spark, sf_dir):
    places = prepare.stage(raw_location(spark, sf_dir))
    return places.join(_some_population(spark, sf_dir), "zip_code", "left").select(
        prepare.ID, "zip_code", "population"
    )


@query("modeling_view", _with(VIEW_SQL, "SELECT * FROM mv"))
def modeling_view(spark, sf_dir):
    return prepare.view_from_sources(raw_tables(spark, sf_dir))


@query(
    "modeling_view_checks",
    _with(
        VIEW_SQL,
        """SELECT count(*) AS n_rows, count(*) - count(DISTINCT customer_id) AS duplicates,
  count(*) FILTER (WHERE is_voluntary_churn IS NULL) AS unlabelled,
  count(*)::DOUBLE / (SELECT count(*) FROM tgt) AS share_of_outcome FROM mv""",
    ),
)
def modeling_view_checks(spark, sf_dir):
    return integrity.view_checks(
        modeling_view(spark, sf_dir), outcome(spark, sf_dir), prepare.ID, prepare.TARGET
    )


@query(
    "referential_integrity",
    """
SELECT 'orders-customer' AS pair,
  (SELECT count(DISTINCT o_custkey) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS left_only,
  (SELECT count(DISTINCT c_custkey) FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS right_only
UNION ALL SELECT 'events-customer',
  (SELECT count(DISTINCT user_id) FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer)),
  (SELECT count(DISTINCT c_custkey) FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events))
UNION ALL SELECT 'lineitem-orders',
  (SELECT count(DISTINCT l_orderkey) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)),
  (SELECT count(DISTINCT o_orderkey) FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))""",
)
def referential_integrity(spark, sf_dir):
    out = None
    for left, lk, right, rk in [
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("events", "user_id", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ]:
        found = integrity.referential_integrity(
            table(spark, sf_dir, left), lk, table(spark, sf_dir, right), rk
        ).select(F.lit(f"{left}-{right}").alias("pair"), "left_only", "right_only")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "unmatched_lookup_rows",
    _with(
        STAGED_SQL,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE zip_code NOT IN (
  SELECT zip_code FROM {_SOME_POPULATION})) AS unmatched FROM stg_location""",
    ),
)
def unmatched_lookup_rows(spark, sf_dir):
    places = prepare.stage(raw_location(spark, sf_dir))
    return integrity.unmatched_rows(
        places, "zip_code", _some_population(spark, sf_dir), "zip_code"
    )


def _feature_query(name, columns):
    select = ", ".join(["customer_id", *columns])

    @query(name, _with(FEATURE_SQL, f"SELECT {select} FROM feat"))
    def run(spark, sf_dir):
        return features(spark, sf_dir).select("customer_id", *columns)


_feature_query("num_addon_services", ["num_addon_services"])
_feature_query("is_month_to_month", ["contract", "is_month_to_month"])
_feature_query("internet_without_security", ["internet_without_security"])
_feature_query("no_addons_despite_internet", ["no_addons_despite_internet"])
_feature_query("is_tenure_censored", ["tenure_in_months", "is_tenure_censored"])


@query("feature_table", _with(FEATURE_SQL, "SELECT * FROM feat"))
def feature_table(spark, sf_dir):
    return features(spark, sf_dir)


@query(
    "sentinel_fill",
    _with(
        FEATURE_SQL,
        """SELECT customer_id, coalesce(internet_type, 'No Internet') AS internet_type,
  coalesce(offer, 'No Offer') AS offer FROM feat""",
    ),
)
def sentinel_fill(spark, sf_dir):
    return encoding.fill_sentinels(features(spark, sf_dir)).select(
        "customer_id", "internet_type", "offer"
    )


def kind(column):
    booleans = {c for cs in prepare.YES_NO_COLUMNS.values() for c in cs}
    booleans |= {
        "is_month_to_month",
        "internet_without_security",
        "no_addons_despite_internet",
        "is_tenure_censored",
    }
    decimals = {
        "latitude",
        "longitude",
        "avg_monthly_long_distance_charges",
        "monthly_charge",
        "total_charges",
        "total_refunds",
        "total_long_distance_charges",
        "total_revenue",
    }
    if column in encoding.CATEGORICAL_COLUMNS:
        return "categorical"
    return "boolean-like" if column in booleans else "decimal" if column in decimals else "integer-like"


_LEVELS = {
    "internet_type": ["No Internet", "T0", "T1", "T2"],
    "offer": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "No Offer"],
    "gender": ["Female", "Male"],
    "contract": ["Month-to-Month", "One Year", "Two Year"],
    "payment_method": ["Bank Withdrawal", "Credit Card", "Mailed Check"],
}
_NUMERIC = [c for c in INPUTS if c not in (prepare.ID, *encoding.CATEGORICAL_COLUMNS)]


@query(
    "one_hot",
    _with(
        FEATURE_SQL + "," + split_sql("feat"),
        "SELECT customer_id, "
        + ", ".join(
            f"CAST(coalesce({c}, '{encoding.SENTINELS.get(c, '')}') = '{v}' AS INTEGER) AS \"{c}={v}\""
            for c, vs in _LEVELS.items()
            for v in vs
        )
        + " FROM split",
    ),
)
def one_hot(spark, sf_dir):
    split = split_features(spark, sf_dir, list(_LEVELS))
    filled = encoding.fill_sentinels(split)
    categories = encoding.fit_categories(filled.where("part = 'train'"), list(_LEVELS))
    return encoding.one_hot(filled, categories, ["customer_id"])


_WIDE = ["p_name", "p_brand", "p_type"]


@query(
    "category_dictionary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS index,
  count(*) AS n_rows FROM part WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in _WIDE
    ),
)
def category_dictionary(spark, sf_dir):
    return encoding.category_dictionary(table(spark, sf_dir, "part"), _WIDE)


@query(
    "dictionary_encode",
    "SELECT p_partkey, "
    + ", ".join(
        f"CASE WHEN {c} IN (SELECT {c} FROM part WHERE p_size <= 40) THEN (SELECT count(DISTINCT q.{c}) "
        f"FROM part q WHERE q.p_size <= 40 AND q.{c} < part.{c}) END AS {c}_index"
        for c in _WIDE[1:]
    )
    + " FROM part",
)
def dictionary_encode(spark, sf_dir):
    """Numbers learned on some parts, looked up for all of them; one column by broadcast, one by shuffle."""
    parts = table(spark, sf_dir, "part")
    dictionary = store(encoding.category_dictionary(parts.where("p_size <= 40"), _WIDE[1:]), "dictionary")
    some = encoding.encode_categories(parts, dictionary, ["p_brand"])
    every = encoding.encode_categories(some, dictionary, ["p_type"], carried=0)
    return every.select("p_partkey", "p_brand_index", "p_type_index")


@query(
    "standard_scale",
    _with(
        FEATURE_SQL + "," + split_sql("feat"),
        ", fitted AS (SELECT "
        + ", ".join(
            f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
            for c in _NUMERIC
        )
        + " FROM split WHERE part = 'train') SELECT customer_id, "
        + ", ".join(
            f"round((CAST({c} AS DOUBLE) - m_{c}) / coalesce(nullif(s_{c}, 0), 1), 6) + 0.0 AS {c}"
            for c in _NUMERIC
        )
        + " FROM split CROSS JOIN fitted",
    ),
)
def standard_scale(spark, sf_dir):
    split = split_features(spark, sf_dir, _NUMERIC)
    scaler = encoding.fit_scaler(split.where("part = 'train'"), _NUMERIC, missing="skip")
    scaled = encoding.scale(split, scaler, ["customer_id"])
    return scaled.select("customer_id", *[r6(c).alias(c) for c in _NUMERIC])


def encoded_sql(number: str) -> str:
    """The encoded inputs as f01, f02, ... in output order; numbers in the given form."""
    cells = [
        f"CAST(coalesce({c}, '{encoding.SENTINELS.get(c, '')}') = '{v}' AS DOUBLE)"
        for c, levels in _LEVELS.items()
        for v in levels
    ]
    cells += [
        number.format(f"(CAST({c} AS DOUBLE) - m_{c}) / coalesce(nullif(s_{c}, 0), 1)")
        for c in _NUMERIC
    ]
    fitted = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
        for c in _NUMERIC
    )
    listed = ", ".join(f"{cell} AS f{i:02d}" for i, cell in enumerate(cells, start=1))
    return f"""fitted AS (SELECT {fitted} FROM split WHERE part = 'train'),
encoded AS (SELECT customer_id, part, {listed} FROM split CROSS JOIN fitted)"""


@query(
    "preprocess_pipeline",
    f"WITH {FEATURE_SQL}, {split_sql('feat')}, {encoded_sql('round({}, 6) + 0.0')} "
    "SELECT * FROM encoded",
)
def preprocess_pipeline(spark, sf_dir):
    split = split_features(spark, sf_dir)
    model = encoding.fit_preprocessor(split.where("part = 'train'").drop("part"))
    encoded = encoding.assemble(model, split, ["customer_id", "part"], encoding.ENCODED)
    values = encoded.select("customer_id", "part", vector_to_array(encoding.ENCODED).alias("v"))
    width = sum(len(levels) for levels in _LEVELS.values()) + len(_NUMERIC)
    cells = [f"round(nullif(v[{i}], double('NaN')), 6) + 0.0D AS f{i + 1:02d}" for i in range(width)]
    return values.selectExpr("customer_id", "part", *cells)


FEATURES = [f"{c}={v}" for c, levels in _LEVELS.items() for v in levels] + _NUMERIC


def _correlation_sql() -> str:
    n = len(FEATURES)
    cells = ", ".join(
        f"{{'a': '{FEATURES[i]}', 'b': '{FEATURES[j]}', "
        f"'r': corr(f{i + 1:02d}, f{j + 1:02d})}}"
        for i in range(n)
        for j in range(i + 1, n)
    )
    return f"""WITH {FEATURE_SQL}, {split_sql('feat')}, {encoded_sql("({})")}
SELECT p.a AS a, p.b AS b, round(p.r, 6) AS r, abs(p.r) >= 1 - 1e-9 AS exact
FROM (SELECT unnest([{cells}]) AS p FROM encoded WHERE part = 'train')
WHERE isfinite(p.r) AND abs(p.r) >= 0.6"""


@query("encoded_feature_correlation", _correlation_sql())
def encoded_feature_correlation(spark, sf_dir):
    """Strongly correlated pairs of the encoded training features."""
    train = split_features(spark, sf_dir).where("part = 'train'").drop("part")
    model = encoding.fit_preprocessor(train)
    encoded = store(encoding.assemble(model, train, [], encoding.ENCODED), "encoded")
    pairs = profile.vector_correlations(encoded, encoding.ENCODED, encoding.feature_names(model))
    return pairs.where("strong").select("a", "b", r6("r").alias("r"), "exact")


def schema_sql(source: str) -> str:
    rows = []
    for i, c in enumerate([c for c in INPUTS if c != "customer_id"], start=1):
        allowed = (
            f"(SELECT CAST(to_json(list(DISTINCT {c} ORDER BY {c}) FILTER (WHERE {c} IS NOT NULL)) "
            f"AS VARCHAR) FROM {source})"
            if kind(c) == "categorical"
            else "'[]'"
        )
        reserved = f'["{encoding.SENTINELS[c]}"]' if c in encoding.SENTINELS else "[]"
        rows.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{kind(c)}' AS kind, "
            f"{str(c in encoding.SENTINELS).lower()} AS nullable, {allowed} AS allowed, "
            f"'{reserved}' AS reserved"
        )
    return " UNION ALL ".join(rows)


def fitted_schema(spark, df):
    categories = encoding.fit_categories(
        encoding.fill_sentinels(df), encoding.CATEGORICAL_COLUMNS
    )
    return encoding.schema_frame(spark, encoding.input_schema(df, categories))


@query("input_schema", _with(FEATURE_SQL, schema_sql("feat")))
def input_schema(spark, sf_dir):
    return fitted_schema(spark, features(spark, sf_dir))


_DIFFERENCES = " UNION ALL ".join(
    f"""SELECT "column", '{aspect}' AS difference FROM both_sides WHERE {condition}"""
    for aspect, condition in [
        ("unexpected", "t_kind IS NULL"),
        ("missing", "o_kind IS NULL"),
        *[
            (a, f"o_kind IS NOT NULL AND t_kind IS NOT NULL AND o_{a} IS DISTINCT FROM t_{a}")
            for a in ["position", "kind", "nullable", "allowed", "reserved"]
        ],
    ]
)


def _renamed(prefix):
    return ", ".join(
        f"{a} AS {prefix}_{a}" for a in ["position", "kind", "nullable", "allowed", "reserved"]
    )


@query(
    "schema_matches_model",
    _with(
        FEATURE_SQL
        + f""",
part_a AS (SELECT * FROM feat WHERE age < 70 AND contract <> 'One Year'),
ours AS (SELECT "column", {_renamed("o")} FROM ({schema_sql("feat")}) WHERE "column" <> 'age'),
theirs AS (SELECT "column", {_renamed("t")} FROM ({schema_sql("part_a")})
  WHERE "column" <> 'gender'),
both_sides AS (SELECT * FROM ours FULL JOIN theirs USING ("column"))""",
        _DIFFERENCES,
    ),
)
def schema_matches_model(spark, sf_dir):
    table_ = features(spark, sf_dir)
    ours = fitted_schema(spark, table_).where(F.col("column") != "age")
    part = table_.where((F.col("age") < 70) & (F.col("contract") != "One Year"))
    theirs = fitted_schema(spark, part).where(F.col("column") != "gender")
    return encoding.schema_differences(ours, theirs)
