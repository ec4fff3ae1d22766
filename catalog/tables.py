"""The five source tables, derived from the given star schema, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _titled(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in names.items()])


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Yes' ELSE 'No' END"


def raw_demographics(spark, sf_dir) -> DataFrame:
    return _titled(
        table(spark, sf_dir, "customer"),
        {
            "Customer ID": "CAST(c_custkey AS STRING)",
            "Count": "1L",
            "Gender": "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
            "Age": "CAST(18 + c_custkey % 63 AS INT)",
            "Under 30": _flag("18 + c_custkey % 63 < 30"),
            "Senior Citizen": _flag("18 + c_custkey % 63 >= 65"),
            "Married": _flag("c_nationkey % 2 = 0"),
            "Dependents": _flag("c_custkey % 5 = 0"),
            "Number of Dependents": "CAST(IF(c_custkey % 5 = 0, 1 + c_custkey % 3, 0) AS INT)",
        },
    )


def raw_location(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    return _titled(
        table(spark, sf_dir, "customer").join(places, F.expr("c_nationkey = n_nationkey")),
        {
            "Customer ID": "CAST(c_custkey AS STRING)",
            "Count": "1L",
            "Country": "'United States'",
            "State": "r_name",
            "City": "n_name",
            "Zip Code": "lpad(CAST(c_nationkey AS STRING), 5, '0')",
            "Lat Long": "concat_ws(', ', c_nationkey, -c_nationkey)",
            "Latitude": "32.0D + c_nationkey * 0.25D",
            "Longitude": "-120.0D + c_nationkey * 0.5D",
        },
    )


def raw_population(spark, sf_dir, where: str = "true") -> DataFrame:
    return _titled(
        table(spark, sf_dir, "nation").where(where),
        {
            "ID": "CAST(n_nationkey + 1 AS INT)",
            "Zip Code": "lpad(CAST(n_nationkey AS STRING), 5, '0')",
            "Population": "CAST((n_nationkey + 1) * 1000 + n_regionkey AS INT)",
        },
    )


def _named(**expressions: str):
    return [F.expr(f"{e} AS {name}") for name, e in expressions.items()]


def _orders_by_customer(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return (
        orders.groupBy("o_custkey")
        .agg(
            *_named(
                last="max(struct(o_orderdate, o_orderkey, o_orderpriority))",
                first_dt="min(o_orderdate)",
                n_orders="count(*)",
                n_u="count_if(o_orderpriority = '1-URGENT')",
                n_h="count_if(o_orderpriority = '2-HIGH')",
                n_p="count_if(o_orderstatus = 'P')",
            )
        )
        .withColumn("snap", orders.agg(F.max("o_orderdate")).scalar())
    )


def _lines_by_customer(spark, sf_dir) -> DataFrame:
    """Line facts per customer; reduced per order first, so a large order is one row."""
    facts = {
        "n_r": "count_if(l_returnflag = 'R')",
        "n_a": "count_if(l_returnflag = 'A')",
        "n_n": "count_if(l_returnflag = 'N')",
        "n_f": "count_if(l_linestatus = 'F')",
        "n_bulk": "count_if(l_quantity >= 40)",
        "cents": "sum(CAST(round(l_extendedprice * 100) AS BIGINT))",
    }
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*_named(**facts))
    owner = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        per_order.join(owner, F.expr("l_orderkey = o_orderkey"))
        .groupBy(F.expr("o_custkey AS lk"))
        .agg(*_named(**{n: f"sum({n})" for n in facts}))
    )


def raw_services(spark, sf_dir) -> DataFrame:
    online = (
        table(spark, sf_dir, "events")
        .where("event_type <> 'error'")
        .selectExpr("user_id AS ek")
        .distinct()
    )
    joined = (
        table(spark, sf_dir, "customer")
        .join(_lines_by_customer(spark, sf_dir), F.expr("c_custkey = lk"), "left")
        .join(
            _orders_by_customer(spark, sf_dir).drop("last"), F.expr("c_custkey = o_custkey"), "left"
        )
        .join(online, F.expr("c_custkey = ek"), "left")
    )
    orders, returned = "coalesce(n_orders, 0)", "coalesce(n_r, 0)"
    spend = "coalesce(cents / 100.0D, 0.0D)"
    tenure = "least(72, CAST(floor(datediff(snap, first_dt) / 30.0D) AS INT))"
    distance = "IF(c_custkey % 10 <> 0, (c_custkey % 50) * 0.25D, 0.0D)"
    return _titled(
        joined,
        {
            "Customer ID": "CAST(c_custkey AS STRING)",
            "Count": "1L",
            "Quarter": "'Q3'",
            "Referred a Friend": _flag(f"{orders} % 4 > 0"),
            "Number of Referrals": f"CAST({orders} % 4 AS INT)",
            "Tenure in Months": tenure,
            "Offer": "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END",
            "Phone Service": _flag("c_custkey % 10 <> 0"),
            "Avg Monthly Long Distance Charges": distance,
            "Multiple Lines": _flag(f"{orders} >= 10"),
            "Internet Service": _flag("ek IS NOT NULL"),
            "Internet Type": "CASE WHEN ek IS NOT NULL THEN concat('T', c_custkey % 3) END",
            "Avg Monthly GB Download": "CAST(IF(ek IS NOT NULL, c_custkey % 60, 0) AS INT)",
            "Online Security": f"CASE WHEN lk IS NOT NULL THEN {_flag('n_r >= 14')} END",
            "Online Backup": _flag("n_a >= 14"),
            "Device Protection Plan": _flag("n_n >= 14"),
            "Premium Tech Support": _flag("n_f >= 20"),
            "Streaming TV": _flag("n_bulk >= 8"),
            "Streaming Movies": _flag("n_u >= 2"),
            "Streaming Music": _flag("n_h >= 2"),
            "Unlimited Data": _flag("n_p >= 3"),
            "Contract": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Month-to-Month' "
            "WHEN c_mktsegment = 'FURNITURE' THEN 'One Year' ELSE 'Two Year' END",
            "Paperless Billing": _flag("c_custkey % 3 <> 0"),
            "Payment Method": "CASE c_custkey % 3 WHEN 0 THEN 'Bank Withdrawal' "
            "WHEN 1 THEN 'Credit Card' ELSE 'Mailed Check' END",
            "Monthly Charge": "c_acctbal",
            "Total Charges": spend,
            "Total Refunds": f"{returned} * 2.5D",
            "Total Extra Data Charges": "CAST(coalesce(n_bulk, 0) * 10 AS INT)",
            "Total Long Distance Charges": f"{distance} * {tenure}",
            "Total Revenue": f"{spend} + {returned} * 2.5D",
        },
    )


def raw_status(spark, sf_dir) -> DataFrame:
    priority = "last.o_orderpriority"
    churned = "last.o_orderdate < snap - INTERVAL 365 DAYS"
    return _titled(
        _orders_by_customer(spark, sf_dir),
        {
            "Customer ID": "CAST(o_custkey AS STRING)",
            "Count": "1L",
            "Quarter": "'Q3'",
            "Satisfaction Score": f"CAST(IF({churned}, 1 + o_custkey % 2, 3 + o_custkey % 3) AS INT)",
            "Customer Status": f"CASE WHEN {churned} THEN 'Churned' "
            "WHEN first_dt > snap - INTERVAL 365 DAYS THEN 'Joined' ELSE 'Stayed' END",
            "Churn Label": _flag(churned),
            "Churn Value": f"CAST({churned} AS INT)",
            "Churn Score": "CAST(o_custkey % 100 AS INT)",
            "CLTV": "CAST(n_orders * 100 AS INT)",
            "Churn Category": f"CASE WHEN NOT ({churned}) THEN NULL "
            f"WHEN {priority} IN ('1-URGENT', '2-HIGH') THEN 'Competitor' "
            f"WHEN {priority} = '3-MEDIUM' THEN 'Dissatisfaction' ELSE 'Other' END",
            "Churn Reason": f"CASE WHEN NOT ({churned}) THEN NULL "
            f"WHEN {priority} = '4-NOT SPECIFIED' THEN 'Deceased' ELSE {priority} END",
        },
    )


def raw_tables(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "demographics": raw_demographics(spark, sf_dir),
        "location": raw_location(spark, sf_dir),
        "population": raw_population(spark, sf_dir),
        "services": raw_services(spark, sf_dir),
        "status": raw_status(spark, sf_dir),
    }


# The same tables, staged to snake-case names, as SQL for the checks.
STAGED_SQL = """
stg_demographics AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CAST(18 + c_custkey % 63 AS INTEGER) AS age,
    CASE WHEN 18 + c_custkey % 63 < 30 THEN 'Yes' ELSE 'No' END AS under_30,
    CASE WHEN 18 + c_custkey % 63 >= 65 THEN 'Yes' ELSE 'No' END AS senior_citizen,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS married,
    CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
    CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 + c_custkey % 3 ELSE 0 END AS INTEGER)
      AS number_of_dependents
  FROM customer),
stg_location AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'United States' AS country,
    r_name AS state, n_name AS city, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code,
    concat(CAST(c_nationkey AS VARCHAR), ', ', CAST(-c_nationkey AS VARCHAR)) AS lat_long,
    32.0::DOUBLE + c_nationkey * 0.25::DOUBLE AS latitude,
    -120.0::DOUBLE + c_nationkey * 0.5::DOUBLE AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
stg_population AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS id,
    lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code,
    CAST((n_nationkey + 1) * 1000 + n_regionkey AS INTEGER) AS population
  FROM nation),
snapshot AS (SELECT max(o_orderdate) AS snap FROM orders),
od AS (
  SELECT o_custkey AS ck, count(*) AS n_orders,
    sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_u,
    sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS n_h,
    sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS n_p, min(o_orderdate) AS first_dt
  FROM orders GROUP BY o_custkey),
li AS (
  SELECT o_custkey AS ck, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
    sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS n_a,
    sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS n_n,
    sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_f,
    sum(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS n_bulk, count(*) AS n_lines,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spend
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey),
ev AS (SELECT DISTINCT user_id AS ck FROM events WHERE event_type <> 'error'),
services_wide AS (
  SELECT c.*, li.ck AS lk, ev.ck AS ek, n_r, n_a, n_n, n_f, n_bulk, n_u, n_h, n_p,
    coalesce(n_orders, 0) AS orders_, coalesce(n_r, 0) AS returned_, coalesce(n_bulk, 0) AS bulk_,
    coalesce(CAST(spend AS DOUBLE), 0.0::DOUBLE) AS spend_,
    least(72, CAST(floor(date_diff('day', first_dt, snap) / 30.0) AS INTEGER)) AS tenure_,
    CASE WHEN c_custkey % 10 <> 0 THEN (c_custkey % 50) * 0.25::DOUBLE ELSE 0.0::DOUBLE END
      AS distance_
  FROM customer c LEFT JOIN li ON li.ck = c_custkey LEFT JOIN od ON od.ck = c_custkey
  LEFT JOIN ev ON ev.ck = c_custkey CROSS JOIN snapshot),
stg_services AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'Q3' AS quarter,
    CASE WHEN orders_ % 4 > 0 THEN 'Yes' ELSE 'No' END AS referred_a_friend,
    CAST(orders_ % 4 AS INTEGER) AS number_of_referrals, tenure_ AS tenure_in_months,
    CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS offer,
    CASE WHEN c_custkey % 10 <> 0 THEN 'Yes' ELSE 'No' END AS phone_service,
    distance_ AS avg_monthly_long_distance_charges,
    CASE WHEN orders_ >= 10 THEN 'Yes' ELSE 'No' END AS multiple_lines,
    CASE WHEN ek IS NULL THEN 'No' ELSE 'Yes' END AS internet_service,
    CASE WHEN ek IS NOT NULL THEN concat('T', CAST(c_custkey % 3 AS VARCHAR)) END AS internet_type,
    CAST(CASE WHEN ek IS NOT NULL THEN c_custkey % 60 ELSE 0 END AS INTEGER)
      AS avg_monthly_gb_download,
    CASE WHEN lk IS NULL THEN NULL WHEN n_r >= 14 THEN 'Yes' ELSE 'No' END AS online_security,
    CASE WHEN n_a >= 14 THEN 'Yes' ELSE 'No' END AS online_backup,
    CASE WHEN n_n >= 14 THEN 'Yes' ELSE 'No' END AS device_protection_plan,
    CASE WHEN n_f >= 20 THEN 'Yes' ELSE 'No' END AS premium_tech_support,
    CASE WHEN n_bulk >= 8 THEN 'Yes' ELSE 'No' END AS streaming_tv,
    CASE WHEN n_u >= 2 THEN 'Yes' ELSE 'No' END AS streaming_movies,
    CASE WHEN n_h >= 2 THEN 'Yes' ELSE 'No' END AS streaming_music,
    CASE WHEN n_p >= 3 THEN 'Yes' ELSE 'No' END AS unlimited_data,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Month-to-Month'
      WHEN c_mktsegment = 'FURNITURE' THEN 'One Year' ELSE 'Two Year' END AS contract,
    CASE WHEN c_custkey % 3 <> 0 THEN 'Yes' ELSE 'No' END AS paperless_billing,
    CASE c_custkey % 3 WHEN 0 THEN 'Bank Withdrawal' WHEN 1 THEN 'Credit Card'
      ELSE 'Mailed Check' END AS payment_method,
    c_acctbal AS monthly_charge, spend_ AS total_charges,
    CAST(returned_ AS DOUBLE) * 2.5::DOUBLE AS total_refunds,
    CAST(bulk_ * 10 AS INTEGER) AS total_extra_data_charges,
    distance_ * tenure_ AS total_long_distance_charges,
    spend_ + CAST(returned_ AS DOUBLE) * 2.5::DOUBLE AS total_revenue
  FROM services_wide),
status_wide AS (
  SELECT *, o_orderdate < snap - INTERVAL 365 DAY AS churned_,
    first_dt > snap - INTERVAL 365 DAY AS joined_
  FROM (SELECT o_custkey, o_orderdate, o_orderpriority, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  JOIN od ON od.ck = o_custkey CROSS JOIN snapshot WHERE rn = 1),
stg_status AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, 'Q3' AS quarter,
    CAST(CASE WHEN churned_ THEN 1 + o_custkey % 2 ELSE 3 + o_custkey % 3 END AS INTEGER)
      AS satisfaction_score,
    CASE WHEN churned_ THEN 'Churned' WHEN joined_ THEN 'Joined' ELSE 'Stayed' END
      AS customer_status,
    CASE WHEN churned_ THEN 'Yes' ELSE 'No' END AS churn_label,
    CAST(churned_ AS INTEGER) AS churn_value, CAST(o_custkey % 100 AS INTEGER) AS churn_score,
    CAST(n_orders * 100 AS INTEGER) AS cltv,
    CASE WHEN NOT churned_ THEN NULL
      WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Competitor'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'Dissatisfaction' ELSE 'Other' END AS churn_category,
    CASE WHEN NOT churned_ THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Deceased'
      ELSE o_orderpriority END AS churn_reason
  FROM status_wide)"""
