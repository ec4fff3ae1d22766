"""The five source tables: declared types, typed CSV scan, shape checks, counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The headers and types of the five source files.
SOURCE_SCHEMAS = {
    "demographics": (
        "`Customer ID` STRING, `Count` BIGINT, `Gender` STRING, `Age` INT, `Under 30` STRING, "
        "`Senior Citizen` STRING, `Married` STRING, `Dependents` STRING, "
        "`Number of Dependents` INT"
    ),
    "location": (
        "`Customer ID` STRING, `Count` BIGINT, `Country` STRING, `State` STRING, `City` STRING, "
        "`Zip Code` STRING, `Lat Long` STRING, `Latitude` DOUBLE, `Longitude` DOUBLE"
    ),
    "population": "`ID` INT, `Zip Code` STRING, `Population` INT",
    "services": (
        "`Customer ID` STRING, `Count` BIGINT, `Quarter` STRING, `Referred a Friend` STRING, "
        "`Number of Referrals` INT, `Tenure in Months` INT, `Offer` STRING, "
        "`Phone Service` STRING, `Avg Monthly Long Distance Charges` DOUBLE, "
        "`Multiple Lines` STRING, `Internet Service` STRING, `Internet Type` STRING, "
        "`Avg Monthly GB Download` INT, `Online Security` STRING, `Online Backup` STRING, "
        "`Device Protection Plan` STRING, `Premium Tech Support` STRING, `Streaming TV` STRING, "
        "`Streaming Movies` STRING, `Streaming Music` STRING, `Unlimited Data` STRING, "
        "`Contract` STRING, `Paperless Billing` STRING, `Payment Method` STRING, "
        "`Monthly Charge` DOUBLE, `Total Charges` DOUBLE, `Total Refunds` DOUBLE, "
        "`Total Extra Data Charges` INT, `Total Long Distance Charges` DOUBLE, "
        "`Total Revenue` DOUBLE"
    ),
    "status": (
        "`Customer ID` STRING, `Count` BIGINT, `Quarter` STRING, `Satisfaction Score` INT, "
        "`Customer Status` STRING, `Churn Label` STRING, `Churn Value` INT, `Churn Score` INT, "
        "`CLTV` INT, `Churn Category` STRING, `Churn Reason` STRING"
    ),
}

# The row counts of the published source files.
SOURCE_ROWS = {
    "demographics": 7043,
    "location": 7043,
    "population": 1671,
    "services": 7043,
    "status": 7043,
}


def source_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SOURCE_SCHEMAS[table])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV with a header and declared types; a wrong header or value is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def scan_sources(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: scan_csv(spark, path, source_schema(name)) for name, path in paths.items()}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def shape_report(
    tables: Mapping[str, DataFrame | None],
    columns: Mapping[str, list[str]],
    rows: Mapping[str, int],
) -> DataFrame:
    """Every difference between the tables and what is expected of them.

    One row per mismatch: an absent table, a wrong row count, a wrong number of
    columns, missing or unexpected names, or the right names in another order.
    """
    spark = SparkSession.getActiveSession()
    found = []
    counted = []
    for name, expected in columns.items():
        df = tables.get(name)
        if df is None:
            found.append((name, "absent", "present", "absent"))
            continue
        actual = df.columns
        missing = [c for c in expected if c not in actual]
        unexpected = [c for c in actual if c not in expected]
        if len(actual) != len(expected):
            found.append((name, "column_count", str(len(expected)), str(len(actual))))
        if missing:
            found.append((name, "missing_columns", ", ".join(missing), ""))
        if unexpected:
            found.append((name, "unexpected_columns", "", ", ".join(unexpected)))
        if not missing and not unexpected and actual != expected:
            found.append((name, "column_order", ", ".join(expected), ", ".join(actual)))
        counted.append(
            df.agg(F.count("*").alias("n"))
            .where(F.col("n") != rows[name])
            .select(
                F.lit(name).alias("source"),
                F.lit("row_count").alias("problem"),
                F.lit(str(rows[name])).alias("expected"),
                F.col("n").cast("string").alias("actual"),
            )
        )
    report = spark.createDataFrame(
        found, "source STRING, problem STRING, expected STRING, actual STRING"
    )
    return reduce(DataFrame.unionByName, counted, report)
