"""Structural checks: keys, references, constants, leaked columns, column types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions import ratio


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows beyond the first of their key."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count("*").alias("n_keys"),
            F.sum(F.col("n") - 1).alias("duplicates"),
        )
    )


def referential_integrity(left: DataFrame, left_key: str, right: DataFrame, right_key: str):
    """One row: distinct keys found on one side only, both ways."""
    a = left.select(F.col(left_key).alias("k")).where("k IS NOT NULL").distinct()
    b = right.select(F.col(right_key).alias("k")).where("k IS NOT NULL").distinct()
    sides = a.withColumn("l", F.lit(1)).join(b.withColumn("r", F.lit(1)), "k", "full_outer")
    return sides.agg(
        F.count_if(F.col("r").isNull()).alias("left_only"),
        F.count_if(F.col("l").isNull()).alias("right_only"),
    )


def unmatched_rows(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """One row: how many rows have a key that the lookup table lacks."""
    # One row per distinct key before the join: a key held by many rows stays one row.
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    known = lookup.select(F.col(lookup_key).alias("k"), F.lit(True).alias("known")).distinct()
    lost = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    return per_key.join(known, "k", "left").agg(
        F.sum("n").alias("n_rows"), F.sum(lost).alias("unmatched")
    )


def constant_column(df: DataFrame, column: str) -> DataFrame:
    """Value counts of a column, its number of values, and whether it is constant."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    distinct = counts.agg(F.count("value").alias("d")).scalar()
    return counts.withColumn("distinct_values", distinct).withColumn(
        "is_constant", F.col("distinct_values") == 1
    )


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with its number of present values."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"_{i}").alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def forbidden_columns(tables: Mapping[str, DataFrame], forbidden: Sequence[str]) -> DataFrame:
    """Forbidden columns that a table has, with their number of present values."""
    found = []
    for name, df in tables.items():
        present = [c for c in df.columns if c in forbidden]
        if present:
            found.append(
                column_types(df.select(*present)).select(
                    F.lit(name).alias("table_name"), "column", "non_null"
                )
            )
    if not found:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name STRING, column STRING, non_null BIGINT")
    return reduce(DataFrame.unionByName, found)


def view_checks(view: DataFrame, outcome: DataFrame, id_column: str, target: str) -> DataFrame:
    """One row: the view has the rows of the outcome, unique ids, and never lacks the target."""
    rows = outcome.agg(F.count("*")).scalar()
    per_id = view.groupBy(id_column).agg(
        F.count("*").alias("n"), F.count_if(F.col(target).isNull()).alias("unlabelled")
    )
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.col("n") - 1).alias("duplicates"),
        F.sum("unlabelled").alias("unlabelled"),
    ).withColumn("share_of_outcome", ratio(F.col("n_rows"), rows))
