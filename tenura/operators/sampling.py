"""Exact stratified splits and folds without sorting the rows.

Rows are ordered by a hash of their id. Per label, a histogram of the leading
hash digits tells in which slice of the order each boundary lies; only the rows
of those slices are ranked to find the exact boundary, and the number of digits
follows the number of rows, so a slice stays small. The assignment is then a plain expression over a few boundaries.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions import hash_order
from tenura.sources.workspace import store

_SLICE_ROWS = 50_000  # rows of a slice that one task ranks, about


def _slice_digits(rows: int) -> int:
    """Leading hex digits of the hash that make slices of about ``_SLICE_ROWS`` rows."""
    return max(3, math.ceil(math.log(max(rows, 1) / _SLICE_ROWS, 16)))


def boundaries(
    df: DataFrame,
    id_column: str,
    label: str,
    salt: int,
    ranks_for: Callable[[dict], Mapping[object, Sequence[int]]],
) -> dict:
    """Per label, the ``(hash, id)`` of the rows at chosen ranks of the hash order.

    ``ranks_for`` gets the row count per label and returns the ranks per label.
    """
    spark = df.sparkSession
    keyed = store(
        df.select(
            F.col(label).alias("label"),
            F.col(id_column).alias("id"),
            hash_order(F.col(id_column), salt).alias("h"),
        ),
        "keys",
    )
    counts = {r.label: r.n for r in keyed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if None in counts:
        raise ValueError("rows without a label cannot be stratified")
    wanted = [
        (value, rank)
        for value, ranks in ranks_for(counts).items()
        for rank in sorted({r for r in ranks if r >= 1})
    ]
    if not wanted:
        return {}
    label_type = df.schema[label].dataType.simpleString()
    keyed = keyed.withColumn(
        "slice", F.substring("h", 1, _slice_digits(sum(counts.values())))
    )
    slices = keyed.groupBy("label", "slice").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("slice"))
    ranks = spark.createDataFrame(wanted, f"label {label_type}, target BIGINT")
    near = (
        slices.select("label", "slice", (upto - F.col("n")).alias("before"), upto.alias("upto"))
        .join(ranks, "label")
        .where("before < target AND target <= upto")
        .select("label", "slice", "target", (F.col("target") - F.col("before")).alias("nth_here"))
    )
    nth = F.row_number().over(Window.partitionBy("label", "target").orderBy("h", "id"))
    cuts = (
        keyed.join(near, ["label", "slice"])
        .withColumn("nth", nth)
        .where(F.col("nth") == F.col("nth_here"))
        .select("label", "target", "h", "id")
        .collect()
    )
    found: dict = {}
    for row in sorted(cuts, key=lambda r: r.target):
        found.setdefault(row.label, []).append((row.h, row.id))
    return found


def _with_passed(
    df: DataFrame, cuts: Mapping, label: str, id_column: str, salt: int, passed: str
) -> DataFrame:
    """Add how many boundaries of its label a row lies after."""
    h, key = F.col("_h"), F.col(id_column)
    count = F.lit(0)
    for value, found in cuts.items():
        after = [
            ((h > cut) | ((h == cut) & (key > cut_id))).cast("int") for cut, cut_id in found
        ]
        count = F.when(F.col(label) == F.lit(value), reduce(add, after)).otherwise(count)
    hashed = df.withColumn("_h", hash_order(key, salt))
    return hashed.withColumn(passed, count).drop("_h")


def quotas(counts: Mapping, fraction: float) -> dict:
    """Per-label test rows: the total rounds up, labels by largest remainder."""
    total = math.ceil(round(sum(counts.values()) * fraction, 9))
    exact = {value: n * total / sum(counts.values()) for value, n in counts.items()}
    quota = {value: math.floor(x) for value, x in exact.items()}
    order = sorted(exact, key=lambda v: (quota[v] - exact[v], str(v)))
    for value in order[: total - sum(quota.values())]:
        quota[value] += 1
    return quota


def stratified_split(
    df: DataFrame,
    id_column: str,
    label: str,
    fraction: float = 0.2,
    seed: int = 42,
    part: str = "part",
) -> DataFrame:
    """Add the part, 'test' for an exact share of every label and 'train' for the rest."""
    cuts = boundaries(
        df,
        id_column,
        label,
        seed,
        lambda counts: {v: [q] for v, q in quotas(counts, fraction).items()},
    )
    # A label whose quota is zero has no boundary: all its rows train.
    has_cut = F.col(label).isin(list(cuts)) if cuts else F.lit(False)
    first = has_cut & (F.col(part) == 0)
    return _with_passed(df, cuts, label, id_column, seed, part).withColumn(
        part, F.when(first, "test").otherwise("train")
    )


def stratified_folds(
    df: DataFrame,
    id_column: str,
    label: str,
    folds: int = 5,
    seed: int = 42,
    fold: str = "fold",
) -> DataFrame:
    """Add the fold 0..folds-1; the folds of a label differ by one row at most."""

    def ranks_for(counts):
        if any(n < folds for n in counts.values()):
            raise ValueError(f"every label needs at least {folds} rows, got {counts}")
        return {v: [-(-n * i // folds) for i in range(1, folds)] for v, n in counts.items()}

    cuts = boundaries(df, id_column, label, seed, ranks_for)
    return _with_passed(df, cuts, label, id_column, seed, fold)


def fold_matrix(
    df: DataFrame,
    id_column: str,
    label: str,
    folds: int = 5,
    inner_folds: int = 5,
    seed: int = 42,
    fold: str = "fold",
    inner: str = "inner",
) -> DataFrame:
    """Add the fold, and for every outer fold the fold of the row among the rows outside of it.

    ``inner[f]`` is what ``stratified_folds`` would give the row among the rows of the other folds, NULL for
    rows of fold f. A fold is a stretch of the hash order, so the rank without it is the rank less its size if
    it lies before: all boundaries are ranks of one order, found together, and the columns are looked up by how many of
    them a row lies after.
    """
    plans: dict = {}

    def ranks_for(counts):
        if any(n < max(folds, 2) or n - -(-n // folds) < inner_folds for n in counts.values()):
            raise ValueError(f"too few rows per label for {folds} by {inner_folds} folds: {counts}")
        for value, n in counts.items():
            outer = [-(-n * i // folds) for i in range(folds + 1)]
            cuts = {}  # per outer fold, the boundaries among the other rows as ranks of all rows
            for f in range(folds):
                size = outer[f + 1] - outer[f]
                own = [-(-(n - size) * j // inner_folds) for j in range(1, inner_folds)]
                cuts[f] = [r if r <= outer[f] else r + size for r in own]
            ranks = sorted({r for c in cuts.values() for r in c} | set(outer[1:-1]))
            plans[value] = (outer, cuts, ranks, n)
        return {value: plan[2] for value, plan in plans.items()}

    cuts = boundaries(df, id_column, label, seed, ranks_for)
    passed = _with_passed(df, cuts, label, id_column, seed, "_passed")
    own_fold, own_inner = F.lit(None).cast("int"), F.lit(None).cast("array<int>")
    for value, (outer, inside, ranks, n) in plans.items():
        ends = [*ranks, n]  # the last rank that lies after so many boundaries
        of = [sum(end > c for c in outer[1:-1]) for end in ends]
        rows = [
            F.array(
                *[
                    F.lit(None if f == own else sum(end > c for c in inside[f])).cast("int")
                    for f in range(folds)
                ]
            )
            for end, own in zip(ends, of, strict=True)
        ]
        here = F.col(label) == F.lit(value)
        own_fold = F.when(here, F.array(*map(F.lit, of))[F.col("_passed")]).otherwise(own_fold)
        own_inner = F.when(here, F.array(*rows)[F.col("_passed")]).otherwise(own_inner)
    return passed.withColumns({fold: own_fold, inner: own_inner}).drop("_passed")


def repeated_folds(
    df: DataFrame, id_column: str, label: str, folds: int = 5, repeats: int = 1, seed: int = 42
) -> DataFrame:
    """Every row once per repeat, each repeat with its own shuffle."""
    parts = [
        stratified_folds(df, id_column, label, folds, seed + r).withColumn("repeat", F.lit(r))
        for r in range(repeats)
    ]
    return reduce(DataFrame.unionByName, parts)


def split_report(
    df: DataFrame, label: str, part: str = "part", tolerance: float = 0.01
) -> DataFrame:
    """Rows, positives and positive rate of every part, and whether the rate is near the overall."""
    hit = F.col(label).cast("double")
    parts = df.groupBy(part).agg(
        F.count("*").alias("n_rows"),
        F.sum(hit).cast("bigint").alias("positives"),
        F.avg(hit).alias("positive_rate"),
    )
    overall = df.agg(F.avg(hit)).scalar()
    return parts.withColumn(
        "within_tolerance", F.abs(F.col("positive_rate") - overall) <= tolerance
    )


def disjoint_check(df: DataFrame, id_column: str, part: str = "part") -> DataFrame:
    """One row: sizes of the parts, of the whole, and ids found in both parts."""
    per_id = df.groupBy(id_column).agg(
        F.count("*").alias("n"),
        F.max((F.col(part) == "test").cast("int")).alias("in_test"),
        F.max((F.col(part) == "train").cast("int")).alias("in_train"),
        F.sum((F.col(part) == "test").cast("int")).alias("n_test"),
        F.sum((F.col(part) == "train").cast("int")).alias("n_train"),
    )
    return per_id.agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_train").alias("n_train"),
        F.sum("n_test").alias("n_test"),
        F.sum(F.col("in_test") * F.col("in_train")).cast("bigint").alias("shared_ids"),
        (F.sum("n") == F.sum("n_train") + F.sum("n_test")).alias("sizes_add_up"),
    )
