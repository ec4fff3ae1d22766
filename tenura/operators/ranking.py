"""Global ranks without a global sort in one task.

Rows are range-partitioned and sorted by an order that ends in a unique id, so
equal scores spread over partitions too. Each row keeps its partition and its
place in it; the written table fixes both. A table with one row per partition
(and group) then turns places into ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions import check_fraction, top_k_count
from tenura.sources.workspace import store

_PLACE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def with_rank(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    rank: str = "rank",
    size: str = "n_rows",
) -> DataFrame:
    """Add the rank (1 is first, no ties) and the row count of the group."""
    keys = [F.col(g).asc() for g in group] + list(order)
    placed = store(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumns(
        {
            "_part": F.shiftright("_place", _PLACE_BITS),
            "_nth": F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1),
        }
    )
    spans = placed.groupBy("_part", *group).agg(
        F.count("*").alias("_rows"), F.min("_nth").alias("_first")
    )
    return _shifted(placed, spans, group, df.columns, rank, size)


def _shifted(placed, spans, group, columns, rank, size) -> DataFrame:
    same = [F.lit(0), *group]
    earlier = Window.partitionBy(*same).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = spans.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias(
            "_shift"
        ),
        F.sum("_rows").over(Window.partitionBy(*same)).alias(size),
    )
    # One row per range partition: bounded by the partition count, so broadcast.
    # With groups the number of rows is not known, so Spark checks the written size.
    spans = store(spans, "spans") if group else F.broadcast(spans)
    on = [F.col("_part") == F.col("_p")]
    on += [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return placed.join(spans, on).select(
        *columns, (F.col("_nth") + F.col("_shift")).alias(rank), size
    )


def rank_scores(
    df: DataFrame, score: str, id_column: str, group: Sequence[str] = (), rank: str = "rank"
) -> DataFrame:
    """Rank by score, highest first; equal scores by ascending id."""
    return with_rank(df, [F.col(score).desc(), F.col(id_column).asc()], group, rank)


def flag_top(
    df: DataFrame, score: str, id_column: str, fraction: float, flag: str = "in_top_k"
) -> DataFrame:
    """Rank the rows and mark the top fraction by rank, so ties cannot change the count."""
    check_fraction(fraction)
    return (
        rank_scores(df, score, id_column)
        .withColumn(flag, F.col("rank") <= top_k_count(F.col("n_rows"), fraction))
        .drop("n_rows")
    )


def running_totals(
    df: DataFrame, order: Column, values: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<value>`` and ``all_<value>`` in the given order, which must be unique."""
    keys = [F.col(g).asc() for g in group] + [order]
    placed = store(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "running"
    )
    same = [F.lit(0), *group]
    earlier = Window.partitionBy(*same).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    spans = placed.groupBy("_part", *group).agg(*[F.sum(v).alias(v) for v in values])
    spans = spans.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_base_{v}") for v in values],
        *[F.sum(v).over(Window.partitionBy(*same)).alias(f"all_{v}") for v in values],
    )
    spans = store(spans, "spans") if group else F.broadcast(spans)
    within = (
        Window.partitionBy("_part", *group)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.select("*", *[F.sum(v).over(within).alias(f"_cum_{v}") for v in values])
    on = [F.col("_part") == F.col("_p")]
    on += [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return local.join(spans, on).select(
        *df.columns,
        *[(F.col(f"_cum_{v}") + F.col(f"_base_{v}")).alias(f"cum_{v}") for v in values],
        *[f"all_{v}" for v in values],
    )


def quantile_bins(ranked: DataFrame, bins: int, rank: str = "rank", size: str = "n_rows") -> Column:
    """Bin 1..bins of equal row counts from a rank."""
    return (F.floor((F.col(rank) - 1) * bins / F.col(size)) + 1).cast("int")
