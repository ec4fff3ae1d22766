"""Profiles of a table: counts, rates, crosstabs, histograms, correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import count_where, ratio
from tenura.sources.workspace import store

_PAIRS_AT_ONCE = 5  # correlations in one aggregation; many more of them run as interpreted code


def _percent(share: Column) -> Column:
    return 100.0 * share


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value; the percentages refer to the present values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n_rows")
    )
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("percent", F.round(_percent(ratio(F.col("n_rows"), total)), 2))


def overall_rate(df: DataFrame, target: str) -> DataFrame:
    hit = F.col(target).cast("double")
    return df.agg(
        F.count(target).alias("n_rows"), _percent(F.avg(hit)).alias("rate_pct")
    )


def _by_single_column(
    df: DataFrame, columns: Sequence[str], name: str, sums: Mapping[str, Column]
) -> DataFrame:
    """``name, value`` and sums per column and present value, by one grouping set per column.

    A row is expanded to one per column and summed where it is read, so that the shuffle carries at
    most one row per task, column and value, however many combinations of values there are.
    """
    plain = [f"_c{i}" for i in range(len(columns))]
    rows = df.select(
        *[F.col(c).cast("string").alias(p) for c, p in zip(columns, plain, strict=True)],
        *[v.alias(f"_s{i}") for i, v in enumerate(sums.values())],
    )
    own = [
        F.when(F.grouping(p) == 0, F.struct(F.lit(c).alias("name"), F.col(p).alias("text")))
        for c, p in zip(columns, plain, strict=True)
    ]
    totals = [F.sum(f"_s{i}").alias(n) for i, n in enumerate(sums)]
    grouped = rows.groupingSets([[p] for p in plain], *plain).agg(F.coalesce(*own).alias("_own"), *totals)
    return grouped.select(
        F.col("_own.name").alias(name), F.col("_own.text").alias("value"), *sums
    ).where("value IS NOT NULL")


def rates_by_value(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Per column and present value: rows and target rate in percent."""
    hit = F.col(target).cast("int")
    sums = {"n_rows": F.when(hit.isNotNull(), 1).otherwise(0), "hits": hit}
    rates = _by_single_column(df, columns, "feature", sums)
    return rates.select(
        "feature", "value", "n_rows", _percent(ratio(F.col("hits"), F.col("n_rows"))).alias("rate_pct")
    )


def subgroup_rates(df: DataFrame, subgroup: Column, flag: str, target: str) -> DataFrame:
    """Target rate of a subgroup (flag NULL) and of its rows by flag, from one rollup."""
    hit = F.col(target).cast("double")
    return (
        df.where(subgroup & F.col(flag).isNotNull())
        .rollup(flag)
        .agg(F.count("*").alias("n_rows"), _percent(F.avg(hit)).alias("rate_pct"))
    )


def reach(df: DataFrame, rule: Column, target: str) -> DataFrame:
    """One row: positives, positives that the rule reaches, and their share."""
    counts = df.agg(
        count_where(F.col(target)).alias("positives"),
        count_where(F.col(target) & rule).alias("reached"),
    )
    return counts.withColumn("reach_pct", _percent(ratio(F.col("reached"), F.col("positives"))))


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, n_rows``: counts of all present row values x present column values.

    A combination without rows counts 0. NULL is a row value, but no column value. The result is long, so
    neither axis has a limit and the driver sees no value.
    """
    counts = store(df.groupBy(row, column).agg(F.count("*").alias("n_rows")), "counts")
    columns = counts.where(F.col(column).isNotNull()).select(column).distinct()
    spine = counts.select(row).distinct().crossJoin(columns)
    found = counts.select(F.col(row).alias("_row"), F.col(column).alias("_column"), "n_rows")
    same = F.col(row).eqNullSafe(F.col("_row")) & (F.col(column) == F.col("_column"))
    return spine.join(found, same, "left").select(row, column, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def present_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(column).alias("non_null_count"), F.count("*").alias("total_count")
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct present values of every column, as rows."""
    return _by_single_column(df, columns, "column", {"n_rows": F.lit(1)})


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width bins from the smallest to the largest present value, the last one closed.

    Empty bins are kept. With ``by``, each class has its own range, and the density
    is the share of the class per unit of width.
    """
    value = F.col(column).cast("double")
    usable = df.where(value.isNotNull() & ~F.isnan(value))
    keys = [F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")]
    rows = usable.select(keys[0].alias("class"), value.alias("v"))
    found = rows.groupBy("class").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total")
    )
    # A constant gets a range of width one around it.
    half = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    ranges = found.select(
        "class", (F.col("lo") - half).alias("lo"), (F.col("hi") + half).alias("hi"), "total"
    )
    if by:
        located = rows.join(ranges, "class")
    else:
        located = rows.withColumns(
            {"lo": ranges.select("lo").scalar(), "hi": ranges.select("hi").scalar()}
        )
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    filled = located.groupBy(
        "class", F.least(at, F.lit(bins - 1)).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce(F.col("n"), F.lit(0))
    out = frame.join(filled, ["class", "bin"], "left").select(
        "class",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        n.alias("n_rows"),
        (n / (F.col("total") * width)).alias("density"),
    )
    return out if by else out.drop("class", "density")


def rule_metrics(df: DataFrame, rules: Mapping[str, Column], target: str) -> DataFrame:
    """Per boolean rule: flagged share, precision and recall, all from one aggregation."""
    y = F.col(target)
    sums = [F.count("*").alias("n"), count_where(y).alias("positives")]
    for i, rule in enumerate(rules.values()):
        sums += [count_where(rule).alias(f"_f{i}"), count_where(rule & y).alias(f"_h{i}")]
    wide = df.agg(*sums)
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"_f{i}").alias("flagged"),
            F.col(f"_h{i}").alias("hits"),
        )
        for i, name in enumerate(rules)
    ]
    return wide.select("n", "positives", F.inline(F.array(*rows))).select(
        "rule",
        "flagged",
        "hits",
        ratio(F.col("flagged"), F.col("n")).alias("flagged_share"),
        ratio(F.col("hits"), F.col("flagged")).alias("precision"),
        F.coalesce(ratio(F.col("hits"), F.col("positives")), F.lit(0.0)).alias("recall"),
    )


def separation_screen(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Target rate per value of candidate columns; a rate of 0 or 100 percent is suspect."""
    rates = rates_by_value(df, columns, target)
    return rates.withColumn("separates", F.col("rate_pct").isin(0.0, 100.0))


def correlations(df: DataFrame, columns: Sequence[str], threshold: float = 0.6) -> DataFrame:
    """Pearson correlation of every pair of columns, with marks for strong and exact ones.

    A pair is correlated over the rows that hold both values. The matrix has one cell per pair of
    columns, whatever the number of rows; it takes several passes over the rows, so the few columns
    are written first.
    """
    numeric = store(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "numeric")
    # Around their means, so that large values lose no digits in the products.
    means = numeric.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = numeric.select(
        *[(F.col(c) - F.lit(means[c]).cast("double")).alias(c) for c in columns]
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="keep")
    vectors = assembler.transform(centred)
    return vector_correlations(vectors, "v", columns, threshold)


def vector_correlations(
    df: DataFrame, vector: str, names: Sequence[str], threshold: float = 0.6
) -> DataFrame:
    """The same for the entries of a vector column; an entry that is NaN is missing."""
    matrix = Correlation.corr(df.select(vector), vector).first()[0].toArray()
    found = _with_missing(df, vector, matrix)
    pairs = []
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            r = found.get((i, j), float(matrix[i, j]))
            pairs.append((a, names[j], None if r is None or r != r else r))
    out = df.sparkSession.createDataFrame(pairs, "a STRING, b STRING, r DOUBLE")
    size = F.abs(F.col("r"))
    return out.withColumns(
        {
            "strong": F.coalesce(size >= threshold, F.lit(False)),
            "exact": F.coalesce(size >= 1 - 1e-9, F.lit(False)),
        }
    )


def _pearson(a: Column, b: Column) -> Column:
    """The correlation over the rows with both; NULL where one of them is constant, which ``corr`` divides by."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def _with_missing(df: DataFrame, vector: str, matrix) -> dict[tuple[int, int], float | None]:
    """The correlations of entries that some row lacks, by place, each over the rows that hold both."""
    size = len(matrix)
    # A missing entry leaves no number in its row of the matrix, and neither does a constant.
    open_rows = [i for i in range(size) if all(matrix[i, j] != matrix[i, j] for j in range(size) if j != i)]
    if not open_rows:
        return {}
    values = vector_to_array(F.col(vector))
    lacks = df.agg(*[F.max(F.isnan(values[i])).alias(f"_{i}") for i in open_rows]).first()
    missing = {i for i in open_rows if lacks[f"_{i}"]}
    pairs = [(i, j) for i in range(size) for j in range(i + 1, size) if missing & {i, j}]
    if not pairs:
        return {}
    v = F.col("v")
    plain = df.select(values.alias("v")).select(
        *[F.when(~F.isnan(v[i]), v[i]).alias(f"_{i}") for i in range(size)]
    )
    rows = store(plain, "plain")
    found = {}
    for at in range(0, len(pairs), _PAIRS_AT_ONCE):
        some = pairs[at : at + _PAIRS_AT_ONCE]
        cells = [_pearson(F.col(f"_{i}"), F.col(f"_{j}")).alias(f"r{n}") for n, (i, j) in enumerate(some)]
        found |= dict(zip(some, rows.agg(*cells).first(), strict=True))
    return found


def label_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts of the combinations of restated labels, and whether each is one-to-one."""
    combos = df.groupBy(*columns).agg(F.count("*").alias("n_rows"))
    checks = []
    for c in columns:
        partners = combos.groupBy(c).agg(F.count("*").alias("n")).agg(F.max("n")).scalar()
        checks.append(partners == 1)
    return combos.withColumn("one_to_one", reduce(lambda a, b: a & b, checks))
