"""Data quality of scoring input, model output and result tables.

The value rules of all columns are checked in one pass: every row yields the
broken rules only, so clean data shuffles next to nothing, and what is shuffled
is at most one row per task, column and rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.functions import count_where
from tenura.sources.workspace import store

# The kinds of an input column.
BOOLEAN = "boolean-like"
INTEGER = "integer-like"
DECIMAL = "decimal"
CATEGORICAL = "categorical"

# The rules in the order in which the first failure is reported.
COLUMN_RULES = ["missing_column", "extra_column", "duplicate_column"]
TABLE_RULES = ["empty_table"]
ID_RULES = ["id_missing", "id_not_text", "id_blank", "id_duplicate"]
VALUE_RULES = [
    "null_not_allowed",
    "nan",
    "infinite",
    "category_not_text",
    "sentinel",
    "unseen_category",
    "boolean_for_number",
    "text_for_number",
    "not_whole",
    "not_a_number",
    "bad_boolean",
]
RULES = [*COLUMN_RULES, *TABLE_RULES, *ID_RULES, *VALUE_RULES]

REPORT = "rule STRING, column STRING, precedence INT, offending BIGINT, first_id STRING"

_BLANK = r"(?U)^[\s\x1c-\x1f]*$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class InputColumn:
    """What one input column may hold."""

    name: str
    kind: str
    nullable: bool = False
    allowed: tuple[str, ...] = ()
    reserved: tuple[str, ...] = ()


class InputError(ValueError):
    """The scoring input breaks a rule."""


def is_blank(text: Column) -> Column:
    return text.rlike(_BLANK)


def column_problems(columns: Sequence[str], expected: Sequence[str]) -> list[tuple[str, str]]:
    """Missing, extra and repeated names; the order of the columns does not matter."""
    present = list(dict.fromkeys(columns))
    return (
        [("missing_column", c) for c in expected if c not in present]
        + [("extra_column", c) for c in present if c not in expected]
        + [("duplicate_column", c) for c in present if list(columns).count(c) > 1]
    )


def _broken_rule(spec: InputColumn, data_type: T.DataType) -> Column:
    """The first rule a value breaks, or NULL; what its type decides is decided here."""
    value = F.col(spec.name)
    found = []
    if not spec.nullable:
        found.append((value.isNull(), "null_not_allowed"))
    if isinstance(data_type, _FRACTIONAL):
        found.append((F.isnan(value), "nan"))
        found.append((F.abs(value) == float("inf"), "infinite"))
    whole = isinstance(data_type, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType))
    present = value.isNotNull()
    if spec.kind == CATEGORICAL:
        if not isinstance(data_type, T.StringType):
            found.append((present, "category_not_text"))
        else:
            if spec.reserved:
                found.append((value.isin(list(spec.reserved)), "sentinel"))
            unseen = ~value.isin(list(spec.allowed)) if spec.allowed else F.lit(True)
            found.append((present & unseen, "unseen_category"))
    elif spec.kind == BOOLEAN:
        if isinstance(data_type, _INTEGRAL):
            found.append((present & ~value.isin(0, 1), "bad_boolean"))
        elif not isinstance(data_type, T.BooleanType):
            found.append((present, "bad_boolean"))
    elif isinstance(data_type, T.BooleanType):
        found.append((present, "boolean_for_number"))
    elif isinstance(data_type, T.StringType):
        found.append((present, "text_for_number"))
    elif not whole:
        found.append((present, "not_a_number"))
    elif spec.kind == INTEGER and not isinstance(data_type, _INTEGRAL):
        found.append((value != F.floor(value), "not_whole"))
    return F.coalesce(*[F.when(bad, F.lit(rule)) for bad, rule in found], F.lit(None))


def _id_rule(df: DataFrame, id_column: str) -> Column:
    value = F.col(id_column)
    data_type = df.schema[id_column].dataType
    missing = value.isNull()
    if isinstance(data_type, _FRACTIONAL):
        missing = missing | F.isnan(value)
    rule = F.when(missing, "id_missing")
    if not isinstance(data_type, T.StringType):
        return rule.otherwise("id_not_text")
    return rule.when(is_blank(value), "id_blank")


def _rules(df: DataFrame, id_column: str, specs: Sequence[InputColumn]) -> dict[str, Column]:
    """For the id and every input the first rule that the value breaks."""
    rules = {id_column: _id_rule(df, id_column)}
    return rules | {s.name: _broken_rule(s, df.schema[s.name].dataType) for s in specs}


def breaks_a_rule(df: DataFrame, id_column: str, specs: Sequence[InputColumn]) -> Column:
    """Whether some value of the row breaks a rule; repeated ids are not looked for."""
    rules = _rules(df, id_column, specs).values()
    return F.exists(F.array(*rules), lambda rule: rule.isNotNull())


def value_report(df: DataFrame, id_column: str, specs: Sequence[InputColumn]) -> DataFrame:
    """Per column and rule that some value breaks: rows, and the smallest id among them."""
    rules = _rules(df, id_column, specs)
    cells = [F.struct(F.lit(c).alias("column"), r.alias("rule")) for c, r in rules.items()]
    # Rows that break nothing leave before the cells are unfolded. The array keeps the
    # rules of many columns in methods small enough to be compiled.
    dirty = df.where(breaks_a_rule(df, id_column, specs))
    cells = dirty.select(
        F.col(id_column).cast("string").alias("_id"), F.inline(F.array(*cells))
    ).where("rule IS NOT NULL")
    return cells.groupBy("rule", "column").agg(
        F.count("*").alias("offending"), F.min("_id").alias("first_id")
    )


def duplicate_report(df: DataFrame, id_column: str) -> DataFrame:
    """Rows that repeat a usable id after its first one."""
    repeated = (
        df.where(F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).cast("string").alias("_id"))
        .agg((F.count("*") - 1).alias("n"))
        .where("n > 0")
    )
    return repeated.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("offending"), F.min("_id").alias("first_id")
    ).select(
        F.lit("id_duplicate").alias("rule"),
        F.lit(id_column).alias("column"),
        "offending",
        "first_id",
    )


def _rule_table(
    spark: SparkSession, id_column: str, specs: Sequence[InputColumn]
) -> DataFrame:
    """All rules that apply, numbered in reporting order."""
    rules = [(rule, id_column) for rule in ID_RULES]
    rules += [(rule, spec.name) for spec in specs for rule in VALUE_RULES]
    rows = [(rule, column, i) for i, (rule, column) in enumerate(rules, start=10)]
    return spark.createDataFrame(rows, "rule STRING, column STRING, precedence INT")


def report(df: DataFrame, id_column: str, specs: Sequence[InputColumn]) -> DataFrame:
    """Broken rules with their precedence, counts, smallest id, and which failure is first.

    Columns come first, then the empty table, the id, and the columns in schema
    order. With wrong columns the values are not looked at.
    """
    spark = df.sparkSession
    problems = column_problems(df.columns, [id_column, *[s.name for s in specs]])
    if problems:
        # One failure that names all column problems.
        shape = [(rule, column, 0, None, None) for rule, column in problems]
        found = spark.createDataFrame(shape, REPORT)
    else:
        empty = df.agg(F.count("*").alias("n")).where("n = 0").select(
            F.lit("empty_table").alias("rule"),
            F.lit(None).cast("string").alias("column"),
            F.lit(len(COLUMN_RULES)).alias("precedence"),
            F.lit(0).cast("bigint").alias("offending"),
            F.lit(None).cast("string").alias("first_id"),
        )
        broken = value_report(df, id_column, specs).unionByName(
            duplicate_report(df, id_column).where("offending > 0")
        )
        # A few rules per column, known from the schema: bounded, so broadcast.
        order = F.broadcast(_rule_table(spark, id_column, specs))
        found = broken.join(order, ["rule", "column"]).unionByName(empty)
    first = F.min("precedence").over(Window.partitionBy())
    return found.select(
        "precedence",
        "rule",
        "column",
        "offending",
        "first_id",
        (F.col("precedence") == first).alias("is_first"),
    )


def require_valid(df: DataFrame, id_column: str, specs: Sequence[InputColumn]) -> DataFrame:
    """The frame itself, or an error that states the first broken rule."""
    rows = report(df, id_column, specs).where("is_first").orderBy("rule", "column").collect()
    if not rows:
        return df
    text = "; ".join(
        f"{r.rule}" + (f" in {r.column}" if r.column else "") for r in rows
    )
    if rows[0].offending:
        text += f": {rows[0].offending} row(s), first id {rows[0].first_id!r}"
    raise InputError(text)


def invariant_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of named conditions, all counted in one pass."""
    wide = df.agg(*[count_where(bad).alias(f"_{i}") for i, bad in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return wide.select(F.inline(F.array(*rows)))


def probability_report(inputs: DataFrame, scored: DataFrame, id_column: str, p: str) -> DataFrame:
    """Model output against its input: not finite, out of range, unscored and unknown ids."""
    value = F.col(p)
    sides = inputs.select(F.col(id_column).alias("_id"), F.lit(True).alias("_in")).join(
        scored.select(F.col(id_column).alias("_id"), value, F.lit(True).alias("_out")),
        "_id",
        "full_outer",
    )
    out = F.col("_out").isNotNull()
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    rule = (
        F.when(~out, "not_scored")
        .when(F.col("_in").isNull(), "unknown_id")
        .when(~finite, "not_finite")
        .when((value < 0) | (value > 1), "out_of_range")
    )
    return (
        sides.select(rule.alias("rule"), "_id")
        .where("rule IS NOT NULL")
        .groupBy("rule")
        .agg(F.count("*").alias("offending"), F.min("_id").alias("first_id"))
    )


def probability_counts(scored: DataFrame, id_column: str, p: str) -> DataFrame:
    """One row, without a shuffle of rows: rows, bad probabilities, and the smallest bad id."""
    return scored.agg(*probability_sums(id_column, p))


def probability_sums(id_column: str, p: str) -> list[Column]:
    """The aggregates of ``probability_counts``, for a table that is being written."""
    value = F.col(p)
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    bad = ~F.coalesce(finite & value.between(0.0, 1.0), F.lit(False))
    return [
        F.count("*").alias("n_rows"),
        count_where(bad).alias("bad"),
        F.min(F.when(bad, F.col(id_column))).alias("first_id"),
    ]


RANKED_COLUMNS = ["customer_id", "churn_probability", "rank", "in_top_k"]
_NUMBERS = (*_INTEGRAL, *_FRACTIONAL, T.DecimalType)


def _as_number(name: str, data_type: T.DataType, kind: str) -> Column:
    """The column as a number of a kind, NULL where its value is none."""
    if isinstance(data_type, _NUMBERS):
        return F.expr(f"try_cast(`{name}` AS {kind})")
    return F.expr(f"try_cast(CAST(`{name}` AS STRING) AS {kind})")


def ranked_table_report(df: DataFrame) -> DataFrame:
    """Checks of a ranked table: its shape, its cells, ranks 1..n without a gap, falling scores.

    One row per check with the number of offending rows. A column of the wrong type offends in
    every row; the checks of the order then use what its values say as numbers.
    """
    spark = df.sparkSession
    if df.columns != RANKED_COLUMNS:
        return spark.createDataFrame(
            [("columns", 1)], "check STRING, offending BIGINT"
        )
    types = {f.name: f.dataType for f in df.schema.fields}
    p = _as_number("churn_probability", types["churn_probability"], "DOUBLE")
    cid = F.col("customer_id")
    usable = p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p <= 1)
    everything = F.lit(True)
    nothing = F.lit(False)
    cells = {
        "missing_value": reduce(lambda a, b: a | b, [F.col(c).isNull() for c in RANKED_COLUMNS]),
        "id_blank": is_blank(cid.cast("string")),
        "id_not_text": nothing if isinstance(types["customer_id"], T.StringType) else everything,
        "rank_not_integer": nothing if isinstance(types["rank"], _INTEGRAL) else everything,
        "flag_not_boolean": nothing
        if isinstance(types["in_top_k"], T.BooleanType)
        else everything,
        "probability_range": F.col("churn_probability").isNotNull() & ~F.coalesce(usable, nothing)
        if isinstance(types["churn_probability"], _NUMBERS)
        else everything,
    }
    sums = [count_where(bad).alias(check) for check, bad in cells.items()]
    sums.append((F.count("*") == 0).cast("bigint").alias("no_rows"))
    names = [*cells, "no_rows"]
    checks = df.agg(*sums).unpivot([], names, "check", "offending")
    # One row per rank first: a rank that many rows share is a single row from here on. Ranges of
    # ranks in the partitions' order, so that sparse ranks spread like dense ones.
    per_rank = store(
        df.select(_as_number("rank", types["rank"], "BIGINT").alias("rank"), p.alias("p"))
        .where("rank IS NOT NULL")
        .groupBy("rank")
        .agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"))
        .repartitionByRange("rank")
        .withColumn("block", F.spark_partition_id()),
        "ranks",
    )
    inside = Window.partitionBy("block").orderBy("rank")
    steps = per_rank.select(
        "*", F.lag("rank").over(inside).alias("prev"), F.lag("low").over(inside).alias("prev_low")
    )
    edges = steps.groupBy("block").agg(
        F.min("rank").alias("rank"),
        F.max("rank").alias("last"),
        F.min_by("high", "rank").alias("high"),
        F.max_by("low", "rank").alias("low"),
    )
    over = Window.orderBy("block")  # one row per partition
    edges = edges.select(
        "rank",
        "high",
        F.coalesce(F.lag("last").over(over), F.lit(0)).alias("prev"),
        F.lag("low").over(over).alias("prev_low"),
    )
    both = steps.where("prev IS NOT NULL").select("rank", "high", "prev", "prev_low").unionByName(
        edges
    )
    order = invariant_report(
        both,
        {
            "rank_gap": F.col("rank") != F.col("prev") + 1,
            "probability_rises": F.col("high") > F.col("prev_low"),
        },
    ).withColumnRenamed("rule", "check")
    repeats = per_rank.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("offending")).select(
        F.lit("rank_repeated").alias("check"), "offending"
    )
    parts = [checks, repeats, order]
    columns = ["check", "offending"]
    return reduce(
        DataFrame.unionByName,
        [d.select("check", F.col(d.columns[1]).alias("offending")) for d in parts],
    ).select(*columns)


# The keys of a training metrics record and the one that must be whole.
METRIC_KEYS = [
    "k",
    "training_rows",
    "estimate_type",
    "precision_at_k",
    "lift_at_k",
    "pr_auc",
    "brier_score",
]
WHOLE_KEYS = ["training_rows"]
ESTIMATE_TYPE = (
    "Five-fold out-of-fold estimates on the training split, using the same folds as tuning; "
    "potentially mildly optimistic."
)


def metrics_from_texts(texts: Mapping[str, str]) -> dict:
    """A metrics record read back from text values."""
    kinds = {"estimate_type": str} | dict.fromkeys(WHOLE_KEYS, int)
    return {k: kinds.get(k, float)(texts[k]) for k in METRIC_KEYS if k in texts}


def check_metrics(metrics: Mapping[str, object]) -> None:
    """An error unless the record has the exact keys, finite numbers and the exact wording."""
    if set(metrics) != set(METRIC_KEYS):
        raise ValueError(f"metrics must have the keys {METRIC_KEYS}, got {sorted(metrics)}")
    if metrics["estimate_type"] != ESTIMATE_TYPE:
        raise ValueError(f"wrong estimate type {metrics['estimate_type']!r}")
    for name, value in metrics.items():
        kinds = int if name in WHOLE_KEYS else (int, float)
        if name != "estimate_type" and (
            isinstance(value, bool) or not isinstance(value, kinds) or not math.isfinite(value)
        ):
            raise ValueError(f"{name} must be a finite number, got {value!r}")


def metrics_record_report(records: DataFrame, keys: Iterable[str] = METRIC_KEYS) -> DataFrame:
    """Problems of ``(record, name, value)`` rows.

    A key may be missing, unexpected or repeated, a number not finite or not whole, the text wrong.
    """
    keys = list(keys)
    number = F.expr("try_cast(value AS DOUBLE)")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != math.inf)
    known = F.coalesce(F.col("name").isin(keys), F.lit(False))
    problem = (
        F.when(~known, "unexpected")
        .when(
            F.col("name") == "estimate_type",
            F.when(~F.col("value").eqNullSafe(ESTIMATE_TYPE), "wrong_text"),
        )
        .when(~finite, "not_finite")
        .when(F.col("name").isin(WHOLE_KEYS) & (number != F.floor(number)), "not_whole")
    )
    wrong = records.select("record", "name", problem.alias("problem")).where("problem IS NOT NULL")
    counts = records.groupBy("record", "name").agg(F.count("*").alias("n"))
    repeated = counts.where(known & (F.col("n") > 1)).select(
        "record", "name", F.lit("repeated").alias("problem")
    )
    have = counts.groupBy("record").agg(
        F.collect_set(F.when(known, F.col("name"))).alias("have")  # at most the known keys
    )
    missing = have.select(
        "record",
        F.explode(F.array_except(F.array(*[F.lit(k) for k in keys]), "have")).alias("name"),
        F.lit("missing").alias("problem"),
    )
    return wrong.unionByName(missing).unionByName(repeated)
