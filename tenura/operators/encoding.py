"""Model inputs: sentinels, one-hot columns, scaling, the fitted preprocessor, its schema."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.profile import distinct_values
from tenura.operators.quality import BOOLEAN, CATEGORICAL, DECIMAL, INTEGER, InputColumn
from tenura.operators.ranking import with_rank

ID = "customer_id"
TARGET = "is_voluntary_churn"

# What replaces a missing category, the encoded columns in output order,
# and the columns that are not model inputs.
SENTINELS = {"internet_type": "No Internet", "offer": "No Offer"}
CATEGORICAL_COLUMNS = ["internet_type", "offer", "gender", "contract", "payment_method"]
EXCLUDED_COLUMNS = [ID, "country", "state", "city", "zip_code"]

#: The vector of a fitted preprocessor that keeps missing numbers, as NaN.
ENCODED = "_encoded"

#: Values of a column, of some 100 bytes each, up to which its dictionary is broadcast.
CARRIED_VALUES = 100_000

# The kind of a model input by its type.
KINDS = {"boolean": BOOLEAN, "int": INTEGER, "double": DECIMAL, "string": CATEGORICAL}


def input_columns(df: DataFrame, excluded: Sequence[str] = EXCLUDED_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in (*excluded, ID, TARGET)]


def select_model_columns(df: DataFrame, excluded: Sequence[str] = EXCLUDED_COLUMNS) -> DataFrame:
    """The id, the target as 0.0/1.0 label, and the model inputs."""
    return df.select(
        ID, F.col(TARGET).cast("double").alias("label"), *input_columns(df, excluded)
    )


def fill_sentinels(df: DataFrame, sentinels: Mapping[str, str] = SENTINELS) -> DataFrame:
    return df.fillna({c: v for c, v in sentinels.items() if c in df.columns})


def fit_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The sorted present values of every categorical column, from one pass.

    They are part of the model, like the encoded columns they name, so the driver holds them.
    """
    rows = distinct_values(train, columns).select("column", "value").collect()
    return {c: sorted(r.value for r in rows if r.column == c) for c in columns}


def category_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, index, n_rows``: every present value numbered from 0 in its column, in text order.

    A table, for columns with more values than the driver should hold: values are summed per column where they
    are read and numbered by a distributed rank.
    """
    values = distinct_values(train, columns)
    ranked = with_rank(values, [F.col("value").asc()], ["column"], "rank", "n_values")
    return ranked.select("column", "value", (F.col("rank") - 1).alias("index"), "n_rows")


def encode_categories(
    df: DataFrame, dictionary: DataFrame, columns: Sequence[str], carried: int = CARRIED_VALUES
) -> DataFrame:
    """Add ``<column>_index`` per column: the dictionary's number, NULL for an absent or unknown value.

    One left join per column; the values of a column go to all tasks if there are at most ``carried``.
    """
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count("*").alias("n")).collect()}
    for c in columns:
        own = dictionary.where(F.col("column") == c).select(
            F.col("value").alias(f"_{c}_value"), F.col("index").alias(f"{c}_index")
        )
        own = F.broadcast(own) if sizes.get(c, 0) <= carried else own
        df = df.join(own, F.col(c).cast("string") == F.col(f"_{c}_value"), "left").drop(f"_{c}_value")
    return df


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], keep: Sequence[str]):
    """One 0/1 column per known category; an unknown value has none set."""
    encoded = [
        F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}={v}")
        for c, values in categories.items()
        for v in values
    ]
    return df.select(*keep, *encoded)


def fit_scaler(
    train: DataFrame, columns: Sequence[str], missing: str = "error"
) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column divides by 1.

    One pass over vectors, which stays fast for many columns. A NULL is an error, or left out of its
    column's moments if ``missing`` is "skip"; those columns take a second pass. A column without any value
    is an error.
    """
    numeric = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    assembler = VectorAssembler(
        inputCols=list(columns), outputCol="v", handleInvalid="keep" if missing == "skip" else "error"
    )
    moments = Summarizer.metrics("mean", "variance", "count").summary(F.col("v"))
    row = assembler.transform(numeric).select(moments.alias("s")).first().s
    shrink = (row["count"] - 1) / row["count"]  # from the sample to the population variance
    scaler = {
        c: (float(mean), math.sqrt(variance * shrink) or 1.0)
        for c, mean, variance in zip(columns, row.mean, row.variance, strict=True)
    }
    lacking = [c for c, (mean, _) in scaler.items() if math.isnan(mean)]
    if lacking:
        cells = [f(c).alias(f"{n}_{c}") for c in lacking for n, f in (("m", F.avg), ("s", F.stddev_pop))]
        own = numeric.agg(*cells).first()
        for c in lacking:
            mean, deviation = own[f"m_{c}"], own[f"s_{c}"]
            if mean is None or math.isnan(mean):
                raise ValueError(f"column {c!r} has no values to scale by, or NaN")
            scaler[c] = (mean, deviation or 1.0)
    return scaler


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]], keep: Sequence[str]):
    return df.select(
        *keep,
        *[((F.col(c).cast("double") - m) / s).alias(c) for c, (m, s) in scaler.items()],
    )


def _literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preprocessor(
    train: DataFrame,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
    sentinels: Mapping[str, str] = SENTINELS,
    excluded: Sequence[str] = EXCLUDED_COLUMNS,
) -> PipelineModel:
    """Sentinels, one-hot columns and scaling, fitted on the training rows only.

    Adds ``features``: the encoded columns first, then the scaled numbers, where a NULL counts as the mean of
    the training rows that have a value. ``_encoded`` is the same with NaN for the NULLs.
    """
    encoded = [c for c in categorical if c in train.columns]
    numeric = [
        c for c in input_columns(train, excluded) if c not in encoded and c != "label"
    ]
    filled = ", ".join(
        f"coalesce(`{c}`, {_quoted(sentinels[c])}) AS `_cat_{c}`"
        if c in sentinels
        else f"`{c}` AS `_cat_{c}`"
        for c in encoded
    )
    fill = SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")
    rows = fill.transform(train)
    index = StringIndexer(
        inputCols=[f"_cat_{c}" for c in encoded],
        outputCols=[f"_idx_{c}" for c in encoded],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(rows)
    # The indexer's extra slot for unknown values is the one that dropLast drops.
    hot = OneHotEncoder(
        inputCols=[f"_idx_{c}" for c in encoded],
        outputCols=[f"_hot_{c}" for c in encoded],
        dropLast=True,
    ).fit(index.transform(rows))
    scaler = fit_scaler(train, numeric, missing="skip")
    scaled = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - {_literal(m)}) / {_literal(s)} AS `_own_{c}`"
        for c, (m, s) in scaler.items()
    )
    scaling = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    known = ", ".join(f"coalesce(`_own_{c}`, 0.0D) AS `_num_{c}`" for c in numeric)
    filling = SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__")
    hots = [f"_hot_{c}" for c in encoded]
    own = VectorAssembler(
        inputCols=hots + [f"_own_{c}" for c in numeric], outputCol=ENCODED, handleInvalid="keep"
    )
    assemble = VectorAssembler(
        inputCols=hots + [f"_num_{c}" for c in numeric], outputCol="features"
    )
    return PipelineModel(stages=[fill, index, hot, scaling, filling, own, assemble])


def fitted_categories(model: PipelineModel) -> dict[str, list[str]]:
    """The sorted categories that a fitted preprocessor learned, sentinels among them."""
    index = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    names = [c.removeprefix("_cat_") for c in index.getInputCols()]
    return {c: sorted(labels) for c, labels in zip(names, index.labelsArray, strict=True)}


def feature_names(model: PipelineModel) -> list[str]:
    """The names of the entries of ``features``, in order."""
    index = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    labels = dict(zip(index.getInputCols(), index.labelsArray, strict=True))
    names = []
    for c in model.stages[-1].getInputCols():
        if c.startswith("_hot_"):
            column = c.removeprefix("_hot_")
            names += [f"{column}={v}" for v in labels[f"_cat_{column}"]]
        else:
            names.append(c.removeprefix("_num_"))
    return names


def assemble(
    model: PipelineModel, df: DataFrame, keep: Sequence[str], vector: str = "features"
) -> DataFrame:
    return model.transform(df).select(*keep, vector)


def lacking_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns with a NULL in some row, from one pass."""
    if not columns:
        return []
    row = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def input_schema(
    df: DataFrame,
    categories: Mapping[str, Sequence[str]],
    sentinels: Mapping[str, str] = SENTINELS,
    excluded: Sequence[str] = EXCLUDED_COLUMNS,
    lacking: Sequence[str] = (),
) -> list[InputColumn]:
    """What each model input may hold, from its type and the fitted categories.

    A column may be NULL only if a sentinel replaces the NULL, or if it is a ``lacking`` number, which
    the preprocessor fills; the sentinel itself is reserved and not accepted as input.
    """
    types = dict(df.dtypes)
    specs = []
    for name in input_columns(df, excluded):
        if types[name] not in KINDS:
            raise ValueError(f"column {name!r} has type {types[name]}, which has no input kind")
        kind = KINDS[types[name]]
        reserved = (sentinels[name],) if name in sentinels else ()
        allowed = ()
        if kind == CATEGORICAL:
            if name not in categories:
                raise ValueError(f"categorical column {name!r} has no fitted categories")
            allowed = tuple(v for v in categories[name] if v not in reserved)
        nullable = name in sentinels or (kind != CATEGORICAL and name in lacking)
        specs.append(InputColumn(name, kind, nullable, allowed, reserved))
    return specs


def schema_text(specs: Sequence[InputColumn]) -> str:
    return json.dumps([asdict(s) for s in specs])


def schema_from_text(text: str) -> list[InputColumn]:
    return [
        InputColumn(**{**d, "allowed": tuple(d["allowed"]), "reserved": tuple(d["reserved"])})
        for d in json.loads(text)
    ]


SCHEMA_COLUMNS = (
    "position INT, column STRING, kind STRING, nullable BOOLEAN, allowed STRING, reserved STRING"
)


def _list_text(values: Sequence[str]) -> str:
    """A list as JSON, so that no two lists share a text."""
    return json.dumps(list(values), ensure_ascii=False, separators=(",", ":"))


def schema_frame(spark: SparkSession, specs: Sequence[InputColumn]) -> DataFrame:
    rows = [
        (i, s.name, s.kind, s.nullable, _list_text(s.allowed), _list_text(s.reserved))
        for i, s in enumerate(specs, start=1)
    ]
    return spark.createDataFrame(rows, SCHEMA_COLUMNS)


def schema_differences(schema: DataFrame, fitted: DataFrame) -> DataFrame:
    """Every difference between two schema frames, one row per column and aspect."""
    aspects = ["position", "kind", "nullable", "allowed", "reserved"]
    a = schema.select("column", F.struct(*aspects).alias("ours"))
    b = fitted.select("column", F.struct(*aspects).alias("theirs"))
    both = a.join(b, "column", "full_outer")
    present = F.col("ours").isNotNull() & F.col("theirs").isNotNull()
    checks = [
        F.struct(F.lit("unexpected").alias("difference"), F.col("theirs").isNull().alias("bad")),
        F.struct(F.lit("missing").alias("difference"), F.col("ours").isNull().alias("bad")),
    ]
    checks += [
        F.struct(
            F.lit(c).alias("difference"),
            (present & ~F.col(f"ours.{c}").eqNullSafe(F.col(f"theirs.{c}"))).alias("bad"),
        )
        for c in aspects
    ]
    return both.select("column", F.inline(F.array(*checks))).where("bad").drop("bad")
