"""Mixing sources to target weights by Poisson replication.

Every document gets a number of copies drawn from a Poisson distribution whose mean is its
source's target repetition rate. The draw inverts the distribution at a number hashed from the
seed and the document's id, so it needs no state, repeats exactly and does not depend on the
partitioning. Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import numbered, written

#: Largest mean that one draw inverts; a larger rate is the sum of several independent draws.
MEAN = 16.0
#: Terms of the inverted distribution: at mean 16 the rest weighs less than 1e-40.
TERMS = 100
#: Sources, of about 1 kB each, up to which the table of rates is broadcast.
CARRIED_SOURCES = 10_000


def target_rates(
    documents: DataFrame,
    source_column: str = "source",
    weights: DataFrame | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
) -> DataFrame:
    """``source, n_documents, rate``: mean copies per document of each source.

    ``weights`` holds ``source, weight`` (one row per source; a source without weight or with a
    negative one gets none). Without it the weight is the source's size to the power
    ``exponent``. The copies of all sources sum to ``epochs`` times the number of documents.
    """
    sizes = documents.groupBy(F.col(source_column).alias("source")).agg(
        F.count("*").alias("n_documents")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("n_documents", F.lit(exponent)))
    else:
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("double"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("given")), "left").select(
            "source", "n_documents", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
        )
    totals = weighed.agg(F.sum("weight").alias("w"), F.sum("n_documents").alias("n"))
    total = totals.select(F.expr(f"n * {float(epochs)}D / nullif(w, 0D)")).scalar()
    return weighed.select(
        "source",
        "n_documents",
        F.coalesce(F.col("weight") * total / F.col("n_documents"), F.lit(0.0)).alias("rate"),
    )


def poisson_copies(
    documents: DataFrame,
    rates: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    seed: int = 17,
    marked: bool = True,
) -> DataFrame:
    """All columns of ``documents``, once per copy, with ``copy`` (from 1) and ``shuffle_key``.

    The rows come in the order of ``shuffle_key``, a hash of seed, id and copy, over all
    partitions: a global shuffle. A null source is a source of its own; a null id hashes as no
    text; rows that repeat an id get equal draws and are all returned; empty and null texts count
    as any other. Columns of the input that are named like the two new ones are replaced; without
    ``marked`` the input's own columns are all that is returned. A source without a rate, and an
    empty table, give no rows.
    """
    rows, names = numbered(documents)
    kept = {c: n for c, n in names.items() if not marked or c not in ("copy", "shuffle_key")}
    own_id = names[id_column]
    cumulative = f"""
        aggregate(
            sequence(1, {TERMS}),
            named_struct('p', exp(-mean), 'c', exp(-mean), 'all', array(exp(-mean))),
            (s, k) -> named_struct(
                'p', s.p * mean / k,
                'c', s.c + s.p * mean / k,
                'all', concat(s.all, array(s.c + s.p * mean / k))),
            s -> filter(s.all, (c, k) -> k = 0 OR c > s.all[k - 1]))
    """
    tables = (
        rates.select(
            F.col("source").alias("_rate_source"),
            F.greatest(F.ceil(F.col("rate") / MEAN), F.lit(1)).cast("int").alias("_draws"),
            F.col("rate"),
        )
        .withColumn("mean", F.col("rate") / F.col("_draws"))
        .select("_rate_source", "_draws", F.expr(cumulative).alias("_cumulative"))
    )
    draw = f"""
        aggregate(
            transform(sequence(1, _draws), j -> conv(substr(md5(
                concat_ws(':', {int(seed)}, j, {own_id})), 1, 13), 16, 10) / 4503599627370496D),
            0,
            (n, u) -> n + size(filter(_cumulative, c -> c <= u)))
    """
    key = F.md5(F.concat_ws(":", F.lit("order"), F.lit(int(seed)), "_copy", F.col(own_id)))
    # One row per source, written so that its size is known: small, it goes to all tasks, and no text is
    # shuffled by its source.
    tables, _ = written(tables, "rates")
    if tables.count() <= CARRIED_SOURCES:
        tables = F.broadcast(tables)
    copies = (
        rows.join(tables, F.col(names[source_column]).eqNullSafe(F.col("_rate_source")))
        .withColumn("_copies", F.expr(draw))
        .where("_copies > 0")
        .select(*kept.values(), F.explode(F.expr("sequence(1, _copies)")).alias("_copy"))
        .withColumn("_key", key)
        .repartitionByRange("_key")
        .sortWithinPartitions("_key")
    )
    own = [F.col(n).alias(c) for c, n in kept.items()]
    marks = [F.col("_copy").alias("copy"), F.col("_key").alias("shuffle_key")]
    return copies.select(*own, *(marks if marked else []))


def mix(documents: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """Replicate ``documents`` to the target weights of their sources and shuffle them."""
    named = {k: options.pop(k) for k in ("exponent", "epochs") if k in options}
    rates = target_rates(documents, weights=weights, **named)
    return poisson_copies(documents, rates, **options)


#: DuckDB SQL for ``mix`` with its default options over a table or view ``documents``.
MIX_SQL = """
    WITH sizes AS (
        SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source
    ), rates AS (
        SELECT source, w * (sum(n) OVER () / sum(w) OVER ()) / n AS rate FROM sizes
    ), draws AS (
        SELECT source, greatest(ceil(rate / 16.0), 1)::INT AS m,
               rate / greatest(ceil(rate / 16.0), 1) AS mean
        FROM rates
    ), cumulative AS (
        SELECT source, m, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1)))
               OVER (PARTITION BY source ORDER BY k) AS c
        FROM draws, generate_series(0, 100) AS g(k)
    ), tables AS (
        SELECT source, m, list(c ORDER BY k) AS cs FROM cumulative GROUP BY source, m
    ), uniform AS (
        SELECT d.*, cs, j,
               ('0x' || substr(md5(concat_ws(':', 17, j, doc_id)), 1, 13))::BIGINT
                   / 4503599627370496.0::DOUBLE AS u
        FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source,
             generate_series(1, m) AS g(j)
    ), counted AS (
        SELECT doc_id, text, lang, source, n_chars,
               sum(len(list_filter(cs, lambda c: c <= u)))::INT AS copies
        FROM uniform GROUP BY ALL
    )
    SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
           md5(concat_ws(':', 'order', 17, copy, doc_id)) AS shuffle_key
    FROM (SELECT *, unnest(generate_series(1, copies)) AS copy FROM counted)
"""
