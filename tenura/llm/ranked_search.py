"""Ranked lexical search: the best documents of every item, by buckets of impact vectors by length.

A document's vector holds, for each term that some item has, the impact of the term in it, scaled by the
root of the term's weight; an item's vector holds the roots of its terms' weights, so that their product is
the score. The vectors are ordered by length over the whole corpus, the longest first, and cut into buckets.
A bucket whose longest vector times the item's length (Cauchy-Schwarz) stays below the item's
``limit``-th score so far is skipped, as are all behind it. Inside of a bucket the coordinates of the
item's heaviest terms are summed; the rest is bounded by the lengths that are left and by the largest
coordinates of the bucket, and only documents whose bound reaches that score are scored, exactly in integers. The first buckets are searched first, and the
scores that they give are where the search of all others starts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.frames import column, forget, pieces, written
from tenura.llm.tokens import ALPHANUMERIC, ragged, split_words

#: Pairs of item and term that are searched together; more items are searched block after block.
BLOCK_TERMS = 500_000
#: Vectors of a bucket.
BUCKET = 2048
#: Share of the ordered vectors, longest first, whose scores all others start from.
HEAD = 1 / 16
#: Heaviest terms of an item whose coordinates bound the score of a vector.
FOCUS = 6
#: Room for rounding in the bounds.
SLACK = 1 + 1e-9


def _item_terms(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, at = split_words(column(piece, "text"), ALPHANUMERIC, fold=True)
            row = np.repeat(np.arange(piece.num_rows), np.diff(at))
            items = column(piece, "item").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([items, words.cast(pa.string())], names=["item", "term"])


def _count(terms):
    """Number of all terms of each row, and the known ones with their occurrences."""

    def run(batches):
        known = pa.array(terms.value, pa.large_string())
        for batch in batches:
            for piece in pieces(batch, "text"):
                words, at = split_words(column(piece, "text"), ALPHANUMERIC, fold=True)
                place = pc.fill_null(pc.index_in(words, value_set=known), -1)
                place = place.to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(piece.num_rows), np.diff(at))[place >= 0]
                key, times = np.unique(row * len(known) + place[place >= 0], return_counts=True)
                cuts = np.searchsorted(key, np.arange(piece.num_rows + 1) * len(known))
                offsets = pa.array(cuts.astype(np.int32))
                found = pa.array((key % max(len(known), 1)).astype(np.int32))
                rows = pa.RecordBatch.from_arrays(
                    [
                        column(piece, "doc"),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, found),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
                    ],
                    names=["doc", "n", "terms", "times"],
                )
                yield rows.filter(pc.greater(rows.column(1), 0))

    return run


def _lists(batch: pa.RecordBatch, *names: str):
    """Row of every element of list columns of equal lengths, and the elements of each column."""
    sizes = pc.list_value_length(column(batch, names[0])).to_numpy(zero_copy_only=False)
    values = (column(batch, n).flatten().to_numpy(zero_copy_only=False) for n in names)
    return np.repeat(np.arange(batch.num_rows), sizes), *values


def _weigh(texts: int, total: int, weights):
    """Impacts of each row's terms and the length of its vector."""

    def run(batches):
        for batch in batches:
            row, term, times = _lists(batch, "terms", "times")
            n = column(batch, "n").to_numpy(zero_copy_only=False)
            m = 50 + (50 * n * texts) // total
            impact = (1_000_000_000 * times) // (1000 * times + 20 * m[row])
            square = np.bincount(row, weights.value[term] * impact.astype(float) ** 2, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc"),
                    pa.array(np.sqrt(square)),
                    column(batch, "terms"),
                    pa.ListArray.from_arrays(column(batch, "terms").offsets, pa.array(impact)),
                ],
                names=["doc", "norm", "terms", "impacts"],
            )

    return run


class _Item:
    """Terms of an item by weight, heaviest first, and its best documents so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, least: int):
        order = np.argsort(-weights[terms], kind="stable")
        self.terms = terms[order][weights[terms[order]] > 0]
        self.weights = weights[self.terms]
        self.norm = math.sqrt(self.weights.sum())
        self.rest = math.sqrt(self.weights[FOCUS:].sum())
        self.least = least
        self.docs, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray, limit: int) -> None:
        docs, scores = np.concatenate([self.docs, docs]), np.concatenate([self.scores, scores])
        best = np.lexsort((docs, -scores))[:limit]
        self.docs, self.scores = docs[best], scores[best]
        if len(best) == limit:
            self.least = max(self.least, int(self.scores[-1]))


class _Bucket:
    """Vectors with their postings by term."""

    def __init__(self, batch: pa.RecordBatch, roots: np.ndarray):
        self.docs = column(batch, "doc").to_numpy(zero_copy_only=False)
        self.norms = column(batch, "norm").to_numpy(zero_copy_only=False)
        row, term, impact = _lists(batch, "terms", "impacts")
        order = np.argsort(term, kind="stable")
        self.row, self.impact = row[order], impact[order]
        self.scaled = self.impact * roots[term[order]]
        self.first = np.searchsorted(term[order], np.arange(len(roots) + 1))
        self.most = np.zeros(len(roots))
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.scaled, self.first[held])

    def _postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.first[terms]
        sizes = self.first[terms + 1] - starts
        return np.repeat(np.arange(len(terms)), sizes), ragged(starts, sizes)

    def survivors(self, item: _Item, roots: np.ndarray) -> np.ndarray:
        """Rows whose heaviest coordinates leave room for the score that is needed."""
        which, at = self._postings(item.terms[:FOCUS])
        if item.least <= 0:
            return np.ones(len(self.docs), bool)
        values = self.scaled[at]
        inner = np.bincount(self.row[at], values * roots[item.terms[which]], len(self.docs))
        used = np.bincount(self.row[at], values**2, len(self.docs))
        left = np.sqrt(np.maximum(self.norms**2 * SLACK - used, 0))
        light = item.terms[FOCUS:]
        rest = np.minimum(item.rest * left, (self.most[light] * roots[light]).sum())
        return (inner + rest) * SLACK >= item.least

    def scores(self, item: _Item, rows: np.ndarray) -> np.ndarray:
        which, at = self._postings(item.terms)
        kept = rows[self.row[at]]
        total = np.zeros(len(self.docs), np.int64)
        np.add.at(total, self.row[at[kept]], item.weights[which[kept]] * self.impact[at[kept]])
        return total


def _search(queries, weights, limit: int, least: dict):
    """Best documents of every item in the rows of a task, which come longest vector first."""

    def run(batches):
        own, roots = weights.value, np.sqrt(weights.value)
        items = [_Item(terms, own, least.get(i, 0)) for i, terms in enumerate(queries.value)]
        norms = np.array([item.norm for item in items])
        needed = np.array([item.least for item in items], float)
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                longest = pc.max(column(part, "norm")).as_py()
                near = np.flatnonzero(norms * longest * SLACK >= np.maximum(needed, 1))
                if not len(near):
                    continue
                bucket = _Bucket(part, roots)
                for i in near:
                    rows = bucket.survivors(items[i], roots)
                    if not rows.any():
                        continue
                    scores = bucket.scores(items[i], rows)
                    found = np.flatnonzero(rows & (scores >= max(items[i].least, 1)))
                    if len(found):
                        items[i].add(bucket.docs[found], scores[found], limit)
                        needed[i] = items[i].least
        sizes = [len(item.docs) for item in items]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(items)), sizes).astype(np.int32)),
                pa.array(np.concatenate([item.docs for item in items])),
                pa.array(np.concatenate([item.scores for item in items])),
            ],
            names=["item", "doc", "score"],
        )

    return run


def _search_block(texts: DataFrame, pairs: list, limit: int) -> DataFrame:
    """``item_id, doc, score`` of the candidates of one block of items."""
    spark = texts.sparkSession
    names = sorted({item for item, _ in pairs})
    terms = sorted({term for _, term in pairs})
    place = {term: i for i, term in enumerate(terms)}
    own: dict = {name: [] for name in names}
    for item, term in pairs:
        own[item].append(place[term])
    shared = spark.sparkContext.broadcast(terms)
    counts, counts_path = written(
        texts.mapInArrow(_count(shared), "doc long, n long, terms array<int>, times array<long>"),
        "term_counts",
    )
    totals = counts.agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("total")).first()
    n = totals["texts"]
    found = np.zeros(len(terms), np.int64)
    for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        found[row["term"]] = row["count"]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) if df else 0 for df in found]
    weights = spark.sparkContext.broadcast(np.array(weights, np.int64))
    queries = spark.sparkContext.broadcast([np.array(sorted(own[name]), np.int64) for name in names])
    vectors, vectors_path = written(
        counts.where("doc IS NOT NULL AND size(terms) > 0")
        .mapInArrow(
            _weigh(n, totals["total"] or 1, weights),
            "doc long, norm double, terms array<int>, impacts array<long>",
        )
        .repartitionByRange(F.desc("norm"), "doc")
        .sortWithinPartitions(F.desc("norm"), "doc")
        .withColumn("place", F.spark_partition_id()),
        "impact_vectors",
    )
    forget(spark, counts_path)
    last = vectors.agg(F.max("place")).first()[0] or 0
    kind = "item int, doc long, score long"
    cut = F.col("place") <= int(last * HEAD)
    columns = ["doc", "norm", "terms", "impacts"]
    head, _ = written(
        vectors.where(cut).select(columns).mapInArrow(_search(queries, weights, limit, {}), kind),
        "candidates",
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    reached = head.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == limit)
    least = {row["item"]: row["score"] for row in reached.collect()}
    rest, _ = written(
        vectors.where(~cut).select(columns).mapInArrow(_search(queries, weights, limit, least), kind),
        "candidates",
    )
    forget(spark, vectors_path)
    named = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return head.union(rest).join(F.broadcast(named), "item").select("item_id", "doc", "score")


def ranked_search(
    documents: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    limit: int = 50,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``limit`` documents with the highest scores of each item.

    Only scores above 0 count; equal scores go by ascending id. Terms are runs of letters, digits
    and non-ASCII characters with A-Z as a-z. With N texts that have a term, L terms in all, n in a text, df
    texts with a term and tf of its occurrences in one, a term weighs ``floor(1000 ln((2N+2)/(2df+1)))`` and
    adds that times ``10^9 tf div (1000 tf + 20 m)``, ``m = 50 + (50 n N) div L``.

    Items are searched in blocks of about ``BLOCK_TERMS`` terms, whose terms and ids the driver holds;
    every block reads all texts. Null, empty and wordless texts are in no list and in no count; texts with a
    null id count, but are not listed; rows that repeat an id are listed one by one, also with equal scores.
    Items with a null id or without terms have no rows; rows that repeat an item's id are one item with the
    terms of all. Other columns are ignored. An empty table gives no rows.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    pairs, pairs_path = written(
        items.where(F.col(item_column).isNotNull())
        .select(F.col(item_column).cast("long").alias("item"), F.col(item_text_column).alias("text"))
        .mapInArrow(_item_terms, "item long, term string")
        .distinct(),
        "item_terms",
    )
    blocks = -(-pairs.count() // BLOCK_TERMS)
    found = spark.createDataFrame([], "item_id long, doc long, score long")
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        if own:
            found = found.union(_search_block(texts, [tuple(r) for r in own], limit))
    forget(spark, pairs_path)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumnRenamed("doc", "doc_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= limit)
        .select("item_id", "rank", "doc_id", "score")
    )


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SEARCH_SQL = f"""
WITH listed AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
texts AS (SELECT doc_id, terms, len(terms) AS n FROM listed WHERE len(terms) > 0),
totals AS (SELECT count(*) AS texts, sum(n)::BIGINT AS total FROM texts),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
words AS (SELECT doc_id, n, unnest(terms) AS term FROM texts),
counts AS (
    SELECT doc_id, n, term, count(*) AS tf FROM words
    WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, n, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(texts) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals GROUP BY term
),
scored AS (
    SELECT item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // total))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term), totals
    GROUP BY item_id, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
