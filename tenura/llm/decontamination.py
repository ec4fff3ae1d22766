"""Benchmark decontamination: BM25 over test items with block-max bounds, then exact overlap.

The test items are indexed; every passage of every document is a query. An item's score is the
share of its own BM25 mass that the passage's words carry, so one threshold serves all items.
Items of similar length form blocks, and a posting of a block holds the largest impact of its
items. The most common terms of a block, which together stay well below the threshold, have no
postings there: they can never lift an item over it alone, so only the others are read. A
block is scored only when the impacts read plus all it could gain from its common terms reach the
threshold. The bounds are exact: every item at or above the threshold is retrieved.

A retrieved item counts as found when the words of its question and of its answer both occur in
the passage as shingles.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import column, pieces, written
from tenura.llm.words import Words, shingles

K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
#: Share of the threshold that the terms without postings of a block may reach together. More
#: leaves fewer postings to read, less leaves fewer blocks to score; either way none is missed.
COMMON = 0.35
#: Items of one index, about; a larger benchmark is searched in several passes, with the same scores.
INDEX_ITEMS = 10_000


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last line, or the last sentence of a single line; it may be empty."""
    text = text.strip()
    cut = text.rfind("\n")
    if cut < 0:
        ends = [m.end() for m in re.finditer(r"[.!?]+\s+", text)]
        cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


def _expand(first: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ragged lists that begin at ``first[key]``: which key, and the place of each element."""
    counts = first[keys + 1] - first[keys]
    which = np.repeat(np.arange(len(keys)), counts)
    ends = np.cumsum(counts)
    return which, np.repeat(first[keys] - (ends - counts), counts) + np.arange(
        ends[-1] if len(ends) else 0
    )


class BenchmarkIndex:
    """Items with their postings.

    ``whole``: number, mean and largest length of all items of the benchmark that have words, and the terms of
    these items, in order, with the number of all items that have them; without it the items are the benchmark.
    """

    def __init__(
        self,
        items: list[tuple[int, str | None]],
        threshold: float,
        overlap: float,
        width: int,
        whole: tuple[int, float, int, np.ndarray, np.ndarray] | None = None,
    ):
        self.threshold, self.overlap, self.width = threshold, overlap, width
        reader = Words(space=False)
        texts = pa.array([t or "" for _, t in items], pa.string())
        hashes, at = reader(pc.utf8_lower(texts))
        sizes = np.diff(at)
        order = np.lexsort(([i for i, _ in items], sizes))
        order = order[sizes[order] > 0]
        self.items = np.array([items[i][0] for i in order], np.int64)
        words = [hashes[at[i] : at[i + 1]] for i in order]
        self.span = max((len(w) for w in words), default=1)
        n, mean = len(words), np.mean([len(w) for w in words] or [1])
        distinct = [np.unique(w, return_counts=True) for w in words]
        self.terms, found = np.unique(
            np.concatenate([t for t, _ in distinct] or [np.zeros(0, np.uint64)]), return_counts=True
        )
        every = n
        if whole is not None:
            every, mean, self.span, terms, held = whole
            found = held[np.searchsorted(terms, self.terms)]
        idf = np.log1p((every - found + 0.5) / (found + 0.5))
        item = np.repeat(np.arange(n), [len(t) for t, _ in distinct])
        term = np.searchsorted(self.terms, np.concatenate([t for t, _ in distinct] or [self.terms]))
        count = np.concatenate([c for _, c in distinct] or [np.zeros(0, np.int64)])
        length = np.array([len(w) for w in words] or [1])[item] / mean
        impact = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * length))
        own = np.bincount(item, impact, n)
        impact = impact / own[item]
        # Postings of each block by term: for scoring, every item's impact.
        self.block_of = np.arange(n) // BLOCK_ITEMS
        blocks = -(-n // BLOCK_ITEMS)
        self.exact = []
        for b in range(blocks):
            some = item // BLOCK_ITEMS == b
            ids, place = np.unique(term[some], return_inverse=True)
            table = np.zeros((len(ids), BLOCK_ITEMS))
            table[place, item[some] % BLOCK_ITEMS] = impact[some]
            self.exact.append((ids, table))
        # Block-max postings; the commonest terms of a block that together miss the threshold
        # are left out and bounded by their sum.
        rows, self.rest = [], np.zeros(blocks)
        for b, (ids, table) in enumerate(self.exact):
            most = table.max(axis=1)
            by_count = np.lexsort((most, -found[ids]))
            total = np.cumsum(most[by_count])
            common = int(np.searchsorted(total, threshold * COMMON))
            self.rest[b] = total[common - 1] if common else 0.0
            kept = by_count[common:]
            rows.append(np.stack([ids[kept], np.full(len(kept), b), most[kept]], axis=1))
        table = np.concatenate(rows) if rows else np.zeros((0, 3))
        table = table[np.argsort(table[:, 0], kind="stable")]
        self.first = np.searchsorted(table[:, 0], np.arange(len(self.terms) + 1))
        self.posting_block, self.posting_most = table[:, 1].astype(np.int64), table[:, 2]
        self.parts = []
        for i in order:
            halves = pa.array(list(question_and_answer(items[i][1].lower())))
            half, cut = reader(halves)
            self.parts.append(
                [self._part(half[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            )

    def _part(self, words: np.ndarray) -> tuple[int, np.ndarray]:
        width = min(self.width, len(words))
        if not width:
            return 0, words
        return width, np.unique(shingles(words, np.array([0, len(words)]), width)[0])

    def passages(self, at: np.ndarray):
        """Overlapping passages that cover each text; every run of ``span`` words lies in one."""
        counts = np.diff(at)
        n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - 2 * self.span) // self.span)), 0)
        text = np.repeat(np.arange(len(counts)), n)
        ends = np.cumsum(n)
        number = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        first = at[text] + number * self.span
        return text, first, np.minimum(first + 2 * self.span, at[1:][text])

    def search(self, texts: pa.Array, reader: Words):
        """``text, item, score, question, answer`` of all verified items, best passage each."""
        hashes, at = reader(pc.utf8_lower(texts))
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        if not len(self.items) or not len(hashes):
            return found
        place = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = self.terms[place] == hashes
        text, first, stop = self.passages(at)
        posted = self.first[place + 1] > self.first[place]
        where = np.flatnonzero(known & posted)
        low, high = np.searchsorted(where, first), np.searchsorted(where, stop)
        passage, position = _ragged(low, high)
        pair = np.unique(passage * len(self.terms) + place[where[position]])
        passage, term = pair // len(self.terms), pair % len(self.terms)
        which, posting = _expand(self.first, term)
        key = passage[which] * len(self.rest) + self.posting_block[posting]
        keys, inverse = np.unique(key, return_inverse=True)
        bound = np.bincount(inverse.reshape(-1), self.posting_most[posting], len(keys))
        block = keys % len(self.rest)
        keep = bound + self.rest[block] >= self.threshold - 1e-9
        for p, b in zip(keys[keep] // len(self.rest), block[keep], strict=True):
            ids, table = self.exact[b]
            inside = slice(first[p], stop[p])
            own = place[inside][known[inside]]
            scores = table[np.isin(ids, own)].sum(axis=0)
            for inner in np.flatnonzero(scores >= self.threshold - 1e-9):
                item = b * BLOCK_ITEMS + inner
                words = hashes[first[p] : stop[p]]
                question, answer = (self._overlap(part, words) for part in self.parts[item])
                if min(question, answer) >= self.overlap:
                    name = (int(text[p]), int(self.items[item]))
                    value = (float(scores[inner]), question, answer)
                    found[name] = max(found.get(name, value), value)
        return found

    @staticmethod
    def _overlap(part: tuple[int, np.ndarray], words: np.ndarray) -> float:
        width, wanted = part
        if not width:
            return 1.0
        if len(words) < width:
            return 0.0
        have = shingles(words, np.array([0, len(words)]), width)[0]
        return float(np.isin(wanted, have).mean())


def _ragged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = high - low
    which = np.repeat(np.arange(len(low)), counts)
    ends = np.cumsum(counts)
    return which, np.repeat(low - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _item_terms(batches):
    """Per item its number of words, and each distinct word's hash."""
    reader = Words(space=False)
    for batch in batches:
        for piece in pieces(batch, "text"):
            hashes, at = reader(pc.utf8_lower(column(piece, "text")))
            distinct = [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            offsets = np.cumsum([0, *(len(d) for d in distinct)])
            terms = np.concatenate([np.zeros(0, np.uint64), *distinct]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(terms))
            yield pa.RecordBatch.from_arrays(
                [column(piece, "part"), pa.array(np.diff(at)), lists], names=["part", "size", "terms"]
            )


def build_indexes(
    benchmark: DataFrame,
    id_column: str = "item_id",
    text_column: str = "text",
    threshold: float = 0.6,
    overlap: float = 0.8,
    width: int = 5,
):
    """Indexes of about ``INDEX_ITEMS`` items each, one after the other; the driver holds one at a time.

    Parts are dealt by a hash of the ids. The number of items, their mean and largest length and the frequencies of
    terms are those of the whole benchmark, counted once, so scores do not depend on the parts. Items with a
    null id, and null or wordless texts, match nothing. Rows that repeat an id are indexed one by one under it.
    """
    rows = benchmark.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("item"), F.col(text_column).alias("text")
    )
    parts = max(1, -(-rows.count() // INDEX_ITEMS))
    if parts == 1:
        own = sorted((r["item"], r["text"]) for r in rows.collect())
        yield BenchmarkIndex(own, threshold, overlap, width)
        return
    rows, _ = written(rows.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int")), "items")
    counted, _ = written(rows.mapInArrow(_item_terms, "part int, size long, terms array<long>"), "item_terms")
    counted = counted.where("size > 0")
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"), F.max("size").alias("span")).first()
    terms = counted.select("part", F.explode("terms").alias("term"))
    frequencies, _ = written(terms.groupBy("term").agg(F.count(F.lit(1)).alias("held")), "frequencies")
    for part in range(parts):
        own = sorted((r["item"], r["text"]) for r in rows.where(F.col("part") == part).collect())
        here = terms.where(F.col("part") == part).select("term").distinct().join(frequencies, "term").toArrow()
        hashes, held = (here[c].to_numpy() for c in ("term", "held"))
        hashes = hashes.astype(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        whole = (total["n"], total["mean"], total["span"] or 1, hashes[order], held[order])
        yield BenchmarkIndex(own, threshold, overlap, width, whole)


def _find(index: BenchmarkIndex):
    def run(batches):
        reader = Words(space=False)
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = index.search(column(piece, "text"), reader)
                if found:
                    ids = column(piece, "doc_id").to_pylist()
                    rows = [(ids[row], item, *value) for (row, item), value in found.items()]
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names
                    )

    return run


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every item found.

    One row per document row and item, of the passage with the largest score. Null and empty texts
    contain nothing; a null id stays null; rows that repeat are searched one by one. Other columns
    are ignored. An empty table or benchmark gives no rows.
    """
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    kind = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    )
    out = None
    for index in build_indexes(benchmark, **options):
        if out is not None:  # an index is let go with its pass
            out, _ = written(out, "found")
        found = rows.mapInArrow(_find(index), kind)
        out = found if out is None else out.union(found)
    return out


def _drop(index: BenchmarkIndex, text_column: str):
    def run(batches):
        reader = Words(space=False)
        for batch in batches:
            for piece in pieces(batch, text_column):
                clean = np.ones(piece.num_rows, bool)
                for row, _ in index.search(column(piece, text_column), reader):
                    clean[row] = False
                yield piece.filter(pa.array(clean))

    return run


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, text_column: str = "text", **options
) -> DataFrame:
    """The rows of ``documents`` in which no item is found, with all their columns."""
    for i, index in enumerate(build_indexes(benchmark, **options)):
        if i:
            documents, _ = written(documents, "clean")
        documents = documents.mapInArrow(_drop(index, text_column), documents.schema)
    return documents
