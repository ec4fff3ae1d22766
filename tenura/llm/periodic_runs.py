"""Runs of repeated words, by an enhanced suffix array and the test for branching squares.

The words of many documents stand on end, numbered per document, so that nothing repeats across a
border. Ranks of 1, 2, 4, ... words (prefix doubling, only over suffixes that are not unique yet) give
the suffix array and, kept level by level, the longest common prefix of any two suffixes. An LCP
interval of depth d whose suffixes i and i + d lie in different children is a square of period d that
ends a run: for each interval, the suffixes of all children but the largest look up the places of
i + d and i - d. Every suffix is looked at once for each time that it lies in a smaller child, which
is a logarithm. A square is then rotated to the left, in steps of powers of two, as far as the period
reaches; equal stretches are one run with the smallest period. Intervals are stretches of arrays, never nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import column, pieces
from tenura.llm.tokens import SPACED, ragged, split_words

#: Bytes of texts whose suffixes are sorted together; a longer text stands alone.
PIECE = 1 << 20


def _sort_suffixes(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and for each level l the ranks of all stretches of ``2 ** l`` codes.

    The last level tells all suffixes apart. Every level has a rank -1 for the empty suffix at the end.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable").astype(np.int32)
    fresh = np.ones(n, bool)
    fresh[1:] = codes[order[1:]] != codes[order[:-1]]
    rank = np.full(n + 1, -1, np.int32)
    heads = np.flatnonzero(fresh)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels = [rank]
    slots = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
    width = 1
    while len(slots):
        suffixes = order[slots]
        key = rank[suffixes].astype(np.int64) * (n + 2) + rank[np.minimum(suffixes + width, n)] + 1
        by_key = np.argsort(key, kind="stable")
        suffixes, key = suffixes[by_key], key[by_key]
        order[slots] = suffixes
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        heads = np.flatnonzero(fresh)
        rank = rank.copy()
        rank[suffixes] = np.repeat(slots[heads], np.diff(np.append(heads, len(slots))))
        levels.append(rank)
        slots = slots[~fresh | ~np.append(fresh[1:], True)]
        width *= 2
    return order, levels


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array; 0 for the first."""
    lcp = np.zeros(len(order) + 1, np.int32)
    some = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    one, two = order[some - 1].copy(), order[some].copy()
    for level in range(len(levels) - 2, -1, -1):
        step = np.where(levels[level][one] == levels[level][two], np.int32(1 << level), np.int32(0))
        one += step
        two += step
    lcp[some] = two - order[some]
    return lcp


def _borders(lcp: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest rows before and behind it with a smaller value; 0 stands at both ends."""
    stretch = np.diff(np.flatnonzero(lcp == 0)).max(initial=1)
    tables = [lcp]
    while 1 << len(tables) < stretch:
        last, step = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(last[:-step], last[step:]))
    before, behind, value = rows.copy(), rows + 1, lcp[rows]
    for level in range(len(tables) - 1, -1, -1):
        table, step = tables[level], 1 << level
        fits = behind + step <= len(lcp)
        behind += step * (fits & (table[np.where(fits, behind, 0)] >= value))
        fits = before >= step
        before -= step * (fits & (table[np.where(fits, before - step, 0)] >= value))
    return before - 1, behind


def _squares(codes: np.ndarray, order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares whose next word breaks the period."""
    n = len(codes)
    rows = np.flatnonzero(lcp)
    if not len(rows):
        return rows, rows
    low, high = _borders(lcp, rows)
    by_interval = np.lexsort((rows, high, low))
    rows, low, high = rows[by_interval], low[by_interval], high[by_interval]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    heads = np.flatnonzero(fresh)
    # Children of an interval: from its first row to the first border, and from border to border.
    border_at = np.arange(len(rows)) + np.cumsum(fresh)
    first = np.empty(len(rows) + len(heads), np.int64)
    first_at = border_at[heads] - 1
    first[border_at], first[first_at] = rows, low[heads]
    stop = np.append(first[1:], 0)
    last_at = np.append(first_at[1:], len(first)) - 1
    stop[last_at] = high[heads]
    owner = np.repeat(heads, np.diff(np.append(first_at, len(first))))
    size = stop - first
    number = np.repeat(np.arange(len(heads)), np.diff(np.append(first_at, len(first))))
    largest = np.flatnonzero(size == np.maximum.reduceat(size, first_at)[number])
    small = np.ones(len(first), bool)
    small[largest[np.unique(number[largest], return_index=True)[1]]] = False
    first, size, owner = first[small], size[small], owner[small]
    suffix = order[ragged(first, size)].astype(np.int64)
    owner = np.repeat(owner, size)
    depth, a, b = lcp[rows[owner]].astype(np.int64), low[owner], high[owner]
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(n)
    after = place[np.minimum(suffix + depth, n)]
    prior = place[np.maximum(suffix - depth, -1)]  # -1 is the place of the empty suffix
    right, left = (after >= a) & (after < b), (prior >= a) & (prior < b)
    start = np.concatenate([suffix[right], suffix[left] - depth[left]])
    period = np.concatenate([depth[right], depth[left]])
    padded = np.append(codes, -1)
    breaks = padded[start + period] != padded[np.minimum(start + 2 * period, n)]
    return start[breaks], period[breaks]


def find_runs(codes: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run, by start and period.

    A run is a stretch of at least ``least`` codes and ``times`` (2 or more) periods that no neighbour
    extends with the same period.
    """
    none = np.zeros(0, np.int64)
    if len(codes) < max(least, 2):
        return none, none, none
    order, levels = _sort_suffixes(codes)
    start, period = _squares(codes, order, _common_prefixes(order, levels))
    stop, first = start + 2 * period, start.copy()
    for level in range(len(levels) - 2, -1, -1):
        step = 1 << level
        fits = first >= step
        back = np.where(fits, first - step, 0)
        first -= step * (fits & (levels[level][back] == levels[level][back + period]))
    kept = stop - first >= np.maximum(least, times * period)
    first, stop, period = first[kept], stop[kept], period[kept]
    by_place = np.lexsort((period, stop, first))
    first, stop, period = first[by_place], stop[by_place], period[by_place]
    fresh = np.ones(len(first), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (stop[1:] != stop[:-1])
    first, stop, period = first[fresh], stop[fresh], period[fresh]
    by_period = np.lexsort((period, first))
    return first[by_period], (stop - first)[by_period], period[by_period]


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _scan(least: int, times: int):
    def run(batches):
        kinds = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                words, at = split_words(column(piece, "text"), SPACED, fold=False)
                encoded = words.dictionary_encode()
                codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(piece.num_rows), np.diff(at))
                codes += row * (len(encoded.dictionary) + 1)  # equal words of two texts differ
                start, length, period = find_runs(codes, least, times)
                edge = np.zeros(len(codes) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                offsets = pa.array(np.searchsorted(kept, at).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, words.take(pa.array(kept)).cast(pa.string()))
                owner = np.searchsorted(at, start, side="right") - 1
                values = [pa.array(v, pa.int64()) for v in (start - at[owner], length, period)]
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(piece.num_rows + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays(values, fields=kinds),
                )
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "doc_id"), runs, pc.binary_join(lists, " ")],
                    names=["doc_id", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = 6,
    times: int = 4,
) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row of ``documents``.

    ``runs`` holds ``start`` (word number from 0), ``length`` and ``period`` in words of every run, by
    start and period. Words are what white space of ASCII separates, letter case counts. A run is a
    stretch of at least ``least`` words and of ``times`` times its smallest period that neither neighbour
    extends with the same period. ``collapsed`` has the words joined by one space, without those behind the
    first period of a run. There is no shuffle; memory follows ``PIECE`` or the longest text.

    Null, empty and blank texts have no runs and an empty ``collapsed``; a null id stays null; rows that
    repeat are read one by one; other columns are ignored. No rows give no rows.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_scan(least, times), f"doc_id {kind}, runs {_RUNS}, collapsed string")


def with_planted_periods(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows, in a tenth of them (by the id's checksum) the end of the text made periodic.

    With h the checksum of the id's digits, g = h div 10 and n words, word i from a = g mod n on becomes
    word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8), if h mod 10 is 0 and n is not.
    """
    h = F.crc32(F.col(id_column).cast("string"))
    words = F.regexp_extract_all(text_column, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    changed = documents.select(
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    )
    periodic = """
        array_join(transform(sequence(0L, size(words) - 1L), i -> element_at(words, cast(1 + if(
            i < g % size(words), i,
            g % size(words) + (i - g % size(words)) % (1 + (size(words) - g % size(words)) div (3 + g % 8))
        ) as int))), ' ')
    """
    return changed.select(
        "doc_id", F.expr(f"CASE WHEN size(words) > 0 THEN {periodic} ELSE text END").alias("text")
    )


def run_digests(runs: DataFrame) -> DataFrame:
    """Number and longest run of each row of ``periodic_runs``, and checksums of its runs and words."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p, r)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return runs.select("doc_id", "runs", "collapsed", longest["r"].alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
