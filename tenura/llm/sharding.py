"""Sharding by a minimax contiguous partition of ordered atomic groups.

Documents with equal texts are one atomic group. Groups are ordered by the digest of their text.
The smallest capacity for which the greedy check needs no more than the given number of shards is
found by binary search, and the shards are cut under that capacity.

The driver never sees the groups. It holds a trie of digest prefixes with the bytes below each
(4,096 prefixes at first) and asks Spark for the children of just those prefixes in which a cut
of the search falls, until every cut of the last search lies at a group's edge. That is exact,
and what the driver holds follows the number of shards, not the number of groups. Only DataFrame
functions run on the rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.llm.frames import forget, written

_FIRST = 3
#: Buckets of a shard in which rows are numbered on their own.
_BUCKETS = 256


class _Edges:
    """Group edges seen through the prefixes known so far; remembers where it had to guess."""

    def __init__(self, nodes: dict[str, tuple[int, int]]):
        self.prefixes = sorted(nodes)
        sizes = [nodes[p][0] for p in self.prefixes]
        self.single = [nodes[p][1] == 1 for p in self.prefixes]
        self.ends = list(accumulate(sizes))
        self.starts = [e - s for e, s in zip(self.ends, sizes, strict=True)]
        self.total = self.ends[-1] if self.ends else 0
        self.guessed: set[str] = set()

    def _edge(self, position: int, up: bool) -> int:
        if position <= 0 or position >= self.total:
            return min(max(position, 0), self.total)
        node = bisect_right(self.starts, position) - 1
        if self.starts[node] == position:
            return position
        if not self.single[node]:
            self.guessed.add(self.prefixes[node])
        return self.ends[node] if up else self.starts[node]

    def before(self, position: int) -> int:
        return self._edge(position, up=False)

    def after(self, position: int) -> int:
        return self._edge(position, up=True)

    def prefix_at(self, edge: int) -> str | None:
        node = bisect_left(self.starts, edge)
        return self.prefixes[node] if node < len(self.starts) else None


def _fits(edges: _Edges, capacity: int, shards: int) -> bool:
    at = 0
    for _ in range(shards):
        at = edges.before(at + capacity)
    return at >= edges.total


def _capacity(edges: _Edges, shards: int, largest: int) -> int:
    low = max(largest, -(-edges.total // shards))
    high = -(-edges.total // shards) + largest
    while low < high:
        middle = (low + high) // 2
        if _fits(edges, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def _cuts(edges: _Edges, shards: int, capacity: int) -> list[int]:
    """Ends of all shards but the last: none holds more than ``capacity``, and each is cut as
    near to an equal share of the rest as the capacity of the shards after it allows."""
    least = [edges.total]
    for _ in range(shards - 1):
        least.append(edges.after(least[-1] - capacity))
    least.reverse()
    at, cuts = 0, []
    for shard in range(shards - 1):
        want = at + (edges.total - at) // (shards - shard)
        below, above = edges.before(want), edges.after(want)
        cut = below if want - below <= above - want else above
        at = max(min(cut, edges.before(at + capacity)), least[shard], at)
        cuts.append(at)
    return cuts


def shard_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The smallest capacity and the digest prefixes at which shards 1, 2, ... begin.

    ``groups`` holds ``key`` (text, unique) and ``bytes`` (long, positive) and is read several
    times, so it should be a written table.
    """

    def children(prefixes: list[str], length: int) -> DataFrame:
        rows = groups.where(F.substring("key", 1, length - 1).isin(prefixes)) if prefixes else groups
        return rows.groupBy(F.substring("key", 1, length).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.max("bytes").alias("largest")
        )

    first = children([], _FIRST).collect()
    nodes = {r["prefix"]: (r["bytes"], r["n"]) for r in first}
    largest = max((r["largest"] for r in first), default=0)
    while True:
        edges = _Edges(nodes)
        capacity = _capacity(edges, shards, largest)
        cuts = _cuts(edges, shards, capacity)
        if not edges.guessed:
            break
        by_length: dict[int, list[str]] = {}
        for prefix in edges.guessed:
            by_length.setdefault(len(prefix) + 1, []).append(prefix)
        finer = reduce(DataFrame.union, [children(p, n) for n, p in by_length.items()]).collect()
        for prefix in edges.guessed:
            del nodes[prefix]
        nodes |= {r["prefix"]: (r["bytes"], r["n"]) for r in finer}
    return capacity, [edges.prefix_at(c) for c in cuts]


def shard_documents(
    documents: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``documents``.

    ``size`` is the text's UTF-8 bytes plus 8. The law is ``bytes``: the largest shard is as
    small as any contiguous cut between groups allows. Rows with equal texts share a shard; a
    null text has no bytes, checksum 0 and a group of its own per id; an empty text is a text.
    ``slot`` numbers the rows of a shard from 0 without gaps, in the order of a hash of the id.
    Rows that repeat an id are numbered one by one. Shards may stay empty when there are fewer
    groups than shards. Other columns are ignored; no rows give no rows.
    """
    spark = documents.sparkSession
    text = F.col(text_column)
    null_key = F.concat(F.lit("n"), F.md5(F.concat_ws(":", F.lit("id"), id_column)))
    rows, _ = written(
        documents.select(
            F.col(id_column).alias("doc_id"),
            F.coalesce(F.md5(text), null_key).alias("key"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        ),
        "sized",
    )
    groups, group_path = written(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    _, begins = shard_cuts(groups, shards)
    forget(spark, group_path)
    shard = F.lit(0)
    for begin in begins:
        if begin is not None:
            shard = shard + F.when(F.col("key") >= begin, 1).otherwise(0)
    bucket = F.pmod(F.xxhash64("doc_id", "key"), F.lit(_BUCKETS)).cast("int")
    dealt = rows.withColumn("shard", shard.cast("int")).withColumn("bucket", bucket)
    in_order = Window.partitionBy("shard").orderBy("bucket")
    firsts = (
        dealt.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", (F.sum("n").over(in_order) - F.col("n")).alias("first"))
    )
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "key")
    return (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(firsts), ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
