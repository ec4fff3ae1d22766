"""Exact near-duplicate vectors by dual traversal of cover trees.

Unit vectors with cosine at least ``c`` lie within the chord ``t = sqrt(2 - 2c)``. The top of the
tree is a small net of centres; below it the vectors of a node lie in blocks, and each block holds
a cover tree: nested nets whose radii halve. Every node knows its true covering radius. A pair of
nodes is given up when their centres lie further apart than both radii and ``t``, taken as linked
whole when even the furthest points lie within ``t``, and replaced by the pairs of its children
otherwise. The bounds hold for all pairs, so the result is exact.

The work of a join of blocks is one task, so memory holds two blocks. Equal vectors are one class
from the start. Where the bounds cannot prune, as with independent directions in many dimensions,
every pair of blocks is visited once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.components import components
from tenura.llm.frames import column, forget, written

#: Vectors in a block.
BLOCK = 4096
#: Centres of the top net at most, and about how many vectors they are chosen from.
CENTRES, SAMPLE = 64, 2048
#: Halving radii of the nets inside a block, as chords.
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
_SLACK = 1e-5


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = values.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _net(unit: np.ndarray) -> list[np.ndarray]:
    """For each radius, the centre of every row. The nets are nested: a centre of one level is a
    centre of all below, and rows that share a centre share the centres above it."""
    near = unit @ unit.T
    nets, chosen = [], []
    for radius in RADII:
        least = 1 - radius * radius / 2
        open_rows = np.ones(len(unit), bool)
        if chosen:
            open_rows[chosen] = False
            others = np.flatnonzero(open_rows)
            open_rows[others] = near[np.ix_(others, chosen)].max(axis=1) < least
        for row in range(len(unit)):
            if open_rows[row]:
                chosen.append(row)
                open_rows &= near[row] < least
        nets.append(np.array(chosen, np.int64))
    levels = [np.arange(len(unit))]
    for net in reversed(nets):
        below = np.unique(levels[0])
        above = np.arange(len(unit))
        below = np.setdiff1d(below, net, assume_unique=True)
        above[below] = net[near[np.ix_(below, net)].argmax(axis=1)]
        levels.insert(0, above[levels[0]])
    return levels[:-1]


class Tree:
    """A block's cover tree: per level its centres, true radii, weights and children."""

    def __init__(self, unit: np.ndarray, weights: np.ndarray, levels: list[np.ndarray]):
        self.unit, self.weights = unit, weights
        self.single = unit.astype(np.float32)
        self.members, self.centres, self.radii = [], [], []
        for of_row in [*levels, np.arange(len(unit))]:
            centres, node = np.unique(of_row, return_inverse=True)
            node = node.reshape(-1)
            apart = unit - unit[centres[node]]
            chord = np.sqrt((apart * apart).sum(axis=1))
            radius = np.zeros(len(centres))
            np.maximum.at(radius, node, chord)
            self.centres.append(centres)
            self.members.append(node)
            self.radii.append(radius)

        self.below, self.first = [], []
        for above, under in zip(self.members[:-1], self.members[1:], strict=True):
            parent = np.empty(under.max(initial=-1) + 1, np.int64)
            parent[under] = above
            order = np.argsort(parent, kind="stable")
            self.below.append(order)
            self.first.append(np.searchsorted(parent[order], np.arange(above.max(initial=-1) + 2)))

    def split(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of the nodes: the parent's place in ``nodes`` and the child at ``level + 1``."""
        first = self.first[level]
        counts = first[nodes + 1] - first[nodes]
        place = np.repeat(np.arange(len(nodes)), counts)
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
        return place, self.below[level][np.repeat(first[nodes], counts) + at]


def _dense(a: Tree, b: Tree, reach: float):
    """Node pairs of the first level that the bound leaves, a strip of rows at a time."""
    one, two = a.centres[0], b.centres[0]
    right = b.single[two].T.copy()
    for at in range(0, len(one), 512):
        rows = one[at : at + 512]
        far = a.radii[0][at : at + 512, None] + b.radii[0][None, :] + reach
        left = a.single[rows] @ right >= 1 - np.minimum(far, 2) ** 2 / 2 - _SLACK
        i, j = np.nonzero(left)
        yield i + at, j


def dual(a: Tree, b: Tree, cosine: float):
    """Linked row pairs between two blocks: ``whole`` node pairs and single pairs.

    Yields ``(level, nodes of a, nodes of b)``; at the last level the nodes are rows.
    """
    reach = math.sqrt(2 - 2 * cosine)
    last = len(RADII)
    for i, j in _dense(a, b, reach):
        stack = [(0, i, j)]
        while stack:
            level, i, j = stack.pop()
            for at in range(0, len(i), 1 << 17):
                p, q = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
                dots = np.einsum(
                    "ij,ij->i", a.unit[a.centres[level][p]], b.unit[b.centres[level][q]]
                )
                if level == last:
                    linked = dots >= cosine
                    yield level, p[linked], q[linked]
                    continue
                chord = np.sqrt(np.maximum(2 - 2 * dots, 0))
                radii = a.radii[level][p] + b.radii[level][q]
                whole = chord + radii <= reach - _SLACK
                yield level, p[whole], q[whole]
                rest = ~whole & (chord <= radii + reach + _SLACK)
                p, q = p[rest], q[rest]
                if not len(p):
                    continue
                place, below = a.split(level, p)
                p, q = below, q[place]
                place, below = b.split(level, q)
                stack.append((level + 1, p[place], below))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the links ``a[i] - b[i]``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def block_links(a: Tree, b: Tree | None, cosine: float):
    """Weights linked to each row of ``a`` and ``b``, and links that span the components.

    With ``b`` none, the links inside ``a``. Rows of ``b`` follow those of ``a`` in the links.
    """
    other = a if b is None else b
    n, m = len(a.unit), len(other.unit)
    shift = 0 if b is None else n
    to_a, to_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
    found: dict[int, list] = {}
    for level, p, q in dual(a, other, cosine):
        if len(p):
            found.setdefault(level, []).append((p, q))
    links_a, links_b = [], []
    for level, pairs in found.items():
        p, q = (np.concatenate(side) for side in zip(*pairs, strict=True))
        in_a, in_b = a.members[level], other.members[level]
        weight_a = np.bincount(in_a, a.weights, len(a.centres[level])).astype(np.int64)
        weight_b = np.bincount(in_b, other.weights, len(other.centres[level])).astype(np.int64)
        got_a, got_b = np.zeros_like(weight_a), np.zeros_like(weight_b)
        np.add.at(got_a, p, weight_b[q])
        np.add.at(got_b, q, weight_a[p])
        to_a += got_a[in_a]
        to_b += got_b[in_b]
        # A whole pair links every row of one node with every row of the other: the centres stand
        # for their nodes, and every row of a node that has any whole pair joins its partner's centre.
        links_a.append(a.centres[level][p])
        links_b.append(other.centres[level][q] + shift)
        mate = np.full(len(weight_a), -1)
        mate[p] = other.centres[level][q]
        rows = np.flatnonzero(mate[in_a] >= 0)
        links_a.append(rows)
        links_b.append(mate[in_a[rows]] + shift)
        mate = np.full(len(weight_b), -1)
        mate[q] = a.centres[level][p]
        rows = np.flatnonzero(mate[in_b] >= 0)
        links_a.append(mate[in_b[rows]])
        links_b.append(rows + shift)
    total = n if b is None else n + m
    if links_a:
        label = _labels(total, np.concatenate(links_a), np.concatenate(links_b))
    else:
        label = np.arange(total)
    if b is None:
        return to_a - a.weights, None, label
    return to_a, to_b, label


def _vectors(documents: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, vector, valid`` with the class key; components beyond all doubt are numbers."""
    vector = F.col(vector_column)
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    some = F.exists(vector, lambda x: x != 0)
    valid = F.col(id_column).isNotNull() & vector.isNotNull() & ~bad & some
    return documents.select(
        F.col(id_column).cast("long").alias("vec_id"),
        vector.alias("vector"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.xxhash64(F.lit(1), vector).alias("key_a"),
        F.xxhash64(F.lit(2), vector).alias("key_b"),
    )


def _place(centres: np.ndarray):
    """Adds the nearest centre and the chord to it."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(column(batch, "vector")) @ centres.T
            node = near.argmax(axis=1)
            chord = np.sqrt(np.maximum(2 - 2 * near[np.arange(len(node)), node], 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(node.astype(np.int32)), pa.array(chord)],
                names=[*batch.schema.names, "node", "chord"],
            )

    return run


def _grow(table: pa.Table) -> pa.Table:
    levels = _net(_matrix(table["vector"]))
    rows = np.stack(levels, axis=1).astype(np.int32)
    place = pa.array(np.arange(len(rows), dtype=np.int32))
    centres = pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(RADII)), pa.array(rows.reshape(-1))
    )
    return table.append_column("place", place).append_column("centres", centres)


def _tree(table: pa.Table) -> Tree:
    table = table.sort_by("place")
    levels = np.array(table["centres"].to_pylist(), np.int64).reshape(-1, len(RADII)).T
    weights = table["copies"].to_numpy().astype(np.int64)
    return Tree(_matrix(table["vector"]), weights, list(levels))


def _join(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        first = table.filter(pc.equal(table["side"], 0))
        second = table.filter(pc.equal(table["side"], 1))
        a, ids = _tree(first), first.sort_by("place")["rep"].to_numpy()
        if second.num_rows:
            b = _tree(second)
            ids = np.concatenate([ids, second.sort_by("place")["rep"].to_numpy()])
            to_a, to_b, label = block_links(a, b, cosine)
            got = np.concatenate([to_a, to_b])
        else:
            got, _, label = block_links(a, None, cosine)
        some = np.flatnonzero((got > 0) | (label != np.arange(len(label))))
        return pa.table(
            {"rep": ids[some], "mate": ids[label[some]], "links": got[some].astype(np.int64)}
        )

    return run


def _centres(vectors: DataFrame) -> np.ndarray:
    """A net over a bounded sample: each centre the furthest from those before it."""
    total = vectors.count()
    every = F.pmod(F.xxhash64("rep"), F.lit(max(1, total // SAMPLE))) == 0
    rows = vectors.where(every).orderBy("rep").select("vector").collect() or vectors.take(1)
    unit = _matrix(pa.array([list(r["vector"]) for r in rows], pa.list_(pa.float64())))
    chosen, nearest = [0], unit @ unit[0]
    wanted = min(CENTRES, max(1, len(unit)), max(1, total // (8 * BLOCK)))
    while len(chosen) < wanted and nearest.min() < 1 - RADII[-1] ** 2 / 2:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _blocks(spark, placed: DataFrame, centres: np.ndarray, reach: float):
    """The rows with their block, and per top node the ranges of blocks that it has to meet.

    Both tables have at most one row per pair of top nodes.
    """
    stats = placed.groupBy("node").agg(F.count("*").alias("n"), F.max("chord").alias("radius"))
    nodes = {r["node"]: r for r in stats.collect()}
    blocks = {k: -(-r["n"] // BLOCK) for k, r in nodes.items()}
    first, total = {}, 0
    for k in sorted(blocks):
        first[k], total = total, total + blocks[k]
    meets = []
    for p in nodes:
        for q in nodes:
            chord = math.sqrt(max(0.0, 2 - 2 * float(centres[p] @ centres[q])))
            if chord - nodes[p]["radius"] - nodes[q]["radius"] <= reach + _SLACK:
                meets.append((p, first[q], first[q] + blocks[q] - 1))
    own = spark.createDataFrame(
        [(p, blocks[p], first[p]) for p in nodes] or [], "node int, blocks int, first int"
    )
    others = spark.createDataFrame(meets, "node int, other_first int, other_last int")
    block = (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int")
    dealt = placed.join(F.broadcast(own), "node").withColumn("block", block)
    return dealt.select("rep", "copies", "vector", "node", "block"), others


def near_vectors(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.95,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    Vectors of the same length are linked when their cosine, in double precision, is at least
    ``cosine``. ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest id reachable, ``kept`` marks it. A vector that is null, zero or holds a null or
    non-finite component, and a row with a null id (null component, kept), is linked with nothing.
    Rows that repeat id and vector are one vector, each returned; rows that repeat an id with
    another vector share the id's links. Other columns are ignored. No rows give no rows.
    """
    spark = embeddings.sparkSession
    rows, row_path = written(_vectors(embeddings, id_column, vector_column), "vectors")
    keys = ["key_a", "key_b"]
    valid = rows.where("valid")
    classes, class_path = written(
        valid.select("vec_id", *keys)
        .distinct()
        .groupBy(*keys)
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    lengths = [r[0] for r in valid.select(F.size("vector")).distinct().collect()]
    parts, paths = None, [row_path, class_path]
    for length in sorted(lengths):
        own = (
            valid.where(F.size("vector") == length)
            .join(classes, keys)
            .where("vec_id = rep")
            .dropDuplicates(keys)
            .select("rep", "copies", "vector")
        )
        part, path = _links_of_length(spark, own, cosine)
        paths.append(path)
        parts = part if parts is None else parts.union(part)
    if parts is None:
        parts = spark.createDataFrame([], "rep long, mate long, links long")
    counts = parts.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(parts.select(F.col("rep").alias("a"), F.col("mate").alias("b")))
    of_class, of_class_path = written(
        classes.join(counts, "rep", "left")
        .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            *keys,
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("class_links"),
            F.coalesce("component_id", "rep").alias("class_component"),
        ),
        "of-class",
    )
    marked = rows.select("vec_id", *[F.when(F.col("valid"), F.col(k)).alias(k) for k in keys])
    return (
        marked.join(of_class, keys, "left")
        .select(
            "vec_id",
            F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("class_component", "vec_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.expr("coalesce(vec_id = component_id, true)"))
    )


def _links_of_length(spark, vectors: DataFrame, cosine: float):
    base, base_path = written(vectors, "distinct")
    centres = _centres(base)
    kind = "rep long, copies long, vector array<double>"
    plain = base.select("rep", "copies", F.col("vector").cast("array<double>").alias("vector"))
    placed, placed_path = written(
        plain.mapInArrow(_place(centres), f"{kind}, node int, chord double"), "placed"
    )
    in_blocks, others = _blocks(spark, placed, centres, math.sqrt(2 - 2 * cosine))
    trees, tree_path = written(
        in_blocks.groupBy("block").applyInArrow(
            _grow, f"{kind}, node int, block int, place int, centres array<int>"
        ),
        "trees",
    )
    met = trees.join(F.broadcast(others), "node").withColumn(
        "other", F.explode(F.sequence("other_first", "other_last"))
    )
    dealt = met.select(
        F.least("block", "other").alias("block_a"),
        F.greatest("block", "other").alias("block_b"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        "rep",
        "copies",
        "vector",
        "place",
        "centres",
    )
    found, path = written(
        dealt.groupBy("block_a", "block_b").applyInArrow(
            _join(cosine), "rep long, mate long, links long"
        ),
        "found",
    )
    forget(spark, base_path, placed_path, tree_path)
    return found, path
