"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Every document carries ``PLACES`` minwise
tokens of its set. A node of a tree holds the documents that share the tokens chosen on the way
to it; the node's name alone decides which one or two tokens are chosen next (1/threshold on
average, so a pair at the threshold keeps one common path per level). Nodes of at most ``LEAF``
documents are compared exhaustively on full sets. A larger one in which most documents are linked
already is compared exhaustively too, its few others against all in blocks; the rest are compared
in random blocks and branch. Independent trees, taken in ``ROUNDS``, raise the recall. Equal sets are one class from the
start, and a node whose documents are linked already is done, so a large group is not compared
again and again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.components import components
from tenura.llm.frames import column, forget, pieces, written
from tenura.llm.words import Words, mix, shingles

#: Trees of each round.
ROUNDS = (2, 8)
PLACES = 64
FIRST_DEPTH = 3
LAST_DEPTH = 24
#: Documents and shingles of a node that are compared exhaustively by one task.
LEAF, LEAF_SHINGLES = 1024, 1 << 21

_NODES = [f"nodes_{i}" for i in range(len(ROUNDS))]
_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, tokens binary" + "".join(
    f", {n} array<long>" for n in _NODES
)


class _Paths:
    """Which tokens a node chooses; a function of the node's name only."""

    def __init__(self, threshold: float, seed: int):
        self.limit = np.uint64(int((1 / threshold - 1) * (1 << 64)) if threshold < 1 else 0)
        self.seed = np.uint64(seed)

    def roots(self, trees: int) -> np.ndarray:
        return mix(np.arange(1, trees + 1, dtype=np.uint64) + self.seed * np.uint64(1_000_003))

    def children(self, names: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the parent in ``names`` and the name of each child."""
        draw = mix(names ^ np.uint64(0xA0761D6478BD642F))
        places = tokens.shape[1]
        first = (draw % np.uint64(places)).astype(np.int64)
        shift = (draw >> np.uint64(20)) % np.uint64(places - 1) + np.uint64(1)
        second = (first + shift.astype(np.int64)) % places
        twice = np.flatnonzero(mix(names ^ np.uint64(0xE7037ED1A0B428DB)) < self.limit)
        parent = np.concatenate([np.arange(len(names)), twice])
        place = np.concatenate([first, second[twice]])
        token = tokens[parent, place].astype(np.uint64)
        step = token + (place.astype(np.uint64) << np.uint64(40))
        return parent, mix(names[parent] * np.uint64(0x9E3779B97F4A7C15) + mix(step))


def _rows(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _sign(width: int, threshold: float, seed: int):
    def run(batches):
        words, paths = Words(), _Paths(threshold, seed)
        odd = mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(7_919)) | np.uint64(1)
        add = mix(odd)
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets, at = shingles(*words(column(piece, "text")), width)
                sizes, set_a, set_b = _fingerprints(sets, at)
                tokens = np.zeros((piece.num_rows, PLACES), np.uint32)
                some = np.flatnonzero(sizes)
                for place in range(PLACES if len(some) else 0):
                    values = ((sets * odd[place] + add[place]) >> np.uint64(32)).astype(np.uint32)
                    tokens[some, place] = np.minimum.reduceat(values, at[:-1][some])
                row = np.repeat(some, sum(ROUNDS))
                turn = np.tile(np.repeat(np.arange(len(ROUNDS)), ROUNDS), len(some))
                name = np.tile(paths.roots(sum(ROUNDS)), len(some))
                for _ in range(FIRST_DEPTH if len(some) else 0):
                    parent, name = paths.children(name, tokens[row])
                    row, turn = row[parent], turn[parent]
                order = np.argsort(row, kind="stable")
                nodes = []
                for i in range(len(ROUNDS)):
                    own = order[turn[order] == i]
                    nodes.append(_rows(name[own], np.bincount(row[own], minlength=piece.num_rows)))
                yield pa.RecordBatch.from_arrays(
                    [
                        column(piece, "doc_id"),
                        pa.array(sizes),
                        pa.array(set_a.view(np.int64)),
                        pa.array(set_b.view(np.int64)),
                        pa.array([t.tobytes() for t in tokens], pa.binary()),
                        *nodes,
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "tokens", *_NODES],
                )

    return run


def _fingerprints(sets: np.ndarray, at: np.ndarray):
    """Number of distinct shingles per row and two independent 64-bit sums over them."""
    n = len(at) - 1
    sizes, set_a, set_b = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for i in range(n):
        if at[i + 1] > at[i]:
            own = np.unique(sets[at[i] : at[i + 1]])
            sizes[i] = len(own)
            set_a[i] = mix(own + np.uint64(0x51ED270B)).sum(dtype=np.uint64)
            set_b[i] = mix(own ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    return sizes, set_a, set_b


def _branch(threshold: float, seed: int):
    def run(batches):
        paths = _Paths(threshold, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            blob = b"".join(column(batch, "tokens").to_pylist())
            tokens = np.frombuffer(blob, np.uint32).reshape(batch.num_rows, PLACES)
            names = column(batch, "node").to_numpy(zero_copy_only=False).astype(np.int64)
            parent, children = paths.children(names.view(np.uint64), tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(children.view(np.int64)),
                    column(batch, "rep").take(pa.array(parent)),
                    column(batch, "n_shingles").take(pa.array(parent)),
                ],
                names=["node", "rep", "n_shingles"],
            )

    return run


def forest(member_sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Linked pairs of positions that join the components among some sets.

    Sets with equal labels are known to be linked. Every pair of unequal labels counts; of the
    linked ones only those that join two components are returned.
    """
    names, label = np.unique(labels, return_inverse=True)
    label = label.reshape(-1)
    if len(names) < 2:
        return []
    minor = np.flatnonzero(label != np.bincount(label).argmax())
    m = len(member_sets)
    sizes = np.array([len(s) for s in member_sets], np.int64)
    if m == 2:
        low, high = sorted(sizes)
        if 100 * low < percent * high:
            return []
        both = len(np.intersect1d(*member_sets, assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (low + high - both) else []
    values = np.concatenate(member_sets)
    owners = np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    shared = np.diff(np.concatenate([np.flatnonzero(new), [len(values)]])) > 1
    keep = shared[np.cumsum(new) - 1]  # a shingle of one set is in no intersection
    column_of, owners = (np.cumsum(shared) - 1)[np.cumsum(new)[keep] - 1], owners[keep]
    both = np.zeros((len(minor), m))
    step = max(1, (1 << 22) // m)
    for first in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(column_of, [first, first + step])
        present = np.zeros((m, min(step, int(shared.sum()) - first)), np.float32)
        present[owners[a:b], column_of[a:b] - first] = 1
        both += present[minor] @ present.T
    both = np.rint(both).astype(np.int64)
    linked = 100 * both >= percent * (sizes[minor, None] + sizes[None, :] - both)
    linked &= label[minor, None] != label[None, :]
    root, found = list(range(len(names))), []

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = top(int(label[minor[i]])), top(int(label[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((int(minor[i]), int(j)))
    return found


def _compare(width: int, percent: int):
    """Rows sorted by ``node, block``: the links of each block. Memory holds one block."""

    def run(batches):
        words = Words()
        key, reps, labels, sets = None, [], [], []

        def links():
            if len(sets) < 2:
                return []
            return [(reps[i], reps[j]) for i, j in forest(sets, labels, percent)]

        def frame(found):
            a, b = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            found = []
            for piece in pieces(batch, "text"):
                hashes, at = shingles(*words(column(piece, "text")), width)
                names = ("node", "block", "rep", "label")
                for i, row in enumerate(zip(*(column(piece, n).to_pylist() for n in names))):
                    if row[:2] != key:
                        found += links()
                        key, reps, labels, sets = row[:2], [], [], []
                    reps.append(row[2])
                    labels.append(row[3])
                    sets.append(np.unique(hashes[at[i] : at[i + 1]]))
            if found:
                yield frame(found)
        if found := links():
            yield frame(found)

    return run


def _links(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    return (
        rows.join(texts, "rep")
        .select("node", "block", "rep", "label", "text")
        .repartition("node", "block")
        .sortWithinPartitions("node", "block", "rep")
        .mapInArrow(_compare(width, percent), "a long, b long")
    )


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 80,
    seed: int = 11,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Words are runs of bytes other than ASCII white space, A-Z as a-z; a set is the distinct
    ``width``-word shingles of the whole text, or the whole sequence if it is shorter. Two
    documents are linked when ``100 * intersection >= percent * union``; each link found is
    confirmed on full sets. ``component_id`` is the smallest id reachable, ``kept`` marks it.

    A null or empty text, or one of white space, has no shingles and is linked with nothing. A
    null id has null ``component_id`` and is kept. Rows that repeat an id are each returned; they are one
    document with the links of all its texts. Other columns are ignored, whatever their names. No rows give
    no rows.
    """
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    repeated = texts.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return _by_id(texts, width, percent, seed)
    # An id may have several texts: each text is a document of its own first, and those of one id are one.
    texts = texts.withColumn("own", F.xxhash64("doc_id", "text"))
    named = texts.where("doc_id IS NOT NULL").select("doc_id", "own")
    found = _by_id(texts.where("doc_id IS NOT NULL").select(F.col("own").alias("doc_id"), "text"), width, percent, seed)
    found, found_path = written(found.dropDuplicates(["doc_id"]), "texts_of_ids")
    rows, rows_path = written(
        named.join(
            found.select(F.col("doc_id").alias("own"), "n_shingles", F.col("component_id").alias("part")), "own"
        ).select("doc_id", "n_shingles", "part"),
        "rows_of_ids",
    )
    least = rows.groupBy("doc_id").agg(F.min("part").alias("least"))
    parts = components(rows.join(least, "doc_id").select(F.col("least").alias("a"), F.col("part").alias("b")))
    whole = rows.join(parts.withColumnRenamed("id", "part").withColumnRenamed("component_id", "whole"), "part")
    first = whole.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    joined = whole.join(first, "whole").select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )
    result, _ = written(
        joined.union(_by_id(texts.where("doc_id IS NULL").drop("own"), width, percent, seed)), "of_ids"
    )
    forget(result.sparkSession, found_path, rows_path)
    return result


def _by_id(texts: DataFrame, width: int, percent: int, seed: int) -> DataFrame:
    """``near_duplicates`` of texts whose ids, where not null, are unique."""
    spark = texts.sparkSession
    threshold = percent / 100
    signed, signed_path = written(
        texts.mapInArrow(_sign(width, threshold, seed), _SIGNED), "signed"
    )
    sets = ["n_shingles", "set_a", "set_b"]
    with_set = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = with_set.groupBy(*sets).agg(F.min("doc_id").alias("rep"))
    tokens = with_set.select(F.col("doc_id").alias("rep"), *sets, "tokens", *_NODES).join(
        classes, [*sets, "rep"], "left_semi"
    )
    tokens, token_path = written(
        tokens.select("rep", "n_shingles", "tokens", *_NODES), "tokens"
    )
    labels, paths = _tree_labels(spark, tokens, texts, width, percent, seed)
    of_class = classes.join(labels, "rep", "left").select(
        *sets, F.coalesce("label", "rep").alias("class_component")
    )
    of_class, _ = written(of_class, "classes")
    forget(spark, token_path, *paths)
    return (
        signed.select("doc_id", *sets)
        .join(of_class, sets, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id")).alias(
                "component_id"
            ),
            F.expr("coalesce(doc_id = coalesce(class_component, doc_id), true)").alias("kept"),
        )
    )


def _tree_labels(spark, tokens, texts, width, percent, seed):
    """``rep, label`` of all linked representatives, and the paths of the tables in use."""
    texts = texts.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").alias("rep"), "text"
    )
    met = tokens.select("rep", F.explode(F.concat(*_NODES)).alias("node"))
    nodes = met.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    met = met.join(nodes, "node", "left_semi").select("rep").distinct()
    texts, text_path = written(texts.join(met, "rep", "left_semi").dropDuplicates(["rep"]), "texts")
    tokens, token_path = written(tokens.join(texts.select("rep"), "rep", "left_semi"), "met")
    labels, label_path = written(spark.createDataFrame([], "rep long, label long"), "labels")
    for nodes in _NODES:
        rows = tokens.select("rep", "n_shingles", F.explode(nodes).alias("node"))
        for depth in range(FIRST_DEPTH, LAST_DEPTH + 1):
            rows, row_path = written(_open(rows, labels), "open")
            found, found_path = written(
                _links(_dealt(rows, depth), texts, width, percent), "found"
            )
            if not found.isEmpty():
                known = labels.select(F.col("rep").alias("a"), F.col("label").alias("b"))
                better, better_path = written(
                    components(known.union(found)).select(
                        F.col("id").alias("rep"), F.col("component_id").alias("label")
                    ),
                    "labels",
                )
                forget(spark, label_path)
                labels, label_path = better, better_path
            forget(spark, found_path)
            large = rows.where("NOT whole")
            if large.isEmpty():
                break
            rows = (
                large.select("node", "rep", "n_shingles")
                .join(tokens.select("rep", "tokens"), "rep")
                .select("node", "rep", "n_shingles", "tokens")
                .mapInArrow(_branch(percent / 100, seed), "node long, rep long, n_shingles long")
            )
    return labels, [text_path, token_path, label_path]


def _dealt(rows: DataFrame, depth: int) -> DataFrame:
    """Rows with the block that compares them.

    In a node compared whole, documents of the commonest label get one block and all others every
    block. Else the block is random, and at the last depth every pair of blocks is one.
    """
    own = F.pmod(F.xxhash64("rep", F.lit(depth)), "blocks").cast("int")
    dealt = rows.select("node", "rep", "label", "blocks", "whole", "major", own.alias("own"))
    every = "sequence(0, blocks - 1)"
    pairs = f"transform({every}, other -> least(own, other) * blocks + greatest(own, other))"
    apart = pairs if depth == LAST_DEPTH else "array(own)"
    blocks = f"IF(whole, IF(blocks > 1 AND label <> major, {every}, array(own)), {apart})"
    return dealt.select("node", "rep", "label", F.explode(F.expr(blocks)).alias("block"))


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, rep, n_shingles, label, blocks, whole, major`` of nodes with two components or more.

    Of nodes with equal members one stays. ``blocks`` is the number of parts of a node that one
    task can compare, ``major`` its commonest label. A node is compared ``whole`` when the
    documents of other labels fit into half a block, or all into one.
    """
    rows = rows.join(labels, "rep", "left").select(
        "node", "rep", "n_shingles", F.coalesce("label", "rep").alias("label")
    )
    scrambled = F.xxhash64("rep")
    per_label = rows.groupBy("node", "label").agg(
        F.count("*").alias("n"),
        F.sum("n_shingles").alias("mass"),
        F.sum(scrambled.bitwiseAND(F.lit(0xFFFFFFFF))).alias("x"),
        F.sum(F.shiftrightunsigned(scrambled, 32)).alias("y"),
    )
    share = F.greatest(F.col("size") / LEAF, F.col("mass") / LEAF_SHINGLES)
    others = F.greatest(
        (F.col("size") - F.col("most")) / LEAF, (F.col("mass") - F.col("most_mass")) / LEAF_SHINGLES
    )
    nodes = (
        per_label.groupBy("node")
        .agg(
            F.sum("n").alias("size"),
            F.sum("mass").alias("mass"),
            F.max("n").alias("most"),
            F.max_by("mass", "n").alias("most_mass"),
            F.max_by("label", "n").alias("major"),
            F.count("*").alias("labels"),
            F.sum("x").alias("x"),
            F.sum("y").alias("y"),
        )
        .where("labels > 1")
        .withColumn("share", share)
        .withColumn("others", others)
        .groupBy("size", "mass", "x", "y")
        .agg(F.min_by(F.struct("node", "share", "others", "major"), "node").alias("kept"))
        .select("kept.*")
        .withColumn("whole", (F.col("share") <= 1) | (F.col("others") <= 0.5))
    )
    # A block of a node compared whole also holds all documents of the other labels.
    room = F.when(F.col("whole") & (F.col("share") > 1), 1 - F.col("others")).otherwise(1.0)
    nodes = nodes.select(
        "node", "major", "whole", F.ceil(F.col("share") / room).cast("int").alias("blocks")
    )
    return rows.join(nodes, "node").select(
        "node", "rep", "n_shingles", "label", "blocks", "whole", "major"
    )
