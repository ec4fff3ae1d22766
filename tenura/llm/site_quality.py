"""Quality by hierarchical empirical Bayes: document evidence and posteriors of host and path.

A logistic model on statistics of the whole text gives every document a probability. Grouped sums
of these give each path and host a Beta posterior: a path's mean is shrunk towards its host's, a
host's towards the global one, by as many pseudo documents as the spread of the means between
sites justifies (method of moments). A document's log odds are then moved by how far its path's
log odds lie from the global ones, so sparse sites stay at the global prior.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import column, numbered, pieces, written
from tenura.llm.words import Words, mix, text_bytes

#: Labelled documents that the document model is fitted on at most, those of smallest hash.
FIT_ROWS = 20_000
#: Bounds of the pseudo documents of a prior.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1e6
FEATURES = 10


def features(texts: pa.Array, words: Words) -> np.ndarray:
    """Statistics of each whole text; an empty or null text has zeros throughout."""
    blob, offsets = text_bytes(texts)
    hashes, at = words(texts)
    n, size = np.diff(offsets), np.diff(at)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(total[offsets]).astype(np.float64)

    upper = count((blob >= 65) & (blob <= 90))
    lower = count(((blob >= 97) & (blob <= 122)) | (blob >= 128))
    digit = count((blob >= 48) & (blob <= 57))
    space = count((blob == 32) | ((blob >= 9) & (blob <= 13)))
    row = np.repeat(np.arange(len(size)), size)
    distinct = np.unique(hashes ^ mix(row.astype(np.uint64)), return_index=True)[1]
    distinct = np.bincount(row[distinct], minlength=len(size))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    again = np.bincount(row[again], minlength=len(size))
    characters, tokens = np.maximum(n, 1), np.maximum(size, 1)
    return np.stack(
        [
            upper / np.maximum(upper + lower, 1),
            (n - upper - lower - digit - space) / characters,
            digit / characters,
            count(blob == 10) / tokens,
            np.log1p(size),
            distinct / tokens**0.9,
            again / tokens,
            (n - space) / tokens,
            count(blob == 124) / tokens,
            count(blob == 33) / tokens,
        ],
        axis=1,
    )


class DocumentModel:
    """Standardised logistic regression with a ridge; without both classes a constant."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.centre, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        good = float((y == 1).sum())
        self.weights[-1] = np.log((good + 1) / (len(y) - good + 1))
        if 0 < good < len(y):
            self.centre, self.scale = x.mean(0), x.std(0) + 1e-9
            z = self._inputs(x)
            for _ in range(25):
                p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
                penalty = np.full(FEATURES + 1, ridge)
                penalty[-1] = 1e-6
                curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
                self.weights += np.linalg.solve(curve, z.T @ (y - p) - penalty * self.weights)

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._inputs(x) @ self.weights, -12, 12)))


def _feature_rows(batches):
    words = Words()
    for batch in batches:
        for piece in pieces(batch, "text"):
            x = features(column(piece, "text"), words)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES)
            yield pa.RecordBatch.from_arrays(
                [column(piece, "y"), pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1)))],
                names=["y", "x"],
            )


def fit_document_model(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DocumentModel:
    """Fit on at most ``FIT_ROWS`` labelled documents. Labels other than 0 and 1 are left out."""
    chosen = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
        .select(F.col(id_column).alias("labelled"), F.col(label_column).cast("int").alias("y"))
        .orderBy(F.xxhash64("labelled"), "labelled", "y")
        .limit(FIT_ROWS)
    )
    rows = (
        documents.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen), F.col("doc") == F.col("labelled"))
        .select("y", "text")
        .mapInArrow(_feature_rows, "y int, x array<double>")
        .toArrow()
    )
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    y = rows["y"].to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # the fit does not depend on the order of rows
    return DocumentModel(x[order], y[order])


def _score(model: DocumentModel):
    def run(batches):
        words = Words()
        for batch in batches:
            for piece in pieces(batch, "_q_text"):
                p = model.probability(features(column(piece, "_q_text"), words))
                kept = [i for i, n in enumerate(piece.schema.names) if n != "_q_text"]
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(i) for i in kept], pa.array(p)],
                    names=[*[piece.schema.names[i] for i in kept], "_q_document"],
                )

    return run


def _scored(rows: DataFrame, model: DocumentModel) -> DataFrame:
    kept = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_q_text"
    )
    return rows.mapInArrow(_score(model), f"{kept}, _q_document double")


def _prior(sites: DataFrame, mean: str) -> float:
    """Pseudo documents of the prior above ``sites`` (``n``, ``s``), by the method of moments."""
    own = F.col("s") / F.col("n")
    spread = sites.agg(
        F.sum(F.col("n") * F.pow(own - F.col(mean), 2)).alias("between"),
        F.sum(F.col(mean) * (1 - F.col(mean))).alias("noise"),
        F.sum(F.col("n") * F.col(mean) * (1 - F.col(mean))).alias("scale"),
        F.sum("n").alias("n"),
    ).first()
    if not spread["n"]:
        return LEAST_PRIOR
    variance = (spread["between"] - spread["noise"]) / spread["n"]
    if variance <= 0:
        return MOST_PRIOR
    return min(MOST_PRIOR, max(LEAST_PRIOR, spread["scale"] / spread["n"] / variance - 1))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """``host, path, p_global, p_host, p_path`` from ``host, path, p`` per document.

    Sums per path come first, with partial aggregation; all that follows has a row per path.
    """
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"))
    paths, _ = written(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(((F.sum("s") + 1) / (F.sum("n") + 2)).alias("p")).first()["p"]
    total = 0.5 if total is None else float(total)
    hosts = hosts.withColumn("p_global", F.lit(total))
    strength = _prior(hosts, "p_global")
    hosts = hosts.withColumn(
        "p_host", (F.col("s") + strength * F.col("p_global")) / (F.col("n") + strength)
    ).select(F.col("host").alias("of_host"), "p_global", "p_host")
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
    strength = _prior(paths, "p_host")
    return paths.select(
        "host",
        "path",
        "p_global",
        "p_host",
        ((F.col("s") + strength * F.col("p_host")) / (F.col("n") + strength)).alias("p_path"),
    )


def _rated(documents, labels, id_column, text_column, host_column, path_column, label_column):
    """The rows with ``_q_document, _q_p_host, _q_p_path, _q_quality``, and the names of their own columns."""
    model = fit_document_model(documents, labels, id_column, text_column, label_column)
    rows, names = numbered(documents)
    host, path, text = (F.col(names[c]) for c in (host_column, path_column, text_column))
    scored = _scored(
        rows.select(host.alias("host"), path.alias("path"), text.alias("_q_text")), model
    )
    sites = site_posteriors(scored.withColumnRenamed("_q_document", "p")).select(
        F.col("host").alias("_q_host"),
        F.col("path").alias("_q_path"),
        F.col("p_global").alias("_q_global"),
        F.col("p_host").alias("_q_p_host"),
        F.col("p_path").alias("_q_p_path"),
    )
    same = host.eqNullSafe(F.col("_q_host")) & path.eqNullSafe(F.col("_q_path"))
    rows = rows.withColumn("_q_text", text)

    def odds(name: str):
        return F.ln(F.col(name)) - F.ln(1 - F.col(name))

    moved = odds("_q_document") + odds("_q_p_path") - odds("_q_global")
    rated = _scored(rows, model).join(sites, same, "left")
    return rated.withColumn("_q_quality", 1 / (1 + F.exp(-moved))), names


def site_quality(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_column: str = "lang",
    label_column: str = "quality",
    threshold: float = 0.5,
) -> DataFrame:
    """All rows and columns of ``documents`` with ``p_document, p_host, p_path, quality, keep``.

    ``quality`` is the probability that a document is good, given its text and its site; ``keep``
    is ``quality >= threshold``. Null hosts and paths are sites of their own. Null and empty texts
    have the evidence of no words. Rows that repeat are rated alike, each returned. Columns of the
    input named like the five new ones are replaced. Without labels of both classes the document
    model is the rate of good labels (one of each assumed), so without any all rows are kept. No
    rows give no rows.
    """
    new = ("p_document", "p_host", "p_path", "quality", "keep")
    names = (id_column, text_column, host_column, path_column, label_column)
    rated, own = _rated(documents, labels, *names)
    kept = [F.col(n).alias(c) for c, n in own.items() if c not in new]
    return rated.select(
        *kept,
        F.col("_q_document").alias("p_document"),
        F.col("_q_p_host").alias("p_host"),
        F.col("_q_p_path").alias("p_path"),
        F.col("_q_quality").alias("quality"),
        (F.col("_q_quality") >= threshold).alias("keep"),
    )


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    path_column: str = "lang",
    label_column: str = "quality",
    threshold: float = 0.5,
) -> DataFrame:
    """The rows of ``documents`` that ``site_quality`` keeps, with their own columns only."""
    names = (id_column, text_column, host_column, path_column, label_column)
    rated, own = _rated(documents, labels, *names)
    return rated.where(F.col("_q_quality") >= threshold).select(
        *[F.col(n).alias(c) for c, n in own.items()]
    )
