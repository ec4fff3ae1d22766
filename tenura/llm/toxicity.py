"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of ``WIDTH`` words. A word enters as its own learned vector
(one shared vector for words outside the vocabulary of the fit) and the means of the learned
vectors of its character grams, borders of the word included. Two gated recurrent layers read the window forwards and
backwards, attention pools their states, and a linear layer gives the window's logit. The
document's logit combines its worst window with how many windows are bad, calibrated on the rows
the network was fitted on.

Fitting runs in numpy on the driver over a bounded sample of labelled rows; scoring runs in Spark
over all windows of all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import column, pieces
from tenura.llm.words import Words, mix, text_bytes

#: Labelled documents of each class that the fit sees at most, those of smallest hash.
FIT_ROWS = 3000
#: Characters of the longest text to fit on.
FIT_CHARS = 200_000
WIDTH, STRIDE = 24, 16
HIDDEN, WORD_SIZE, CHAR_SIZE, ATTENTION = 12, 8, 8, 8
#: Length of the character grams of a word with its two borders, and the rows of their tables.
GRAMS = {"char": (3, 1 << 12), "stem": (5, 1 << 14)}
_LEAST_ROWS = 4  # documents a word of the vocabulary occurs in


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward pass and gradients; ``float32`` throughout."""

    def __init__(self, vocabulary: np.ndarray, hints: np.ndarray, seed: int = 5):
        draw = np.random.RandomState(seed)

        def some(*shape, scale=0.3):
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary = vocabulary  # sorted hashes; row 0 of ``word`` is any other word
        word = some(len(vocabulary) + 1, WORD_SIZE, scale=0.05)
        word[0] = 0
        word[1:, 0] = hints
        size = WORD_SIZE + CHAR_SIZE
        self.p = {
            "word": word,
            "char": some(GRAMS["char"][1], CHAR_SIZE, scale=0.05),
            "stem": np.zeros((GRAMS["stem"][1], CHAR_SIZE), np.float32),
            "in_f": some(size, 3 * HIDDEN),
            "in_b": some(size, 3 * HIDDEN),
            "bias_f": np.zeros(3 * HIDDEN, np.float32),
            "bias_b": np.zeros(3 * HIDDEN, np.float32),
            "rec_f": some(HIDDEN, 3 * HIDDEN),
            "rec_b": some(HIDDEN, 3 * HIDDEN),
            "att": some(2 * HIDDEN, ATTENTION),
            "query": some(ATTENTION),
            "out": some(2 * HIDDEN),
            "shift": np.zeros(1, np.float32),
        }
        self.calibration = np.zeros(4)

    def inputs(self, words: "WordTable") -> np.ndarray:
        """The input vector of every distinct word."""
        p = self.p
        chars = np.zeros((len(words.ids), CHAR_SIZE), np.float32)
        for name, (offsets, grams) in words.grams.items():
            sizes = np.diff(offsets)
            filled = np.flatnonzero(sizes)
            if len(filled):
                sums = np.add.reduceat(p[name][grams], offsets[:-1][filled], axis=0)
                chars[filled] += sums / sizes[filled, None].astype(np.float32)
        return np.concatenate([p["word"][words.ids], chars], axis=1)

    def _read(self, gates: np.ndarray, where: np.ndarray, mask, name: str, keep: bool):
        """States of one direction, a step at a time; ``gates`` holds each word's input part."""
        rec = self.p["rec_" + name]
        steps = range(WIDTH) if name == "f" else range(WIDTH - 1, -1, -1)
        state = np.zeros((where.shape[0], HIDDEN), np.float32)
        states = np.empty((WIDTH, where.shape[0], HIDDEN), np.float32)
        tape = []
        for t in steps:
            x = gates[where[:, t]]
            h = state @ rec
            zr = _sigmoid(x[:, : 2 * HIDDEN] + h[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            hn = h[:, 2 * HIDDEN :]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * hn)
            new = n + z * (state - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, state)
            if keep:
                tape.append((t, state, z, r, hn, n))
            state = new
            states[t] = state
        return states, tape

    def forward(self, inputs: np.ndarray, where: np.ndarray, mask=None, keep: bool = False):
        """Logit of every window; ``where`` holds the word of each place, ``mask`` the true ones."""
        p = self.p
        f, tape_f = self._read(inputs @ p["in_f"] + p["bias_f"], where, mask, "f", keep)
        b, tape_b = self._read(inputs @ p["in_b"] + p["bias_b"], where, mask, "b", keep)
        both = np.concatenate([f, b], axis=2)
        seen = np.tanh(both @ p["att"])
        score = seen @ p["query"]
        if mask is not None:
            score = np.where(mask.T, score, np.float32(-1e9))
        score = np.exp(score - score.max(axis=0))
        weight = score / score.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, both)
        logit = pooled @ p["out"] + p["shift"][0]
        return (logit, (both, seen, weight, pooled, tape_f, tape_b)) if keep else logit

    def gradients(self, words: "WordTable", where: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """Gradients of the mean log loss over the windows."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        inputs = self.inputs(words)
        logit, (both, seen, weight, pooled, tape_f, tape_b) = self.forward(inputs, where, mask, True)
        d_logit = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["out"], g["shift"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["out"]
        d_both = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnh,nh->tn", both, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_seen = d_score[:, :, None] * p["query"] * (1 - seen * seen)
        g["query"] = np.einsum("tna,tn->a", seen, d_score)
        g["att"] = np.einsum("tnh,tna->ha", both, d_seen)
        d_both = d_both + d_seen @ p["att"].T
        d_inputs = np.zeros_like(inputs)
        for name, tape, part in (("f", tape_f, slice(0, HIDDEN)), ("b", tape_b, slice(HIDDEN, None))):
            rec, d_state = p["rec_" + name], np.zeros((len(y), HIDDEN), np.float32)
            d_gates = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            for t, state, z, r, hn, n in reversed(tape):
                d_new = d_state + d_both[t][:, part]
                live = mask[:, t, None]
                d_state = np.where(live, d_new * z, d_new)
                d_new = np.where(live, d_new, 0)
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (state - n) * z * (1 - z)
                d_r = d_n * hn * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_n], axis=1)
                d_h = np.concatenate([d_z, d_r, d_n * r], axis=1)
                np.add.at(d_gates, where[:, t], d_x)
                g["rec_" + name] += state.T @ d_h
                d_state = d_state + d_h @ rec.T
            g["in_" + name] = inputs.T @ d_gates
            g["bias_" + name] = d_gates.sum(axis=0)
            d_inputs += d_gates @ p["in_" + name].T
        np.add.at(g["word"], words.ids, d_inputs[:, :WORD_SIZE])
        g["word"][0] = 0
        for name, (offsets, grams) in words.grams.items():
            sizes = np.diff(offsets)
            share = d_inputs[:, WORD_SIZE:] / np.maximum(sizes, 1)[:, None]
            np.add.at(g[name], grams, np.repeat(share, sizes, axis=0).astype(np.float32))
        return g

    def probability(self, summary: np.ndarray) -> np.ndarray:
        """Probability of documents given ``summaries``."""
        inputs = np.concatenate([summary, np.ones((len(summary), 1))], axis=1)
        return 1 / (1 + np.exp(-np.clip(inputs @ self.calibration, -30, 30)))


class WordTable:
    """The distinct words of a batch of texts: vocabulary row and trigrams; words per text."""

    def __init__(self, texts: pa.Array, reader: Words, vocabulary: np.ndarray):
        blob, offsets = text_bytes(texts)
        starts, ends = reader.spans(blob, offsets)
        self.hashes = reader.hashes(blob, starts, ends)
        self.at = np.searchsorted(starts, offsets)
        distinct, first, which = np.unique(self.hashes, return_index=True, return_inverse=True)
        self.which = which.reshape(-1)
        place = np.minimum(np.searchsorted(vocabulary, distinct), max(len(vocabulary) - 1, 0))
        known = vocabulary[place] == distinct if len(vocabulary) else np.zeros(len(distinct), bool)
        self.ids = np.where(known, place + 1, 0)
        a, b = starts[first], ends[first]
        sizes = b - a + 2
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(a - 1 - edges[:-1], sizes) + np.arange(edges[-1])
        border = np.zeros(edges[-1], bool)
        border[edges[:-1]] = True
        border[edges[1:] - 1] = True
        value = reader.value[blob[np.where(border, 0, at)]] if len(blob) else np.zeros(0, np.uint64)
        value = np.where(border, np.uint64(0x5851F42D4C957F2D), value)
        self.grams = {}
        for name, (length, rows) in GRAMS.items():
            count = np.maximum(sizes - length + 1, 0)
            offsets = np.concatenate([[0], np.cumsum(count)])
            at = np.repeat(edges[:-1] - offsets[:-1], count) + np.arange(offsets[-1])
            mixed = np.zeros(len(at), np.uint64)
            for j in range(length):
                mixed += value[at + j] * np.uint64(2 * j + 1)
            ids = (mix(mixed) >> np.uint64(40)).astype(np.int64) & (rows - 1)
            self.grams[name] = (offsets, ids)

    def windows(self, row_windows=None):
        """Text, word of each place and mask of all overlapping windows that cover the texts.

        The last window of a text ends with it; a text shorter than a window has one, masked.
        """
        counts = np.diff(self.at)
        n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WIDTH) // STRIDE)), 0)
        text = np.repeat(np.arange(len(counts)), n)
        ends = np.cumsum(n)
        number = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        first = np.minimum(number * STRIDE, np.maximum(counts[text] - WIDTH, 0))
        place = first[:, None] + np.arange(WIDTH)
        mask = place < counts[text][:, None]
        where = self.which[self.at[text][:, None] + np.where(mask, place, 0)] if len(text) else place
        return text, where, mask


def _summaries(n: int, text: np.ndarray, logits: np.ndarray) -> np.ndarray:
    """Per text: its largest window logit, the log of its number of bad windows, of its windows."""
    worst, bad = np.full(n, -12.0), np.zeros(n)
    logits = np.clip(logits.astype(np.float64), -12, 12)
    np.maximum.at(worst, text, logits)
    np.add.at(bad, text, _sigmoid(logits))
    return np.stack([worst, np.log(bad + 0.05), np.log1p(np.bincount(text, minlength=n))], axis=1)


def summaries(network: Network, texts: pa.Array, reader: Words) -> np.ndarray:
    """What the windows of every text say; a text without words has no bad window."""
    words = WordTable(texts, reader, network.vocabulary)
    inputs = network.inputs(words)
    text, where, mask = words.windows()
    logits = np.zeros(len(text), np.float32)
    whole = mask.all(axis=1) if len(text) else np.zeros(0, bool)
    for rows, masked in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
        for at in range(0, len(rows), 8192):
            some = rows[at : at + 8192]
            logits[some] = network.forward(inputs, where[some], mask[some] if masked else None)
    return _summaries(len(texts), text, logits)


def _vocabulary(words: WordTable, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of enough documents and a first value for each: how much likelier it makes label 1."""
    row = np.repeat(np.arange(len(y)), np.diff(words.at))
    pairs = np.unique(np.stack([words.which, row], axis=1), axis=0)
    total = np.bincount(pairs[:, 0], minlength=len(words.ids))
    toxic = np.bincount(pairs[:, 0], y[pairs[:, 1]], len(words.ids))
    distinct = np.empty(len(words.ids), np.uint64)
    distinct[words.which] = words.hashes
    use = np.flatnonzero(total >= _LEAST_ROWS)
    ones, zeros = y.sum(), len(y) - y.sum()
    hint = np.log((toxic[use] + 0.5) / (ones + 1)) - np.log((total[use] - toxic[use] + 0.5) / (zeros + 1))
    hint = np.clip(hint, -2, 4) * (np.abs(hint) > 1)
    order = np.argsort(distinct[use])
    return distinct[use][order], hint[order].astype(np.float32)


def fit(texts: list[str | None], y: np.ndarray, rounds: int = 3, epochs: int = 4) -> Network:
    """Fit on whole documents: rounds that choose windows, epochs of Adam on those chosen.

    Of a document labelled 1 the two windows with the largest logit stand for it (at first those
    with the largest first values of words), of one labelled 0 its two worst windows and two
    others, so the network learns from what it gets wrong.
    """
    reader, texts = Words(space=False), pa.array(texts, pa.string())
    y = np.asarray(y, np.float32)
    words = WordTable(texts, reader, np.zeros(0, np.uint64))
    vocabulary, hints = _vocabulary(words, y)
    network = Network(vocabulary, hints)
    words = WordTable(texts, reader, vocabulary)
    text, where, mask = words.windows()
    if not len(text) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        network.calibration[-1] = np.log(rate / (1 - rate))
        return network
    draw = np.random.RandomState(11)
    hint_of = np.concatenate([np.zeros(1, np.float32), hints])[words.ids]
    value = np.where(mask, hint_of[where], 0).max(axis=1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    for _ in range(rounds):
        order = np.lexsort((draw.random_sample(len(text)), -value, text))
        rank = np.arange(len(text)) - np.searchsorted(text[order], text[order])
        best = order[rank < 2]
        others = order[(rank >= 2) & (draw.random_sample(len(order)) < 0.08)]
        chosen = np.concatenate([best, others[y[text[others]] == 0]])
        for _ in range(epochs):
            draw.shuffle(chosen)
            for at in range(0, len(chosen), 256):
                some = chosen[at : at + 256]
                part = _Part(words, where[some])
                g = network.gradients(part, part.where, mask[some], y[text[some]])
                step += 1
                for k, d in g.items():
                    m, v = moments[k]
                    m += 0.1 * (d - m)
                    v += 0.01 * (d * d - v)
                    m_hat, v_hat = m / (1 - 0.9**step), v / (1 - 0.99**step)
                    network.p[k] -= 0.01 * m_hat / (np.sqrt(v_hat) + 1e-6)
        inputs = network.inputs(words)
        value = np.concatenate(
            [network.forward(inputs, where[i : i + 8192], mask[i : i + 8192]) for i in range(0, len(text), 8192)]
        )
    _calibrate(network, _summaries(len(y), text, value), y)
    return network


class _Part:
    """The words of some windows only."""

    def __init__(self, words: WordTable, where: np.ndarray):
        used, inner = np.unique(where, return_inverse=True)
        self.where = inner.reshape(where.shape)
        self.ids = words.ids[used]
        self.grams = {}
        for name, (offsets, grams) in words.grams.items():
            sizes = np.diff(offsets)[used]
            own = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(offsets[:-1][used] - own[:-1], sizes) + np.arange(own[-1])
            self.grams[name] = (own, grams[at])


def _calibrate(network: Network, summary: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression on what the windows of a document say."""
    z = np.concatenate([summary, np.ones((len(y), 1))], axis=1)
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)) * 0.1
        w += np.linalg.solve(curve, z.T @ (y - p) - 0.1 * w)
    network.calibration = w


def held_out(id_column) -> F.col:
    """Rows that no fit may see: the checksum of the id's digits is a multiple of five."""
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    fit_chars: int = FIT_CHARS,
) -> Network:
    """Fit on at most ``FIT_ROWS`` labelled documents of each class that are not held out.

    They are drawn by a hash of their ids among the labelled documents of at most ``fit_chars`` characters,
    whose texts the driver holds.
    """
    usable = labels.where(F.col(id_column).isNotNull() & ~held_out(id_column)).select(
        F.col(id_column).alias("labelled"), F.col(label_column).cast("int").alias("y")
    )
    size = F.coalesce(F.length(F.col(text_column)), F.lit(0))
    short = documents.where(size <= fit_chars).select(F.col(id_column).alias("labelled")).distinct()
    usable = usable.join(short, "labelled")
    chosen = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("labelled"), "labelled").limit(FIT_ROWS)
        chosen = part if chosen is None else chosen.union(part)
    rows = (
        documents.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen), F.col("doc") == F.col("labelled"))
        .where(F.coalesce(F.length("text"), F.lit(0)) <= fit_chars)
        .select("doc", "text", "y")
        .toArrow()
        .sort_by([("doc", "ascending"), ("y", "ascending"), ("text", "ascending")])
    )
    if not rows.num_rows:
        return fit([None], np.zeros(1))
    return fit(rows["text"].to_pylist(), rows["y"].to_numpy())


def _score(network: Network):
    def run(batches):
        reader = Words(space=False)
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                score = network.probability(summaries(network, column(piece, "text"), reader))
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return run


def score_toxicity(
    documents: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, score, predicted`` for every row; the text alone decides the score.

    Null and empty texts, and texts without letters or digits, have no window and score as the
    least toxic; rows that repeat are each returned; null ids stay null. Other columns are
    ignored. No rows give no rows.
    """
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return rows.mapInArrow(_score(network), "doc_id long, score double, predicted int")
