"""Words of a text column as 64-bit hashes, computed with numpy over the column's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows on end, and the ``n + 1`` row offsets; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    blob = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return blob[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Splits texts into words and hashes each word.

    ``space``: a word is a run of bytes other than 0x20 and 0x09-0x0D. Otherwise a word is a
    run of ASCII letters, digits and non-ASCII bytes. A-Z count as a-z if ``fold``.
    """

    def __init__(self, space: bool = True, fold: bool = True):
        codes = np.arange(256)
        if space:
            self.inside = ~((codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D)))
        else:
            low = codes | 0x20
            self.inside = ((low >= 0x61) & (low <= 0x7A) & (codes < 0x80)) | (codes >= 0x80)
            self.inside |= (codes >= 0x30) & (codes <= 0x39)
        folded = np.where(fold & (codes >= 0x41) & (codes <= 0x5A), codes + 0x20, codes)
        self.value = mix((folded.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        self.base, self.inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.powers = np.cumprod(np.full(size, self.base, np.uint64), dtype=np.uint64)
        self.inverses = np.cumprod(np.full(size, self.inverse, np.uint64), dtype=np.uint64)

    def spans(self, blob: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of every word; no word spans two rows."""
        inside = self.inside[blob]
        fresh, last = inside.copy(), inside.copy()
        fresh[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(blob))]
        fresh[cuts] |= inside[cuts]
        last[cuts - 1] |= inside[cuts - 1]
        return np.flatnonzero(fresh), np.flatnonzero(last) + 1

    def hashes(self, blob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each word's bytes, taken piece by piece, so memory follows the words."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            first = starts[at]
            stop = max(at + 1, int(np.searchsorted(ends, first + _CHUNK, side="right")))
            piece = blob[first : ends[stop - 1]]
            if len(piece) > len(self.powers):
                self._grow(max(len(piece), 2 * len(self.powers)))
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(self.value[piece] * self.powers[: len(piece)], out=sums[1:])
            a, b = starts[at:stop] - first, ends[at:stop] - first
            out[at:stop] = mix((sums[b] - sums[a]) * self.inverses[a])
            at = stop
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words on end, and the ``n + 1`` offsets of the rows in them."""
        blob, offsets = text_bytes(texts)
        starts, ends = self.spans(blob, offsets)
        return self.hashes(blob, starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, on end, with row offsets.

    A row with fewer words has its whole sequence as one shingle; without words it has none.
    """
    counts = np.diff(offsets)
    n = len(hashes)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        rolled += hashes[j : n - width + 1 + j] * np.uint64((2 * j + 3) * 0x9E3779B97F4A7C15 % (1 << 64))
    rolled = mix(rolled)
    full = np.maximum(counts - width + 1, 0)
    sizes = np.where((counts > 0) & (full == 0), 1, full)
    ends = np.cumsum(sizes)
    at = np.concatenate([[0], ends])
    where = np.repeat(offsets[:-1] - at[:-1], sizes) + np.arange(at[-1])
    out = np.zeros(at[-1], np.uint64)
    ok = np.repeat(full > 0, sizes)
    out[ok] = rolled[where[ok]]
    short = np.flatnonzero((counts > 0) & (full == 0))
    total = mix(counts[short].astype(np.uint64))
    for j in range(width - 1):
        some = counts[short] > j
        total[some] = mix(total[some] * np.uint64(5) + hashes[offsets[:-1][short[some]] + j])
    out[at[short]] = total
    return out, at
