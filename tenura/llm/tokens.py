"""Words of a text column as the words themselves, split with numpy over the column's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tenura.llm.words import text_bytes

_CODES = np.arange(256)
#: Bytes of words split at white space, and of words of letters, digits and non-ASCII characters.
SPACED = ~((_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D)))
ALPHANUMERIC = (
    ((_CODES >= 0x30) & (_CODES <= 0x39))
    | ((_CODES | 0x20 >= 0x61) & (_CODES | 0x20 <= 0x7A) & (_CODES < 0x80))
    | (_CODES >= 0x80)
)
_FOLDED = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 0x20, _CODES).astype(np.uint8)


def split_words(texts: pa.Array, inside: np.ndarray, fold: bool) -> tuple[pa.Array, np.ndarray]:
    """All words on end as a string array, and the ``n + 1`` offsets of the rows in them.

    A word is a run of bytes that are ``inside``; no word spans two rows; null is an empty text. A-Z
    count as a-z if ``fold``.
    """
    blob, offsets = text_bytes(texts)
    within = inside[blob]
    fresh = within.copy()
    fresh[1:] &= ~within[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(blob))]
    fresh[cuts] |= within[cuts]
    data = blob[within]
    if fold:
        data = _FOLDED[data]
    starts = np.flatnonzero(fresh[within])
    ends = np.append(starts, len(data)).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), buffers)
    return words, np.searchsorted(np.flatnonzero(fresh), offsets)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every stretch, on end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)
