"""Token ids as binary files: frequency-ranked ids in byte-aligned codes.

Layout of a file, all numbers little-endian::

    8 bytes   b"RANKTOK1"
    4 x u64   number of documents, ids, distinct ids, data bytes
    u32 []    distinct ids, the most frequent first: a token is stored as its rank here
    i64 []    document ids;  u8 [] 1 where the id is null
    u32 []    ids per document, the end id included
    u8  []    control bytes, two bits per rank: its length less one, four ranks a byte
    u8  []    the ranks' bytes, one to four each
    1 byte    a line feed, which Spark's writer adds

The rank table counts every id of the file and travels with it, so a file is written in one pass,
can be written again alone when its task is lost, and is read without anything else.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.llm.frames import column, folders_of, pieces, read_files, write_files, written
from tenura.llm.tokens import ragged
from tenura.llm.words import Words, text_bytes
from tenura.sources.workspace import new_path

_MAGIC = b"RANKTOK1"
#: A file is closed when it holds this many ids; a task's memory follows this number.
FILE_IDS = 1 << 22


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = codes
    control = padded[0::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    ends = np.cumsum(codes.astype(np.int64) + 1)
    starts = ends - codes - 1
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    data[starts] = ranks.astype(np.uint8)
    for place in range(1, 4):
        some = np.flatnonzero(codes >= place)
        data[starts[some] + place] = (ranks[some] >> np.uint32(8 * place)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """The values; a table of the 256 control bytes gives the four lengths of each."""
    table = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)
    codes = table[control].reshape(-1)[:count]
    starts = np.concatenate([[0], np.cumsum(codes.astype(np.int64) + 1)])[:-1]
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    out = padded[starts].astype(np.uint32) if count else np.zeros(0, np.uint32)
    for place in range(1, 4):
        some = np.flatnonzero(codes >= place)
        out[some] |= padded[starts[some] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def encode_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The parts of a file."""
    if len(ids) and int(ids.max()) < 4 * len(ids) + (1 << 16):  # a table of all ids up to the largest
        inverse = ids
        counts = np.bincount(ids)
        values = np.flatnonzero(counts)
        counts = counts[values]
        places = values
    else:
        values, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        inverse, places = inverse.reshape(-1), np.arange(len(values))
    order = np.lexsort((values, -counts))
    rank_of = np.empty(int(places[-1]) + 1 if len(places) else 0, np.uint32)
    rank_of[places[order]] = np.arange(len(values), dtype=np.uint32)
    control, data = pack(rank_of[inverse])
    sizes = np.array([len(doc_ids), len(ids), len(values), len(data)], "<u8")
    return [
        _MAGIC,
        sizes.tobytes(),
        values[order].astype("<u4").tobytes(),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.asarray(lengths).astype("<u4").tobytes(),
        control,
        data,
    ]


def decode_file(blob: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids per document and all ids of a file."""
    if blob[:8] != _MAGIC:
        raise ValueError("not a token file")
    docs, count, distinct, size = (int(x) for x in np.frombuffer(blob, "<u8", 4, 8))
    at = 40

    def take(kind, n):
        nonlocal at
        out = np.frombuffer(blob, kind, n, at)
        at += out.nbytes
        return out

    table, doc_ids, nulls = take("<u4", distinct), take("<i8", docs), take("u1", docs)
    lengths, control, data = take("<u4", docs), take("u1", -(-count // 4)), take("u1", size)
    ids = table[unpack(control, data, count)] if count else np.zeros(0, "<u4")
    named = [None if n else int(d) for d, n in zip(doc_ids, nulls, strict=True)]
    return named, lengths, ids.astype("<u4")


class _Pieces:
    """Ids of distinct pieces by the pieces' hashes, in order of the hashes."""

    def __init__(self):
        self.known = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each of the sorted hashes stands or belongs, and whether it is there."""
        at = np.searchsorted(self.known, hashes)
        there = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        there[inside] = self.known[at[inside]] == hashes[inside]
        return at, there

    def add(self, at: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Merge new hashes, which belong at ``at``, with their ids on end."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.known = np.insert(self.known, at, hashes)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes in order, where each stands first, and the number of each hash among them."""
    coded = pa.array(hashes).dictionary_encode()
    which = coded.indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
    distinct = hashes[first]
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], first[order], rank[which]


class TextEncoder:
    """``tokenizers`` over whole texts, each distinct run of white space with its word once.

    No token of a byte-level vocabulary crosses from a character that is not white space to one
    that is, so the ids of a text are those of such pieces on end. Pieces are told apart by a
    64-bit hash. Texts with white space outside ASCII, or characters that engines disagree about,
    go to the library whole.
    """

    #: Distinct pieces held, about 50 bytes each. Half of them fill a generation; then the one before is
    #: dropped, and pieces of the last that come again move to the new one.
    HELD = 800_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Words(space=True, fold=False)
        self.odd = re.compile(
            "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u2064\u3000\ufeff]"
        ).search
        #: Bytes with which what ``odd`` looks for begins.
        self.rare = np.zeros(256, bool)
        self.rare[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
        #: Tokens that begin with a space, by id.
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(names.values(), default=0) + 1, bool)
        self.leads[[i for name, i in names.items() if name.startswith("\u0120")]] = True
        self._reset()

    def _reset(self) -> None:
        self.young, self.old = _Pieces(), _Pieces()

    def _encode(self, blob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces on end and their number per piece.

        Words after one space are put on end and encoded at once: each begins with the only token that
        begins with a space.
        """
        second = blob[np.minimum(starts + 1, len(blob) - 1)]
        plain = (blob[starts] == 0x20) & (ends - starts > 1) & self.words.inside[second]
        rare = np.flatnonzero(self.rare[blob])
        for i in np.flatnonzero(plain & (np.searchsorted(rare, starts) < np.searchsorted(rare, ends))):
            plain[i] = not self.odd(blob[starts[i] : ends[i]].tobytes().decode())
        sizes, parts, rest = np.zeros(len(starts), np.int64), [], [np.flatnonzero(~plain)]
        plain = np.flatnonzero(plain)
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            text = blob[ragged(starts[some], ends[some] - starts[some])].tobytes().decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            heads = np.flatnonzero(self.leads[ids])
            if len(heads) != len(some) or heads[0]:
                rest.append(some)
                continue
            sizes[some] = np.diff(heads, append=len(ids))
            parts.append((some, ids))
        rest = np.concatenate(rest)
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            texts = [blob[starts[i] : ends[i]].tobytes().decode() for i in some]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes[some] = [len(x) for x in found]
            parts.append((some, np.concatenate(found).astype(np.uint32)))
        begins = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        for some, ids in parts:
            out[ragged(begins[some], sizes[some])] = ids
        return out, sizes

    def _learn(self, at, hashes, blob, starts, ends) -> None:
        """Take pieces that the young generation lacks from the old one, or encode them."""
        place, there = self.old.find(hashes)
        found, lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not there.all():
            found, lengths = self._encode(blob, starts[~there], ends[~there])
        sizes = np.zeros(len(hashes), np.int64)
        sizes[there], sizes[~there] = self.old.sizes[place[there]], lengths
        begins = np.cumsum(sizes) - sizes
        ids = np.zeros(int(sizes.sum()), np.uint32)
        ids[ragged(begins[there], sizes[there])] = self.old.ids[ragged(self.old.starts[place[there]], sizes[there])]
        ids[ragged(begins[~there], lengths)] = found
        self.young.add(at, hashes, sizes, ids)

    def _segments(self, blob: np.ndarray, offsets: np.ndarray):
        space = ~self.words.inside[blob]
        first = space.copy()
        first[1:] &= ~space[:-1]
        rows = np.unique(offsets[:-1][np.diff(offsets) > 0])
        first[rows] = True
        starts = np.flatnonzero(first)
        return starts, np.append(starts[1:], len(blob))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end and their number per text; null is empty."""
        if len(self.young.known) > self.HELD // 2:
            self.old, self.young = self.young, _Pieces()
        blob, offsets = text_bytes(texts)
        starts, ends = self._segments(blob, offsets)
        hashes, first, which = _distinct(self.words.hashes(blob, starts, ends))
        at, there = self.young.find(hashes)
        rare = np.flatnonzero(self.rare[blob])
        rows = np.unique(np.searchsorted(offsets, rare, side="right") - 1)
        whole = {int(i): text for i in rows if self.odd(text := texts[int(i)].as_py())}
        if not there.all():
            new = first[~there]
            self._learn(at[~there], hashes[~there], blob, starts[new], ends[new])
            at = np.searchsorted(self.young.known, hashes)
        at = at[which]
        sizes, begins = self.young.sizes[at], self.young.starts[at]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.young.ids[np.repeat(begins - (stops - sizes), sizes) + np.arange(total)]
        edges = np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]
        if not whole:
            return ids, np.diff(edges)
        rows = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for i, text in whole.items():
            own = self.tokenizer.encode(text, add_special_tokens=False).ids
            rows[i] = np.array(own, np.uint32)
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)


def worker_encoder(path: str) -> TextEncoder:
    """The encoder of this Python worker, which keeps it from task to task."""
    import os
    import sys
    import types

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = sys.modules.setdefault("tenura_worker", types.ModuleType("tenura_worker")).__dict__
    if path not in held:
        held[path] = TextEncoder(path)
    return held[path]


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(lengths), end_id).astype(np.uint32)


def _write(vocabulary: str, end_id: int):
    def run(batches):
        encoder = worker_encoder(vocabulary)
        docs, lengths, ids, held = [], [], [], 0

        def close():
            nonlocal docs, lengths, ids, held
            blob = b"".join(encode_file(docs, np.concatenate(lengths), np.concatenate(ids)))
            docs, lengths, ids, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["content"])

        for batch in batches:
            for piece in pieces(batch, "text"):
                own, counts = encoder(column(piece, "text"))
                docs += column(piece, "doc_id").to_pylist()
                lengths.append(counts + 1)
                ids.append(_with_end(own, counts, end_id))
                held += len(ids[-1])
                if held >= FILE_IDS:
                    yield close()
        if docs:
            yield close()

    return run


_MANIFEST = "part int, number int, path string, documents long, ids long"


def _heads(batches):
    """The manifest's rows, from the files' first bytes."""
    for batch in batches:
        heads = [np.frombuffer(c.as_buffer(), "<u8", 2, 8) for c in column(batch, "content")]
        sizes = np.array(heads, np.int64).reshape(-1, 2)
        named = [column(batch, n) for n in ("part", "number", "path")]
        yield pa.RecordBatch.from_arrays(
            [*named, pa.array(sizes[:, 0]), pa.array(sizes[:, 1])],
            names=["part", "number", "path", "documents", "ids"],
        )


def write_token_files(
    documents: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Write all documents in ascending id order; the files as ``part, number, path, documents, ids``.

    The order of files is ``part, number``. Null and empty texts are a lone end id. A null id comes
    first and stays null; rows that repeat an id are all written. Other columns are ignored. An
    empty table writes no file.
    """
    spark = documents.sparkSession
    folder = folder or new_path(spark, "token-files")
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files = write_files(ordered.mapInArrow(_write(vocabulary, end_id), "content binary"), folder)
    return written(files.mapInArrow(_heads, _MANIFEST), "manifest")[0]


def _read(digest: bool):
    def run(batches):
        for batch in batches:
            for content, before in zip(column(batch, "content"), column(batch, "before").to_pylist()):
                doc_ids, lengths, ids = decode_file(content.as_py())
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                if digest:
                    last = pa.array(
                        [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()
                    )
                else:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    last = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts + before),
                        pa.array(lengths.astype(np.int64)),
                        last,
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``ids`` (or ``ids_crc32``) read back from the files.

    ``start`` counts the ids of all documents before; it comes from the running total over the
    list of files, which has one row per file.
    """
    in_order = Window.orderBy("part", "number")
    files = manifest.select("path", (F.sum("ids").over(in_order) - F.col("ids")).alias("before"))
    contents = read_files(manifest.sparkSession, folders_of(manifest)).select("path", "content")
    last = "ids_crc32 long" if digest else "ids array<long>"
    return contents.join(F.broadcast(files), "path").mapInArrow(
        _read(digest), f"doc_id long, start long, n_tokens long, {last}"
    )
