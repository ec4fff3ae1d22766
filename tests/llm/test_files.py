"""Token files and archives: round trips, brute force and odd rows."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenura.llm import token_files, warc
from tenura.llm.queries import vocabulary_path
from tenura.llm.token_files import TextEncoder, read_token_files, write_token_files
from tenura.llm.warc import read_archives, write_archives


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 1 << 24])))
@settings(max_examples=100, deadline=None)
def test_codes_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    back = token_files.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert np.array_equal(back, ranks)


def test_frequent_ids_take_one_byte():
    ids = np.array([50000] * 900 + [7] * 5 + list(range(1000, 1400)), np.uint32)
    parts = token_files.encode_file([1, None], np.array([900, 405]), ids)
    assert len(parts[-1]) == 900 + 5 + 254 + 2 * 146
    docs, lengths, back = token_files.decode_file(b"".join(parts))
    assert docs == [1, None] and lengths.tolist() == [900, 405] and np.array_equal(back, ids)


@given(st.lists(st.text(max_size=40) | st.none(), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_encode_like_whole_texts(texts):
    encoder, _ = _encoder()
    ids, counts = encoder(pa.array(texts, pa.string()))
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in whole]
    assert ids.tolist() == [i for w in whole for i in w]


_HELD = []


def _encoder():
    if not _HELD:
        _HELD.append((TextEncoder(vocabulary_path()), None))
    return _HELD[0]


def test_texts_with_every_kind_of_space():
    encoder, _ = _encoder()
    texts = [
        " a", "a ", "a  b", "a\n\n b\t\tc ", "\n", "x  y", "x  y", "a\x1cb c", "a\x85 b",
        "it's  IT'S 's", "<|endoftext|> a<|endoftext|>", "1 23 4.5!! ?a", "​ x", "é ́",
    ]
    ids, counts = encoder(pa.array(texts))
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in whole for i in w]


def test_token_files_against_the_library(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    texts = [(i, f"Some words {i} and more " * (i % 40)) for i in range(200, 0, -1)]
    texts += [(1000, None), (1001, ""), (None, "no id"), (7, "again"), (1002, "x " * 50_000)]
    df = spark.createDataFrame([(*r, "p") for r in texts], "doc_id long, text string, path string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    manifest = write_token_files(df.repartition(5), vocabulary_path())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert manifest.count() > 5
    got = {}
    for row in read_token_files(manifest, digest=True).collect():
        got.setdefault(row["doc_id"], []).append(tuple(row)[1:])
    at, rows = 0, sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        sizes.setdefault(doc_id, []).append((len(ids), crc))
        if doc_id != 7:
            assert got[doc_id] == [(at, len(ids), crc)]
        at += len(ids)
    assert sorted(x[1:] for x in got[7]) == sorted(sizes[7])
    plain = {r["doc_id"]: r["ids"] for r in read_token_files(manifest).collect()}
    assert plain[1001] == [0] and plain[1] == tokenizer.encode(texts[199][1]).ids + [0]
    none = write_token_files(df.limit(0), vocabulary_path())
    assert none.count() == 0 and read_token_files(none).count() == 0


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    big, other = "<p>é" + "x" * 1200, "<p>" + "y" * 1500
    rows = [
        (3, "http://a/1", big), (9, "http://a/2", big), (4, None, big), (5, "u\r\nInjected: 1", other),
        (6, "", "small"), (7, "v", "small"), (8, "w", None), (10, "z", ""), (None, "n", big),
        (11, "t", "a\r\n\r\nb" * 300), (12, "same", other + "!"), (12, "same", other + "!"),
        (None, "q", "null ids only" * 100), (None, "q", "null ids only" * 100),
    ] + [(100 + i, f"http://b/{i}", f"<html>{i} " + "word " * 300) for i in range(40)]
    df = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    manifest = write_archives(df)
    assert manifest.count() > 2 and sum(r["records"] for r in manifest.collect()) == len(rows)
    wanted = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        to = max(same) if len(payload) >= 1000 and same else None
        to = None if to == page_id else to
        kind = "response" if to is None else "revisit"
        wanted.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, to))
    got = [tuple(r) for r in read_archives(manifest).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert read_archives(write_archives(df.limit(0))).count() == 0


def test_archive_leads_with_the_dictionary_and_frames_stand_alone(spark):
    import struct

    import zstandard

    rows = [(i, f"u{i}", f"<html><body>{i} common words in all pages</body>" * 20) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = write_archives(df.coalesce(1)).first()["path"]
    blob = open(path.removeprefix("file:").replace("//", "/", 1), "rb").read()
    magic, size = struct.unpack("<II", blob[:8])
    assert magic == 0x184D2A5D and size > 0
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(blob[8 : 8 + size]))
    frame = reader.decompressobj()
    text = frame.decompress(blob[8 + size :])
    fields, block = warc.parse(text)
    assert frame.eof and fields["warc-type"] == "response" and block.startswith(b"HTTP/1.1 200 OK")
    assert fields["content-length"] == str(len(block))


def test_the_library_sees_each_distinct_piece_once_and_nothing_between():
    encoder = TextEncoder(vocabulary_path())
    library, seen = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **kw):
            seen.extend(texts)
            return library.encode_batch_fast(texts, **kw)

        encode_batch = encode_batch_fast

    words = [f"w{i}x'{i % 7}" for i in range(5000)] + ["café", "’s", "中文", "<|endoftext|>"]
    text = "".join(f" {w}" for w in words)
    encoder.tokenizer = Counting()
    ids, counts = encoder(pa.array([text, text, None]))
    own = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == own * 2 and counts.tolist() == [len(own), len(own), 0]
    assert sum(map(len, seen)) == len(text) and len(seen) <= 4


@pytest.mark.parametrize("most", [5, 70_000, 2**32 - 1])
def test_files_hold_small_and_large_ids(most):
    draw = np.random.default_rng(most)
    ids = np.append(draw.integers(0, most, 3000, endpoint=True), most).astype(np.uint32)
    parts = token_files.encode_file([1, None], np.array([3000, 1]), ids)
    names, lengths, got = token_files.decode_file(b"".join(parts))
    assert names == [1, None] and lengths.tolist() == [3000, 1] and got.tolist() == ids.tolist()


def test_files_are_written_and_read_by_spark(spark, monkeypatch):
    """On a file system that only Spark reaches, the tasks cannot open a path themselves."""
    import zstandard

    from tenura.llm import frames
    from tenura.sources import workspace

    context = spark.sparkContext
    plain = workspace.new_path(spark, "store").removeprefix("file:")
    hadoop, mounted = context._jsc.hadoopConfiguration(), "fs.viewfs.mounttable.files.link./in"
    context._jvm.java.io.File(plain).mkdirs()
    hadoop.set(mounted, f"file:{plain}")
    try:
        for module in (token_files, warc):
            monkeypatch.setattr(module, "new_path", lambda _, name: f"viewfs://files/in/{name}")
        monkeypatch.setattr(token_files, "FILE_IDS", 100)
        docs = spark.createDataFrame([(i, "some words " * i) for i in range(40)], "doc_id long, text string")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        manifest = write_token_files(docs.repartition(3), vocabulary_path())
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        paths = [r["path"] for r in manifest.collect()]
        assert len(paths) > 3 and all(p.startswith("viewfs://files/in/") for p in paths)
        assert sorted(r["doc_id"] for r in read_token_files(manifest).collect()) == list(range(40))
        assert [r["documents"] for r in manifest.orderBy("part", "number").limit(1).collect()][0] > 0
        pages = spark.createDataFrame(
            [(i, f"u{i}", f"<p>{i}" + "\nword\xe9" * 300) for i in range(30)], "page_id long, url string, html string"
        )
        archives = write_archives(pages)
        assert archives.agg({"records": "sum"}).first()[0] == 30
        assert sorted(r["page_id"] for r in read_archives(archives).collect()) == list(range(30))
        # A file with its line feed is whole Zstandard frames, and as long as the manifest says.
        row = archives.first()
        blob = spark.read.format("binaryFile").load(row["path"]).first()["content"]
        assert len(blob) == row["bytes"] and blob.endswith(b"\n")
        last, count = blob[-17:], int.from_bytes(blob[-9:-1], "little")
        assert zstandard.ZstdDecompressor().decompressobj().decompress(last) == b"" and count == row["records"]
    finally:
        hadoop.unset(mounted)
    any_bytes = spark.createDataFrame([(bytearray(range(256)),), (bytearray(b"\xff\n"),)], "content binary")
    files = frames.write_files(any_bytes.coalesce(1), workspace.new_path(spark, "bytes"))
    got = [(r["part"], r["number"], bytes(r["content"])) for r in files.orderBy("part", "number").collect()]
    assert got == [(0, 0, bytes(range(256))), (0, 1, b"\xff\n")]
