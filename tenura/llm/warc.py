"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

A file starts with a skippable frame that holds the dictionary; every record is a frame of its
own. A skippable frame ends the file: the number of records and the line feed that Spark's writer adds.
A payload of at least ``REVISIT_BYTES`` that occurs again is stored once, as the response
with the largest page id; its other records are revisits without payload.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.frames import column, folders_of, read_files, write_files, written
from tenura.sources.workspace import new_path

REVISIT_BYTES = 1000
#: The dictionary is fitted on about this many distinct whole payloads (one in so many by a hash, at
#: most twice the number), none longer than the next number.
SAMPLES, SAMPLE_BYTES = 400, 1 << 16
DICTIONARY_BYTES = 112_640
#: A file is closed when it holds this many bytes.
FILE_BYTES = 1 << 25
# Fixed values of the formats.
_SKIPPABLE = 0x184D2A5D
#: The last frame without its line feed: mark, size with the line feed, number of records.
_END = "<IIQ"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def fit_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves when they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(blob: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(blob) if len(blob) >= 8 else None


def _name(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, payload: bytes, digest: str, response_id) -> bytes:
    """One WARC record; a revisit of ``response_id`` unless that is null."""
    revisit = response_id is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [("WARC-Type", "revisit" if revisit else "response")]
    if page_id is not None:
        fields.append(("WARC-Record-ID", _name(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields += [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(response_id))]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(blob: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (lower case) and block of a record."""
    head, _, rest = blob.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return fields, rest[: int(fields["content-length"])]


def _page(fields: dict[str, str], field: str) -> int | None:
    name = fields.get(field)
    return None if name is None else int(name[len("<urn:page:") : -1])


def _frames(source, dictionary_of):
    """The decompressed records of a file, read in small chunks."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != _SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    dictionary = dictionary_of(source.read(size))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = b""
    while rest or (rest := source.read(1 << 15)):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = source.read(1 << 15)
            if not rest:
                raise ValueError("the archive ends within a record")
        yield b"".join(parts)


_MANIFEST = "path string, records long, bytes long"
_ROWS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _write(dictionary: bytes):
    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))
        lead = struct.pack("<II", _SKIPPABLE, len(dictionary)) + dictionary
        held, size = [], 0
        names = ("page_id", "url", "html", "digest", "response_id")

        def close():
            nonlocal held, size
            blob = b"".join((lead, *held, struct.pack(_END, _SKIPPABLE, 9, len(held))))
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["content"])

        for batch in batches:
            for page_id, url, html, digest, response_id in zip(
                *(column(batch, n).to_pylist() for n in names), strict=True
            ):
                payload = (html or "").encode()
                held.append(packer.compress(record(page_id, url, payload, digest, response_id)))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    return run


def _heads(batches):
    """The manifest's rows, from the files' last bytes."""
    for batch in batches:
        blobs = [c.as_buffer() for c in column(batch, "content")]
        records = [struct.unpack_from(_END, b, len(b) - struct.calcsize(_END))[2] for b in blobs]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "path"), pa.array(records, pa.int64()), pa.array([len(b) + 1 for b in blobs], pa.int64())],
            names=["path", "records", "bytes"],
        )


def write_archives(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    folder: str | None = None,
) -> DataFrame:
    """Write a record per row; the files as ``path, records, bytes``.

    A null html is an empty payload. A null url leaves its field out. Of equal payloads of at least
    ``REVISIT_BYTES`` bytes the largest page id is the response (each row that repeats this id is
    one); a row with a null id revisits it, and where all ids are null all rows are responses.
    Smaller payloads are always responses. Other columns are ignored; no rows write no file.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archives")
    payload = F.coalesce(F.col(html_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        payload.alias("html"),
        F.sha1(payload).alias("digest"),
    )
    size = F.octet_length("html")
    repeated = (
        rows.where(size >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
        .where("n > 1 AND last IS NOT NULL")
        .select("digest", "last")
    )
    every = max(1, pages.count() // SAMPLES)
    chosen = rows.where(size.between(1, SAMPLE_BYTES)).where(
        F.pmod(F.xxhash64("digest"), F.lit(every)) == 0
    )
    samples = chosen.groupBy("digest").agg(F.min("html").alias("html")).collect()
    samples = [r["html"].encode() for r in sorted(samples)[: 2 * SAMPLES]]
    dictionary = fit_dictionary(samples) if samples else b""
    linked = rows.join(repeated, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.expr("nullif(last, page_id)").alias("response_id"),
    )
    files = write_files(linked.mapInArrow(_write(dictionary), "content binary"), folder)
    return written(files.mapInArrow(_heads, _MANIFEST), "archives")[0]


def _read(batches):
    for batch in batches:
        for path, content in zip(column(batch, "path").to_pylist(), column(batch, "content"), strict=True):
            rows = []
            with io.BytesIO(content.as_py()[: -struct.calcsize(_END)]) as source:
                for blob in _frames(source, _dictionary):
                    fields, block = parse(blob)
                    head, _, payload = block.partition(b"\r\n\r\n")
                    said = base64.b32decode(fields["warc-payload-digest"][5:]).hex()
                    if fields["warc-type"] == "response":
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        if digest != said:
                            raise ValueError(f"damaged record in {path}")
                    else:
                        lines = head.decode().split("\r\n")[1:]
                        size = int(dict(x.split(": ", 1) for x in lines)["Content-Length"])
                        digest = said
                    refers = _page(fields, "warc-refers-to")
                    own = _page(fields, "warc-record-id")
                    rows.append((own, size, digest, fields["warc-type"], refers))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=names,
            )


def read_archives(manifest: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` read from the files.

    Of a response, size and digest are those of the payload found; of a revisit, those that its
    HTTP header and WARC header give for the payload it refers to.
    """
    contents = read_files(manifest.sparkSession, folders_of(manifest)).select("path", "content")
    return contents.join(F.broadcast(manifest.select("path")), "path").mapInArrow(_read, _ROWS)
