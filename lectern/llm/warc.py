"""WARC archives of individually compressed records with a Zstandard dictionary in a leading skippable frame.

Each file begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, built from records of that file;
after it each record is one Zstandard frame of its own, so a reader can start at any record's offset.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from itertools import islice

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, written

SKIPPABLE = 0x184D2A5D
#: Raw bytes of the records of one file, about.
FILE_BYTES = 32 << 20
#: Bytes that a dictionary is built from, taken evenly in pieces over all records of a file, and its size at most.
SAMPLE_BYTES, SAMPLE_PIECE, DICTIONARY_BYTES = 2 << 20, 4 << 10, 64 << 10
LEVEL = 3
ARCHIVED_AT = "2026-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, html: str | None, archived_at: str = ARCHIVED_AT) -> bytes:
    """One WARC resource record; null fields leave out their header, and a null page is marked as such."""
    body = b"" if html is None else html.encode()
    name = uuid.UUID(bytes=hashlib.md5(repr((page_id, url)).encode() + body).digest())
    head = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {archived_at}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if html is None:
        head.append("X-Null-Payload: 1")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, str | None, str | None]:
    """(page_id, url, html) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if len(rest) != length + 4:
        raise ValueError("a record's length doesn't agree with its header")
    url = fields.get("WARC-Target-URI")
    url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%") if url is not None else None
    page = fields.get("X-Page-ID")
    return int(page) if page is not None else None, url, None if "X-Null-Payload" in fields else rest[:length].decode()


def dictionary(records: list[bytes]) -> bytes:
    """A dictionary from pieces of all records: a trained one, or, where they are too few to train one, their first bytes."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    pieces = (raw[i : i + SAMPLE_PIECE] for raw in records for i in range(0, len(raw), SAMPLE_PIECE))
    sample = list(islice(pieces, 0, None, step))
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, sample)) // 8))
    try:
        return zstandard.train_dictionary(size, sample, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:size]


def encode_file(records: list[bytes]) -> tuple[bytes, list[tuple[int, int]]]:
    """A file's bytes and (offset, length) of each record's frame."""
    words = dictionary(records)
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_content_size=True)
    out, places = bytearray(struct.pack("<II", SKIPPABLE, len(words)) + words), []
    for raw in records:
        frame = coder.compress(raw)
        places.append((len(out), len(frame)))
        out += frame
    return bytes(out), places


def decode_file(data: bytes):
    """Yield (page_id, url, html) of each record of a file."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the start")
    words = data[8 : 8 + size]
    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
    rest = memoryview(data)[8 + size :]
    while rest:
        unit = coder.decompressobj()
        raw = unit.decompress(rest)
        yield parse(raw)
        rest = rest[len(rest) - len(unit.unused_data) :]


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive every row; returns (page_id, url, file, offset, length, n_bytes), one row for each record.

    Files go to `folder` (a new one in the shared folder by default), one or more for each partition, named by
    partition and attempt: a task that runs again writes files of its own, and the index, which is written before this
    returns, names only those of the attempt that counted.  Every file has a dictionary, of a single record too.  Null
    ids, URLs and pages are kept as null.  Repeated rows are archived each, extra columns are left out, and an empty
    table gives no file.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")

    def run(batches):
        held, size, part = [], 0, 0
        from pyspark import TaskContext

        task = TaskContext.get()
        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)

        def close():
            nonlocal held, size, part
            data, places = encode_file([record(*h) for h in held])
            name = f"part-{task.partitionId():05d}-{part:04d}-{uuid.uuid4().hex}.warc.zst"
            with where.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(data)
            ids, urls, bodies = zip(*held, strict=True)
            index = pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array([f"{folder}/{name}"] * len(held)), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64()), pa.array([None if b is None else len(b.encode()) for b in bodies], pa.int64())],
                names=["page_id", "url", "file", "offset", "length", "n_bytes"],
            )
            held, size, part = [], 0, part + 1
            return index

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.append(row)
                size += len(row[2] or "") + 300
                if size >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return written(rows.mapInArrow(run, "page_id bigint, url string, file string, offset bigint, length bigint, n_bytes bigint"), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """(page_id, url, html) of every record of the files that an index names; files are read once, in parallel.

    Null ids, URLs and pages come back as null; an empty index gives an empty result.
    """

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                where, path = fs.FileSystem.from_uri(file)
                with where.open_input_stream(path, compression=None) as source:
                    data = source.read()
                held = []
                for row in decode_file(data):
                    held.append(row)
                    if len(held) == 500:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    files = index.select("file").distinct()
    n = files.count()
    return files.repartition(max(1, min(n, 4096)), "file").mapInArrow(run, "page_id bigint, url string, html string")


def read_record(file: str, offset: int, length: int) -> tuple[int | None, str | None, str | None]:
    """One record by its place in the index, without reading the records before it."""
    where, path = fs.FileSystem.from_uri(file)
    with where.open_input_file(path) as source:
        _, size = struct.unpack("<II", source.read(8))
        words = source.read(size)
        source.seek(offset)
        frame = source.read(length)
    return parse(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)).decompress(frame))


def _rows(held):
    ids, urls, pages = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(pages, pa.string())], names=["page_id", "url", "html"])


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, url, n_bytes, md5) of every row as read back from an archive of all of them; null pages have nulls."""
    back = read(write(pages, folder))
    return back.select("page_id", "url", F.octet_length("html").cast("long").alias("n_bytes"), F.md5(F.col("html").cast("binary")).alias("md5"))
