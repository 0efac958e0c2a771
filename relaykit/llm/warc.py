"""WARC archives with a Zstandard dictionary.

A task writes its records to one archive after another in a shared folder. An
archive begins with a skippable frame that holds a dictionary built from
records of that archive; each record follows as a frame of its own, compressed
with that dictionary, so any record can be read alone. Reading streams an
archive: it takes the dictionary from the skippable frame, then one record at a
time.

Payloads are compared before writing by digest and length: in a group of equal
payloads of at least ``least`` bytes the row with the smallest id is the
response, the others are revisits that name it and carry no body. Digests are
counted in partial sums, and only (id, digest) is joined back, so a payload that
a third of all rows share does not gather their bodies in one task.

A repeated task attempt writes new files; only archives that the finished job
lists are read.

Defined results: a null payload is empty; rows that repeat the smallest id of a
group are all responses; a null id is written as an empty record id and counts
as larger than any; a null url is empty; line ends and control characters in a
url are percent-encoded; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .shared import saved

#: First four bytes of the skippable frame that holds the dictionary.
MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 16 << 10
#: Bytes of records that a dictionary is built from, spread over its archive.
SAMPLE_BYTES = 1 << 20
#: Bytes of records before an archive is closed.
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
_READ = 1 << 18


def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to names the response of a
    revisit, and is null for a response."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"))
    slim = rows.select("page_id", "digest", "size").where(F.col("size") >= least)
    first = slim.groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # ids and digests only; bodies are joined by id and digest, which spreads a hot digest
    again = (slim.join(first, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
             .select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct())
    both = rows.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return both.select("page_id", "url", "payload", F.col("first").alias("refers_to"))


def _record(page_id, url: str, body: bytes, refers_to) -> bytes:
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    name = "" if page_id is None else page_id
    uri = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(body)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _dictionary(records: list[bytes]):
    """Built from every n-th record; too few or too small records: raw content."""
    import zstandard
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=LEVEL)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write(path: str, records: list[bytes]) -> int:
    import zstandard
    place, name = fs.FileSystem.from_uri(path)
    words = _dictionary(records)
    made = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=True)
    held, size = words.as_bytes(), 0
    with place.open_output_stream(name) as out:
        size += out.write(struct.pack("<II", MAGIC, len(held)) + held)
        for r in records:
            size += out.write(made.compress(r))
    return size


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of ``mark_revisits`` and returns (path, records, bytes)
    of each archive. ``folder``: a URI that all executors reach."""
    root = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, name = fs.FileSystem.from_uri(root)
        place.create_dir(name, recursive=True)
        records, size = [], 0

        def close() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(records)], "bytes": [_write(path, records)]})

        for batch in batches:
            for page_id, url, payload, refers in zip(*batch.columns, strict=True):
                records.append(_record(page_id.as_py(), url.as_py(), payload.as_py().encode(), refers.as_py()))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, size = [], 0
        if records:
            yield close()

    return saved(marked.mapInArrow(write, "path string, records long, bytes long"))


def frames(stream) -> Iterator[bytes]:
    """Records of one archive, read piece by piece."""
    import zstandard
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("archive does not begin with a dictionary frame")
    made = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest = stream.read(_READ)
    while rest:
        one, parts = made.decompressobj(), []
        while not one.eof:
            if not rest:
                rest = stream.read(_READ)
                if not rest:
                    raise ValueError("archive ends within a record")
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)
        rest = rest or stream.read(_READ)


def parse(record: bytes) -> dict:
    head, _, body = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])

    def page(name: str):
        return int(got) if (got := fields.get(name, "")[len("<urn:page:"):-1]) else None

    return {"page_id": page("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": int(fields["X-Payload-Length"]),
            "refers_to": page("WARC-Refers-To"), "payload": body[:int(fields["Content-Length"])]}


_READ_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                          ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the archives that column path names."""
    n = max(1, archives.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                place, name = fs.FileSystem.from_uri(path)
                with place.open_input_stream(name) as stream:
                    rows, size = [], 0
                    for record in frames(stream):
                        rows.append(parse(record))
                        size += len(record)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _READ_SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _READ_SCHEMA)

    shape = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
    return archives.select("path").repartition(min(n, 2000)).mapInArrow(read, shape)


def archive_folder(spark) -> str:
    """A new folder for archives in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
