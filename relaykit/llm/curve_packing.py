"""Packing along a space-filling curve: documents that resemble each other share
sequences.

A document's token ids are hashed into a vector of ``HASHED`` signed counts
(square roots damp the frequent ones), which a fixed matrix projects to
``DIMENSIONS`` coordinates. Each is put on an even grid by the normal
distribution's integral, and the cell's place on the Hilbert curve is the key
that documents are range-sorted by. The sorted documents form one row of ids
without a gap, cut every ``size`` ids; the end, shorter than ``size``, is cut
into powers of two, which need no padding. So there is none at all.

Rows are sorted by (key, number): the number is written with the ids before the
sort, so a hot key (copies of one text) is split over many partitions and a lost
task sorts as before. Partitions are as large as the sort makes them; the driver
sees one count of ids for each. A task holds one batch of rows.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each; ids may repeat or be null; an empty table
gives no pieces; other columns pass through, but for those named like the
operator's own (key, piece, start, length, ids, doc_tokens, sequence_id,
offset), which go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import END_ID, _Ids
from .shared import mix, slices, stored, text_bytes

SIZE = 2048
HASHED = 256
DIMENSIONS, BITS = 4, 15
OWN = ("key", "piece", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
#: Rows, and bytes of text or ids, that a task works on at a time.
ROWS = 500
PART_BYTES = 8 << 20


class _Projection:
    """Coordinates of token ids, the same in every task and run."""

    def __init__(self, vocabulary: int):
        h = mix(np.arange(1, vocabulary + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.slot = ((h >> np.uint64(1)) % np.uint64(HASHED) * np.uint64(2) + (h & np.uint64(1))).astype(np.int64)  # odd: counts down
        self.matrix = np.random.Generator(np.random.PCG64(11)).standard_normal((HASHED, DIMENSIONS))

    def __call__(self, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Coordinates of documents with ``count`` ids each, of their ids in a row."""
        n = len(count)
        at = self.slot[ids]
        at += np.repeat(np.arange(n) * (2 * HASHED), count)
        up, down = np.moveaxis(np.bincount(at, minlength=n * 2 * HASHED).reshape(n, HASHED, 2), 2, 0)
        v = np.sign(up - down) * np.sqrt(np.abs(up - down))
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return (v / np.maximum(norm, 1)) @ self.matrix


def _binary(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow array of the ids between neighbouring ``bounds``."""
    at = (bounds * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(ids)])


def grid(coordinates: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of coordinates that are about normally distributed."""
    share = np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in coordinates.ravel()]).reshape(coordinates.shape)
    return np.minimum((share * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of ``cells`` (one column per dimension) on the curve.

    From the coarsest bit on, each quadrant is turned so that its curve starts
    where the one before ends; the turned bits, Gray-decoded, are the digits."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            on = (x[d] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(on, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> b) & 1
    return key


def _width(tokenizer: str, end_id: int) -> str:
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def token_keys(docs: DataFrame, tokenizer: str, text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(row, ids, doc_tokens, key): ids as little-endian unsigned numbers, of 16
    bits where the vocabulary allows, else of 32."""
    names = [c for c in docs.columns if c not in (text_col, *OWN)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("_")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    width, closing = _width(tokenizer, end_id), np.array([end_id], "<u4").tobytes()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(tokenizer)
        project = _Projection(max(known.tokenizer.get_vocab_size(), end_id + 1))
        for batch in batches:
            for low, high in slices(text_bytes(batch.column(1))[1], PART_BYTES, ROWS):
                got = [known.text(text.as_py() or "") + closing for text in batch.column(1).slice(low, high - low)]
                count = np.array([len(x) // 4 for x in got], np.int64)
                ids = np.frombuffer(b"".join(got), "<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), _binary(ids.astype(width), np.append(0, np.cumsum(count))),
                     pa.array(count), pa.array(hilbert_key(grid(project(ids, count))))], names=["row", "ids", "doc_tokens", "key"])

    return rows.mapInArrow(tokens, f"row {kind}, ids binary, doc_tokens long, key long")


def cuts(total: int, size: int = SIZE) -> list[int]:
    """First ids of the sequences at the end, which are shorter than ``size``."""
    at, rest = total - total % size, total % size
    out = []
    for b in range(size.bit_length(), -1, -1):
        if rest >> b & 1:
            out.append(at)
            at += 1 << b
    return out


def pack_along_curve(docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pieces of ``docs`` in curve order: the columns without the text, start,
    length, ids (binary: little-endian unsigned 32-bit), doc_tokens, sequence_id
    and offset."""
    made = token_keys(docs, tokenizer, text_col, end_id)
    kind = made.schema["row"].dataType.simpleString()
    names = [f for f in made.schema["row"].dataType.names if f != "_"]
    made = stored(made.withColumn("number", F.monotonically_increasing_id()), codec="zstd")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            first = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(np.full(len(n), part, np.int32)), pa.array(first)],
                                             names=["row", "ids", "doc_tokens", "part", "first"])

    ordered = made.repartitionByRange("key", "number").sortWithinPartitions("key", "number").select("row", "ids", "doc_tokens")
    ordered = stored(ordered.mapInArrow(place, f"row {kind}, ids binary, doc_tokens long, part int, first long"), codec="zstd")
    # one row for each partition of the sort
    base, total = {}, 0
    for part, n in ordered.groupBy("part").agg(F.sum("doc_tokens")).orderBy("part").collect():
        base[part], total = total, total + n
    ends, full = np.array(cuts(total, size), np.int64), total - total % size
    width = _width(tokenizer, end_id)

    def pieces(batch: pa.RecordBatch, first: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pieces of documents that lie side by side."""
        low, high = int(first[0]), int(first[-1] + n[-1])
        inner = np.arange(low // size * size + size, min(high, full + 1), size)
        borders = np.unique(np.concatenate((first, inner, ends[(ends > low) & (ends < high)])))
        owner = np.searchsorted(first, borders, "right") - 1
        start, stop = borders - first[owner], np.append(borders[1:], high) - first[owner]
        late = np.searchsorted(ends, borders, "right")  # how many short sequences begin up to here
        sequence = np.where(late > 0, full // size + late - 1, borders // size)
        begin = np.where(late > 0, np.append(ends, 0)[late - 1], borders // size * size)
        ids = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(1)), width)
        step = max(1, PART_BYTES // (4 * size))
        for k in range(0, len(borders), step):
            o, a, b = pa.array(owner[k:k + step]), start[k:k + step], stop[k:k + step]
            at = np.append(borders[k:k + step], borders[k + step] if k + step < len(borders) else high) - low
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(o), pa.array(a), pa.array(b - a), _binary(ids[at[0]:at[-1]].astype("<u4"), at - at[0]),
                 batch.column(2).take(o), pa.array(sequence[k:k + step]), pa.array((borders - begin)[k:k + step])],
                names=["row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            n, part, first = (batch.column(k).to_numpy() for k in (2, 3, 4))
            first = first + np.array([base[p] for p in part.tolist()], np.int64)
            # a scan may read several partitions of the sort one after another
            seams = np.flatnonzero(first[1:] != first[:-1] + n[:-1]) + 1
            for a, b in zip([0, *seams.tolist()], [*seams.tolist(), len(n)]):
                yield from pieces(batch.slice(a, b - a), first[a:b], n[a:b])

    done = ordered.mapInArrow(cut, f"row {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
