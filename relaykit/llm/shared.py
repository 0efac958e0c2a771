"""Helpers that several operators share: reliable checkpoints, connected
components, size-checked broadcasts and byte-level text hashing in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows of a two-column table of longs that may be broadcast (about 40 MB in
#: a task); a larger table takes the shuffle join.
BROADCAST_ROWS = 1_000_000
#: Edges of a file in which the components' steps keep them, and the least
#: number of files; more of them would be as many files in every step.
EDGES, LEAST_FILES = 100_000, 8
#: Bytes of text that numpy works on at a time.
SLICE_BYTES = 1 << 20

#: ASCII white space that separates words: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64)
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when ``df`` is proven to have at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse mod 2**64."""
    if len(_pow[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _pow[k] = np.cumprod(row, dtype=np.uint64)
    return _pow[0][:n], _pow[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h with h[b] - h[a] = hash of data[a:b] times the base to the a."""
    h = np.empty(len(data) + 1, np.uint64)
    h[0] = 0
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][:-1], out=h[1:])
    return h


def span_hash(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each data[a:b], equal for equal bytes wherever they stand."""
    return mix((h[b] - h[a]) * powers(len(h))[1][a] + (b - a).astype(np.uint64) * _M1)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, most: int = 4000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes and at most ``most`` rows; a longer
    text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), i + most, n)
        yield i, j
        i = j


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans of ``data``; a word never goes over one of ``starts``."""
    space = SPACE[data]
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = space[:-1]
    before[starts[starts < len(data)]] = True
    first = np.flatnonzero(before & ~space)
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = space[1:] | before[1:]
    return first, np.flatnonzero(after & ~space) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text) of the texts between ``offsets``."""
    base, n = offsets[0], len(offsets) - 1
    body = data[base:offsets[-1]]
    body = LOWER[body] if lower else body
    if len(body) == 0:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    if n == 1 and len(body) > 4 * SLICE_BYTES:  # a very long text: cut at white space
        found, at = [], 0
        while at < len(body):
            end = min(at + SLICE_BYTES, len(body))
            while end < len(body) and not SPACE[body[end]]:
                end += 1
            part = body[at:end]
            a, b = _words(part, np.zeros(1, np.int64))
            found.append(span_hash(prefix_hash(part), a, b))
            at = end
        words = np.concatenate(found)
        return words, np.array([len(words)])
    a, b = _words(body, offsets[:-1] - base)
    words = span_hash(prefix_hash(body), a, b)
    return words, np.diff(np.searchsorted(a, offsets - base))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 52-bit shingle hashes, how many per text).

    A text with fewer than ``size`` words has its whole word sequence as one
    shingle; a text without words has none."""
    words, count = word_hashes(data, offsets, lower)
    n = len(count)
    doc = np.repeat(np.arange(n, dtype=np.uint64), count)
    made, owner = [], []
    if len(words) >= size:
        k = len(words) - size + 1
        h = np.zeros(k, np.uint64)
        for j in range(size):
            h = mix(h * _M1 + words[j:j + k])
        whole = doc[:k] == doc[size - 1:]
        made.append(h[whole])
        owner.append(doc[:k][whole])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = (np.cumsum(count) - count)[short]
        h = mix(count[short].astype(np.uint64) * _M3)
        for j in range(size - 1):
            on = j < count[short]
            h[on] = mix(h[on] * _M1 + words[first[on] + j])
        made.append(h)
        owner.append(short.astype(np.uint64))
    if not made:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    key = (np.concatenate(owner) << np.uint64(52)) | (np.concatenate(made) >> np.uint64(12))
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return key & np.uint64((1 << 52) - 1), np.bincount((key >> np.uint64(52)).astype(np.int64), minlength=n)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node
    that it reaches.

    Alternating large-star and small-star steps: each keeps only links to a
    node's smallest neighbour, so the edge list never grows, and a few rounds
    settle long chains. Minima combine before the shuffle, and joins on a hub
    node are ordinary sort-merge joins that adaptive execution can split. Steps
    write as many files as there are edges for, not one for each partition of
    their last shuffle.
    """
    e = saved(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    files = max(LEAST_FILES, -(-e.count() // EDGES))
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low, "u")
        e = saved(tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(low.select("u", F.col("m").alias("v"))).distinct().coalesce(files))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())


def stored(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back;
    the files go when the application ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
