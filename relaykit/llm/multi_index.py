"""Approximate nearest neighbours with an inverted multi-index.

Each half of the vector has its own codebook of ``CENTROIDS`` centroids, fitted
on a bounded sample; a vector lies in the cell of its pair of nearest centroids,
and every row is indexed. A query takes cells in the order of its summed squared
distance to the two centroids, from a heap over the two sorted lists, until the
cells hold ``share`` of all rows; a cell counts for a bounded part of that, so a
cell full of copies does not end the search. Its candidates are reranked by
exact distance on the original vectors, in double precision.

Cells with one first centroid lie together and are cut into chunks of bounded
size, so a vector that a third of all rows have spreads over many tasks. A query
goes to a chunk once, with the cells that it asks for there, and a chunk returns
its ``k`` nearest per query.

Defined results: vectors that are null, zero, of another length than the most
common one, or hold null or non-finite components take no part, neither as query
nor as candidate; every row with the query's id is the query's own and no
candidate; of several query rows with one id the least vector is taken; ties go
to the smaller id; fewer than ``k`` candidates are returned all; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

CENTROIDS = 64
#: Rows that the codebooks are fitted on.
SAMPLE = 16_384
#: Share of all rows that a query looks at, and least number. Vectors without
#: clusters need such a share for a recall of 0.95; clustered ones far less.
SHARE, LEAST = 0.5, 2_000
#: Part of its candidates that one cell may count for.
CELL_PART = 16
CHUNK = 4_096
ROUNDS = 12


def usable(vector: Column, size: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def codebook(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 8) -> np.ndarray:
    """k-means from k-means++ seeds; a centroid that loses all its vectors
    moves to the vector that lies farthest out."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centre = np.empty((k, x.shape[1]))
    centre[0] = x[rng.integers(len(x))]
    far = ((x - centre[0]) ** 2).sum(1)
    for i in range(1, k):
        total = far.sum()
        centre[i] = x[rng.choice(len(x), p=far / total)] if total > 0 else x[rng.integers(len(x))]
        far = np.minimum(far, ((x - centre[i]) ** 2).sum(1))
    for _ in range(rounds):
        d = _squares(x, centre)
        near = d.argmin(1)
        size = np.bincount(near, minlength=k)
        for j in range(x.shape[1]):
            centre[:, j] = np.where(size > 0, np.bincount(near, x[:, j], k) / np.maximum(size, 1), centre[:, j])
        gone = np.flatnonzero(size == 0)
        centre[gone] = x[np.argsort(-d.min(1))[:len(gone)]]
    return centre


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None]


def traverse(first: np.ndarray, second: np.ndarray, worth: np.ndarray, goal: int) -> list[int]:
    """Cells by ascending first[i] + second[j], until their worth adds up to
    ``goal``; empty cells are passed over. A pair enters the heap when the pairs
    before it on both lists have left it."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap, out, got = [(x[0] + y[0], 0, 0)], [], 0
    seen = {(0, 0)}
    while heap and got < goal:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(b) + int(b[j])
        if worth[cell]:
            out.append(cell)
            got += int(worth[cell])
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(a) and p[1] < len(b) and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (x[p[0]] + y[p[1]], *p))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            centroids: int = CENTROIDS, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(query_id, rank from 1, vec_id, score: Euclidean distance)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q"))
    common = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    shape = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], shape)
    size = int(common["n"])
    rows = rows.where(usable(F.col("v"), size) & F.col("vec_id").isNotNull())
    # a bounded sample, the same whenever the rows are the same
    sample = np.array([r[0] for r in rows.select("v", F.xxhash64("vec_id", "v").alias("h")).orderBy("h").limit(SAMPLE).select("v").collect()])
    if not len(sample):
        return spark.createDataFrame([], shape)
    half = (size + 1) // 2
    books = [codebook(sample[:, :half], centroids), codebook(sample[:, half:], centroids) if size > 1 else np.zeros((1, 0))]
    sent = spark.sparkContext.broadcast(books)
    wide = len(books[1])

    def index(parts):
        for part in parts:
            x = np.array(part["v"].tolist()).reshape(-1, size)
            one, two = (_squares(h, b).argmin(1) for h, b in zip((x[:, :half], x[:, half:]), sent.value, strict=True))
            yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "q": part["q"], "cell": (one * wide + two).astype(np.int32)})

    indexed = saved(rows.mapInPandas(index, "vec_id long, v array<double>, q boolean, cell int"))
    # at most centroids ** 2 rows
    held = np.zeros(len(books[0]) * wide, np.int64)
    for cell, n in indexed.groupBy("cell").count().collect():
        held[cell] = n
    total = int(held.sum())
    goal = max(least, k + 1, int(share * total))
    worth = np.minimum(held, max(k + 1, goal // CELL_PART))
    chunks = -(-held.reshape(-1, wide).sum(1) // CHUNK)
    plan = spark.sparkContext.broadcast((worth, chunks))

    def route(parts):
        worth, chunks = plan.value
        for part in parts:
            out = []
            for vec_id, v in zip(part["vec_id"], part["v"], strict=True):
                v = np.asarray(v)
                far = [((h - b) ** 2).sum(1) for h, b in zip((v[:half], v[half:]), sent.value, strict=True)]
                cells = np.array(traverse(*far, worth, goal), np.int64)
                for first in np.unique(cells // wide).tolist():
                    asked = np.zeros(wide, np.uint8)
                    asked[cells[cells // wide == first] % wide] = 1
                    out += [(vec_id, v, first, c, asked.tobytes()) for c in range(chunks[first])]
            yield pd.DataFrame(out, columns=["vec_id", "v", "first", "chunk", "cells"])

    queries = indexed.where("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = queries.mapInPandas(route, "vec_id long, v array<double>, first int, chunk int, cells binary")
    first = F.floor(F.col("cell") / wide).cast("int")
    number = F.get(F.split(F.lit(",".join(map(str, chunks.tolist()))), ",").cast("array<int>"), first)
    entries = indexed.select("vec_id", "v", F.pmod("cell", F.lit(wide)).alias("second"), first.alias("first"),
                             F.pmod(F.xxhash64("vec_id"), number).cast("int").alias("chunk"))

    def rerank(key, some: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(near):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, x = near["vec_id"].to_numpy(), np.array(near["v"].tolist()).reshape(-1, size)
        second, out = near["second"].to_numpy(), []
        for query, v, cells in zip(some["vec_id"], some["v"], some["cells"], strict=True):
            other = np.flatnonzero((np.frombuffer(cells, np.uint8)[second] > 0) & (ids != query))
            d = np.full(len(x), np.inf)
            d[other] = np.sqrt(((x[other] - np.asarray(v)) ** 2).sum(1))
            if len(other) > k:  # all that tie with the k-th stay for the order by id
                other = other[d[other] <= np.partition(d[other], k - 1)[k - 1]]
            best = other[np.lexsort((ids[other], d[other]))][:k]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": d[best]}))
        return pd.concat(out)

    found = asked.groupBy("first", "chunk").cogroup(entries.groupBy("first", "chunk")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
