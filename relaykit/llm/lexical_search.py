"""Ranked lexical search with bag deduplication.

Documents are read once and restricted to the items' vocabulary: what is left
of a text is its length and the counts of the items' terms (its bag). Rows with
the same bag and the same length weight m score alike for every item, so they
form a class: classes are told apart by a hash, then by the bag itself, each is
scored once, and its members stand in for it by ascending id.

At most ``k`` members of a class can be among an item's best ``k``, and an item's
best documents lie in its best ``k`` classes by (score, smallest id); so a class
keeps its ``k`` smallest ids (cut before the shuffle, copies of one text never
meet in one task) and a task gives out ``k`` documents per item.

Items go to the tasks in blocks of about ``BLOCK_BYTES`` of text and at most
about ``BLOCK_ITEMS`` items, dealt by a hash; one block is one pass over the
documents. An item longer than that makes its block as long as itself.

All of a score but the term weights (doubles, rounded down) is 64-bit integers.

Defined results: null and empty texts have no terms (such a document is not
counted, such an item finds nothing); every row of documents is a document of
its own, repeated rows are ranked each; a null id comes after all others; items
of one id and one text are one item; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

#: Text and number of a block of items.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 20, 2000
#: Scores that a task holds at a time.
CELLS = 1 << 19

#: Bytes of a term as they are, A-Z in lower case; all others separate terms.
_TERM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, ASCII letters and all non-ASCII characters."""
    return (text or "").encode().translate(_TERM).split()


class _Items:
    """A block of items: its terms, and for each term the items that hold it."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids = ids
        counts = [Counter(terms(t)) for t in texts]
        self.term = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        posted = sorted((self.term[t], j, n) for j, c in enumerate(counts) for t, n in c.items())
        self.item = np.array([j for _, j, _ in posted], np.int64)
        self.times = np.array([n for _, _, n in posted], np.int64)
        self.bounds = np.searchsorted(np.array([t for t, _, _ in posted], np.int64), np.arange(len(self.term) + 1))
        self.number = len(texts)

    def scores(self, term: np.ndarray, value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """(rows, items): sums of the values of the rows' terms over the items."""
        many = self.bounds[term + 1] - self.bounds[term]
        owner = np.repeat(np.arange(len(term)), many)
        at = np.arange(len(owner)) - (np.cumsum(many) - many)[owner] + self.bounds[term][owner]
        out = np.zeros(rows * self.number, np.int64)
        np.add.at(out, row[owner] * self.number + self.item[at], value[owner] * self.times[at])
        return out.reshape(rows, self.number)


def _bags(docs: DataFrame, id_col: str, text_col: str, sent) -> DataFrame:
    """(doc, n, bag): the number of a text's terms, and of the block's terms in
    it the numbers, ascending, and counts (little-endian 32-bit)."""
    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value.term
        for batch in batches:
            n, bags = [], []
            for text in batch.column(1):
                found = terms(text.as_py())
                n.append(len(found))
                count = Counter(found)
                bag = sorted((known[t], count[t]) for t in count.keys() & known.keys())
                bags.append(np.array(bag, "<u4").T.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(bags, pa.binary())], names=["doc", "n", "bag"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(restrict, "doc long, n long, bag binary")


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, count, row) of all entries of the bags."""
    both = [np.frombuffer(b.as_buffer(), "<u4").reshape(2, -1) for b in bags]
    term, count = np.concatenate([np.zeros((2, 0), "<u4"), *both], axis=1).astype(np.int64)
    return term, count, np.repeat(np.arange(len(both)), [b.shape[1] for b in both])


def _document_counts(bags: DataFrame, number: int) -> np.ndarray:
    """Documents that hold each term of the block: one row per term and task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(number, np.int64)
        for batch in batches:
            held += np.bincount(_unpacked(batch.column(0))[0], minlength=number)
        there = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(held[there])], names=["term", "df"])

    out = np.zeros(number, np.int64)
    for term, df in bags.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def classes(bags: DataFrame, documents: int, total: int, k: int) -> DataFrame:
    """(m, bag, members): documents with equal bags and weights, at most ``k``
    of them by ascending id."""
    m = F.expr(f"25 + (75L * n * {documents}L) div {max(total, 1)}L")
    rows = bags.where("length(bag) > 0").withColumn("m", m).withColumn("class", F.xxhash64("m", "bag"))
    order = Window.partitionBy("class", "m", "bag").orderBy(F.col("doc").asc_nulls_last())
    return (rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
            .groupBy("class", "m", "bag").agg(F.collect_list(F.struct("place", "doc")).alias("members"))
            .select("m", "bag", F.transform(F.array_sort("members"), lambda x: x["doc"]).alias("members")))


def _best(classes_: DataFrame, sent, weight: np.ndarray, k: int) -> DataFrame:
    """(item, id, score, doc): of every task the best ``k`` documents per item."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: _Items = sent.value
        best: list[list[tuple]] = [[] for _ in range(items.number)]  # (-score, id is null, id), ascending
        least = np.ones(items.number, np.int64)  # a score that may still enter
        step = max(1, CELLS // max(1, items.number))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                term, tf, row = _unpacked(batch.column(1))
                m = batch.column(0).to_numpy()
                value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                cells = items.scores(term, value, row, batch.num_rows)
                members = batch.column(2).to_pylist()
                first = [ids[0] for ids in members]
                null = np.array([i is None for i in first])
                smallest = np.array([i or 0 for i in first], np.int64)
                bar = least if batch.num_rows <= k else np.maximum(least, np.partition(cells, -k, axis=0)[-k])
                where, which = np.nonzero(cells >= bar)
                order = np.lexsort((smallest[where], null[where], -cells[where, which], which))
                where, which = where[order], which[order]
                begin = np.searchsorted(which, np.arange(items.number + 1))
                for j in np.flatnonzero(np.diff(begin)).tolist():
                    rows = where[begin[j]:begin[j + 1]][:k].tolist()
                    new = [(-int(cells[r, j]), i is None, i or 0) for r in rows for i in members[r]]
                    best[j] = heapq.nsmallest(k, best[j] + new)
                    if len(best[j]) == k:
                        least[j] = max(1, -best[j][-1][0])
        out = [(j, items.ids[j], -s, None if null else i) for j, top in enumerate(best) for s, null, i in top]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([],) * 4)], names=["item", "id", "score", "doc"])

    return classes_.mapInArrow(score, "item long, id long, score long, doc long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents of those
    with a score above 0. ``docs`` is read once for each block of items."""
    spark = docs.sparkSession
    items = stored(items.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).distinct())
    held, number = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil((held or 0) / block_bytes), math.ceil(number / BLOCK_ITEMS))
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    parts = []
    for b in range(blocks):
        asked = items.where(F.col("block") == b).collect()
        if not asked:
            continue
        sent = spark.sparkContext.broadcast(_Items([r.id for r in asked], [r.text for r in asked]))
        bags = stored(_bags(docs, id_col, text_col, sent), codec="zstd")
        documents, total = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        df = _document_counts(bags, len(sent.value.term))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        best = _best(classes(bags, documents, total or 0, k), sent, weight, k)
        parts.append(best.withColumn("block", F.lit(b)))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return (reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("id").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"))
