"""URL filters: host and path rules, then a character language-model ratio.

A rule names a host and a path; it fits that host and its subdomains when the
url's path begins with the rule's path, and the longest fitting rule decides.
What no rule fits is judged by two smoothed variable-order Markov models over
the bytes of host and path, one of accepted and one of rejected urls: those that
rules allow and block. The probability of a byte blends all orders, from none
to ``ORDER`` bytes of context: each order's counts are smoothed by the order
below, so a context that was never seen leaves the shorter one's estimate. The
difference of the two log-likelihoods, divided by the length, is the score. The
models learn from four fifths of the ruled urls, by hash; on the last fifth the
threshold is set where the two classes' error rates sum to the least.

Counts go into ``SLOTS`` slots by hash, per class, in each task and then over
all tasks, so the model has one size for any number of urls.

Defined results: a null url, or one without ``://``, has an empty host and path
and the score of an empty text; without ruled urls of both classes every score
is 0 and the threshold 0, so all are allowed; repeated rows are judged and
counted each; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import _M1, mix, slices, text_bytes

#: (rule, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
ORDER = 5
SLOTS = 1 << 18
#: Pseudo-count of the lower order's estimate.
PRIOR = 2.0
FOLDS = 5
#: Score histogram for the threshold: this many bins from -LIMIT to LIMIT.
BINS, LIMIT = 2000, 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(_u, locate('://', _u) + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _grams(data: np.ndarray, offsets: np.ndarray):
    """(slots of contexts, slots of context and byte) per order, for each byte
    and the end of each text, and the texts' sizes."""
    size = np.diff(offsets) + 1
    n = len(size)
    wide = size + ORDER
    first = np.cumsum(wide) - wide
    body = np.zeros(int(wide.sum()), np.uint64)  # ORDER marks before each text
    text = np.repeat(np.arange(n), size - 1)
    body[np.arange(len(text)) - (offsets[:-1] - offsets[0])[text] + (first + ORDER)[text]] = data[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(2)
    body[first + wide - 1] = 1
    at = np.concatenate([np.arange(s + ORDER, s + w) for s, w in zip(first.tolist(), wide.tolist(), strict=True)]) if n else np.zeros(0, np.int64)
    h = np.full(len(at), np.uint64(0x51ED270B0A1F39C1))
    shift = np.uint64(64 - SLOTS.bit_length() + 1)
    contexts, grams = [], []
    for k in range(ORDER + 1):
        if k:
            h = mix(h * _M1 + body[at - k] + np.uint64(k << 10))
        contexts.append((mix(h) >> shift).astype(np.int64))
        grams.append((mix(h * _M1 + (body[at] << np.uint64(20))) >> shift).astype(np.int64))
    return contexts, grams, size


def _scores(data: np.ndarray, offsets: np.ndarray, model: np.ndarray) -> np.ndarray:
    """``model``: [class][contexts, grams][slot] counts."""
    contexts, grams, size = _grams(data, offsets)
    total = []
    for counts in model:
        p = np.full(len(grams[0]), 1 / 257)
        for c, g in zip(contexts, grams, strict=True):
            p = (counts[1][g] + PRIOR * p) / (np.maximum(counts[0][c], counts[1][g]) + PRIOR)
        total.append(np.log(p))
    return np.add.reduceat(total[0] - total[1], np.cumsum(size) - size) / size


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, score, verdict) per row; score is null where
    a rule decides."""
    spark = pages.sparkSession
    url = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("_u"))
    host, path = host_and_path(F.col("_u"))
    rows = url.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    ruled = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.create_map(*[F.lit(x) for r in rules for x in r])[F.col("rule")] if rules else F.lit(None).cast("string")
    known = ruled.select(F.concat("host", "path").alias("text"), verdict.alias("verdict")).where(F.col("verdict").isNotNull())
    known = known.select("text", (F.col("verdict") == "block").cast("int").alias("class"), (F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0).alias("held"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, 2, SLOTS), np.int64)
        for batch in batches:
            for c in (0, 1):
                part = batch.filter(pa.array(batch.column(1).to_numpy() == c))
                data, offsets = text_bytes(part.column(0))
                for i, j in slices(offsets, 1 << 18):
                    contexts, grams, _ = _grams(data, offsets[i:j + 1])
                    for kind, slots in ((0, contexts), (1, grams)):
                        table[c, kind] += np.bincount(np.concatenate(slots), minlength=SLOTS)
        on = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(table.ravel()[on])], names=["slot", "n"])

    # at most 4 * SLOTS rows come back
    learned = known.where(~F.col("held")).select("text", "class").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(4 * SLOTS)
    table[learned.column("slot").to_numpy()] = learned.column("n").to_numpy()
    table = table.reshape(2, 2, SLOTS).astype(np.float32)
    both = bool(table[0].any() and table[1].any())
    sent = spark.sparkContext.broadcast(table)

    def score(col: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(col)
        made = [_scores(data, offsets[i:j + 1], sent.value) for i, j in slices(offsets, 1 << 18)]
        return np.concatenate(made) if made and both else np.zeros(len(col))

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros((2, BINS), np.int64)
        for batch in batches:
            at = np.clip((score(batch.column(0)) + LIMIT) * BINS / (2 * LIMIT), 0, BINS - 1).astype(np.int64)
            for c in (0, 1):
                bins[c] += np.bincount(at[batch.column(1).to_numpy() == c], minlength=BINS)
        on = np.flatnonzero(bins)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(bins.ravel()[on])], names=["bin", "n"])

    seen = known.where("held").select("text", "class").mapInArrow(histogram, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect() if both else []
    bins = np.zeros(2 * BINS)
    for at, n in seen:
        bins[at] = n
    threshold = threshold_of(bins.reshape(2, BINS)) if both else 0.0

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(score(batch.column(4)), mask=~batch.column(3).is_null().to_numpy(False))],
                                             names=["page_id", "host", "path", "rule", "score"])

    kind = rows.schema["page_id"].dataType.simpleString()
    text = F.when(F.col("rule").isNull(), F.concat("host", "path")).otherwise("")
    judged = ruled.withColumn("text", text).mapInArrow(decide, f"page_id {kind}, host string, path string, rule string, score double")
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return judged.withColumn("verdict", F.coalesce(verdict, by_model))


def threshold_of(bins: np.ndarray) -> float:
    """Lower edge of the bin from which on urls are accepted: least sum of the
    share of accepted urls below and of rejected urls from there on; of equal
    sums, the middle edge."""
    share = bins / np.maximum(bins.sum(1, keepdims=True), 1)
    below = np.concatenate((np.zeros((2, 1)), np.cumsum(share, 1)), 1)
    error = below[0] + (1 - below[1])
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(best[len(best) // 2] * 2 * LIMIT / BINS - LIMIT)
