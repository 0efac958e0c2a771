"""Keys of all events that earlier runs delivered, for tables far larger than a run.

The keys lie in a table bucketed by key; a run's keys move to its buckets, the
table itself is never shuffled. Most rows of a run are new and need not ask it:
a Bloom filter tells them apart first. It is a table too, of blocks of 256 bits
(about 1.5 bytes a key, bucketed by block): a key sets ``BITS`` bits of one block, and
a row joins the block of its key. Rows that the filter does not know are new;
the others are held against the keys themselves, so the result is exact and a
full filter only sends more rows there.

Blocks are written before keys: a job that died in between leaves a filter that
knows too much, never too little. Adding keys twice changes no result.

A null part of a key is a value like any other (:func:`dedupe.delivery_key`).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedupe import delivery_key

#: Bits of a block, as longs, and bits that a key sets (8 for each byte of a hash).
WORDS, BITS = 4, 8
#: Bits of the filter for each key of its capacity.
BITS_PER_KEY = 12


def _block(blocks: int, key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: str) -> list[Column]:
    """The bits that a key sets in its block, one long per word: the bytes of a
    second hash are bit numbers."""
    h = F.xxhash64(key, F.lit(1))
    masks = []
    for word in range(WORDS):
        mask = F.lit(0).cast("long")
        for k in range(BITS):
            bit = F.shiftright(h, 8 * k).bitwiseAND(F.lit(64 * WORDS - 1))
            one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
            mask = mask.bitwiseOR(F.when(F.shiftright(bit, 6) == word, one).otherwise(F.lit(0).cast("long")))
        masks.append(mask.alias(f"m{word}"))
    return masks


class DeliveredKeys:
    """Delivered keys under ``path``. ``buckets`` and ``capacity`` (keys that the
    filter is made for) belong to the path: give the same ones every time, or
    the tables do not fit."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024, capacity: int = 1_000_000_000):
        self.spark, self.buckets = spark, buckets
        self.blocks = max(1, -(-capacity * BITS_PER_KEY // (64 * WORDS)))
        name = hashlib.md5(f"{path}|{buckets}|{self.blocks}".encode()).hexdigest()[:16]
        self.key_table, self.block_table = f"delivered_keys_{name}", f"delivered_blocks_{name}"
        words = ", ".join(f"m{w} BIGINT" for w in range(WORDS))
        base = f"{path.rstrip('/')}/{buckets}-{self.blocks}"
        for table, columns, by in ((self.key_table, "delivery_key STRING", "delivery_key"), (self.block_table, f"block BIGINT, {words}", "block")):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{base}/{by}'")

    def add(self, payloads: DataFrame) -> None:
        """Record the keys of delivered ``payloads`` (table_name, dt,
        user_unique_id, et, params)."""
        keys = payloads.select(delivery_key().alias("delivery_key")).distinct()
        words = [f"m{w}" for w in range(WORDS)]
        bits = (keys.select(_block(self.blocks, "delivery_key").alias("block"), *_masks("delivery_key"))
                .groupBy("block").agg(*[F.bit_or(w).alias(w) for w in words]))
        # rows of a bucket in one task: one file per bucket and run
        bits.repartition(self.buckets, "block").write.insertInto(self.block_table)
        keys.repartition(self.buckets, "delivery_key").write.insertInto(self.key_table)

    def known(self) -> DataFrame:
        return self.spark.table(self.key_table)

    def filter_blocks(self) -> DataFrame:
        """The filter: a block's bits of all runs (grouped within its bucket)."""
        words = [f"m{w}" for w in range(WORDS)]
        return self.spark.table(self.block_table).groupBy("block").agg(*[F.bit_or(w).alias(f"known_{w}") for w in words])

    def flagged(self, payloads: DataFrame) -> DataFrame:
        """``payloads`` with delivery_key and ``maybe``: false is surely new."""
        keyed = payloads.withColumn("delivery_key", delivery_key())
        asked = keyed.select("*", _block(self.blocks, "delivery_key").alias("block"))
        both = asked.join(self.filter_blocks().hint("merge"), "block", "left")
        maybe = F.lit(True)
        for w, mask in enumerate(_masks("delivery_key")):
            maybe = maybe & (F.coalesce(F.col(f"known_m{w}"), F.lit(0).cast("long")).bitwiseAND(mask) == mask)
        return both.select(*keyed.columns, maybe.alias("maybe"))

    def not_delivered(self, payloads: DataFrame) -> DataFrame:
        """Rows of ``payloads``, with delivery_key, whose key is not recorded;
        rows that repeat within ``payloads`` all stay."""
        flagged = self.flagged(payloads)
        asked = flagged.where("maybe").join(self.known().hint("merge"), "delivery_key", "left_anti")
        return flagged.where("not maybe").unionByName(asked).drop("maybe")
