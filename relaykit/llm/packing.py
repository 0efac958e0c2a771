"""Best-fit packing with exact-complement hashing.

Texts become token ids; a text of more than ``size`` ids is cut into pieces.
What fits with what depends on lengths alone, and there are at most ``size`` of
them, so the plan is made from the histogram of lengths: a few thousand counts,
whatever the corpus. For the longest piece that is left, the plan looks up its
gap among the lengths there are, then among sums of two and of three of them,
and uses the combination as often as the counts of its lengths allow. A gap
that no sum meets takes the best fit, the longest piece that goes in, and is
looked up again. The result is a list of patterns, each used many times.

Pieces find their places by rank: within a length, pieces are numbered by salted
ranks (a length that a third of all pieces have is numbered in many tasks), and
the n-th piece of a length goes to its n-th place in the plan.

Defined results: a null or empty text is one piece of the closing id alone;
repeated rows are packed each; ids may repeat or be null; an empty table gives
no pieces; other columns pass through.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

SIZE = 4096
END_ID = 1
#: Words whose ids a task keeps at hand.
WORDS = 600_000
SALTS = 64


#: From here on, letters and case may differ between Unicode versions.
_PLAIN = "\u0250"
#: Marks that are words of their own after a letter; not ', which opens 's and 't.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a printable letter: printable
    Latin-1 as itself, the others in order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Ids(dict):
    """Ids of a white-space word as little-endian unsigned 32-bit bytes.

    The tokenizer's words never go over white space, so a text's ids are those
    of its words, one after the other. A word of plain lower-case letters is a
    tokenizer's word as it stands and goes to its model at once; marks after a
    letter are a word apart."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()

    def text(self, text: str) -> bytes:
        if "<|" in text:  # control strings are matched before case is folded
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = text.encode().lower().decode().replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, words))

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        stem = word.rstrip(_MARKS)
        if not word:
            ids = b""
        elif len(stem) < len(word) and stem[-1:].isalpha() and stem[-1] < _PLAIN:
            ids = self[stem] + self[word[len(stem):]]
        elif word.isalpha() and max(word) < _PLAIN and word == word.lower():  # composed as it stands
            if not word.isascii():
                word_ = word.encode().decode("latin-1").translate(self.letters)
                ids = self.pack([t.id for t in self.model.tokenize(word_)])
            else:
                ids = self.pack([t.id for t in self.model.tokenize(word)])
        else:
            ids = self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids


def token_pieces(docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Rows of ``docs`` without the text, one per piece, with piece (from 0),
    start, length and ids (binary: little-endian unsigned 32-bit)."""
    names = [c for c in docs.columns if c not in (text_col, "piece", "start", "length", "ids")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("_")).alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    closing = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                row, piece, start, length, ids = [], [], [], [], []
                for k, text in enumerate(part.column(1)):
                    got = known.text(text.as_py() or "") + closing
                    for n, at in enumerate(range(0, len(got), 4 * size)):
                        row.append(k)
                        piece.append(n)
                        start.append(at // 4)
                        ids.append(got[at:at + 4 * size])
                        length.append(len(ids[-1]) // 4)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())], names=["row", "piece", "start", "length", "ids"])

    made = rows.mapInArrow(cut, f"row {kind}, piece int, start long, length long, ids binary")
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "piece", "start", "length", "ids")


class _Counts:
    """Pieces left of each length, and the sums that they make."""

    def __init__(self, count: np.ndarray):
        self.count = count
        self.there = count > 0

    def take(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.count[x] -= times
            if self.count[x] == 0:
                self.there[x] = False

    def times(self, lengths: list[int]) -> int:
        return min(int(self.count[x]) // lengths.count(x) for x in lengths)

    def two(self, gap: int) -> list[int] | None:
        """The most unequal two lengths that fill the gap."""
        if gap < 2:
            return None
        half = gap // 2
        low = self.there[1:half + 1] & self.there[gap - 1:gap - half - 1:-1]
        for x in (np.flatnonzero(low) + 1).tolist():
            if 2 * x != gap or self.count[x] >= 2:
                return [gap - x, x]
        return None

    def fill(self, gap: int, beside: list[int]) -> list[int] | None:
        """One, two or three lengths whose sum is the gap."""
        held = [x for x in beside]
        for x in held:  # not the pieces that the sequence already has
            self.count[x] -= 1
            self.there[x] = self.count[x] > 0
        try:
            if gap < len(self.there) and self.there[gap]:
                return [gap]
            if (pair := self.two(gap)) is not None:
                return pair
            for x in np.flatnonzero(self.there[1:gap - 1])[::-1].tolist():
                x += 1
                if 3 * x < gap:
                    break
                self.count[x] -= 1
                self.there[x] = self.count[x] > 0
                pair = self.two(gap - x)
                self.count[x] += 1
                self.there[x] = True
                if pair is not None:
                    return [x, *pair]
            return None
        finally:
            for x in held:
                self.count[x] += 1
                self.there[x] = True

    def best(self, gap: int, beside: list[int]) -> int | None:
        """The longest length that goes into the gap."""
        for x in np.flatnonzero(self.there[1:gap + 1])[::-1].tolist():
            if self.count[x + 1] > beside.count(x + 1):
                return x + 1
        return None


def plan(lengths: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences) that use up all pieces."""
    count = np.zeros(size + 1, np.int64)
    for x, n in lengths.items():
        count[x] = n
    left, patterns = _Counts(count), []
    for seed in range(size, 0, -1):
        while count[seed] > 0:
            held, gap = [seed], size - seed
            while gap:
                if (rest := left.fill(gap, held)) is not None:
                    held, gap = held + rest, 0
                elif (x := left.best(gap, held)) is not None:
                    held, gap = [*held, x], gap - x
                else:
                    break
            times = left.times(held)
            left.take(held, times)
            patterns.append((held, times))
    return patterns


def places(patterns: list[tuple[list[int], int]], size: int = SIZE) -> dict[str, np.ndarray]:
    """The plan by length: rank ``rank`` and on of ``length`` goes into the
    sequences from ``sequence`` on, at ``offset``; ``key`` sorts by both."""
    used = np.zeros(size + 1, np.int64)
    out, first = [], 0
    for held, times in patterns:
        offset = 0
        for x in held:
            out.append((x, used[x], first, offset))
            used[x] += times
            offset += x
        first += times
    rows = np.array(out, np.int64).reshape(-1, 4)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return {"length": rows[:, 0], "rank": rows[:, 1], "sequence": rows[:, 2], "offset": rows[:, 3],
            "bounds": np.searchsorted(rows[:, 0], np.arange(size + 2))}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (any columns, with length from 1 to ``size``) with
    sequence_id and offset. ``pieces`` is read twice: give a stored table."""
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    salted = pieces.select(*[F.col(f"`{c}`") for c in names]).withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names if c != "ids"]), F.lit(SALTS)).cast("int"))
    # at most size * SALTS rows
    counts = [tuple(r) for r in salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n")).orderBy("length", "_salt").collect()]
    base = np.zeros((size + 1) * SALTS, np.int64)
    total: dict[int, int] = {}
    for length, salt, n in counts:
        base[length * SALTS + salt] = total.get(length, 0)
        total[length] = total.get(length, 0) + n
    sent = pieces.sparkSession.sparkContext.broadcast((base, places(plan(total, size), size)))
    order = Window.partitionBy("length", "_salt").orderBy(*[F.col(f"`{c}`") for c in names if c not in ("ids", "length")])
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1)
    slim = ranked.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "length", "_salt", "_rank")
    kind = slim.schema["row"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, where = sent.value
        for batch in batches:
            length, salt, rank = (batch.column(k).to_numpy() for k in (1, 2, 3))
            rank = rank + base[length * SALTS + salt]
            # places of a length lie together, by rank: one search for the batch
            step = np.int64(max(int(where["rank"].max(initial=0)), int(rank.max(initial=0))) + 1)
            at = np.searchsorted(where["length"] * step + where["rank"], length * step + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(where["sequence"][at] + rank - where["rank"][at]), pa.array(where["offset"][at])],
                names=["row", "sequence_id", "offset"])

    done = slim.mapInArrow(place, f"row {kind}, sequence_id long, offset long")
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, text_col: str = "text", size: int = SIZE, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """Token pieces of ``docs`` with their places. ``digest``: ids_crc32
    stands in for the ids, so that they need not be stored or moved."""
    pieces = token_pieces(docs, tokenizer, text_col, size, end_id)
    if digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stored(pieces), size)
