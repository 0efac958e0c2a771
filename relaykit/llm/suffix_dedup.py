"""Suffix-array dedup: every byte of a 400-byte string that starts twice goes.

A suffix array of all bytes would move the corpus many times over. Two equal
400-byte strings hold the same anchors, though: the positions whose 200-byte
gram has the least hash of any in such a string. So only suffixes at anchors
are sorted (about one byte in a hundred), and the array is split by gram, as
suffixes that agree for 400 bytes have the same gram.

1. *Anchors.* One scan gives each anchor's gram hash and the hash of its
   surroundings (200 bytes before, 400 after; less at the ends of a text).
   Anchors with equal surroundings are repeats as they stand. A map task folds
   its own to one row, so a hot passage costs a row per task.
2. *Grams* with unequal surroundings send one suffix for each of those, bytes
   and all, to the task of the gram.
3. *Common-prefix interval tree.* There the suffixes are sorted, common prefixes
   of neighbours taken, and a stack scan lists the tree's intervals: all
   suffixes that share that many bytes to the right. Within an interval, order
   by the bytes to the left tells whether its members differ there or extend
   together: members that agree for l bytes to the left and r to the right are
   occurrences of one maximal repeat, and with l + r >= 400 each of them, not
   just neighbours, has those bytes removed.
4. A gram with very many surroundings (a hot passage set in ever new text) is
   not sent to one task: the 400-byte strings around its anchors are counted by
   hash instead, combined before the shuffle.

Defined results: null texts are empty; texts under 400 bytes lose nothing;
matches never cross texts; repeated rows match each other, so both go; a null
id is an id like any other; other columns pass through or are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import _M1, SPACE, mix, prefix_hash, slices, small, span_hash, stored, text_bytes

#: Bytes of a repeat and of the gram at an anchor, unless given.
WINDOW, GRAM = 400, 200
#: Bytes of a text that are scanned at once.
SEGMENT = 1 << 21
#: Suffixes of one gram that are sorted in one task; beyond, strings are counted.
HOT_GRAM = 20_000

_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, width: int, op: Callable) -> np.ndarray:
    """``op`` over each ``width`` neighbours, in log2(width) passes."""
    size = 1
    while 2 * size <= width:
        x = op(x[:len(x) - size], x[size:])
        size *= 2
    return op(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def anchors(data: np.ndarray, offsets: np.ndarray, windows: tuple[int, int] | None = None, window: int = WINDOW, gram_size: int = GRAM):
    """(text index, place in the text, gram hash, hash of the surroundings,
    bytes before, bytes after) of the anchors of the texts between ``offsets``.
    ``windows``: only those of strings that start in this range."""
    reach = window - gram_size
    none = np.zeros(0, np.int64)
    base = int(offsets[0])
    body = data[base:int(offsets[-1])]
    starts, ends = offsets[:-1] - base, offsets[1:] - base
    if len(body) < window:
        return none, none, none, none, none, none
    h = prefix_hash(body)
    left = np.repeat(ends, ends - starts) - np.arange(len(body))  # bytes up to the end of the text
    gram = np.full(len(body), _MAX)
    on = np.flatnonzero(left >= gram_size)
    gram[on] = np.clip(span_hash(h, on, on + gram_size), np.uint64(1), _MAX - np.uint64(1))
    least = _slide(gram, reach + 1, np.minimum)
    least[left[:len(least)] < window] = 0
    if windows is not None:
        least[:windows[0]] = 0
        least[windows[1]:] = 0
    most = _slide(np.concatenate((np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64))), reach + 1, np.maximum)
    at = np.flatnonzero(gram == most[:len(gram)])
    doc = np.searchsorted(ends, at, "right")
    before, after = np.minimum(at - starts[doc], reach), np.minimum(left[at], window)
    ctx = mix(span_hash(h, at - before, at + after) + (before * 4096 + after).astype(np.uint64) * _M1)
    return doc, at - starts[doc], gram[at].view(np.int64), ctx.view(np.int64), before, after


def _anchors_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram_size: int = GRAM):
    """The same, for texts of any length: long ones in overlapping segments."""
    reach = window - gram_size
    for i, j in slices(offsets, SEGMENT // 2):
        if offsets[j] - offsets[i] <= 2 * SEGMENT:
            doc, *rest = anchors(data, offsets[i:j + 1], None, window, gram_size)
            yield (doc + i, *rest)
            continue
        a, z = int(offsets[i]), int(offsets[j])
        found = []
        for s in range(a, z, SEGMENT):
            lo, hi = max(a, s - reach), min(z, s + SEGMENT + 2 * window)
            doc, at, gram, ctx, before, after = anchors(data, np.array([lo, hi]), (s - lo, s - lo + SEGMENT), window, gram_size)
            found.append(np.stack((at + (lo - a), gram, ctx, before, after)))
        found = np.concatenate(found, 1)
        _, first = np.unique(found[0], return_index=True)
        yield (np.full(len(first), i), *found[:, first])


class SparseMin:
    """Minimum of any range of ``x`` in two look-ups."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        while len(self.rows[-1]) > (step := 1 << (len(self.rows) - 1)):
            self.rows.append(np.minimum(self.rows[-1][:-step], self.rows[-1][step:]))
        wide = max(len(r) for r in self.rows)
        self.table = np.stack([np.pad(r, (0, wide - len(r))) for r in self.rows])
        self.log = np.concatenate(([0], np.floor(np.log2(np.arange(1, len(x) + 2))).astype(np.int64)))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of x[a:b], a < b."""
        k = self.log[b - a]
        return np.minimum(self.table[k, a], self.table[k, b - (1 << k)])


def _sorted_prefixes(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix of each with the next) of byte strings of at most
    ``width`` bytes. Bytes are shifted by one, as 0xFF is not in UTF-8, so the
    padding sorts first and equals no byte."""
    size = np.array([len(p) for p in parts])
    flat = np.frombuffer(b"".join(parts), np.uint8)
    table = np.zeros((len(parts), width), np.uint8)
    table[np.arange(width) < size[:, None]] = flat + np.uint8(1)
    order = np.argsort(table.view(f"S{width}").ravel(), kind="stable")
    table, size = table[order], size[order]
    differ = table[1:] != table[:-1]
    same = np.where(differ.any(1), differ.argmax(1), width)
    return order, np.minimum(same, np.minimum(size[1:], size[:-1]))


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of the common-prefix array: (length, first, last) of every
    interval of the tree whose members share ``least`` bytes or more, inner
    intervals before outer ones."""
    stack: list[tuple[int, int]] = []
    values = common.tolist()
    values.append(-1)
    for i, now in enumerate(values):
        first = i
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def repeats(lefts: list[bytes], rights: list[bytes], window: int = WINDOW, gram_size: int = GRAM) -> list[tuple[int, int, int]]:
    """(suffix, bytes to the left, bytes to the right) of every occurrence of a
    maximal repeat of window bytes or more around the anchors. ``lefts`` are
    the bytes before them, last byte first."""
    order, common = _sorted_prefixes(rights, window)
    by_left, agree = _sorted_prefixes(lefts, (window - gram_size))
    rank = np.empty(len(by_left), np.int64)
    rank[by_left] = np.arange(len(by_left))
    shared = SparseMin(agree)
    reached = np.full(len(order), -1)
    out = []
    for length, first, last in intervals(common, gram_size):
        members = order[first:last + 1]
        place = rank[members]
        turn = np.argsort(place)
        members, place = members[turn], place[turn]
        ext = shared(place[:-1], place[1:])  # left extension shared with the next member
        far = np.concatenate((ext, [-1]))
        far[1:] = np.maximum(far[1:], ext)
        # members whose left extensions differ part here; those that still agree
        # for long enough are one repeat, unless an inner interval had it whole
        hit = (far + length >= window) & (far > reached[members])
        for m, left in zip(members[hit].tolist(), far[hit].tolist(), strict=True):
            out.append((m, left, length))
        reached[members[hit]] = far[hit]
    return out


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ROW = pa.schema([("kind", pa.int8()), ("gram", pa.int64()), ("ctx", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                  ("a", pa.int32()), ("b", pa.int32()), ("many", pa.bool_())])
_ROW_SQL = "kind byte, gram long, ctx long, doc_id long, th long, a int, b int, many boolean"
#: kind of a row: an anchor (a: place, b: bytes after it), a span to remove
#: (a to b), an anchor whose suffix is to be sorted.
_ANCHOR, _SPAN, _SORT = 0, 1, 2


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_gram: int = HOT_GRAM,
                   window: int = WINDOW, gram_size: int = GRAM) -> DataFrame:
    """(doc_id, th, start, end, gram): the bytes of every occurrence of every
    repeat, possibly overlapping; th is xxhash64 of the text, gram names the
    anchor that the occurrences share."""
    reach = window - gram_size
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for doc, at, gram, ctx, _, after in _anchors_of(data, offsets, window, gram_size):
                rows = pa.array(doc)
                held.append((gram, ctx, batch.column(0).take(rows), batch.column(2).take(rows), at, after))
                size += len(doc)
            if size > 1_000_000:
                yield from fold(held)
                held, size = [], 0
        if size:
            yield from fold(held)

    def fold(held) -> Iterator[pa.RecordBatch]:
        gram, ctx, at, after = (np.concatenate([x[k] for x in held]) for k in (0, 1, 4, 5))
        ids, th = (pa.concat_arrays([x[k] for x in held]) for k in (2, 3))
        order = np.lexsort((ctx, gram))
        new = np.concatenate(([True], (gram[order][1:] != gram[order][:-1]) | (ctx[order][1:] != ctx[order][:-1])))
        times = np.diff(np.append(np.flatnonzero(new), len(order)))
        first, many = order[new], times > 1
        yield _batch(_ROW, np.full(len(first), _ANCHOR), gram[first], ctx[first], ids.take(pa.array(first)), th.take(pa.array(first)),
                     at[first], after[first], many)
        twice = order[np.repeat(many, times)]
        if len(twice):
            yield _batch(_ROW, np.full(len(twice), _SPAN), gram[twice], ctx[twice], ids.take(pa.array(twice)), th.take(pa.array(twice)),
                         np.maximum(at[twice] - reach, 0), at[twice] + after[twice], np.ones(len(twice), bool))

    found = stored(texts.mapInArrow(scan, _ROW_SQL))
    marks = found.where(F.col("kind") == _ANCHOR)
    hot = stored(marks.groupBy("gram").count().where(F.col("count") > hot_gram).select("gram"))
    side = small(hot)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if got is None or not got.num_rows:
            return
        gram, ctx, at, after = (got.column(k).to_numpy() for k in (1, 2, 5, 6))
        many = got.column(7).to_numpy()
        ids, th = got.column(3).combine_chunks(), got.column(4).combine_chunks()
        order = np.lexsort((ctx, gram))
        g, c = gram[order], ctx[order]
        new_gram = np.concatenate(([True], g[1:] != g[:-1]))
        new = new_gram | np.concatenate(([True], c[1:] != c[:-1]))
        lead = np.flatnonzero(new)
        times = np.diff(np.append(lead, len(order)))
        seen_twice = (times > 1) | np.add.reduceat(many[order].astype(np.int64), lead).astype(bool)
        group = np.cumsum(new_gram[lead]) - 1
        wide = np.bincount(group)[group] > 1  # grams with more than one kind of surroundings

        span = order[np.repeat(seen_twice, times)]
        span = span[~many[span]]  # the others' spans went out with their task's
        if len(span):
            yield _batch(_ROW, np.full(len(span), _SPAN), gram[span], ctx[span], ids.take(pa.array(span)), th.take(pa.array(span)),
                         np.maximum(at[span] - reach, 0), at[span] + after[span], np.ones(len(span), bool))
        ship = order[lead[wide]]
        if len(ship):
            yield _batch(_ROW, np.full(len(ship), _SORT), gram[ship], ctx[ship], ids.take(pa.array(ship)), th.take(pa.array(ship)),
                         at[ship], after[ship], seen_twice[wide])

    settled = stored(marks.join(side, "gram", "left_anti").select(*[f.name for f in _ROW]).repartition("gram").mapInArrow(settle, _ROW_SQL))

    def with_text(rows: DataFrame) -> DataFrame:
        per_doc = rows.groupBy("doc_id", "th").agg(F.collect_list(F.struct("gram", "a", "many")).alias("marks"))
        same = texts.alias("t").join(per_doc.alias("m"), F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.th") == F.col("m.th")))
        return same.select("t.doc_id", "t.th", F.col("t.text").cast("binary").alias("body"), "marks")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_id, th, body = (batch.column(c)[k].as_py() for c in range(3))
                picked = batch.column(3)[k].as_py()
                for cut in range(0, len(picked), 5_000):
                    part = picked[cut:cut + 5_000]
                    yield pa.RecordBatch.from_pydict(
                        {"gram": [m["gram"] for m in part], "many": [m["many"] for m in part], "doc_id": pa.array([doc_id] * len(part), pa.int64()),
                         "th": [th] * len(part), "at": pa.array([m["a"] for m in part], pa.int32()),
                         "before": [body[max(m["a"] - reach, 0):m["a"]][::-1] for m in part],
                         "after": [body[m["a"]:m["a"] + window] for m in part]})

    def sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole grams at a time, a few thousand suffixes together."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size > 8_000:
                table = pa.Table.from_batches(held).combine_chunks()
                gram = table.column(0).to_numpy()
                cut = int(np.searchsorted(gram, gram[min(8_000, size - 1)]))  # keeps the last gram whole
                if cut == 0:
                    cut = int(np.searchsorted(gram, gram[0], "right"))
                    if cut == size:
                        break
                yield from solve(table.slice(0, cut))
                held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield from solve(pa.Table.from_batches(held))

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        many = table.column("many").to_numpy()
        hits = [x for x in repeats(table.column("before").to_pylist(), table.column("after").to_pylist(), window, gram_size) if not many[x[0]]] if table.num_rows > 1 else []
        if hits:
            who, left, right = (np.array(x) for x in zip(*hits, strict=True))
            at = table.column("at").to_numpy()[who]
            rows = pa.array(who)
            yield _batch(_ROW, np.full(len(who), _SPAN), *(table.column(c).take(rows).combine_chunks() for c in ("gram", "gram", "doc_id", "th")),
                         at - left, at + right, np.zeros(len(who), bool))

    shape = "gram long, many boolean, doc_id long, th long, at int, before binary, after binary"
    sorted_ = (with_text(settled.where(F.col("kind") == _SORT)).mapInArrow(suffixes, shape).repartition("gram")
               .sortWithinPartitions("gram", "doc_id", "th", "at").mapInArrow(sort_suffixes, _ROW_SQL))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every window-byte string around the anchors of hot grams, by hash."""
        for batch in batches:
            for k in range(batch.num_rows):
                body = np.frombuffer(batch.column(2)[k].as_py(), np.uint8)
                done = 0  # a string around two anchors counts once
                for at, gram in sorted((m["a"], m["gram"]) for m in batch.column(3)[k].as_py()):
                    lo, hi = max(at - reach, done), min(at, len(body) - window)
                    if hi < lo:
                        continue
                    done = hi + 1
                    starts = np.arange(lo, hi + 1)
                    part = prefix_hash(body[lo:hi + window])
                    n = len(starts)
                    yield pa.RecordBatch.from_pydict(
                        {"string": span_hash(part, starts - lo, starts - lo + window).view(np.int64), "gram": np.full(n, gram),
                         "doc_id": batch.column(0).take(pa.array(np.full(n, k))), "th": batch.column(1).take(pa.array(np.full(n, k))),
                         "start": pa.array(starts, pa.int32())})

    spans = [found.where(F.col("kind") == _SPAN), settled.where(F.col("kind") == _SPAN), sorted_]
    out = [s.select("doc_id", "th", F.col("a").alias("start"), F.col("b").alias("end"), "gram") for s in spans]
    if not hot.isEmpty():
        # rows that a task folded stand for more than one string each
        near = with_text(marks.join(side, "gram", "left_semi"))
        each = near.mapInArrow(strings, "string long, gram long, doc_id long, th long, start int")
        twice = each.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
        out.append(each.join(twice, "string").select("doc_id", "th", "start", (F.col("start") + window).alias("end"), "gram"))
    total = out[0]
    for more in out[1:]:
        total = total.unionByName(more)
    return total


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [(a, b) for a, b in runs]


def whole_words(body: bytes, a: int, b: int) -> int:
    """Words of ``body`` that lie in body[a:b] as a whole."""
    if a and not body[a - 1:a].isspace():
        while a < b and not body[a:a + 1].isspace():
            a += 1
    if b < len(body) and not body[b:b + 1].isspace():
        while b > a and not body[b - 1:b].isspace():
            b -= 1
    return len(body[a:b].split())


def whole_characters(body: bytes, a: int, b: int) -> tuple[int, int]:
    """body[a:b] with the rest of the UTF-8 characters that it cuts."""
    while a > 0 and body[a] & 0xC0 == 0x80:
        a -= 1
    while b < len(body) and body[b] & 0xC0 == 0x80:
        b += 1
    return a, b


def seamed(parts: list[bytes]) -> bytes:
    """The parts that are not empty, with a blank where two words would meet."""
    out = b""
    for part in parts:
        if out and part and not SPACE[out[-1]] and not SPACE[part[0]]:
            out += b" "
        out += part
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_gram: int = HOT_GRAM,
                   window: int = WINDOW, gram_size: int = GRAM, over_words: int = -1, as_text: bool = False) -> DataFrame:
    """``docs`` with columns kept (binary: the bytes that stay), removed (array
    of start, end of the maximal removed runs) and n_bytes. Runs of at most
    ``over_words`` whole words stay, unless they have WINDOW bytes. ``as_text``:
    runs grow to whole characters, and a blank stands where a run between two
    words was, so that what stays is text again."""
    spans = (repeated_spans(docs, id_col, text_col, hot_gram, window, gram_size)
             .groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    names = [c for c in docs.columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    s = spans.select(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th"), "spans")
    # the text travels once: it is put back into the row after the join
    slim = rows.withColumn("row", F.col("row").dropFields(text_col)) if len(names) > 1 else rows.withColumn("row", F.struct(F.lit(0).alias("_")))
    both = slim.join(s, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")), "left").select("row", "text", "spans")
    given = docs.schema[text_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, size = [], [], []
            for body, spans_ in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                body = body.as_py()
                runs = merged([(x["start"], x["end"]) for x in spans_.as_py() or ()])
                runs = [(a, b) for a, b in runs if over_words < 0 or b - a >= WINDOW or whole_words(body, a, b) > over_words]
                runs = merged([whole_characters(body, a, b) for a, b in runs]) if as_text else runs
                at, parts = 0, []
                for a, b in runs:
                    parts.append(body[at:a])
                    at = b
                parts.append(body[at:])
                kept.append(seamed(parts) if as_text else b"".join(parts))
                removed.append([{"start": a, "end": b} for a, b in runs])
                size.append(len(body))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(kept, pa.binary()), pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(size, pa.int64())], names=["row", "text", "kept", "removed", "n_bytes"])

    kind = both.schema["row"].dataType.simpleString()
    done = both.mapInArrow(cut, f"row {kind}, text string, kept binary, removed array<struct<start:int,end:int>>, n_bytes long")
    back = [F.col("text").cast(given).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names]
    return done.select(*back, F.col("kept").alias("kept"), "removed", "n_bytes")
