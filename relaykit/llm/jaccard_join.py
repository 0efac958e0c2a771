"""N-gram Jaccard join: T-occurrence search over inverted lists (DivideSkip).

Every pair of texts whose shingle sets reach the similarity is found, none is
guessed:

1. *Classes.* Texts with equal sets are one class; only classes go on, each as
   one node, so exact copies never meet pairwise.
2. *Candidate clusters.* Sets are binned by size, so that a set can only link
   with sets of its own or the next bin. For a pair of bins, two linked sets
   differ in at most ``H`` elements; the elements are dealt over ``m > H``
   blocks by hash, so at least ``m - H`` blocks are equal. A node emits one key
   per block; nodes that share a key are candidates. Pairs that share a key of
   few nodes are held against their parity sketches, which differ in no more bits
   than the sets in elements; so most that only share a passage part here. Very
   frequent shingles are
   left out of the blocks (that keeps the bound, as leaving elements out of
   both sets adds no difference); a block left empty is skipped while a node
   has few of those, else its whole content is the key. A key that many nodes of
   a map task share folds to a few rows before the shuffle, and its nodes become
   candidates through the least of them, so a hot group emits no pairs.
   Passages that many texts share chain texts which are not similar. A cluster
   that would have to be cut is therefore looked at again, by prefixes: linked
   sets share one of their rarest shingles, of which each set emits as many as it
   may have more than its partner, plus one. Its candidates are the keys' nodes,
   as above, and their components take the cluster's place.
3. *T-occurrence search.* The sets of a candidate cluster meet by pairs of bins,
   in one task or, when they are many, in tasks for pairs of blocks of them. There the sets
   are indexed by shingle and each set is a query: its longest lists are set
   aside (how many follows from the required overlap T and the longest list),
   the short lists are heap-merged and texts found in at least T minus the
   number of long lists are then looked up in the long lists by binary search.
   Texts that reach the overlap are links.
4. *Components* of links, over classes.

Defined results: a text that is null, empty or without words has an empty set
and links with nothing; rows repeated with one id are each returned; a null id
takes part through rows of an equal set that have one, and gets their component
(null if there are none).
Other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, connected_components, mix, saved, shingle_sets, slices, small, text_bytes

#: Weight of a probe against a merge step in the choice of long lists.
MU = 0.0085
#: Shingles of the sets that meet in one task before a cluster is cut in blocks.
CLUSTER_SHINGLES = 2_000_000
#: Most shingles that are left out of the blocks as frequent (8 bytes each).
HOT_MOST = 200_000
#: Most shingles that are put last in the order of a large cluster (12 bytes each).
OFTEN_MOST = 2_000_000
#: A shingle is frequent when a map task finds it in this share of its texts.
HOT_SHARE, HOT_LEAST = 0.001, 8

#: Nodes of one key that are paired to be held against their sketches; a key of
#: more nodes links them all to the least, unchecked.
FEW = 12
#: Nodes with their seats that may be broadcast (about 100 bytes each); of more
#: nodes the ids are, so that only texts of candidates are shuffled.
FEW_NODES = 200_000
#: Most bits of a sketch. Any size keeps every link; more bits part more.
SKETCH_BITS = 1 << 15

#: Of a part of up to SHORT nodes, and of a larger one.
_KEYS = [np.dtype([("low", "<u4"), ("high", "u1"), ("node", kind)]) for kind in ("<u2", "<u4")]
SHORT = 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def size_bins(num: int, den: int, top: int = 1 << 40) -> list[tuple[int, int]]:
    """(smallest, largest) size of each bin; largest = floor(smallest / t)."""
    bins, low = [], 1
    while low <= top:
        high = low * den // num
        bins.append((low, high))
        low = high + 1
    return bins


def block_counts(num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per bin as the smaller side: its smallest size, how many blocks, and how
    many empty blocks a node may skip."""
    low, blocks, spare = [], [], []
    for lo, hi in size_bins(num, den):
        differ = (hi + hi * den // num) * (den - num) // (den + num)
        m = differ + 1 if differ == 0 else math.ceil((differ + 3) / 0.96)
        low.append(lo)
        blocks.append(m)
        spare.append(m - differ - 1)
    return np.array(low), np.array(blocks), np.array(spare)


def set_keys(sets: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One long per set, equal for equal sets."""
    ends = np.concatenate(([0], np.cumsum(count)))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sets * _A + _B), dtype=np.uint64)))
    return mix((total[ends[1:]] - total[ends[:-1]]) * _B + count.astype(np.uint64)).view(np.int64)


def block_keys(sets: np.ndarray, count: np.ndarray, hot: np.ndarray, num: int, den: int,
               bins: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, key) of every block that is to be looked up."""
    low, blocks, spare = bins
    doc = np.repeat(np.arange(len(count)), count)
    here = np.searchsorted(low, count, "right") - 1
    if len(hot):
        at = np.minimum(np.searchsorted(hot, sets), len(hot) - 1)
        cold = (hot[at] != sets).astype(np.float64)
    else:
        cold = np.ones(len(sets))
    value = mix(sets * _B + _A)
    half = [(value & np.uint64(0xFFFFFFFF)).astype(np.float64), (value >> np.uint64(32)).astype(np.float64)]
    place = mix(sets + _B) >> np.uint64(24)
    owners, keys = [], []
    for step in (0, 1):  # with the larger bin, then with the smaller one
        side = np.maximum(here - step, 0)
        on = (count > 0) & (here - step >= 0)
        m = np.where(on, blocks[side], 0)
        first = np.cumsum(m) - m
        total = int(m.sum())
        if not total:
            continue
        pick = on[doc]
        d = doc[pick]
        slot = first[d] + (place[pick] % m[d].astype(np.uint64)).astype(np.int64)
        w = cold[pick]
        own = np.repeat(np.arange(len(count)), m)
        some = np.bincount(slot, w, total)
        # sums of 32-bit halves are exact in a double; parts join as integers
        part = [np.bincount(slot, h[pick] * w, total).astype(np.uint64) for h in half]
        whole = [np.bincount(slot, h[pick], total).astype(np.uint64) for h in half]
        empty = some == 0
        many = np.bincount(own[empty], minlength=len(count)) > spare[side]
        keep = ~empty | many[own]
        code = np.where(empty, mix(whole[0] * _A + mix(whole[1] + _B)), mix(part[0] * _B + mix(part[1] + _A)))
        where = (side[own].astype(np.uint64) << np.uint64(40)) + (np.arange(total) - first[own]).astype(np.uint64)
        key = mix(code ^ mix(where * _A + empty.astype(np.uint64)))
        owners.append(own[keep])
        keys.append(key[keep])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(keys).view(np.int64)


def prefix_keys(sets: np.ndarray, count: np.ndarray, often: np.ndarray, rank: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, key) of the first n - ceil(t * n) + 1 shingles of each set, in
    an order of all shingles: those in ``often`` (ascending) are last, by their
    ``rank``. Linked sets share t * n shingles of either, so one of these."""
    doc = np.repeat(np.arange(len(count)), count)
    key = mix(sets * _A + _B)
    order = key >> np.uint64(13)
    if len(often):
        at = np.minimum(np.searchsorted(often, sets), len(often) - 1)
        order = np.where(often[at] == sets, np.uint64(1 << 51) + rank[at].astype(np.uint64), order)
    turn = np.argsort((doc.astype(np.uint64) << np.uint64(52)) | order, kind="stable")
    place = np.arange(len(sets)) - np.repeat(np.cumsum(count) - count, count)
    turn = turn[place < np.repeat(count + num * -count // den + 1, count)]
    return doc[turn], key[turn].view(np.int64)


def _runs(x: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the end."""
    return np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)])) if len(x) else np.zeros(1, np.int64)


def sketches(sets: np.ndarray, count: np.ndarray, num: int, den: int) -> list[bytes]:
    """Per set, for each of some bits whether an odd number of its elements
    falls on it: sketches of two sets differ in at most as many bits as the sets
    in elements. Sizes are powers of two, about four times the difference that
    two linked sets of this size may have."""
    want = np.maximum(64, 8 * count * (den - num) // (den + num))
    bits = np.minimum(SKETCH_BITS, 1 << np.ceil(np.log2(want)).astype(np.int64))
    first = np.cumsum(bits) - bits
    doc = np.repeat(np.arange(len(count)), count)
    at = first[doc] + (mix(sets ^ _A) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    body = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [body[i // 8:(i + n) // 8] for i, n in zip(first.tolist(), bits.tolist(), strict=True)]


def may_link(one: bytes, other: bytes, most: int) -> bool:
    """False when the sets of these sketches differ in more than ``most``
    elements. The longer sketch is folded: places that meet add up."""
    if len(one) > len(other):
        one, other = other, one
    x, y, bits = int.from_bytes(one, "little"), int.from_bytes(other, "little"), 8 * len(other)
    while bits > 8 * len(one):
        bits //= 2
        y = (y >> bits) ^ (y & ((1 << bits) - 1))
    return (x ^ y).bit_count() <= most


def _groups(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (key, node) in order, each with its place within its key, how
    many nodes the key has, and the least of them."""
    key, node = _distinct(key, node)
    runs = _runs(key)
    size = np.diff(runs)
    start = np.repeat(runs[:-1], size)
    return key, node, np.arange(len(key)) - start, np.repeat(size, size), node[start]


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _pairs(node: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs within the keys of ``FEW`` nodes or less."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for step in range(1, FEW):
        on = np.flatnonzero((size <= FEW) & (place + step < size))
        a, b = _distinct(np.concatenate((a, node[on])), np.concatenate((b, node[on + step])))
    return a, b


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def overlaps(lists: np.ndarray, at: np.ndarray, postings: np.ndarray, need: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """DivideSkip: (nodes, overlap) of all nodes on at least ``need`` of the
    inverted lists ``lists``. ``at`` has the bounds of each list in
    ``postings``, whose nodes are ascending within a list."""
    length = at[lists + 1] - at[lists]
    order = np.argsort(length, kind="stable")
    lists, length = lists[order], length[order]
    aside = min(need - 1, int(need / (MU * math.log2(max(2, int(length[-1]))) + 1)))
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    least = need - aside
    steps = int(length[:len(short)].sum())
    if steps <= 512:
        found, times = _heap_merge([postings[at[i]:at[i + 1]].tolist() for i in short], least)
    else:  # the same merge by counting, for many postings at once
        tally = np.bincount(_gather(short, at, postings), minlength=nodes)
        found = np.flatnonzero(tally >= least)
        times = tally[found]
    if aside and len(found):
        if len(found) * aside * 8 < int(length[len(short):].sum()) + 512:
            times = times + _probe(found, long, at, postings, nodes)
        else:
            times = times + np.bincount(_gather(long, at, postings), minlength=nodes)[found]
    hit = times >= need
    return found[hit], times[hit]


def _gather(lists: np.ndarray, at: np.ndarray, postings: np.ndarray) -> np.ndarray:
    size = at[lists + 1] - at[lists]
    return postings[np.repeat(at[lists] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def _heap_merge(lists: list[list[int]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on at least ``least`` lists: pop equal heads off a heap; with too
    few of them, pop up to ``least - 1`` heads and skip their lists ahead to
    the next head by binary search."""
    heap = [(x[0], k) for k, x in enumerate(lists) if x]
    heapq.heapify(heap)
    head = [0] * len(lists)
    found, times = [], []
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            found.append(top)
            times.append(len(popped))
            for k in popped:
                head[k] += 1
                if head[k] < len(lists[k]):
                    heapq.heappush(heap, (lists[k][head[k]], k))
            continue
        while heap and len(popped) < least - 1:
            popped.append(heapq.heappop(heap)[1])
        if not heap:
            break
        goal = heap[0][0]
        for k in popped:
            head[k] = bisect_left(lists[k], goal, head[k])
            if head[k] < len(lists[k]):
                heapq.heappush(heap, (lists[k][head[k]], k))
    return np.array(found, np.int64), np.array(times, np.int64)


def _probe(found: np.ndarray, lists: np.ndarray, at: np.ndarray, postings: np.ndarray, nodes: int) -> np.ndarray:
    """On how many of ``lists`` each found node is, by binary search: bounds
    of all (list, node) searches close in together."""
    goal = np.repeat(found, len(lists))
    low, high = np.tile(at[lists], len(found)), np.tile(at[lists + 1], len(found))
    end = high.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        right = open_ & (postings[np.minimum(mid, len(postings) - 1)] < goal)
        low = np.where(right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    hit = (low < end) & (postings[np.minimum(low, len(postings) - 1)] == goal)
    return hit.reshape(len(found), len(lists)).sum(1)


def search(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, upper: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``sets``: (root of each by links, weighted number of links).
    ``side``: 0 for all pairs among equals; sets of side 1 and 2 link across only.
    Two sets of the upper bin are another task's pair."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    _, lists = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.concatenate(([0], np.cumsum(size)))
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(lists, kind="stable")
    postings = owner[order]
    at = np.concatenate(([0], np.cumsum(np.bincount(lists))))
    root, links = np.arange(n), np.zeros(n, np.int64)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        if side[i] == 2:
            continue
        need = -(-num * int(size[i]) // den)
        found, times = overlaps(lists[ends[i]:ends[i + 1]], at, postings, max(1, need), n)
        near = (found > i) if side[i] == 0 else (side[found] == 2)
        if upper[i]:
            near &= ~upper[found]
        found, times = found[near], times[near]
        hit = found[(num + den) * times >= num * (size[i] + size[found])]
        links[hit] += weight[i]
        links[i] += int(weight[hit].sum())
        for j in hit.tolist():
            x, y = top(i), top(j)
            if x != y:
                root[max(x, y)] = min(x, y)
    return np.array([top(i) for i in range(n)]), links


def with_texts(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of ``nodes`` by their least id. Texts do not move while the nodes
    are few; then only those of nodes do, or all of them once."""
    rows = texts.withColumnRenamed("doc_id", "low")
    if nodes.limit(FEW_NODES + 1).count() <= FEW_NODES:
        return F.broadcast(nodes).join(rows, "low")
    ids = nodes.select("low")
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(ids), "low", "left_semi")
    return nodes.join(rows, "low")


def parted(inner: DataFrame, texts: DataFrame, candidates, shingle: int, num: int, den: int, lower: bool) -> DataFrame:
    """(node, root) of the components of candidates by prefixes among the nodes of
    ``inner``; a node without candidates is not in it."""
    mine = with_texts(inner.where(F.col("low").isNotNull()).select("node", "low"), texts).select("low", "text", "node")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                seen.append(shingle_sets(data, offsets[i:j + 1], shingle, lower)[0])
                if sum(map(len, seen)) > 2_000_000:
                    value, times = np.unique(np.concatenate(seen), return_counts=True)
                    yield _table(shingle=value.view(np.int64), n=times)
                    seen = []
        if seen:
            value, times = np.unique(np.concatenate(seen), return_counts=True)
            yield _table(shingle=value.view(np.int64), n=times)

    # a bounded set, as any order keeps the links; the rarer a prefix, the fewer candidates
    found = saved(mine.mapInArrow(tally, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") > FEW))
    least, total = FEW + 1, 0
    for r in found.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        total += r["count"]
        if total > OFTEN_MOST:
            least = r["n"] + 1
            break
    got = found.where(F.col("n") >= least).toArrow()
    value, times = (got.column(k).to_numpy() for k in (0, 1))
    value = value.view(np.uint64)
    rank = np.empty(len(value), np.int32)
    rank[np.lexsort((value, times))] = np.arange(len(value))
    turn = np.argsort(value)
    sent = inner.sparkSession.sparkContext.broadcast((value[turn], rank[turn]))
    return connected_components(candidates(mine, lambda sets, count: prefix_keys(sets, count, *sent.value, num, den)))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       num: int = 90, den: int = 100, lower: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, set_id) per row of ``docs``.

    Two rows link when den * intersection >= num * union of their sets of
    ``shingle``-word shingles; n_links counts the rows a row links with."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: id, set size, set key and sketch of each row; kind 1: a shingle
        that is frequent in this task, and its count there."""
        names = ["kind", "doc_id", "n", "set_id", "sketch"]
        seen, rows = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                sets, count = shingle_sets(data, offsets[i:j + 1], shingle, lower)
                key = set_keys(sets, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(j - i, np.int8)), batch.column(0).slice(i, j - i), pa.array(count),
                     pa.array(key, mask=count == 0), pa.array(sketches(sets, count, num, den), pa.binary())], names=names)
                seen.append(sets)
                rows += j - i
                if sum(map(len, seen)) > 2_000_000:
                    seen = [_frequent(seen, 2)]
        hot = _frequent(seen, max(HOT_LEAST, rows * HOT_SHARE), counts=True)
        if len(hot[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(hot[0]), np.int8)), pa.array(hot[0].astype(np.int64)), pa.array(hot[1]),
                 pa.nulls(len(hot[0]), pa.int64()), pa.nulls(len(hot[0]), pa.binary())], names=names)

    told = saved(texts.mapInArrow(describe, "kind byte, doc_id long, n long, set_id long, sketch binary"))
    rows = told.where("kind = 0").drop("kind", "sketch")
    classes = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"),
                                                       F.first("n").alias("n"))
    # a bounded set; which shingles are in it changes the work, never the links
    hot = np.sort(np.array([r[0] for r in told.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n"))
                            .orderBy(F.desc("n"), "doc_id").limit(HOT_MOST).collect()], np.int64)).view(np.uint64)
    sent = spark.sparkContext.broadcast(hot)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keyed(keys_of):
        """Folded keys of the texts in the second column; of texts with a third
        column only those whose set is the node there."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes, keys, size = [], [], 0
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                for i, j in slices(offsets):
                    sets, count = shingle_sets(data, offsets[i:j + 1], shingle, lower)
                    own, key = keys_of(sets, count)
                    name = set_keys(sets, count)
                    if batch.num_columns > 2:
                        same = (name == batch.column(2).to_numpy()[i:j])[own]
                        own, key = own[same], key[same]
                    nodes.append(name[own])
                    keys.append(key)
                    size += len(key)
                    if size > 2_000_000:
                        yield from fold(nodes, keys)
                        nodes, keys, size = [], [], 0
            if size:
                yield from fold(nodes, keys)

        return run

    def fold(nodes, keys) -> Iterator[pa.RecordBatch]:
        """A task's keys by bucket, in 7 bytes each, 9 in a part of very many
        nodes: the key's low 40 bits and the number of its node in the part's list. Keys that fall together only
        add candidates. Of a key of many nodes one more than ``FEW`` is sent, the
        rest is linked to the least here."""
        key, node, rank, _, least = _groups(np.concatenate(keys), np.concatenate(nodes))
        rest = rank > FEW
        star = np.stack(_distinct(least[rest], node[rest]), 1)
        key, node = key[~rest], node[~rest]
        place = (mix(key.view(np.uint64)) >> np.uint64(20)).astype(np.int64) % buckets
        order = np.argsort(place, kind="stable")
        names, number = np.unique(node[order], return_inverse=True)
        ends = np.searchsorted(place[order], np.arange(buckets + 1))
        key = key[order]
        for k in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
            part = slice(ends[k], ends[k + 1])
            mine, at = np.unique(number[part], return_inverse=True)
            packed = np.empty(len(at), _KEYS[len(mine) > SHORT])
            packed["low"], packed["high"], packed["node"] = key[part], (key[part] >> 32) & 255, at
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([k], pa.int32()), "nodes": [names[mine].tobytes()], "keys": [packed.tobytes()]})
        if len(star):  # links found within the task need no key any more
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(mix(names[:1].view(np.uint64))[0] % np.uint64(buckets))], pa.int32()),
                                              "nodes": [star.tobytes()], "keys": pa.array([None], pa.binary())})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, stars = [], [], []
        for batch in batches:
            for bucket, names, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = np.frombuffer(names, np.int64)
                if packed is None:
                    stars.append(got.reshape(-1, 2))
                    continue
                packed = np.frombuffer(packed, _KEYS[len(got) > SHORT])
                keys.append(packed["low"].astype(np.int64) | (packed["high"].astype(np.int64) << 32) | (bucket << 40))
                nodes.append(got[packed["node"]])
        if keys:
            _, node, place, size, least = _groups(np.concatenate(keys), np.concatenate(nodes))
            many = (size > FEW) & (place > 0)
            stars.append(np.stack((least[many], node[many]), 1))
            a, b = _pairs(node, place, size)
            yield _table(a=a, b=b, sure=np.zeros(len(a), bool))
        if stars:
            a, b = _distinct(*np.concatenate(stars).T)
            yield _table(a=a, b=b, sure=np.ones(len(a), bool))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            # a long sketch that is folded to a short one says little
            batch = batch.filter(pa.array(np.minimum(n_a, n_b) * den >= np.maximum(n_a, n_b) * num))
            total = (batch.column(2).to_numpy() + batch.column(4).to_numpy()) * (den - num) // (den + num)
            on = [may_link(x.as_py(), y.as_py(), most) for x, y, most in zip(batch.column(3), batch.column(5), total.tolist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(on, pa.bool_()))

    sketch = told.where("kind = 0 and n > 0").groupBy("set_id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    held = [sketch.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab"]

    def candidates(rows: DataFrame, keys_of) -> DataFrame:
        met = saved(rows.mapInArrow(keyed(keys_of), "bucket int, nodes binary, keys binary").repartition(buckets, "bucket")
                    .mapInArrow(meet, "a long, b long, sure boolean"))
        checked = (met.where("not sure").select("a", "b").distinct().join(held[0], "a").join(held[1], "b")
                   .select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(near, "a long, b long"))
        return checked.unionByName(met.where("sure").select("a", "b"))

    bins = block_counts(num, den)
    edges = candidates(texts, lambda sets, count: block_keys(sets, count, sent.value, num, den, bins))
    cluster = saved(connected_components(edges).join(classes, F.col("node") == F.col("set_id"))
                    .select("node", "root", "low", "copies", "n"))

    # a cluster is cut by pairs of size bins (a set sits in its own bin's group
    # and in that of the bin below), a large group in blocks; a pair of blocks is a task
    lows = F.array(*[F.lit(int(x)) for x in bins[0]])
    home = F.size(F.filter(lows, lambda x: x <= F.col("n"))) - 1
    upper = F.col("home") != F.col("bin")
    parts = F.ceil(F.sum("n") * 2 / F.lit(CLUSTER_SHINGLES)).cast("int")

    def seats_of(cluster: DataFrame) -> tuple[DataFrame, DataFrame]:
        seats = (cluster.where(F.col("low").isNotNull()).withColumn("home", home)
                 .select("*", F.explode(F.array("home", F.col("home") - 1)).alias("bin")).where("bin >= 0"))
        return seats, seats.groupBy("root", "bin").agg(
            F.when(parts <= 2, 1).otherwise(parts).alias("parts"), F.count(F.lit(1)).alias("sets"),
            F.sum((~upper).cast("int")).alias("own")).where("sets >= 2 and own >= 1").drop("sets", "own")

    large = seats_of(cluster)[1].where("parts > 1").select("root").distinct()
    inner = cluster.join(small(large), "root")
    if not inner.isEmpty():  # each set goes to as many tasks as its group has parts
        now = parted(inner, texts, candidates, shingle, num, den, lower).select("node", F.col("root").alias("now"))
        cluster = saved(cluster.join(small(large.withColumn("cut", F.lit(True))), "root", "left").join(now, "node", "left")
                        .select("node", F.when(F.col("cut"), F.coalesce("now", "node")).otherwise(F.col("root")).alias("root"), "low", "copies", "n"))
    seats, groups = seats_of(cluster)
    seated = seats.join(groups, ["root", "bin"]).select("node", "low", "copies", F.struct(
        "root", "bin", upper.alias("upper"), F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "parts").alias("seat"))
    per_node = seated.groupBy("node", "low", "copies").agg(F.collect_list("seat").alias("seats"))  # two at most
    texts_of = with_texts(per_node, texts).select("node", "copies", "seats", "text")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(3))
            node = batch.column(0).to_numpy()
            for i, j in slices(offsets):
                sets, count = shingle_sets(data, offsets[i:j + 1], shingle, lower)
                ends = np.concatenate(([0], np.cumsum(count)))
                same = set_keys(sets, count) == node[i:j]  # a repeated id may have another text
                got = pa.array([sets[ends[k]:ends[k + 1]].tobytes() for k in range(j - i)], pa.binary())
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in batch.columns[:3]] + [got],
                                                 names=["node", "copies", "seats", "shingles"]).filter(pa.array(same))

    kind = texts_of.schema["seats"].dataType.simpleString()
    dealt = (texts_of.mapInArrow(shingled, f"node long, copies long, seats {kind}, shingles binary")
             .select("node", "copies", "shingles", F.explode("seats").alias("s")).select("node", "copies", "shingles", "s.*")
             .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("mate"))
             .select("root", "bin", F.least("part", "mate").alias("i"), F.greatest("part", "mate").alias("j"),
                     F.when(F.col("mate") == F.col("part"), 0).when(F.col("part") < F.col("mate"), 1).otherwise(2).alias("side"),
                     "upper", "node", "copies", "shingles")
             .repartition("root", "bin", "i", "j").sortWithinPartitions("root", "bin", "i", "j", "node"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            nodes, first = np.unique(np.array([g[0] for g in group]), return_index=True)  # repeated rows meet once
            picked = [group[k] for k in first]
            if len(picked) < 2:
                return None
            sets = [np.frombuffer(g[3], np.uint64) for g in picked]
            root, links = search(sets, *(np.array([g[k] for g in picked]) for k in (1, 2, 4)), num, den)
            on = links > 0
            return _table(a=nodes[on], b=nodes[root][on], links=links[on]) if on.any() else None

        now, group = None, []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(9)]
            for *place, side, upper, node, copies, got in zip(*cols, strict=True):
                if place != now:
                    if len(group) > 1 and (made := close()) is not None:
                        yield made
                    now, group = place, []
                group.append((node, copies, side, got, upper))
        if len(group) > 1 and (made := close()) is not None:
            yield made

    links = saved(dealt.mapInArrow(joined, "a long, b long, links long"))
    reach = connected_components(links.select("a", "b")).join(
        cluster.select("node", "low"), "node")
    least = reach.groupBy("root").agg(F.min("low").alias("component"))
    placed = reach.join(least, "root").select(F.col("node").alias("set_id"), "component")
    number = links.groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    told_of = (classes.join(placed, "set_id", "left").join(number, "set_id", "left")
               .select("set_id", F.coalesce("component", "low").alias("component"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = rows.join(told_of, "set_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "set_id")


def _frequent(parts: list[np.ndarray], least: float, counts: bool = False):
    """Shingles on ``least`` of the parts' texts or more; repeated by count, so
    that the rest of a task can be added, unless ``counts``."""
    if not parts:
        return (np.zeros(0, np.uint64), np.zeros(0, np.int64)) if counts else np.zeros(0, np.uint64)
    value, times = np.unique(np.concatenate(parts), return_counts=True)
    on = times >= least
    return (value[on], times[on]) if counts else np.repeat(value[on], times[on])
