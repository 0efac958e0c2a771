"""Spelling variants: words at one edit from each other, and their usual form.

The pairs are those that the vocabulary's minimised acceptor accepts when it is
composed with a one-edit transducer (one code point inserted, deleted or
replaced) and with itself again. No task holds the whole acceptor: an edit lies
in the first or in the second half of a word, so the other half stands outside
it, and words that share that half form a partition. Its acceptor starts in the
state that the shared half leads to. A word of length L goes to the partitions
of both halves for pairs whose shorter word has length L, and for those with
length L - 1, as the longer word. Partitions of more than ``GROUP_ROWS`` words
are split again: their words go on to both halves of the window in which the
edit may lie, until it is one code point wide and the alphabet bounds them.

In a partition the acceptor is a table of states by letters left to read, with
equal states merged from the end on (by hash, then verified). Composition walks
pairs of states from one edit on, level by level; a pair that reaches the same
state accepts everything that follows, so its words pair up in order. A pair of
words differs first at one place and is accepted only in the window of that
place, hence once.

Defined results: null and empty texts have no words; a null id is empty text in
the noise's hash; repeated rows count each; forms of equal counts: the smallest
in code-point order; an empty table gives no words; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mix, small, stored

LETTERS = "A-Za-zÀ-ÿ"
#: Words of the largest partition that is composed as it is.
GROUP_ROWS = 200_000
#: Words that a task composes at a time, and counts at a time.
CHUNK_ROWS = 100_000
COUNTED = 300_000


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 7,
               occurrences: int = 2, noise: int | None = None) -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case, of at least ``least`` code
    points that occur ``occurrences`` times or more. ``noise``: where it divides
    the crc32 of ``<id>:<run>``, the run loses the code point at that crc32
    modulo its length."""
    long_runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

        found: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                runs = Counter(long_runs.findall((text.as_py() or "").encode().lower().decode()))
                if noise:
                    seed = zlib.crc32(f"{key.as_py() or ''}:".encode())
                    for run, n in runs.items():
                        h = zlib.crc32(run.encode(), seed)
                        if h % noise == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                        if len(run) >= least:
                            found[run] += n
                else:
                    found.update(runs)
                if len(found) > COUNTED:
                    yield rows()
                    found.clear()
        yield rows()

    made = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(count, "word string, n long")
    return made.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


#: A partition: the edit's window and the letters outside it.
_KEY = "xxhash64(m, lo, hi, substring(word, 1, lo), substring(word, length(word) - (m - hi) + 1, m - hi))"


def _partitions(words: DataFrame, least: int, most: int) -> DataFrame:
    """(key, word, n, m, lo, hi): each word with the windows [lo, hi) in which
    the edit may lie, m being the length of the pair's shorter word."""
    spots = F.expr(f"""filter(flatten(transform(array(length(word), length(word) - 1), m -> array(
        named_struct('m', m, 'lo', 0, 'hi', m div 2), named_struct('m', m, 'lo', cast(m div 2 as int), 'hi', m)))),
        s -> s.m >= {least})""")
    rows = words.select("word", "n", F.explode(spots).alias("s")).selectExpr("word", "n", "s.m", "s.lo", "cast(s.hi as int) as hi").withColumn("key", F.expr(_KEY))
    whole = None
    while True:
        hot = stored(rows.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select("key"))
        if hot.isEmpty():
            return rows if whole is None else whole.unionByName(rows)
        hot = small(hot)
        done = rows.join(hot, "key", "left_anti")
        whole = done if whole is None else whole.unionByName(done)
        half = F.expr("cast((lo + hi) div 2 as int)")
        windows = F.array(F.struct(F.col("lo").alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("hi").alias("b")))
        rows = (rows.join(hot, "key", "left_semi").select("word", "n", "m", F.explode(windows).alias("w"))
                .selectExpr("word", "n", "m", "w.a as lo", "w.b as hi").withColumn("key", F.expr(_KEY)))


class _States:
    """States of the partitions' acceptors that have ``left`` letters to read,
    in the order of their first words: words [first, first + size) go through
    a state, ``parent`` (one level up) reaches it by ``label``."""

    def __init__(self, left: int, labels: np.ndarray, length: np.ndarray, common: np.ndarray):
        depth = length - left
        starts = (common < depth) & (depth >= 0)
        self.of = np.cumsum(starts) - 1
        self.first = np.flatnonzero(starts)
        self.size = np.diff(np.append(self.first, len(length)))
        at = depth[self.first]
        self.label = np.where(at > 0, labels[self.first, np.maximum(at, 1) - 1], 0).astype(np.int64)
        self.root = at == 0
        self.words_of = length[self.first]  # tells the shorter words' acceptor from the longer ones'

    def hang(self, above: _States, letters: int) -> None:
        """Link the states to their parents; a root is nobody's child."""
        self.parent = np.where(self.root, -1, above.of[self.first])
        child = np.flatnonzero(~self.root)
        above.children = child
        above.key = self.parent[child] * letters + self.label[child]  # ascending
        ids = np.arange(len(above.first))
        above.low = np.searchsorted(self.parent[child], ids)
        above.many = np.searchsorted(self.parent[child], ids, "right") - above.low

    def merge(self, below: _States | None) -> None:
        """``state``: equal for states that accept the same rest."""
        if below is None:
            self.state = np.zeros(len(self.first), np.int64)
            return
        c = self.children
        part = below.label[c].astype(np.uint64) << np.uint64(40) | below.state[c].astype(np.uint64)
        place = np.arange(len(c)) - np.repeat(self.low, self.many)
        for seed in range(1, 100):
            marks = mix(part * np.uint64(2 * seed + 1) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(marks)))
            _, model, self.state = np.unique(total[self.low + self.many] - total[self.low], return_index=True, return_inverse=True)
            like = model[self.state]
            if np.array_equal(self.many, self.many[like]) and np.array_equal(part, part[np.repeat(self.low[like], self.many) + place]):
                return
        raise RuntimeError("states cannot be told apart by hash")


def _runs(low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of all positions low[k] .. low[k] + many[k] - 1."""
    owner = np.repeat(np.arange(len(low)), many)
    first = np.cumsum(many) - many
    return owner, np.arange(len(owner)) - first[owner] + low[owner]


def _step(up: _States, a: np.ndarray, up_b: _States, b: np.ndarray, below: _States, letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which pair, child of a, child of b) for the letters that both read."""
    pair, at = _runs(up.low[a], up.many[a])
    if len(pair) == 0 or len(up_b.key) == 0:
        return (np.zeros(0, np.int64),) * 3
    x = up.children[at]
    want = b[pair] * letters + below.label[x]
    spot = np.minimum(np.searchsorted(up_b.key, want), len(up_b.key) - 1)
    hit = up_b.key[spot] == want
    return pair[hit], x[hit], up_b.children[spot[hit]]


def compose(labels: np.ndarray, length: np.ndarray, group: np.ndarray, width: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of words at one edit from each other, each pair once; pairs
    of two longer words are left out.

    ``labels``: a row of letters from 1 on (0 after its end) per word, ordered by
    group, length (``width`` or ``width`` + 1) and letters, no word twice in a
    group. ``last``: whether a group's longer word may have a letter after the
    shorter's end."""
    n, letters = len(length), int(labels.max(initial=0)) + 1
    common = np.full(n, -1, np.int64)
    if n > 1:
        same = (group[1:] == group[:-1]) & (length[1:] == length[:-1])
        common[1:] = np.where(same, np.argmax(labels[1:] != labels[:-1], axis=1), -1)
    level = [_States(left, labels, length, common) for left in range(width + 2)]
    for left in range(width + 1):
        level[left].hang(level[left + 1], letters)
    for left in range(width + 2):
        level[left].merge(level[left - 1] if left else None)
    found = [(np.zeros(0, np.int64),) * 2]

    def accept(at: _States, a: np.ndarray, b: np.ndarray) -> None:
        k, i = _runs(at.first[a], at.size[a])
        found.append((i, i - at.first[a][k] + at.first[b][k]))

    # before the edit: states that the same letters lead to, of the shorter and of the longer words
    s, t = (np.flatnonzero(x.root) for x in (level[width], level[width + 1]))
    _, of_s, of_t = np.intersect1d(group[level[width].first[s]], group[level[width + 1].first[t]], assume_unique=True, return_indices=True)
    s, t = s[of_s], t[of_t]
    a = b = np.zeros(0, np.int64)  # after the edit
    for left in range(width, -1, -1):
        at, up = level[left], level[left + 1]
        if left < width:  # replaced: two letters out of one state of the shorter words
            here = np.flatnonzero(up.words_of == width)
            _, x = _runs(up.low[here], up.many[here])
            end = np.repeat(up.low[here] + up.many[here], up.many[here])
            k, y = _runs(x + 1, end - x - 1)
            a, b = np.concatenate((a, up.children[x[k]])), np.concatenate((b, up.children[y]))
        equal = at.state[a] == at.state[b]
        accept(at, a[equal], b[equal])
        a, b = a[~equal], b[~equal]
        # inserted: the longer word reads one letter more, and the two go on with different letters
        k, y = _runs(up.low[t], up.many[t])
        shorter, longer = s[k], up.children[y]
        if left == 0:
            on = last[group[at.first[shorter]]]
            accept(at, shorter[on], longer[on])
            break
        below = level[left - 1]
        k, c, d = _step(at, shorter, at, longer, below, letters)
        differ = below.label[c] != at.label[longer[k]]
        few = at.many[a] <= at.many[b]
        _, a, b = _step(at, np.where(few, a, b), at, np.where(few, b, a), below, letters)
        a, b = np.concatenate((a, c[differ])), np.concatenate((b, d[differ]))
        _, s, t = _step(at, s, up, t, below, letters)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _pairs(word: list[str], m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of near words, by partition, of whole partitions ordered by
    the words' lengths and letters."""
    known: dict[tuple, int] = {}
    tail = m - hi
    group = np.fromiter((known.setdefault((k, w[:a], w[len(w) - z:]), len(known))
                         for w, a, z, k in zip(word, lo.tolist(), tail.tolist(), m.tolist())), np.int64, len(word))
    length = np.fromiter(map(len, word), np.int64, len(word))
    code = np.frombuffer("".join(word).encode("utf-32-le"), "<u4")
    first = np.cumsum(length) - length
    alphabet, code = np.unique(code, return_inverse=True)
    code = code + 1
    found = [(np.zeros(0, np.int64),) * 2]
    for width in np.unique(hi - lo).tolist():
        rows = np.flatnonzero(hi - lo == width)
        rows = rows[np.lexsort((rows, length[rows], group[rows]))]
        mid = length[rows] - lo[rows] - tail[rows]
        place = np.arange(width + 1)
        inside = place < mid[:, None]
        labels = np.where(inside, code[np.where(inside, (first + lo)[rows][:, None] + place, 0)], 0)
        last = np.zeros(len(known), bool)
        last[group[rows]] = tail[rows] == 0
        i, j = compose(labels, mid, group[rows], width, last)
        found.append((rows[i], rows[j]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _whole_partitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that end where a key ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key = batch.column(0)
        cut = pc.index(key, key[-1]).as_py()  # the last key may go on in the next batch
        if rows + cut >= CHUNK_ROWS and (cut or held[-1].column(0)[-1] != key[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _composed(words: DataFrame, least: int, most: int, schema: str, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_partitions(batches):
            word = table["word"].combine_chunks()
            i, j = _pairs(word.to_pylist(), *(table[c].to_numpy().astype(np.int64) for c in ("m", "lo", "hi")))
            yield make(word, table["n"].to_numpy(), np.concatenate((i, j)), np.concatenate((j, i)))

    rows = _partitions(words, least, most).select("key", "word", "n", "m", "lo", "hi")
    rows = rows.repartition("key").sortWithinPartitions("key", F.length("word"), "word")
    return rows.mapInArrow(run, schema)


def near_pairs(words: DataFrame, least: int = 1, most: int = GROUP_ROWS) -> DataFrame:
    """(word, n, near, near_n): each pair of near words both ways, of distinct
    ``words`` (word, n) of ``least`` code points or more."""
    def make(word, n, i, j):
        return pa.RecordBatch.from_arrays([word.take(pa.array(i)), pa.array(n[i]), word.take(pa.array(j)), pa.array(n[j])], names=["word", "n", "near", "near_n"])

    return _composed(words, least, most, "word string, n long, near string, near_n long", make)


def near_words(words: DataFrame, least: int = 1, most: int = GROUP_ROWS) -> DataFrame:
    """(word, n, n_near, best_n, best): of every word the number of near words,
    and the most frequent of them; pairs are summed up where they are found."""
    def make(word, n, i, j):
        count = np.bincount(i, minlength=len(word))
        rank = np.empty(len(word), np.int64)
        rank[pc.sort_indices(word).to_numpy()] = np.arange(len(word))
        order = np.lexsort((rank[j], -n[j], i))
        i, j = i[order], j[order]
        best = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
        i, j = i[best], j[best]
        return pa.RecordBatch.from_arrays([word.take(pa.array(i)), pa.array(n[i]), pa.array(count[i]), pa.array(n[j]), word.take(pa.array(j))],
                                          names=["word", "n", "n_near", "best_n", "best"])

    parts = _composed(words, least, most, "word string, n long, n_near long, best_n long, best string", make)
    every = words.selectExpr("word", "n", "0L as n_near", "cast(null as long) as best_n", "cast(null as string) as best")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    return (parts.unionByName(every).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def variants(words: DataFrame, least: int = 1, times: int = 10, most: int = GROUP_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words``, which
    is read more than once: give a stored table.

    form: the most frequent near word, if ``times`` as frequent; root: where the
    forms lead. Every step multiplies the count, so a few rounds of following
    the form's form reach all roots."""
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    found = stored(near_words(words, least, most).withColumn("form", form).withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("best_n"))))
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    steps = math.log(max(found.agg(F.max("n")).first()[0] or 1, 1), max(times, 2))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):  # from 2**k steps to 2**(k + 1)
        on = links.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        links = stored(links.join(on, "root", "left").select("word", F.coalesce("_on", "root").alias("root")))
    return (found.join(links, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
