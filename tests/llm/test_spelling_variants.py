"""Spelling variants against brute force over all pairs of words."""
import random
import zlib
from collections import Counter

import pytest

from relaykit.llm import spelling_variants as sv


def near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def brute(count: dict[str, int], times: int = 10) -> set[tuple]:
    forms, out = {}, {}
    for w, n in count.items():
        others = [v for v in count if near(w, v)]
        best = min(others, key=lambda v: (-count[v], v), default=None)
        forms[w] = best if best is not None and count[best] >= times * n else None
        out[w] = len(others)
    rows = set()
    for w, n in count.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, out[w], count[forms[w]] if forms[w] else None))
    return rows


def collected(df) -> list[tuple]:
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("seed,alphabet,least,most", [(1, "ab", 1, 200_000), (2, "abcé", 2, 200_000), (3, "abc", 5, 6), (4, "aé", 7, 3)])
def test_variants_match_brute_force(spark, seed, alphabet, least, most):
    """A small ``most`` splits partitions down to windows of one letter."""
    rnd = random.Random(seed)
    count = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(least, least + 5))): rnd.choice([2, 3, 20, 30, 400, 5000]) for _ in range(250)}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    got = collected(sv.variants(words, least=least, most=most))
    assert len(got) == len(count) and set(got) == brute(count)
    pairs = [tuple(r) for r in sv.near_pairs(words, least=least, most=most).select("word", "near").collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in count for b in count if near(a, b)}


def test_forms_lead_to_the_root_over_many_steps(spark):
    count = {"a" * (10 + k): 2 * 10**k for k in range(9)}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    got = {r[0]: r[2] for r in collected(sv.variants(words))}
    assert set(got.values()) == {"a" * 18}


def test_vocabulary_noise_and_defined_cases(spark):
    long_run = "z" * 300_000
    rows = [(None, None), (1, ""), (2, None), (3, "Straße-ÉTUDES études ETUDES x7 abcdefg1hijklmn"), (3, "Straße-ÉTUDES études ETUDES x7 abcdefg1hijklmn"),
            (None, "abcdefg abcdefg"), (4, f"{long_run} {long_run}"), (5, "kurz "), (6, " ".join(f"wort{'abcdefghij'[k % 10] * 3}" for k in range(400)))]
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], "doc_id long, text string, word string, n int")
    want: Counter[str] = Counter()
    for i, t in rows:
        letters = "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in t or "")
        for run in letters.split():
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] += 1
    got = {r.word: r.n for r in sv.vocabulary(docs, noise=31).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert sv.variants(sv.vocabulary(docs.where("false"))).collect() == []


def test_partitions_stay_small_and_lose_nothing(spark):
    """A third of all words share one half."""
    rnd = random.Random(9)
    count = {"aaaaaa" + "".join(rnd.choice("abcdefgh") for _ in range(4)): 2 for _ in range(600)}
    count |= {"".join(rnd.choice("abcdefgh") for _ in range(10)): 2 for _ in range(1200)}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    parts = sv._partitions(words, 7, 50)
    biggest = parts.where("hi - lo > 1").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert biggest <= 50
    assert {(r[0], r[4]) for r in collected(sv.variants(words, least=7, most=50))} == {(r[0], r[4]) for r in brute(count)}
