"""Ranked lexical search against a brute-force ranking."""
import math
import random
import re
from collections import Counter

import pytest

from relaykit.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    number = sum(1 for _, _, n in bags if n)
    total = sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    rows = []
    for item, text in set(items):
        asked, found = Counter(terms(text)), []
        for doc, count, n in bags:
            m = 100 - 75 + (75 * n * number) // max(total, 1)
            score = sum(q * math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * count[t]) // (1000 * count[t] + 8 * m))
                        for t, q in asked.items() if count[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        rows += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k])]
    return sorted(rows, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Éa", "日本", "İ"]
    docs = [(k, " ".join(rnd.choices(words, range(1, 64), k=rnd.randint(1, 30)))) for k in range(200)]
    docs += [(1000 + k, "hot copy W1 w2") for k in range(150)] + [(5, docs[5][1]), (5, docs[5][1]), (None, docs[7][1]), (None, None), (900, None), (901, ""), (902, "--"), (903, "w3 " * 50_000)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.randint(1, 8)))) for k in range(30)]
    items += [(100, "w1"), (101, "W1, w1 w2"), (102, ""), (103, None), (104, "unseen"), (1, items[1][1]), (1, "w9 w9"), (None, "w2 x")]
    return docs, items


@pytest.mark.parametrize("seed,k,block", [(1, 10, 1 << 20), (2, 3, 200), (3, 500, 1 << 20)])
def test_ranking_matches_brute_force(spark, seed, k, block):
    """Ties, copies in a hot class, repeated rows and ids, nulls, several blocks."""
    docs, items = corpus(seed)
    left = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, score string").repartition(7)
    right = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    got = ls.search(left, right, k=k, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def test_classes_are_scored_once_and_kept_small(spark):
    rows = [(k, 4, b"bag-one!") for k in range(1000)] + [(7, 4, b"bag-two!"), (3, 5, b"bag-one!")]
    got = ls.classes(spark.createDataFrame(rows, "doc long, n long, bag binary"), 1002, 4009, 10).collect()
    assert sorted((bytes(r.bag), r.members) for r in got) == [(b"bag-one!", list(range(10))), (b"bag-one!", [3]), (b"bag-two!", [7])]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ls.search(docs.where("false"), items).collect() == []
    assert ls.search(docs, items.where("false")).collect() == []
    assert [tuple(r) for r in ls.search(docs, items).collect()] == brute([(1, "a b")], [(1, "a")], 10)
