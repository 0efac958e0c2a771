"""The training-data operators against brute force, on small tables with
nulls, empty and long texts, ties, repeated rows and clashing columns."""
import base64
import functools
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from relaykit.llm import (chat_format, jaccard_join, multi_index, packing, quality_model, quality_rules, queries, shared,
                          source_mix, suffix_dedup, url_filter, warc)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(3)
VOCAB = [f"w{i}" for i in range(400)] + ["é", "Ünï"]


def prose(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


@functools.cache
def corpus():
    base = prose(300)
    words = base.split(" ")
    passage = prose(120)
    texts = [base, base, " ".join(words[:-3] + ["x", "y", "z"]), " ".join(words[:150] + ["q"] + words[151:]), None, "", "  \n\t ",
             "one", "one", "One two", "one two three", prose(3000), prose(60) + " " + passage + " " + prose(60), prose(80) + " " + passage,
             "ab " * 500, "line of words here\n" * 40, passage.upper(), "é" * 700, prose(5) + "\x00" + prose(90)]
    rows = list(enumerate(texts)) + [(3, texts[3])]  # a repeated row
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")


def empty(docs):
    return docs.where("false")


def shingles(text, k):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(lower)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, num):
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[top(i)].append(r[0])
    return sorted((r[0], len(sets[i]), min(low[top(i)]), links[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_jaccard_join(spark, docs, k, num, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CLUSTER_SHINGLES", 300)  # blocks also on a small table
    near = prose(150).split(" ")
    rows = corpus() + [(100 + i, " ".join(near[:i % 12] + ["v%d" % i] + near[i % 12 + 1:]), "en", "s", 1) for i in range(40)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, docs.schema), shingle=k, num=num)
    assert sorted(tuple(r)[:4] for r in got.collect()) == components(rows, k, num)


def test_jaccard_join_parts_what_only_shares_passages(spark, docs, monkeypatch):
    """A cluster too large for one task is no longer dealt whole while only its
    passages are shared; copies of different lengths do not hold it together."""
    monkeypatch.setattr(jaccard_join, "CLUSTER_SHINGLES", 2_000)
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", 1_000)  # passages stay in the blocks
    line = " ".join(f"line{j}" for j in range(20))
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(i, f"{line} {own(i, 20 + i % 3)}", "en", "s", 1) for i in range(150)]
    rows += [(200 + i, rows[i][1] + " end", "en", "s", 1) for i in range(0, 150, 5)]
    rows += [(400 + i, f"{line} {own(400 + i, 400)} {own(i, 20 + i % 3)}", "en", "s", 1) for i in range(6)]
    dealt, real = [], jaccard_join.with_texts
    monkeypatch.setattr(jaccard_join, "with_texts", lambda nodes, texts: [dealt.append(nodes), real(nodes, texts)][1])
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, docs.schema), shingle=5, num=80)
    assert sorted(tuple(r)[:4] for r in got.collect()) == components(rows, 5, 80)
    sent = dealt[-1].selectExpr("explode(seats) s").selectExpr("s.parts", "s.root").collect()
    assert len(dealt) == 2 and {r.parts for r in sent} == {1} and len({r.root for r in sent}) == 30


@pytest.mark.parametrize("num", [50, 80, 90])
def test_linked_sets_share_a_prefix_key(num):
    rng = np.random.default_rng(num)
    base = np.sort(rng.choice(1 << 52, 60, replace=False).astype(np.uint64))
    sets = [np.sort(rng.choice(base, rng.integers(20, 61), replace=False)) for _ in range(80)]
    often = base[::3]
    own, key = jaccard_join.prefix_keys(np.concatenate(sets), np.array([len(s) for s in sets]), often, rng.permutation(len(often)), num, 100)
    keys = [set(key[own == i].tolist()) for i in range(len(sets))]
    assert [len(k) for k in keys] == [len(s) - -(-num * len(s) // 100) + 1 for s in sets]
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                assert keys[i] & keys[j]


def test_jaccard_join_null_id_and_empty(spark, docs):
    rows = [(None, "a b c d", "", "", 1), (7, "a b c d", "", "", 1), (None, None, "", "", 1)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, docs.schema))
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got.collect()) == [("7", 2, 7, 1), ("None", 0, None, 0), ("None", 2, 7, 1)]
    assert jaccard_join.jaccard_components(empty(docs)).collect() == []


def test_components_steps_write_few_files(spark, monkeypatch):
    real, files = shared.saved, []
    monkeypatch.setattr(shared, "saved", lambda df: [out := real(df), files.append(out.rdd.getNumPartitions())][0])
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(i, 1000 - i) for i in range(400, 450)], "a long, b long")
        got = {r.node: r.root for r in shared.connected_components(edges).collect()}
        assert max(files[1:]) <= shared.LEAST_FILES
        monkeypatch.setattr(shared, "EDGES", 4)  # more edges, more files
        files.clear()
        again = {r.node: r.root for r in shared.connected_components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files[1] == 20
    assert got == again == {i: 0 for i in range(31)} | {i: min(i, 1000 - i) for i in [*range(400, 450), *range(551, 601)]}


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lists = [np.sort(rng.choice(30, rng.integers(1, 25), replace=False)) for _ in range(12)]
        at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
        need = int(rng.integers(1, 12))
        found, times = jaccard_join.overlaps(np.arange(12), at, np.concatenate(lists), need, 30)
        count = np.bincount(np.concatenate(lists), minlength=30)
        assert dict(zip(found.tolist(), times.tolist())) == {i: int(c) for i, c in enumerate(count) if c >= need}


def removed(rows):
    seen = Counter()
    bodies = [(r[1] or "").encode() for r in rows]
    for b in bodies:
        seen.update(b[i:i + 400] for i in range(len(b) - 399))
    out = []
    for r, b in zip(rows, bodies):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i:i + 400] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((r[0], len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup(docs, hot):
    got = suffix_dedup.remove_repeats(docs, hot_gram=hot).select(
        "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("removed"), F.sha2("kept", 256))
    assert sorted(tuple(r) for r in got.collect()) == removed(corpus())
    assert suffix_dedup.remove_repeats(empty(docs)).collect() == []


def test_suffix_dedup_long_text_in_segments(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1500)
    body = prose(1500)
    rows = [(1, body + " " + prose(50) + " " + body[200:2200], "", "", 0), (2, prose(40) + body[3000:4000], "", "", 0)]
    data = [np.frombuffer(r[1].encode(), np.uint8) for r in rows]
    found = [p for o in suffix_dedup._anchors_of(data[0], np.array([0, len(data[0])])) for p in o[1].tolist()]
    whole = suffix_dedup.anchors(data[0], np.array([0, len(data[0])]))[1].tolist()
    assert sorted(found) == whole
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, docs.schema))
    assert sorted((r.doc_id, r.n_bytes - len(r.kept)) for r in got.collect()) == [(a, c) for a, _, c, _, _ in removed(rows)]


def test_interval_tree():
    # suffixes a, ab, abc, abd, b: common prefixes 1 2 2 0
    assert sorted(suffix_dedup.intervals(np.array([1, 2, 2, 0]), 1)) == [(1, 0, 3), (2, 1, 3)]


def test_source_mix(spark, docs):
    rows = [(i, "t", "en", "big" if i % 3 else "small", 1) for i in range(6000)] + [(9001, None, None, None, None)]
    got = source_mix.mix(spark.createDataFrame(rows, docs.schema), spark.createDataFrame([("big", 1.0), ("small", 3.0), ("gone", 5.0)], "source string, weight double"))
    n = Counter(r.source for r in got.collect())
    assert set(n) == {"big", "small"} and abs(n["small"] / (n["big"] + n["small"]) - 0.75) < 0.03
    assert abs(sum(n.values()) - 6001) < 250
    keys = [r.mix_key for r in got.collect()]
    assert keys == sorted(keys)
    assert source_mix.mix(empty(docs), queries.weights(spark)).collect() == []


def test_warc_round_trip(spark):
    rows = [(1, "http://a/\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "z" * 400_000), (1, "dup", "<p>é</p>"), (None, "n", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(warc.mark_revisits(pages), warc.archive_folder(spark))
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in warc.read_archives(archives).collect()), key=str)
    want = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = min(p for p, _, h in rows if (h or "") == (html or "") and p is not None)
        again = page_id != first
        want.append((page_id, "revisit" if again else "response", first if again else None, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), b"" if again else body))
    assert got == sorted(want, key=str)
    assert warc.read_archives(warc.write_archives(warc.mark_revisits(pages.where("false")), warc.archive_folder(spark))).collect() == []


def test_quality_classifier(spark):
    rows = [(i, prose(60) if i % 2 else "BUY NOW!! " * 20 + prose(5).upper()) for i in range(600)] + [(None, None), (7001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    got = quality_model.classify(docs, labels).collect()
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == r.doc_id % 2 for r in held if r.doc_id < 600)
    assert {r.score for r in quality_model.classify(docs, labels.where("false")).collect()} == {0.5}


def test_chat_format(spark):
    rows = [(1, 0, "user", "a\\b<|im_end|>"), (1, 1, "assistant", "<\\|x\\"), (1, 2, "user", None), (2, 0, "a\n\\n", "x"), (3, 0, "assistant", ""),
            (3, 1, "assistant", "é\n"), (3, 1, "assistant", "é\n"), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.summary(chat_format.examples(turns)).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    for c, said in by.items():
        loss = "".join(x for _, r, x in said if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in said)
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.examples(turns).where("conv_id = 3").count() == 3
    assert chat_format.examples(turns.where("false")).count() == 0


def test_url_filter(spark):
    urls = ["http://WWW.Example.com/en/x?q#f", "https://a.example.com/en/1", "http://b.com", "http://b.com/", "x.net/es/1", "http://x.net/es/1",
            None, "", "http://notexample.com/en/", "http://é.NET/fr/", "http://q.org/é?x"] + [f"http://h{i}.com/{i}" for i in range(50)] + [f"http://h{i}.net/es/{i}" for i in range(50)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(11)] == [
        ("www.example.com", "/en/x", "www.example.com/en/"), ("a.example.com", "/en/1", "example.com/en/"), ("b.com", "", None), ("b.com", "/", "com/"),
        ("", "", None), ("x.net", "/es/1", "net/es/"), ("", "", None), ("", "", None), ("notexample.com", "/en/", "com/"), ("é.net", "/fr/", "net/fr/"), ("q.org", "/é", None)]
    assert (got[0].verdict, got[1].verdict, got[3].verdict, got[5].verdict) == ("allow", "block", "allow", "block")
    assert {r.verdict for r in got.values()} <= {"allow", "block"}
    alone = url_filter.judge(spark.createDataFrame([(1, "http://q.org/a")], "page_id long, url string")).collect()
    assert alone[0].verdict == "allow" and alone[0].score == 0


def test_multi_index_recall_and_edges(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5100, [0.0] * 16), (5200, [1.0] * 3), (5300, [float("nan")] * 16), (5400, [None] * 16), (5500, x[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in multi_index.nearest(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {*range(0, 3000, 100), 5500}
    full, ids = np.concatenate((x, x[:1])).astype(float), np.array([*range(3000), 5500])
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((full - full[ids == q][0]) ** 2).sum(1))
        best = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hits += len({i for i, _ in found} & set(ids[best].tolist()))
        assert all(abs(s - d[ids == i][0]) < 1e-12 for i, s in found) and found == sorted(found, key=lambda f: (f[1], f[0]))
    assert hits / (10 * len(got)) >= 0.9
    few = multi_index.nearest(table.where("vec_id < 4 or vec_id = 5500"), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, i) for i in range(1, 5)] + [(5500, i) for i in range(1, 5)]
    assert multi_index.nearest(table.where("false"), F.lit(True)).collect() == []


def test_packing(docs):
    from tokenizers import Tokenizer
    got = packing.pack_documents(docs.select("doc_id", "text"), queries.TOKENIZER, size=256).collect()
    encode = Tokenizer.from_file(queries.TOKENIZER).encode
    want = sorted((i, ids[a:a + 256]) for i, t, *_ in corpus() for ids in [encode(t or "", add_special_tokens=False).ids + [1]] for a in range(0, len(ids), 256))
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(empty(docs).select("doc_id", "text"), queries.TOKENIZER).collect() == []


@pytest.mark.parametrize("text", ["Hello, WORLD. it's  a\ttest\n\nÉcole é. naïve… ÑANDÚ <|endoftext|> x", "ΣΑΣ σας. İstanbul ß ſ ª º Ⅷ 12.5 don't 'Tis",
                                  "école É. a b .. ., x., y.. É, é.,", "<|STARTOFTEXT|> ...", ""])
def test_token_ids_equal_the_tokenizers(text):
    from tokenizers import Tokenizer
    ids = packing._Ids(queries.TOKENIZER)
    assert np.frombuffer(ids.text(text), "<u4").tolist() == Tokenizer.from_file(queries.TOKENIZER).encode(text, add_special_tokens=False).ids


def test_token_ids_of_marks_after_letters():
    from tokenizers import Tokenizer
    encode = Tokenizer.from_file(queries.TOKENIZER).encode
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    ends = marks + [a + b for a in marks for b in marks if a + b != "<|"] + ["***", "...", "&&&", ".'s", "'s.", "',", ".\u0338", "<\u0338"]
    for stem in ["en", "\u00e9t\u00e9", "x.y", "a1", "7", "e\u0301", "\u00aa", "\u03c3", "it's", "don't", ""]:
        text = " ".join(stem + end for end in ends)
        assert np.frombuffer(packing._Ids(queries.TOKENIZER).text(text), "<u4").tolist() == encode(text, add_special_tokens=False).ids, stem


def test_marks_after_letters_are_looked_up_once():
    ids, asked = packing._Ids(queries.TOKENIZER), []

    class Asked:
        def encode(self, text, **how):
            asked.append(text)
            return whole.encode(text, **how)

    whole, ids.tokenizer = ids.tokenizer, Asked()
    ids.text(" ".join(f"{word}{end}" for word in ("one", "two", "three") for end in ("***", "&&&", "...", "!")))
    assert sorted(asked) == ["!", "&&&", "***", "..."]


def test_plan_uses_every_piece_once():
    rng = random.Random(1)
    for _ in range(20):
        lengths = Counter(rng.randint(1, 64) for _ in range(500))
        made = packing.plan(lengths, 64)
        used = Counter()
        for held, times in made:
            assert sum(held) <= 64 and times > 0
            for x in held:
                used[x] += times
        assert used == lengths
        assert sum(t for _, t in made) <= -(-sum(k * n for k, n in lengths.items()) // 64) * 1.05 + 1


def test_quality_rules(spark, docs):
    wide = docs.withColumn("kept", F.lit("x")).withColumn("score", F.lit("y"))  # clashing names
    got = quality_rules.judge(wide, spark.createDataFrame([(0,), (2,)], "doc_id long")).collect()
    assert len(got) == len(corpus())
    for r in got:
        text = r.text or ""
        w = WORD.findall(text)
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        rep = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        base = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        assert r.base_failed == failed and r.kept == (not failed and r.score >= quality_rules.THRESHOLD)
    none = quality_rules.judge(docs, docs.where("false").select("doc_id")).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in none)
    assert quality_rules.judge(empty(docs), docs.select("doc_id")).collect() == []


def test_quality_rules_buckets_grow_with_the_corpus(spark, docs, monkeypatch):
    def grown(n):
        return spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(
            F.sequence(F.lit(0), F.lit(59)), lambda i: F.concat(F.lit("w"), F.col("id") * 60 + i))).alias("text"))
    few, many = (quality_rules.bucket_count(grown(n)) for n in (2000, 16000))
    assert 7 < many / few < 9
    # buckets beyond the table's bound meet it in a join: the scores stay the same, those of repeated rows too
    trust = spark.createDataFrame([(0,), (2,), (11,)], "doc_id long")

    def scores():
        return sorted((str(r.doc_id), r.n_words, r.score, r.kept) for r in quality_rules.judge(docs, trust, buckets=5000).collect())
    whole = scores()
    monkeypatch.setattr(quality_rules, "SLOTS", 64)
    monkeypatch.setattr(quality_rules, "MOST", 4999)
    parted = scores()
    assert len({s for _, _, s, _ in whole}) > 8
    assert parted == whole


def test_quality_rules_count_in_few_tasks(spark, docs, monkeypatch):
    """Each counting task sends a row per bucket, so small partitions are taken together."""
    trust = spark.createDataFrame([(0,), (2,), (11,)], "doc_id long")
    plans, kept = [], quality_rules.stored
    monkeypatch.setattr(quality_rules, "stored", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(df))
    cores = spark.sparkContext.defaultParallelism
    many = docs.repartition(8 * cores)
    few = sorted(quality_rules.model_of(many, trust, 5000).collect())
    assert f"Repartition {cores}, false" in plans[-1]
    size = quality_rules.text_size(many)
    monkeypatch.setattr(quality_rules, "TASK_TEXT", size // (3 * cores))  # as much text as three tasks a core take
    assert sorted(quality_rules.model_of(many, trust, 5000).collect()) == few
    assert f"Repartition {3 * cores}, false" in plans[-1]
    assert quality_rules.text_size(empty(docs)) == 0


def spark_hash(value, seed=42):
    """xxhash64 of a text or a long, as Spark computes it."""
    h = xxhash.xxh64_intdigest(value.encode() if isinstance(value, str) else struct.pack("<q", value), seed)
    return h - (h >> 63 << 64)


def test_quality_rules_score(spark, docs):
    trusted = {0, 2, 11}
    trust = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    grams = []
    for i, text, *_ in corpus():
        h = [spark_hash(w) for w in WORD.findall(text or "")]
        grams.append((i, h + [spark_hash(b, spark_hash(a) % 2 ** 64) for a, b in zip(h, h[1:])]))
    for buckets in (quality_rules.LEAST, 5000):  # one row of the table, and two
        raw, target = Counter(), Counter()
        for i, g in grams:
            raw.update(x % buckets for x in g)
            target.update(x % buckets for x in g if i in trusted)
        n, m = raw.total(), target.total()
        steps = {b: math.floor((math.log((target[b] + 1) / (m + buckets)) - math.log((raw[b] + 1) / (n + buckets))) * quality_rules.STEPS + 0.5)
                 for b in raw}
        want = sorted((i, len(g), sum(steps[x % buckets] for x in g)) for i, g in grams)
        for parts in (1, 7):  # the same whatever the partitions
            got = quality_rules.judge(docs.repartition(parts), trust, buckets=buckets).collect()
            size = {r.doc_id: max(1, 2 * r.n_words - 1) if r.n_words else 0 for r in got}
            assert sorted((r.doc_id, size[r.doc_id], round(r.score * quality_rules.STEPS * max(1, size[r.doc_id]))) for r in got) == want


@pytest.mark.parametrize("epochs", [1.0, 5.0])
def test_source_mix_rare_source_keeps_its_share(spark, epochs):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2, "rare").otherwise("big").alias("source"))
    weights = spark.createDataFrame([("big", 1.0), ("rare", 1.0)], "source string, weight double")
    got = source_mix.mix(docs, weights, epochs=epochs)  # rates 1,000 and 5,000 for each row of the rare source
    n = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(n["rare"] - 2000 * epochs) < 6 * (2000 * epochs) ** 0.5
    assert abs(n["big"] - 2000 * epochs) < 6 * (2000 * epochs) ** 0.5
    each = [r["count"] for r in got.where("source = 'rare'").groupBy("doc_id").count().collect()]
    assert len(each) == 2 and each[0] != each[1]
