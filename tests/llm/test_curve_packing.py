"""Curve packing: exact round trip against the tokenizer, no padding, locality."""
import itertools
import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from relaykit.llm import curve_packing as cp
from relaykit.llm import queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check_places(rows, size):
    """Offsets are gapless from 0; sequences are full or a power of two."""
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    assert all(n == size or n & (n - 1) == 0 for n in lengths) and max(lengths, default=0) <= size
    return lengths


def test_curve_visits_every_cell_by_steps_of_one():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = cp.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_every_id_lies_in_one_piece(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_curve_packing(spark, SF).collect()
    check_places(rows, 2048)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == docs.keys()
    total = 0
    for doc, parts in by_doc.items():
        ids, at = ids_of(docs[doc]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            part = ids[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
        total += at
    assert len({r.sequence_id for r in rows}) == total // 2048 + bin(total % 2048).count("1")


def test_defined_cases(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "word " * 9000), (3, "same text"), (3, "same text"), (4, "<|endoftext|> Ünïcode")] + [(9, "one hot text " * 40)] * 300
    docs = spark.createDataFrame([(i, t, "a", 7, 8) for i, t in rows], "doc_id long, text string, key string, length int, extra int").repartition(5)
    got = cp.pack_along_curve(docs, PATH, size=512)
    assert got.columns == ["doc_id", "extra", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    got = got.collect()
    check_places(got, 512)
    want = sum(len(ids_of(t)) for _, t in rows)
    assert sum(r.length for r in got) == want
    whole = sorted((r.doc_id or 0, r.start, r.sequence_id, r.ids) for r in got)
    assert sorted(i for _, s, _, b in whole for i in struct.unpack(f"<{len(b) // 4}I", b)) == sorted(i for _, t in rows for i in ids_of(t))
    assert cp.pack_along_curve(docs.where("false"), PATH).collect() == []


def test_neighbours_share_sequences(spark):
    """Documents of three vocabularies, mixed up, lie together on the curve."""
    rng = np.random.default_rng(1)
    words = ["river stone water bank".split(), "market price trade share".split(), "music song dance stage".split()]
    rows = [(k, " ".join(rng.choice(words[k % 3], 60))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = cp.pack_along_curve(docs, PATH, size=256).orderBy("sequence_id", "offset").collect()
    kinds = [r.doc_id % 3 for r in got]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    assert changes < len(kinds) / 10, changes
