"""Packing: ids against the library on whole texts, every id in one piece, sequences full or a power of two."""

import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from instrel.llm import op11_packing as op
from instrel.llm import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(n=300, seed=5):
    rng = random.Random(seed)
    some = ["a", "word", " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "\x1c", "　", "'s", "it's", "é", "日本", "😀", "123", "½", "!?", "<|endoftext|>", "́", "x" * 70, "_", "٣"]
    return ["".join(rng.choice(some) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("long", [3, 100_000])
def test_ids_are_those_of_whole_texts(library, monkeypatch, long):
    monkeypatch.setattr(op, "LONG", long)
    encoder = op.Encoder(PATH)
    assert encoder.ranked
    latin = ["".join(c for c in t if c < "\u0250") for t in odd_texts(seed=8)]
    every = ["".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250))), *(f"a{chr(i)} {chr(i)}1 {chr(i)}" for i in range(0x250))]
    for text in odd_texts() + latin + every + ["", " ", "   a", "a   ", "a \n b", "it's we'll 'S"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text), repr(text)


def test_texts_without_ranks_go_to_the_library(library):
    encoder = op.Encoder(PATH)
    encoder.ranked = None
    for text in odd_texts(50):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text)


def check(rows, texts, library, size, least):
    """``texts``: list of (doc_id, text). Every property that packing promises."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) > 0
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(library(t) + [0])
    for i, documents in want.items():
        got = defaultdict(list)
        for start, ids, total in pieces[i]:
            for at, x in enumerate(ids):
                got[start + at].append((total, x))
        expected = defaultdict(list)
        for d in documents:
            for at, x in enumerate(d):
                expected[at].append((len(d), x))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert pieces.keys() == want.keys()
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size and (at > size - least or at & (at - 1) == 0), at
    return sequences


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_packs_every_id_once(spark, library, parts):
    texts = list(enumerate(odd_texts(200, parts))) + [(1000, "long " * 5000), (1001, None), (1002, ""), (7, "again"), (7, "again"), (None, "none")]
    frame = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, ids int, start int").repartition(parts)
    rows = op.pack(frame, PATH, 64, 4, 3).collect()
    check(rows, texts, library, 64, 3)


def test_open_windows_are_bounded_and_best_fit():
    windows = op.Windows(16, 3, 2, 100)
    token = lambda n: b"\1\0\0\0" * n
    for nr, n in enumerate((10, 8, 12)):
        windows.add(nr, 0, token(n), n)
    windows.add(3, 0, token(4), 4)  # exactly the room beside 12
    assert [(p[0], p[4], p[5]) for p in windows.sealed] == [(2, 100, 0), (3, 100, 12)]
    windows.add(4, 0, token(7), 7)  # the window of 8, not a new one
    assert len(windows.rooms) == 2 and windows.rooms[0][0] == 1
    windows.add(5, 0, token(9), 9)
    windows.add(6, 0, token(8), 8)  # none takes it: the fullest has 1 id of room, which is padded, then a new one opens
    assert [p[0] for p in windows.sealed[2:]] == [1, 4] and len(windows.rooms) == 3
    windows.add(7, 0, token(9), 9)  # the fullest has room for 6, so a head of 6 fills it
    assert [(p[0], p[1], len(p[2]) // 4) for p in windows.sealed[4:]] == [(0, 0, 10), (7, 0, 6)]
    assert all(len(windows.held) <= 3 for _ in [0])


def test_empty_table(spark):
    assert op.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = queries.op11_packing(spark, folder).collect()
    texts = {r.doc_id: library(r.text) + [0] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    lengths = defaultdict(int)
    for r in rows:
        ids = np.array(texts[r.doc_id][r.start:r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == crc32(ids.tobytes()) and r.doc_tokens == len(texts[r.doc_id])
        lengths[r.sequence_id] += r.length
    total = sum(map(len, texts.values()))
    assert sum(lengths.values()) == total
    padding = sum(1024 - n for n in lengths.values() if n & (n - 1))
    assert padding < 0.005 * total
