"""BPE against the public library, round trips, odd rows."""

import random
import tracemalloc
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from instrel.llm import op08_bpe as op

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op.ranks(PATH), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_words(word):
    assert op.encode_word(word, op.ranks(PATH)) == LIBRARY._encode_single_piece(word)


def test_long_word():
    word = "".join(random.Random(1).choice("abcdeé") for _ in range(5000)).encode()
    assert op.encode_word(word, op.ranks(PATH)) == LIBRARY._encode_single_piece(word)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé1'.s \n\t\xa0\x1c\u2003\r", max_size=30))
def test_pieces_match_alone(text):
    cut = op.regex.compile(public_tokenizers.PATTERN).findall
    first, *rest = op.pieces_of(text)
    assert [w for p in [first, *(" " + x for x in rest)] for w in cut(p)] == cut(text)


@pytest.mark.parametrize("parted", [False, True])
def test_documents(spark, parted):
    rng = random.Random(2)
    bits = ["the", " ", "  ", "\n", "\n\n ", "Über", "don't", "12345", "漢字", "𝄞", "<|endoftext|>", "!!", "a" * 50, "\t", "é", "'s"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(200))) for _ in range(80)] + [None, "", "   ", "x" * 20000, "word " * 9000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "null id"), (2, texts[1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    encoded = op.encode(frame, PATH, public_tokenizers.PATTERN, parted).collect()
    key = lambda x: (str(x[0]), list(x[1]))
    assert sorted(((r.doc_id, r.ids) for r in encoded), key=key) == sorted(((i, LIBRARY.encode_ordinary(t or "")) for i, t in rows), key=key)
    back = op.decode(spark.createDataFrame(encoded, "doc_id long, ids array<int>"), PATH).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == sorted((str(i), (t or "").encode()) for i, t in rows)
    for r in back:
        if r.doc_id == 80:
            assert (r.n_tokens, r.ids_sha256) == (0, sha256(b"").hexdigest())
        if r.doc_id == 5:
            assert r.ids_sha256 == sha256(np.array(LIBRARY.encode_ordinary(texts[5]), "<u4").tobytes()).hexdigest()


def test_empty(spark):
    encoded = op.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN)
    assert op.decode(encoded, PATH).count() == 0


def test_memory_of_a_block(tmp_path):
    """A block of distinct words takes a bounded multiple of its text, and its ids do not hold the texts they came with."""
    rng = random.Random(4)
    texts = [" ".join(f"{rng.getrandbits(50):x}" for _ in range(400)) for _ in range(600)]
    whole = pa.record_batch({"doc_id": pa.array(range(600)), "text": pa.array(texts)})
    with pa.OSFile(str(tmp_path / "in"), "wb") as out, pa.ipc.new_stream(out, whole.schema) as writer:
        writer.write_batch(whole)
    size = whole.nbytes
    del whole
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    with open(tmp_path / "in", "rb") as stream:
        block, = op._blocks(iter(pa.ipc.open_stream(stream)), public_tokenizers.PATTERN, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    block = block._replace(words=None)
    assert pa.total_allocated_bytes() - before < size / 4
    assert peak < 25 * size, peak / size
    assert sum(map(len, block.ids)) == 600
