"""Language model scores by context-tree weighting.

A text is coded as it runs: its words with a blank behind each, then an end. Each
byte is eight binary decisions from the top, in the context of the ``DEPTH`` bytes
before it, whichever words they belong to; before a text stand blanks. Every node of
the tree, a context of some length with the bits of the byte so far, holds how often
0 and 1 followed in training. Its Krichevsky-Trofimov probability is weighted,
half and half, with the product of its children's weighted probabilities:

    Pw = (Pkt + product of children's Pw) / 2,  at full depth Pw = Pkt

The next bit's probability mixes the estimates of all depths along the path by
the weights that these block probabilities give. A context that training never
met adds nothing: the mixture ends at the longest that it met.

The work is split so that no table has to fit in one task. The last ``DEPTH`` + 1
bytes at a place (a gram, one 64-bit number) decide a code. Texts are read in
blocks; a block's distinct grams and words go, sorted and packed, to buckets. A
gram's bucket is a hash of its nearest three context bytes, so a bucket holds whole
subtrees, and its blocks are read one after the other. Buckets add up and keep the
counts and give the sums of two-byte contexts, of which the two upper levels, at most
257 x 256 x 255 nodes, are mixed on the driver and sent to all. Then buckets mix their subtrees and
send each block the codes of its own grams and the counts of its words, in the
order in which the block had sent them. A block adds them up by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from instrel.llm.common import held_out, key_and_text, stored, text_bytes

#: Bytes of context.
DEPTH = 6
#: Context bytes whose subtrees stay together.
NEAR = 3
#: Bytes of the texts of a block, about, and of what a block looks at at once.
BLOCK, PART = 16 << 20, 2 << 20
#: Buckets, and bytes of text above which there are more of them.
BUCKETS, BUCKET_BYTES = 512, 16 << 30
#: Grams that a bucket holds before it adds them up.
HELD = 2_000_000
#: The end of a text as a token: one byte that no word holds.
END = b"\n"

_HALF = np.log(0.5)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series eight places on."""
    y = x + 8.0
    shift = np.log(x)
    for k in range(1, 8):
        shift = shift + np.log(x + k)
    inverse = 1 / y
    series = inverse * (1 / 12 - inverse**2 * (1 / 360 - inverse**2 * (1 / 1260 - inverse**2 / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - shift


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of gamma at n + 1/2 and at n + 1 for small n."""
    n = np.arange(1 << 16, dtype=float)
    return log_gamma(n + 0.5), log_gamma(n + 1.0)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability of so many zeros and ones."""
    halves, wholes = _tables()
    both = zeros + ones
    most = np.minimum(both, len(wholes) - 1).astype(np.int64)
    found = halves[np.minimum(zeros, most).astype(np.int64)] + halves[np.minimum(ones, most).astype(np.int64)] - wholes[most]
    many = np.flatnonzero(both >= len(wholes))
    if len(many):
        found[many] = log_gamma(zeros[many] + 0.5) + log_gamma(ones[many] + 0.5) - log_gamma(both[many] + 1.0)
    return found - np.log(np.pi)


def coded(words: list[bytes]) -> bytes:
    """What is coded of a text."""
    return b" ".join([*words, END])


def grams_of(texts: list[bytes]) -> np.ndarray:
    """The gram at each byte of each text; before a text stand blanks."""
    pad = b" " * DEPTH
    joined = np.frombuffer(b"".join(x for text in texts for x in (pad, text)), dtype=np.uint8).astype(np.uint64)
    grams = joined.copy()
    for back in range(1, DEPTH + 1):
        grams[back:] |= joined[:-back] << np.uint64(8 * back)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + DEPTH)
    inside = np.ones(len(joined), dtype=bool)
    for back in range(1, DEPTH + 1):
        inside[ends - lengths - back] = False
    return grams[inside]


def _nodes(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the eight bits of the last byte: the bits before it with a leading 1 (columns), and the bit."""
    byte = (grams & np.uint64(255)).astype(np.int64)
    prefix = np.stack([(1 << k) | (byte >> (8 - k)) for k in range(8)], axis=1)
    bits = np.stack([(byte >> (7 - k)) & 1 for k in range(8)], axis=1)
    return prefix, bits


class Level:
    """Nodes of one context length: keys (context and bits so far), counts of both bits, logarithm of the weighted probability."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_kt(zeros, ones)
        self.weighted = own if children is None else np.logaddexp(own, children) + _HALF
        self.share = np.ones(len(keys)) if children is None else np.exp(own + _HALF - self.weighted)

    def mix(self, keys: np.ndarray, bits: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of the bits with what lies deeper mixed in; NaN where no such node exists, and taken so from ``deeper``."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        there = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        zeros, ones = self.zeros[at], self.ones[at]
        own = (np.where(bits == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)
        if deeper is not None:
            share = np.where(np.isnan(deeper), 1.0, self.share[at])
            own = share * own + (1 - share) * np.where(np.isnan(deeper), 0.0, deeper)
        return np.where(there, own, np.nan)

    def parents(self, drop: int) -> Level:
        """The level of contexts shorter by a byte, whose first 8 bits stand at ``drop`` in the keys."""
        keys = self.keys & ((1 << drop) - 1)
        short, where = np.unique(keys, return_inverse=True)
        sums = [np.bincount(where, x, len(short)) for x in (self.zeros, self.ones, self.weighted)]
        return Level(short, *sums)


def _keys(grams: np.ndarray, prefix: np.ndarray, length: int) -> np.ndarray:
    """Context of ``length`` bytes and the bits so far in one number: the nearest byte stands lowest."""
    context = (grams >> np.uint64(8)) & np.uint64((1 << 8 * length) - 1)
    return (context.astype(np.int64)[:, None] << 8) | prefix


def subtree_levels(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The levels of some contexts of ``NEAR`` bytes, deepest first, from all their grams."""
    trained = counts > 0
    prefix, bits = _nodes(grams[trained])
    keys, where = np.unique(_keys(grams[trained], prefix, DEPTH).ravel(), return_inverse=True)
    weights, flat = np.repeat(counts[trained], 8).astype(float), bits.ravel()
    levels = [Level(keys, np.bincount(where, weights * (1 - flat), len(keys)), np.bincount(where, weights * flat, len(keys)), None)]
    for length in range(DEPTH, NEAR, -1):
        levels.append(levels[-1].parents(8 * length))
    return levels


def mix_subtrees(grams: np.ndarray, levels: list[Level]) -> np.ndarray:
    """For each gram the probability of each bit mixed from ``NEAR`` bytes of context on; NaN without training."""
    prefix, bits = _nodes(grams)
    mixed = None
    for level, length in zip(levels, range(DEPTH, NEAR - 1, -1), strict=True):
        mixed = level.mix(_keys(grams, prefix, length).ravel(), bits.ravel(), mixed)
    return mixed.reshape(-1, 8)


class Top:
    """Contexts shorter than ``NEAR`` bytes, over the subtrees."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray):
        """Sums over subtrees for each context of ``NEAR`` - 1 bytes and bits so far."""
        order = np.argsort(keys)
        self.levels = [Level(keys[order], zeros[order], ones[order], weighted[order])]
        for length in range(NEAR - 1, 0, -1):
            self.levels.append(self.levels[-1].parents(8 * length))

    def log_probability(self, grams: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Natural logarithm of each gram's last byte; a bit that training never led to has probability 1/2."""
        prefix, bits = _nodes(grams)
        flat, mixed = bits.ravel(), mixed.ravel()
        for length, level in zip(range(NEAR - 1, -1, -1), self.levels, strict=True):
            mixed = level.mix(_keys(grams, prefix, length).ravel(), flat, mixed)
        return np.log(np.where(np.isnan(mixed), 0.5, mixed)).reshape(-1, 8).sum(axis=1)


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def gram_bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    near = (grams >> np.uint64(8)) & np.uint64((1 << 8 * NEAR) - 1)
    return ((near * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) >> np.uint64(9)).astype(np.int64) % buckets


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, the first bytes of all before the second of all, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1) if len(values) else b""


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8) if blob else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, "<u8"), dtype=np.uint64)


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts of about ``PART`` bytes at once."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def gram_counts(texts: list[bytes], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of coded texts, sorted, and how often those of training hold each."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for own in (True, False):
        for part in _parts([t for t, y in zip(texts, train, strict=True) if y == own]):
            found, n = _distinct(grams_of(part))
            keys.append(found)
            counts.append(n if own else np.zeros_like(n))
    return add_up(np.concatenate(keys), np.concatenate(counts))


def tokens_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of coded texts as first met, the number of each token in turn, and how many each text has."""
    cut = pc.split_pattern(pa.array(texts, pa.binary()), b" ")
    met = cut.flatten().dictionary_encode()
    return met.dictionary.to_pylist(), met.indices.to_numpy(), cut.value_lengths().to_numpy().astype(np.int64)


def dealt_words(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by bucket, and where each bucket's start."""
    where = np.fromiter(map(xxh32_intdigest, words), np.int64, len(words)) % buckets
    order = np.argsort(where, kind="stable")
    return order, np.searchsorted(where[order], np.arange(buckets + 1))


def distinct_grams(texts: list[bytes]) -> np.ndarray:
    """The distinct grams of coded texts, sorted."""
    return _distinct(np.concatenate([np.zeros(0, np.uint64), *(_distinct(grams_of(part))[0] for part in _parts(texts))]))[0]


def code_sums(texts: list[bytes], known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The sum of the codes of each coded text's grams; ``known`` are all their grams, sorted."""
    sums = [np.zeros(0)]
    # An odd factor is one to one and spreads grams over the upper bits.
    known = known * _SPREAD
    order = np.argsort(known)
    known, codes = known[order], codes[order]
    for part in _parts(texts):
        grams = grams_of(part) * _SPREAD
        # Upper bits of the gram over its place are sorted, as numbers sort far quicker than places do by numbers. Grams that agree
        # in the upper bits may mix: some are then looked up more than once.
        low = np.uint64((1 << len(grams).bit_length()) - 1)
        places = (np.sort(grams & ~low | np.arange(len(grams), dtype=np.uint64)) & low).astype(np.int64)
        grams = grams[places]
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        ranked = np.empty(len(grams))
        # Nearly sorted grams are found one behind the other, which is far quicker than here and there.
        ranked[places] = np.repeat(codes[np.searchsorted(known, grams[first])], np.diff(first, append=len(grams)))
        sums.append(np.add.reduceat(ranked, np.cumsum([0, *(len(t) for t in part[:-1])])))
    return np.concatenate(sums)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, pa.Table]]:
    """A partition's rows in blocks of about ``most`` bytes of text, however the rows come in batches."""
    held, size, nr = [], 0, 0
    name = lambda: f"{TaskContext.get().partitionId()}-{nr}"
    for batch in batches:
        sizes = np.cumsum([len(t) for t in text_bytes(batch.column("text"))])
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = int(np.searchsorted(sizes, before + most - size, side="left")) + 1
            some = batch.slice(start, min(end, batch.num_rows) - start)
            held.append(some)
            if end <= batch.num_rows and sizes[end - 1] - before + size >= most:
                yield name(), pa.Table.from_batches(held)
                held, size, nr = [], 0, nr + 1
            else:
                size += int(sizes[min(end, batch.num_rows) - 1] - before)
            start = min(end, batch.num_rows)
    if held:
        yield name(), pa.Table.from_batches(held)


def _texts_of(table: pa.Table) -> tuple[list[bytes], list[bool]]:
    """The coded texts of a block's rows, and which of them training holds."""
    texts = [coded(t.lower().split()) for chunk in table.column("text").chunks for t in text_bytes(chunk)]
    return texts, [not h for h in table.column("held_out").to_pylist()]


def _dealt(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted grams by bucket, and where each bucket's start."""
    where = gram_bucket(grams, buckets)
    order = np.argsort(where, kind="stable")
    return order, np.searchsorted(where[order], np.arange(buckets + 1))


_SENT = "bucket int, block string, grams binary, gram_counts binary, words binary, word_counts binary"


def _sent(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """A row for each bucket of each block: its sorted grams and its words with the counts of both in training."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in _blocks(batches, most):
            texts, train = _texts_of(table)
            found, n = gram_counts(texts, train)
            order, cuts = _dealt(found, buckets)
            found, n, spans = found[order], n[order].astype("<i8"), list(zip(cuts, cuts[1:], strict=False))
            grams, counts = [packed_keys(found[a:b]) for a, b in spans], [packed(n[a:b]) for a, b in spans]
            distinct, numbers, lengths = tokens_of(texts)
            n = np.bincount(numbers[np.repeat(train, lengths)], minlength=len(distinct)).astype("<i8")
            order, cuts = dealt_words(distinct, buckets)
            distinct, n, spans = [distinct[i] for i in order.tolist()], n[order], list(zip(cuts.tolist(), cuts[1:].tolist(), strict=False))
            words, word_counts = [b" ".join(distinct[a:b]) for a, b in spans], [packed(n[a:b]) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(buckets), pa.int32()), pa.array([name] * buckets), *(pa.array(x, pa.binary()) for x in (grams, counts, words, word_counts))],
                ["bucket", "block", "grams", "gram_counts", "words", "word_counts"])

    return rows.select("held_out", "text").mapInArrow(each, _SENT)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["bucket"], row


def _merged(sent: DataFrame) -> DataFrame:
    """Each bucket's grams and words with the sums of their counts, and the sums of its subtrees (``keys`` and so on) for the levels above."""
    def finish(bucket: int, grams: np.ndarray, counts: np.ndarray, words: dict[bytes, int]) -> pa.RecordBatch:
        grams, counts = add_up(grams, counts)
        level = subtree_levels(grams, counts)[-1]
        keys, where = np.unique(level.keys & ((1 << 8 * NEAR) - 1), return_inverse=True)
        sums = [packed(np.bincount(where, x, len(keys))) for x in (level.zeros, level.ones, level.weighted)]
        total = np.fromiter(words.values(), "<i8", len(words))
        blobs = [packed_keys(grams), packed(counts.astype("<i8")), b" ".join(words), packed(total), packed(keys.astype("<i8")), *sums]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs),
             pa.array([int(total.sum())], pa.int64()), pa.array([int((total > 0).sum())], pa.int64())],
            ["bucket", "grams", "gram_counts", "words", "word_counts", "keys", "zeros", "ones", "weighted", "tokens", "distinct"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, words = None, [], 0, {}
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        both = lambda: [np.concatenate([h[i] for h in held]) if held else none[i] for i in (0, 1)]
        for bucket, row in _by_bucket(batches):
            if bucket != now:
                if now is not None:
                    yield finish(now, *both(), words)
                now, held, size, words = bucket, [], 0, {}
            held.append((unpacked_keys(row["grams"]), unpacked(row["gram_counts"], "<i8")))
            size += len(held[-1][0])
            if size > HELD:
                held = [add_up(*both())]
                size = len(held[0][0]) // 2  # no more than twice the distinct ones are held before the next time
            for word, n in zip(row["words"].split(b" ") if row["words"] else [], unpacked(row["word_counts"], "<i8").tolist(), strict=True):
                words[word] = words.get(word, 0) + n
        if now is not None:
            yield finish(now, *both(), words)

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    shape = "bucket int, grams binary, gram_counts binary, words binary, word_counts binary, keys binary, zeros binary, ones binary, weighted binary, tokens bigint, distinct bigint"
    return dealt.mapInArrow(each, shape)


def _top(merged: DataFrame) -> Top:
    """The levels above the subtrees; contexts of two bytes, of which there are 65,536, and at most 255 nodes of each."""
    rows = merged.select("keys", "zeros", "ones", "weighted").toArrow().to_pylist()
    cells = [np.concatenate([unpacked(r[c], kind) for r in rows]) if rows else np.zeros(0, kind)
             for c, kind in (("keys", "<i8"), ("zeros", "<f8"), ("ones", "<f8"), ("weighted", "<f8"))]
    keys, where = np.unique(cells[0], return_inverse=True)
    return Top(keys, *(np.bincount(where, x, len(keys)) for x in cells[1:]))


def _answered(sent: DataFrame, merged: DataFrame, top: Top) -> DataFrame:
    """``block, bucket, codes, counts``: for each bucket of each block the codes of its grams and the training counts of its words."""
    told = sent.sparkSession.sparkContext.broadcast(top)
    first = merged.select("bucket", F.lit(None).cast("string").alias("block"), "grams", "gram_counts", "words", "word_counts")
    asked = sent.select("bucket", "block", "grams", F.lit(None).cast("binary").alias("gram_counts"), "words", F.lit(None).cast("binary").alias("word_counts"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codes, counts, out = None, None, {}, []
        for bucket, row in _by_bucket(batches):
            if row["block"] is None:
                known = unpacked_keys(row["grams"])
                mixed = mix_subtrees(known, subtree_levels(known, unpacked(row["gram_counts"], "<i8")))
                codes = told.value.log_probability(known, mixed).astype("<f4")
                counts = dict(zip(row["words"].split(b" ") if row["words"] else [], unpacked(row["word_counts"], "<i8").tolist(), strict=True))
                continue
            own = codes[np.searchsorted(known, unpacked_keys(row["grams"]))]
            words = row["words"].split(b" ") if row["words"] else []
            out.append((row["block"], bucket, packed(own), packed(np.array([counts[w] for w in words], dtype="<i8"))))
            if len(out) >= 64:
                yield _rows(out)
                out = []
        yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        block, bucket, codes, counts = zip(*out, strict=True) if out else ((),) * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(block, pa.string()), pa.array(bucket, pa.int32()), pa.array(codes, pa.binary()), pa.array(counts, pa.binary())],
            ["block", "bucket", "codes", "counts"])

    dealt = first.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
    return dealt.mapInArrow(each, "block string, bucket int, codes binary, counts binary")


def score_documents(
    docs: DataFrame, remainder: int = 1, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK,
) -> DataFrame:
    """Scores of all rows by the model of those that are not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bytes, bits_per_byte``. A null or empty text is its
    end alone. Rows with a null id are not held out. Repeated rows are texts of their own. An empty table gives none.
    The table is read twice and has to give the same partitions with the same rows in the same order, as files do; if it
    does not, the job stops.
    """
    rows = key_and_text(docs, id_col, text_col).select("doc_id", held_out(F.col("doc_id"), remainder).alias("held_out"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = BUCKETS * (1 + size // BUCKET_BYTES)
    sent = stored(_sent(rows, buckets, block_bytes), "grams")
    merged = stored(_merged(sent), "merged")
    totals = merged.agg(F.sum("tokens"), F.sum("distinct")).first()
    total, spread = int(totals[0] or 0), int(totals[0] or 0) + 0.5 * (int(totals[1] or 0) + 1)
    answered = _answered(sent, merged, _top(merged))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table in _blocks(batches, block_bytes):
            nr = 0
            for batch in table.to_batches():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * batch.num_rows), pa.array(range(nr, nr + batch.num_rows), pa.int64()), *batch.columns],
                    ["block", "nr", *batch.schema.names])
                nr += batch.num_rows

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts, answers = texts.sort_by("nr"), answers.sort_by("bucket")
        own, _ = _texts_of(texts)
        known = distinct_grams(own)
        order, cuts = _dealt(known, buckets)
        distinct, numbers, lengths = tokens_of(own)
        places, ends = dealt_words(distinct, buckets)
        codes = [unpacked(x, "<f4") for x in answers.column("codes").to_pylist()]
        counts = [unpacked(x, "<i8") for x in answers.column("counts").to_pylist()]
        if [len(c) for c in codes] != np.diff(cuts).tolist() or [len(c) for c in counts] != np.diff(ends).tolist():
            raise RuntimeError("the table did not give the same rows twice")
        n = np.empty(len(distinct), np.int64)
        n[places] = np.concatenate(counts)
        logs = np.log10((n + 0.5) / spread)
        code = np.empty(len(known), np.float32)
        code[order] = np.concatenate(codes)
        code = code_sums(own, known, code)
        starts = np.cumsum(lengths) - lengths
        seen = np.add.reduceat(n[numbers] > 0, starts, dtype=np.int64)
        base = [float(sum(logs[numbers[a:a + m]].tolist())) for a, m in zip(starts.tolist(), lengths.tolist(), strict=True)]
        sizes = np.array([len(t) for t in own], dtype=np.int64)
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": texts.column("held_out"), "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(seen, pa.int64()), "train_tokens": pa.array([total] * len(own), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(code / np.log(10)), "bytes": pa.array(sizes),
            "bits_per_byte": pa.array(-code / np.log(2) / sizes)})

    own = rows.mapInArrow(named, f"block string, nr bigint, doc_id {kind}, held_out boolean, text string")
    return own.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bytes bigint, bits_per_byte double")
