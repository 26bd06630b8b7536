"""How far the sources of a language use its terms differently, counted through minimal perfect hashes.

A first pass counts in how many documents of its language each term is, exactly,
and keeps the terms that are in enough of them. Kept terms are dealt to shards
by their hash, and each shard's task builds a minimal perfect hash: levels of bit
arrays in which a key sits at the first level where no other key meets it, its
slot being the rank of its bit. The tables hold the terms themselves in the
order of slots. The second pass reads the texts again with the tables broadcast;
a word's slot is verified against the term stored there, so words that were not
kept are never counted, and counts go to dense slots of each (language, source).

The tables are broadcast only if their measured size is within
``BROADCAST_BYTES``. Beyond it the second pass's counts, added up in each task,
meet the terms in a join by language and term instead; both ways give the same
rows.

Pair sums are worked out in blocks: a task has the dense counts of two blocks of
sources for one shard of terms and adds up the integer divergences in 64 bits,
which hold them exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from instrel.llm.common import sized_batches, stored, text_bytes

#: Documents of a language that a kept term is in at least.
LEAST_DOCS = 10
#: Terms ranked for each group.
TOP = 10
#: Fixed value: proportions are counted in units of 10^-9.
SCALE = 10**9
#: Terms of a shard, at most about; sources of a block, about.
SHARD, BLOCK = 8192, 32
#: Bytes of all tables up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Distinct words a task counts before it passes them on, and dense slots before it emits them.
COUNTED, DENSE = 400_000, 2_000_000
#: Levels of a perfect hash, and bits of a level for each key; keys that no level parts are listed.
LEVELS, ROOM = 24, 2
SEED = 42
#: Neighbouring slots whose counts stand in one row, and slots that a task of the pair sums looks at.
WIDE, PIECE = 16, 1024
_WIDE = [f"n{k}" for k in range(WIDE)]

# A-Z in lower case; all ASCII but letters parts terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0x94D049BB133111EB) >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)


def hash_terms(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxh64_intdigest(t, SEED) for t in terms), dtype=np.uint64, count=len(terms))


def build(terms: list[bytes]) -> tuple[list[int], bytes, list[bytes]]:
    """A minimal perfect hash of distinct terms: bits of each level, all bits packed, and the terms in the order of their slots."""
    terms = sorted(terms)
    hashes, left = hash_terms(terms), np.arange(len(terms))
    sizes, levels, order = [], [], []
    while len(left) and len(sizes) < LEVELS:
        bits = max(8, -(-len(left) * ROOM // 8) * 8)
        at = _places(hashes[left], len(sizes), bits)
        alone = np.bincount(at, minlength=bits)[at] == 1
        level = np.zeros(bits, dtype=bool)
        level[at[alone]] = True
        order.append(left[alone][np.argsort(at[alone])])
        sizes.append(bits)
        levels.append(np.packbits(level, bitorder="little"))
        left = left[~alone]
    slots = np.concatenate([*order, left]) if len(terms) else left
    packed = np.concatenate(levels).tobytes() if levels else b""
    return sizes, packed, [terms[i] for i in slots.tolist()]


class PerfectHash:
    """What ``build`` made, for lookups of many words at once."""

    def __init__(self, sizes: list[int], packed: bytes, terms: list[bytes]):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")
        self.sizes, self.starts = sizes, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.bits, self.rank = bits.astype(bool), np.cumsum(bits) - bits
        self.terms = np.array([*terms, b""], dtype=object)[:-1]
        placed = int(bits.sum())
        self.rest = {t: placed + i for i, t in enumerate(terms[placed:])}

    def slots(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each word that is the term stored there, else -1."""
        found, left = np.full(len(words), -1), np.arange(len(words))
        for level, bits in enumerate(self.sizes):
            at = self.starts[level] + _places(hashes[left], level, bits)
            hit = self.bits[at]
            found[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        own = np.array([*words, b""], dtype=object)[:-1]
        met = np.flatnonzero(found >= 0)
        found[met[self.terms[found[met]] != own[met]]] = -1
        if self.rest:
            for i in np.flatnonzero(found < 0).tolist():
                found[i] = self.rest.get(words[i], -1)
        return found


def proportions(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(``SCALE`` x (count + 2) / (total + 2 x kept)) in 64 bits, three digits at a time; exact up to 9 x 10^15 occurrences."""
    whole = total + 2 * kept
    rest, found = counts + 2, np.zeros_like(counts)
    found, rest = rest // whole, rest % whole
    for _ in range(3):
        rest = rest * 1000
        found, rest = found * 1000 + rest // whole, rest % whole
    return found + 1


def _rows(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), F.col(text_col).alias("text"))


def _texts(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def document_counts(rows: DataFrame) -> DataFrame:
    """``lang, term, n``: documents of a language that hold a term, as sums over tasks."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in counted.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), _texts(list(counts)), pa.array(counts.values(), pa.int64())], ["lang", "term", "n"])
            counted.clear()

        for batch in sized_batches(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text")), strict=True):
                counted.setdefault(lang, Counter()).update(set(terms_of(text)))
            if sum(map(len, counted.values())) > COUNTED:
                yield from out()
        yield from out()

    return rows.select("lang", "text").mapInArrow(each, "lang string, term string, n bigint")


def perfect_hashes(kept: DataFrame, shards: int) -> DataFrame:
    """``lang, shard, sizes, bits, terms``: a table for each language's terms of each of ``shards`` shards; ``terms`` are in the order of slots."""
    dealt = kept.withColumn("shard", F.pmod(F.shiftrightunsigned(F.xxhash64("term"), 32), F.lit(shards).cast("bigint")).cast("int"))

    def each(table: pa.Table) -> pa.Table:
        sizes, packed, terms = build(text_bytes(table.column("term").combine_chunks()))
        return pa.table({
            "lang": table.column("lang")[:1], "shard": table.column("shard")[:1], "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([packed], pa.binary()), "terms": pa.array([[t.decode() for t in terms]], pa.list_(pa.string()))})

    return dealt.groupBy("lang", "shard").applyInArrow(each, "lang string, shard int, sizes array<int>, bits binary, terms array<string>")


def _buffered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[tuple[str, str], Counter]]:
    """Words of each (lang, source), counted until about ``COUNTED`` are held."""
    counted: dict[tuple[str, str], Counter] = {}
    for batch in sized_batches(batches):
        columns = batch.column("lang").to_pylist(), batch.column("source").to_pylist(), text_bytes(batch.column("text"))
        for lang, source, text in zip(*columns, strict=True):
            counted.setdefault((lang, source), Counter()).update(terms_of(text))
        if sum(map(len, counted.values())) > COUNTED:
            yield counted
            counted = {}
    yield counted


def _recount_by_slots(rows: DataFrame, tables: DataFrame, shards: int) -> DataFrame:
    """``lang, source, shard, block, n0, n1, ..``: counts of ``WIDE`` slots from ``block`` x ``WIDE`` on, through broadcast tables, whose size the

    caller has checked.
    """
    sent = rows.sparkSession.sparkContext.broadcast(
        {(r.lang, r.shard): (r.sizes, bytes(r.bits), [t.encode() for t in r.terms]) for r in tables.collect()})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[tuple[str, int], PerfectHash] = {}
        langs = {lang for lang, _ in sent.value}
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def out() -> pa.RecordBatch:
            """All that is held, in one batch: a batch for each of very many small tables would cost more than what is in it."""
            found = [(key, counts.reshape(-1, WIDE)) for key, counts in dense.items()]
            at = [np.flatnonzero(rows.any(axis=1)) for _, rows in found]
            n = np.concatenate([rows[i] for (_, rows), i in zip(found, at, strict=True)] or [np.zeros((0, WIDE), np.int64)])
            keys = [[key[c] for (key, _), i in zip(found, at, strict=True) for _ in range(len(i))] for c in range(3)]
            dense.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.string()), pa.array(keys[2], pa.int32()),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int32)), *(pa.array(np.ascontiguousarray(n[:, k])) for k in range(WIDE))],
                ["lang", "source", "shard", "block", *_WIDE])

        held = 0
        for counted in _buffered(batches):
            for (lang, source), words in counted.items():
                if lang not in langs or not words:
                    continue
                terms, n = np.array([*words, b""], dtype=object)[:-1], np.fromiter(words.values(), np.int64, len(words))
                hashes = hash_terms(list(words))
                dealt = ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
                for shard in np.unique(dealt).tolist():
                    if (lang, shard) not in sent.value:
                        continue
                    if (lang, shard) not in ready:
                        ready[lang, shard] = PerfectHash(*sent.value[lang, shard])
                    own = np.flatnonzero(dealt == shard)
                    slots = ready[lang, shard].slots(terms[own].tolist(), hashes[own])
                    if (lang, source, shard) not in dense:
                        dense[lang, source, shard] = np.zeros(-(-len(ready[lang, shard].terms) // WIDE) * WIDE, np.int64)
                        held += len(dense[lang, source, shard])
                    dense[lang, source, shard][slots[slots >= 0]] += n[own][slots >= 0]
                    if held > DENSE:
                        yield out()
                        held = 0
        yield out()

    return rows.mapInArrow(each, "lang string, source string, shard int, block int, " + ", ".join(f"{n} bigint" for n in _WIDE))


def _recount_by_join(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """The same rows by a join of counted words with the terms, where the tables are too large to broadcast."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for counted in _buffered(batches):
            for (lang, source), words in counted.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()), _texts(list(words)),
                     pa.array(words.values(), pa.int64())], ["lang", "source", "term", "n"])

    summed = rows.mapInArrow(each, "lang string, source string, term string, n bigint").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    return summed.join(slots, ["lang", "term"]).groupBy("lang", "source", "shard", F.expr(f"slot div {WIDE}").cast("int").alias("block")).agg(
        *(F.sum(F.when(F.col("slot") % WIDE == k, F.col("n")).otherwise(0)).alias(n) for k, n in enumerate(_WIDE)))


def pair_sums(counts: DataFrame, groups: DataFrame, sizes: DataFrame, shards: int, block: int = BLOCK) -> DataFrame:
    """``lang, source, item, value``: the divergence of all pairs of a language's sources, summed over its kept terms.

    ``counts``: lang, source, shard, block and the counts of its slots; ``groups``: lang, source, total, kept, sources; ``sizes``: lang, shard, size.
    """
    dealt = groups.withColumn("blocks", F.ceil(F.col("sources") / F.lit(block)).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("source"), F.col("blocks").cast("bigint")).cast("int")).select("lang", "source", "total", "kept", "own", "blocks")
    # A piece of a shard for each ``PIECE`` slots, one at least, so that a language without terms has its pairs too.
    pieces = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(sizes, ["lang", "shard"], "left").withColumn(
        "size", F.coalesce("size", F.lit(0)))
    keys = ["lang", "source", "shard", "own", "blocks", "kept"]
    heads = pieces.withColumn("piece", F.explode(F.expr(f"sequence(0, cast(greatest(size - 1, 0) div {PIECE} as int))"))).select(
        *keys, "piece", F.lit(-1).alias("block"), F.expr(f"cast(least(size - piece * {PIECE}, {PIECE}) as int)").alias("size"), F.col("total").alias(_WIDE[0]),
        *(F.lit(0).cast("bigint").alias(n) for n in _WIDE[1:]))
    cells = counts.join(dealt, ["lang", "source"]).select(
        *keys, F.expr(f"cast(block div {PIECE // WIDE} as int)").alias("piece"), F.expr(f"block % {PIECE // WIDE}").alias("block"),
        F.lit(0).alias("size"), *_WIDE)
    both = heads.unionByName(cells).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "shard", "piece", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "source", "own", "kept", "block", "size", *_WIDE)

    def each(table: pa.Table) -> pa.Table:
        held = {c: table.column(c).to_numpy() for c in ("own", "kept", "block", "size", "a", "b")}
        n = np.stack([table.column(c).to_numpy() for c in _WIDE], axis=1)
        names = table.column("source").combine_chunks().dictionary_encode()
        codes, head = names.indices.to_numpy(), held["block"] < 0
        size = int(held["size"].max())
        matrix = np.zeros((len(names.dictionary), PIECE // WIDE, WIDE), np.int64)
        matrix[codes[~head], held["block"][~head]] = n[~head]
        matrix = matrix.reshape(len(matrix), -1)[:, :size]
        totals, own = np.zeros(len(matrix), np.int64), np.zeros(len(matrix), np.int64)
        totals[codes[head]], own[codes[head]] = n[head, 0], held["own"][head]
        kept, a, b = int(held["kept"][0]), int(held["a"][0]), int(held["b"][0])
        if size:
            matrix = np.stack([proportions(row, total, kept) for row, total in zip(matrix, totals.tolist(), strict=True)])
        found = []
        for i in np.flatnonzero(own == a).tolist():
            for j in np.flatnonzero(own == b).tolist():
                if a != b or i < j:
                    apart = matrix[i] - matrix[j]
                    value = int((apart * apart // (matrix[i] + matrix[j])).sum())
                    found += [(i, j, value), (j, i, value)]
        first, second, values = zip(*found, strict=True) if found else ((), (), ())
        take = lambda at: names.dictionary.take(pa.array(at, pa.int64()))
        return pa.table({
            "lang": pa.array([table.column("lang")[0].as_py()] * len(found), pa.string()), "source": take(first), "item": take(second),
            "value": pa.array(values, pa.int64())})

    partial = both.groupBy("lang", "shard", "piece", "a", "b").applyInArrow(each, "lang string, source string, item string, value bigint")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _proportion(n: str, total: str):
    """As ``proportions``, in decimals."""
    return F.expr(f"1 + ({SCALE} * cast({n} + 2 as decimal(20,0))) div cast({total} + 2 * kept as decimal(20,0))")


def term_scores(counts: DataFrame, groups: DataFrame, slots: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value, rank``: the terms a group uses most beyond its language."""
    used = counts.groupBy("lang", "shard", "block").agg(*(F.sum(n).alias(f"lang_{n}") for n in _WIDE))
    pairs = F.array(*(F.struct(F.col(n).alias("n"), F.col(f"lang_{n}").alias("lang_n")) for n in _WIDE))
    cells = counts.join(used, ["lang", "shard", "block"]).join(groups, ["lang", "source"]).select(
        "lang", "source", "shard", "block", "total", "lang_total", "kept", F.posexplode(pairs).alias("at", "c")).where("c.n > 0").select(
        "lang", "source", "shard", (F.col("block") * WIDE + F.col("at")).alias("slot"),
        _proportion("c.n", "total").alias("p"), _proportion("c.lang_n", "lang_total").alias("q")).where("p > q")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return cells.join(slots, ["lang", "shard", "slot"]).select(
        "lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value")).withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= top)


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, shard: int = SHARD, block: int = BLOCK, broadcast_bytes: int = BROADCAST_BYTES,
    lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source) that occurs.

    Part ``pair``: the divergence from every other source of the language over its kept terms, 0 if it has none. Part ``term``: the
    ``top`` kept terms whose proportion is above the language's. Null lang, source and text are ''. Repeated rows are documents of their
    own; ties rank by the item's bytes; an empty table gives no rows. Columns other than the three named are not looked at.
    """
    rows = _rows(docs, lang_col, source_col, text_col)
    frequent = document_counts(rows).groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_docs).select("lang", "term")
    kept = stored(frequent, "kept")
    shards = max(1, -(-kept.count() // shard))
    tables = stored(perfect_hashes(kept, shards), "hashes")
    slots = tables.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    held = tables.agg(F.sum(F.length("bits") + F.aggregate("terms", F.lit(0).cast("bigint"), lambda n, t: n + F.octet_length(t) + 8))).first()[0] or 0
    recounted = _recount_by_slots(rows, tables, shards) if held <= broadcast_bytes else _recount_by_join(rows, slots)
    counts = stored(recounted.groupBy("lang", "source", "shard", "block").agg(*(F.sum(n).alias(n) for n in _WIDE)), "recount")

    sizes = tables.select("lang", "shard", F.size("terms").alias("size"))
    of_lang = rows.select("lang", "source").distinct().groupBy("lang").agg(F.count(F.lit(1)).cast("int").alias("sources"))
    of_terms = tables.groupBy("lang").agg(F.sum(F.size("terms")).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum(sum(map(F.col, _WIDE), F.lit(0))).alias("total"))
    lang_totals = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    zero = F.lit(0).cast("bigint")
    groups = stored(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang").join(of_terms, "lang", "left")
        .join(lang_totals, "lang", "left").select(
            "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"),
            F.coalesce("kept", zero).alias("kept"), "sources"), "groups")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_sums(counts, groups, sizes, shards, block).withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        term_scores(counts, groups, slots, top).withColumn("part", F.lit("term")).select(*columns))
