"""Sharding by a weighted hash tree of regions, racks and shards.

A key descends from the root to a region, from there to a rack and to a shard. At
each node every child has an exponential draw that the key and the child decide,
at the rate of the summed weight of the child's subtree, and the least draw wins:
a child is met with a probability proportional to its weight. A draw depends on
nothing else, so a weight that changes moves keys only between children of the nodes above it
whose sums change: if one shard of a rack rises and another falls by as
much, no key leaves or enters the rack.

The tree has a base layout. Each shard beyond it opens a region of its own, so that
one more shard changes no other sum and takes keys only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RACK, REGION = 4, 8
#: Parts of a shard that are numbered apart; parts x shards bounds the table of offsets.
PARTS = 64

_LEVELS = ("region", "rack", "shard")


def layout(shards: int, base: int | None = None, rack: int = RACK, region: int = REGION) -> list[tuple[int, int, int]]:
    """``(region, rack, shard)`` of every shard: ``rack`` shards to a rack and ``region`` to a region up to ``base``, then a region each."""
    base = shards if base is None else base
    if region % rack:
        raise ValueError("a region is a whole number of racks")
    regions, racks = -(-base // region), -(-base // rack)
    return [(s // region, s // rack, s) if s < base else (regions + s - base, racks + s - base, s) for s in range(shards)]


def draw(key: Column, level: int, node: int, weight: float) -> Column:
    """An exponential variate at rate ``weight`` that key and node decide."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(node)), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(uniform) / F.lit(float(weight))


def descend(df: DataFrame, key: str, weights: Sequence[float], name: str, base: int | None = None, rack: int = RACK, region: int = REGION) -> DataFrame:
    """``df`` with ``name``, the shard of each key. A shard of weight 0 takes none."""
    places = [p for p, w in zip(layout(len(weights), base, rack, region), weights, strict=True) if w > 0]
    if not places:
        raise ValueError("some weight is above 0")
    chosen: Column | None = None
    for level, _ in enumerate(_LEVELS):
        parents = sorted({p[level - 1] if level else 0 for p in places})
        branches = []
        for parent in parents:
            inside = [p for p in places if not level or p[level - 1] == parent]
            sums: dict[int, float] = {}
            for place in inside:
                sums[place[level]] = sums.get(place[level], 0.0) + weights[place[2]]
            draws = [F.struct(draw(F.col(key), level, node, w).alias("draw"), F.lit(node).alias("node")) for node, w in sorted(sums.items())]
            branches.append((parent, F.array_min(F.array(*draws))["node"] if len(draws) > 1 else F.lit(min(sums))))
        # Only the chosen parent's children are drawn.
        pick = branches[0][1] if chosen is None else reduce(
            lambda so_far, b: so_far.when(chosen == b[0], b[1]), branches[1:], F.when(chosen == branches[0][0], branches[0][1]))
        df = df.withColumn(f"_{name}_{level}", pick)
        chosen = F.col(f"_{name}_{level}")
    return df.withColumn(name, chosen).drop(*(f"_{name}_{level}" for level, _ in enumerate(_LEVELS)))


def shard_documents(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Shard, position and checksum of every document.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``grown`` holds the weights after a
    change (default: one more shard of the mean weight); shards beyond ``weights`` have regions of their own. A null text has size 8 and a null checksum; rows of a null id share one
    shard. Equal rows are numbered one after the other. An empty table gives none.
    Equal rows are counted before the shuffle, and slots are numbered in ``PARTS`` parts of a shard,
    so no key and no shard has to fit in one task.
    """
    grown = list(weights) + [sum(weights) / len(weights)] if grown is None else list(grown)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    both = descend(descend(rows, "doc_id", weights, "shard"), "doc_id", grown, "grown_shard", base=len(weights))
    placed = both.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit("part")), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").agg(F.sum("copies").alias("held")).select(
        "shard", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    numbered = placed.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    # At most PARTS rows for each shard, so its size is known.
    joined = numbered.join(F.broadcast(offsets), ["shard", "part"])
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(F.col("offset") + F.col("ahead"), F.col("offset") + F.col("ahead") + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
