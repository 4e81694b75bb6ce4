"""Sharding by best-fit-decreasing bin packing.

A group (rows that must stay together) is indivisible. Groups are sized in Spark and counted by size; only the counts
reach the driver, however many groups there are. The `EXACT` largest sizes that occur are exact; below them, where groups
are small against a shard, a size counts as its twelve leading bits, rounded up. Best fit decreasing over the counts is the
same as over the single groups: groups of one size go to the tightest bin until it is full, and bins that are filled
alike stay one range of bins. What comes back is, for each size, which ranks go to which range, so that the driver's part
grows with the sizes and not with the groups or the shards.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import positions, stored

CLASS_BITS = 12
EXACT = 10_000


class Treap:
    """A balanced search tree of (remaining capacity, first bin, number of bins): bins in a row with equal capacity left."""

    @dataclass
    class Node:
        key: tuple[int, int, int]
        weight: float
        left: Treap.Node | None = None
        right: Treap.Node | None = None

    def __init__(self):
        self.root: Treap.Node | None = None
        self.random = random.Random(7)

    def _split(self, node, key):
        if node is None:
            return None, None
        if node.key < key:
            node.right, other = self._split(node.right, key)
            return node, other
        other, node.left = self._split(node.left, key)
        return other, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a.weight > b.weight:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, key: tuple[int, int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, self.Node(key, self.random.random())), high)

    def take_at_least(self, size: int) -> tuple[int, int, int] | None:
        """Remove and return the smallest key with at least `size` remaining."""
        low, high = self._split(self.root, (size, -1))
        node = high
        while node is not None and node.left is not None:
            node = node.left
        if node is not None:
            _, high = self._split(high, (node.key[0], node.key[1] + 1))
        self.root = self._merge(low, high)
        return node.key if node else None


@dataclass
class Run:
    """Groups of class `size` with ranks from `first` up to `last` (exclusive) go to `shard`."""
    size: int
    first: int
    last: int
    shard: int


@dataclass
class Filled:
    """Groups of class `size` with ranks from `first` up to `last` (exclusive) go to bins from `shard` on, `each` to a bin."""
    size: int
    first: int
    last: int
    shard: int
    each: int


def fill(counts: dict[int, int], capacity: int, most: int | None = None, first_rank: dict[int, int] | None = None,
         first_shard: int = 0) -> list[Filled] | None:
    """Pack `counts` (size to number of groups) into bins of `capacity`; None if that takes more than `most` bins.

    A group larger than the capacity gets a bin of its own.
    """
    tree, filled, bins = Treap(), [], first_shard
    for size in sorted(counts, reverse=True):
        at = (first_rank or {}).get(size, 0)
        left = counts[size]
        while left:
            found = tree.take_at_least(size)
            if found is None:
                room = max(capacity, size)
                fresh = -(-left // (room // size))
                if most is not None and bins + fresh - first_shard > most:
                    return None
                found = (room, bins, fresh)
                bins += fresh
            remaining, shard, many = found
            each = remaining // size
            whole = min(many, left // each)
            parts = [(whole, whole * each, remaining - each * size)]  # bins, groups in them, capacity that stays
            if whole < many and left % each and left < many * each:
                parts.append((1, left % each, remaining - left % each * size))
            for used, groups, rest in parts:
                if used:
                    filled.append(Filled(size, at, at + groups, shard, each))
                    at, left, shard, many = at + groups, left - groups, shard + used, many - used
                    if rest:
                        tree.add((rest, shard - used, used))
            if many:
                tree.add((remaining, shard, many))
    return filled


def best_fit_decreasing(counts: dict[int, int], capacity: int, most: int | None = None,
                        first_rank: dict[int, int] | None = None, first_shard: int = 0) -> list[Run] | None:
    """`fill` with one `Run` per bin and size, for a number of bins that is known to be small."""
    filled = fill(counts, capacity, most, first_rank, first_shard)
    return None if filled is None else [
        Run(f.size, at, min(at + f.each, f.last), f.shard + k)
        for f in filled for k, at in enumerate(range(f.first, f.last, f.each))]


def level(counts: dict[int, int], shards: int) -> list[Run]:
    """Pack into `shards` bins of near equal sums: the least capacity for which best fit decreasing needs no more bins.

    A group above the mean of what is left cannot be matched by others; it gets a shard alone, and the rest is
    levelled over the other shards.
    """
    counts, ranks, runs, used = dict(counts), {}, [], 0
    while shards - used > 1 and counts:
        largest = max(counts)
        if largest * (shards - used) <= sum(s * n for s, n in counts.items()):
            break
        runs.append(Run(largest, ranks.get(largest, 0), ranks.get(largest, 0) + 1, used))
        ranks[largest] = ranks.get(largest, 0) + 1
        counts[largest] -= 1
        counts = {s: n for s, n in counts.items() if n}
        used += 1
    if not counts:
        return runs
    total = sum(s * n for s, n in counts.items())
    low, high = -(-total // (shards - used)), total
    best = best_fit_decreasing(counts, high, shards - used, ranks, used)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(counts, middle, shards - used, ranks, used)
        if tried is None:
            low = middle + 1
        else:
            high, best = middle, tried
    return runs + best


def size_class(size: Column, bits: int = CLASS_BITS) -> Column:
    """`size` rounded up to its `bits` leading bits; sizes below 2**bits stay exact."""
    step = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(size, F.lit(1)))) - (bits - 1))).cast("bigint")
    return (F.ceil(size / step) * step).cast("bigint")


def pack(groups: DataFrame, size: str, order: list[Column], shards: int | None = None,
         capacity: int | None = None) -> DataFrame:
    """Add `shard` to one row per group: `shards` shards of near equal size, or as few as fit `capacity`.

    Groups of one size are taken in the ascending order of `order`. A size that is missing or below 1 counts as 1. A
    column `shard` of the groups is replaced; other columns may have any name.
    """
    spark = groups.sparkSession
    sized = stored(groups.select(F.struct(*[F.col(f"`{c}`") for c in groups.columns if c != "shard"]).alias("_rest"),
                                 F.struct(*order).alias("_order"),
                                 F.greatest(F.coalesce(F.col(size), F.lit(1)), F.lit(1)).cast("bigint").alias("_size")), "sizes")
    least = sized.select("_size").distinct().orderBy(F.col("_size").desc()).limit(EXACT).agg(F.min("_size")).first()[0]
    classed = sized.withColumn("_class", F.when(F.col("_size") >= F.lit(least), F.col("_size")).otherwise(
        size_class(F.col("_size"))))
    ranked = positions(classed, [F.col("_order")], ["_class"], "groups", "_rank")
    counts = {r[0]: r[1] for r in ranked.groupBy("_class").count().collect()}  # EXACT sizes and the classes below them
    if capacity is None:
        filled = [Filled(r.size, r.first, r.last, r.shard, r.last - r.first) for r in level(counts, shards)]
    else:
        filled = fill(counts, capacity)
    rows = [(f.size, f.first, f.last, f.shard, f.each) for f in filled]
    plan = spark.createDataFrame(rows, "_class long, _first long, _last long, _shard long, _each long")
    return ranked.join(plan, (ranked["_class"] == plan["_class"]) & (F.col("_rank") >= F.col("_first"))
                       & (F.col("_rank") < F.col("_last"))).select(
        "_rest.*", (F.col("_shard") + F.floor((F.col("_rank") - F.col("_first")) / F.col("_each"))).cast("int").alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """Place every row; rows of equal text (all missing texts are one group) share a shard.

    Law `bytes`: the sums of `size` (UTF-8 bytes plus 1; 1 for a missing text) are as equal as whole groups allow.
    `slot` counts the rows of a shard from 0 by doc_id. `text_crc32` of a missing text is 0. Ties between equal
    rows are free. Other columns are left behind.
    """
    rows = docs.select(
        "doc_id", F.sha2(text, 256).alias("_group"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"))
    rows = rows.withColumn("_group", F.coalesce(F.unhex("_group"), F.lit(b"")))
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    placed = pack(groups, "_bytes", [F.col("_group")], shards)
    joined = rows.join(placed.select("_group", "shard"), "_group")
    slotted = positions(joined, [F.col("doc_id"), F.col("_group")], ["shard"], "slots", "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
