"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group that is never split.  Group sizes are
counted by size class (exact below ``2**PRECISION`` bytes, above it classes of
relative width ``2**-PRECISION``, so at most ``2**PRECISION`` classes an octave
whatever the data); the counts, not the groups, go to the driver, where the
classes enter, largest first, the bin with the tightest sufficient remaining
capacity, found in a balanced tree (an AVL tree over remaining capacities).  A
run of equal groups enters a bin at once.  Groups are then ranked inside their
class by a distributed numbering, and a join of (class, rank) with the runs
places them.

``assign`` minimises the number of shards of a given capacity; ``balance``
finds, by bisection over the capacity, the smallest at which the groups need
no more than the given number of shards, which makes their sizes near equal.
A group larger than the capacity gets a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, number_rows

PRECISION = 12
OVERHEAD = 16


class CapacityTree:
    """AVL tree of bins ordered by (remaining capacity, bin)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    @classmethod
    def _node(cls, left, key, right):
        """A node over two trees whose heights differ by at most two, rotated into balance."""
        if cls._height(left) > cls._height(right) + 1:
            ll, lk, lr, _ = left
            if cls._height(ll) >= cls._height(lr):
                return cls._node(ll, lk, cls._node(lr, key, right))
            return cls._node(cls._node(ll, lk, lr[0]), lr[1], cls._node(lr[2], key, right))
        if cls._height(right) > cls._height(left) + 1:
            rl, rk, rr, _ = right
            if cls._height(rr) >= cls._height(rl):
                return cls._node(cls._node(left, key, rl), rk, rr)
            return cls._node(cls._node(left, key, rl[0]), rl[1], cls._node(rl[2], rk, rr))
        return left, key, right, 1 + max(cls._height(left), cls._height(right))

    @classmethod
    def _insert(cls, node, key):
        if not node:
            return None, key, None, 1
        left, at, right, _ = node
        return cls._node(cls._insert(left, key), at, right) if key < at else cls._node(left, at, cls._insert(right, key))

    @classmethod
    def _delete(cls, node, key):
        left, at, right, _ = node
        if key < at:
            return cls._node(cls._delete(left, key), at, right)
        if key > at:
            return cls._node(left, at, cls._delete(right, key))
        if not left or not right:
            return left or right
        low = right
        while low[0]:
            low = low[0]
        return cls._node(left, low[1], cls._delete(right, low[1]))

    def add(self, room: int, which: int) -> None:
        self.root = self._insert(self.root, (room, which))

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (remaining capacity, bin) that fits ``size`` most tightly."""
        node, best = self.root, None
        while node:
            if node[1][0] >= size:
                best, node = node[1], node[0]
            else:
                node = node[2]
        if best:
            self.root = self._delete(self.root, best)
        return best


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, limit: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Runs (size, first rank, end rank, bin) for ``classes`` of (size, count); None if more than ``limit`` bins are needed."""
    tree, runs, bins = CapacityTree(), [], 0
    for size, count in sorted(classes, reverse=True):
        at = 0
        while at < count:
            best = tree.take(size)
            if best is None:
                room, which, bins = max(capacity, size), bins, bins + 1
                if limit is not None and bins > limit:
                    return None
            else:
                room, which = best
            n = min(count - at, room // size)
            runs.append((size, at, at + n, which))
            at += n
            if room - n * size > 0:
                tree.add(room - n * size, which)
    return runs


def balanced(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """The runs at the smallest capacity (to one part in 2**14 of the mean) that needs at most ``shards`` bins."""
    total = sum(s * n for s, n in classes)
    low, high, best = 0, 2 * total // shards + max(s for s, _ in classes) + 1, None
    best = best_fit_decreasing(classes, high, shards)
    while high - low > max(1, total // shards >> 14):
        mid = (low + high) // 2
        runs = best_fit_decreasing(classes, mid, shards)
        if runs is None:
            low = mid
        else:
            high, best = mid, runs
    return best


def size_class(size: Column) -> Column:
    """``size`` rounded up to PRECISION + 1 significant bits."""
    s = size.cast("long")
    drop = F.greatest(F.lit(0), F.length(F.bin(s)) - (PRECISION + 1)).cast("int")
    unit = F.expr("1L")
    step = F.call_function("shiftleft", unit, drop)
    return F.call_function("shiftleft", F.call_function("shiftright", s + step - 1, drop), drop)


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_text"))


def assign(docs: DataFrame, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): one row for each input row.

    Either ``shards`` (near equal sizes) or ``capacity`` in bytes (as few
    shards as best fit needs).  size: UTF-8 bytes of the text (null: none)
    plus 16.  Null and empty texts are one group.  Null and repeated ids keep
    their rows; slot is gapless from 0 in each shard, by doc_id.  An empty
    table gives no rows.  Only the two named columns are read.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    rows = scratch.table(_groups(docs, id_col, text_col))
    n = rows.count()
    groups = rows.groupBy("_text").agg(F.sum("size").alias("bytes")).select("_text", size_class(F.col("bytes")).alias("class"))
    ranked = number_rows(scratch, groups, "class", ["_text"], "rank", n)
    classes = [(r["class"], r["n"]) for r in ranked.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()]  # bounded by PRECISION
    if not classes:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    runs = balanced(classes, shards) if shards else best_fit_decreasing(classes, capacity)
    plan = spark.createDataFrame(runs, "class long, lo long, hi long, shard int")
    # runs: at most one for each class and one for each shard that a class fills or tops up
    plan = F.broadcast(plan) if len(runs) <= 1_000_000 else plan
    where = (ranked.join(plan, "class").filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select("_text", "shard"))
    placed = rows.join(where, "_text").select("doc_id", "size", "text_crc32", "shard")
    return number_rows(scratch, placed, "shard", ["doc_id", "text_crc32"], "slot", n)
