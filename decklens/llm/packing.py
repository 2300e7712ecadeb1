"""Best-fit packing of documents into fixed-length token sequences.

Bulk-synchronous best fit.  Pieces are taken in falling size classes.  In a
round the pieces of the class and the gaps of the open sequences are sorted by
size and cut into ranges of about equal tokens, the largest pieces with the
largest gaps; every task sweeps its ranges, pieces from large to small, and
gives each piece its successor, the smallest gap that still holds it.  Of
pieces that want the same gap the first in rank (length, then number) takes
it, and what is left of the gap goes on standing at its true size.  The gaps
are updated and dealt anew with the pieces that found none, until a round
places few of them; then the tasks open sequences for the rest, and the next
class begins.

Only counts of sizes (at most ``capacity`` of pieces and of gaps) reach the
driver, which cuts the ranges by them; a size that fills several ranges is
spread over them by number.  No task holds more than its ranges.

``plan`` is sequential best-fit decreasing over counts of lengths: what tests
hold the number of sequences against.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, shuffle_partitions, slices
from decklens.llm.tokens import encoder, vocabulary_path

#: Size classes: pieces of more than capacity/(next) and at most capacity/(this) tokens.
DIVISORS = (1, 2, 3, 6, 24)
#: Tokens of pieces in a range of a sweep, and rows in it.
RANGE_TOKENS = 2_000_000
RANGE_ROWS = 50_000
#: Sequences are opened once a round places at most such a share of the pieces that were left.
FEW_PLACED = 0.05


def pieces(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and ``end_id``, cut if longer than ``capacity``.

    The first piece of a cut document takes the remainder, the others are
    full.  Null text counts as empty: one piece that holds only ``end_id``.
    """
    vocabulary = vocabulary_path(vocabulary)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, special=True), np.array([end_id], dtype="<u4").tobytes()
        for b in (s for batch in batches for s in slices(batch)):
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py()) + end
                n, start, k = len(ids) // 4, 0, 0
                while start < n:
                    stop = min(n, start + (n % capacity or capacity)) if k == 0 else start + capacity
                    part = ids[4 * start:4 * stop]
                    out.append((doc, k, start, stop - start, zlib.crc32(part), part))
                    start, k = stop, k + 1
            cols = list(zip(*out)) if out else [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in cols[5]])]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(cols[5]), dtype="<i4"))))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(arrays)])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def plan(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """Best-fit decreasing of ``counts`` (length, pieces) as runs (first piece, first sequence, pieces to a sequence).

    Pieces are numbered from 0 in falling length; a run ends where the next begins.
    """
    runs, gaps, alike, opened, at = [], [], {}, 0, 0

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in alike:
                insort(gaps, gap)
            alike.setdefault(gap, []).append((first, n))

    for length, left in sorted(counts, reverse=True):
        while left:
            i = bisect_left(gaps, length)
            if i < len(gaps):
                gap = gaps[i]
                first, n = alike[gap].pop()
                if not alike[gap]:
                    del alike[gap], gaps[i]
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = gap // length
            full = min(n, left // each)
            if full:
                runs.append((at, first, each))
                keep(gap - each * length, first, full)
                at, left = at + full * each, left - full * each
            if full < n:
                if left:
                    # fewer than `each`: the last pieces of this length
                    runs.append((at, first + full, left))
                    keep(gap - left * length, first + full, 1)
                    full, at, left = full + 1, at + left, 0
                keep(gap, first + full, n - full)
    return runs


def _ranges(counts: dict[int, int], n: int) -> dict[int, tuple[int, int]]:
    """size -> (first range, ranges): ``counts`` cut into ``n`` ranges of about equal tokens, large sizes first."""
    total, done, out = sum(size * c for size, c in counts.items()), 0, {}
    for size in sorted(counts, reverse=True):
        lo = done * n // total
        done += size * counts[size]
        out[size] = (lo, max(1, -(-done * n // total) - lo))
    return out


def _sweep(capacity: int, opening: bool, turn: int):
    """Rows (range, kind, size, id) in order, a range's gaps (kind 0) before its pieces, pieces from large to small.

    Gives (kind, size, id, bin): kind 0 a gap as it is now, 1 a piece without a
    place, 2 a piece and its sequence.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, gaps, sizes, opened, out = None, {}, [], 0, []

        def put(gap: int, which: int) -> None:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append(which)

        def flush(rows: list) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["kind", "size", "id", "bin"])

        for b in batches:
            for part, kind, size, key in zip(*(c.to_pylist() for c in b.columns)):
                if part != at:
                    out += [(0, gap, which, None) for gap, all_ in gaps.items() for which in all_]
                    at, gaps, sizes, opened = part, {}, [], 0
                if kind == 0:
                    put(size, key)
                    continue
                i = bisect_left(sizes, size)
                if i < len(sizes):
                    gap = sizes[i]
                    which = gaps[gap].pop()
                    if not gaps[gap]:
                        del gaps[gap], sizes[i]
                elif opening:
                    # numbers below -1, a block for each turn and range
                    gap, which = capacity, -2 - (turn << 50 | part << 25 | opened)
                    opened += 1
                else:
                    out.append((1, size, key, None))
                    continue
                out.append((2, size, key, which))
                if gap > size:
                    put(gap - size, which)
            if len(out) > 1 << 16:
                yield flush(out)
                out = []
        out += [(0, gap, which, None) for gap, all_ in gaps.items() for which in all_]
        yield flush(out)

    return run


def best_fit(scratch: Scratch, items: DataFrame, capacity: int = 2048) -> DataFrame:
    """(uid, bin) for ``items`` (uid long, unique and not negative; length from 1 to ``capacity``; written)."""
    spark = scratch.spark
    bounds = [capacity // d for d in DIVISORS] + [0]
    # no two pieces of more than half the capacity fit together: each opens its sequence
    pieces_left = items.filter(F.col("length") <= bounds[1]).select(F.lit(1).alias("kind"), F.col("length").alias("size"), F.col("uid").alias("id"))
    gaps = items.filter((F.col("length") > bounds[1]) & (F.col("length") < capacity)).select(F.lit(0).alias("kind"), (capacity - F.col("length")).alias("size"), F.col("uid").alias("id"))
    placed, turn, tables = [items.filter(F.col("length") > bounds[1]).select("uid", F.col("uid").alias("bin"))], 0, []

    def counted(df: DataFrame) -> dict[int, int]:
        return {r["size"]: r["count"] for r in df.groupBy("size").count().collect()}  # at most `capacity` rows

    every, free = counted(pieces_left), counted(gaps)
    for hi, lo in zip(bounds[1:], bounds[2:]):
        docs, todo = pieces_left.filter((F.col("size") <= hi) & (F.col("size") > lo)), {s: c for s, c in every.items() if lo < s <= hi}
        before = 0
        while todo:
            left = sum(todo.values())
            smallest = min(todo)
            usable = {s: c for s, c in free.items() if s >= smallest}
            opening, turn = not usable or 0 < before and before - left <= FEW_PLACED * before, turn + 1
            rows = left + sum(usable.values())
            n = max(1, sum(s * c for s, c in todo.items()) // RANGE_TOKENS, rows // RANGE_ROWS)
            cuts = [(kind, s, *at) for kind, part in ((0, usable), (1, todo)) if part for s, at in _ranges(part, n).items()]
            # a row for each size: at most `capacity` of pieces and of gaps
            cuts = F.broadcast(spark.createDataFrame(cuts, "kind int, size long, lo long, span long"))
            both = gaps.filter(F.col("size") >= smallest).unionByName(docs).join(cuts, ["kind", "size"])
            part = (F.col("lo") + F.pmod(F.xxhash64("id"), F.col("span"))).alias("part")
            swept = (both.select(part, "kind", "size", "id").repartition(min(shuffle_partitions(spark), n), "part")
                     .sortWithinPartitions("part", "kind", F.desc("size"), "id").mapInArrow(_sweep(capacity, opening, turn), "kind int, size long, id long, bin long"))
            table = scratch.table(swept)
            tables.append(table)
            placed.append(table.filter("kind = 2").select(F.col("id").alias("uid"), "bin"))
            small = gaps.filter(F.col("size") < smallest)
            gaps, docs = table.filter("kind = 0").select("kind", "size", "id").unionByName(small), table.filter("kind = 1").select("kind", "size", "id")
            now = table.filter("kind < 2").groupBy("kind", "size").count().collect()  # at most 2 * `capacity` rows
            before, todo = left, {r["size"]: r["count"] for r in now if r["kind"] == 1}
            free = {s: c for s, c in free.items() if s < smallest} | {}
            for r in now:
                if r["kind"] == 0:
                    free[r["size"]] = free.get(r["size"], 0) + r["count"]
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def pack(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (see ``pieces``) with sequence_id and offset in their sequence.

    ``with_ids`` adds the token ids of each piece.  Null texts are empty; null
    and repeated ids keep a row for each of their pieces; an empty table gives
    no rows.  Only the two named columns are read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.table(pieces(docs, capacity, id_col, text_col, vocabulary, with_ids=with_ids)
                        .withColumn("uid", F.monotonically_increasing_id()))
    where = best_fit(scratch, cut.select("uid", "length"), capacity)
    offset = "sum(length) over (partition by sequence_id order by uid rows between unbounded preceding and current row) - length"
    out = cut.join(where, "uid").withColumnRenamed("bin", "sequence_id")
    # a sequence holds at most `capacity` pieces, which bounds this window
    return out.withColumn("offset", F.expr(offset)).drop("uid")
