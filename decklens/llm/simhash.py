"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprint: A-Z lowered, words are runs of anything but ASCII white space,
``shingle``-word shingles with repeats; a bit is 1 if set in over half of the
shingles' XXH64 values (seed 42).  Fewer words than a shingle: the whole
sequence is one shingle; no words: fingerprint zero, linked like any other.

Index.  The distinct fingerprints are range-sorted by Gray rank, so that
neighbours differ in few bits, and cut into leaves of ``LEAF`` codes.  A node
keeps the AND and the OR of its codes: bits that are 1 in the AND or 0 in the
OR are its shared masked pattern.  Upper nodes join ``2**FAN_BITS`` children
each.  The search starts with the pair (root, root) and replaces a pair by
pairs of children; the bits in which the patterns of two nodes differ for
certain only accumulate on the way down, and a pair is pruned with all below
it as soon as they exceed the distance.  What survives at the leaves is
compared code by code.  No code is compared with all others, only hot codes
(at most ``HOT``) are broadcast by hint, and no cap cuts a bucket: the search is exact.

Links are reduced to spanning links inside each pair of leaves (a dense group
never emits all its pairs) and joined into components by alternating
large-star and small-star rounds, each cut by a written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import Scratch, free_name, lower_slabs, shuffle_partitions

LEAF = 256
FAN_BITS = 5
#: At most this many codes hold more than 1 / HOT of the rows each.
HOT = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint of one text as an unsigned integer."""
    ones, n, carry, begun = np.zeros(64, dtype=np.int64), 0, [], []
    for words in lower_slabs(text):
        w = carry + words
        begun = (begun + words)[:shingle] if len(begun) < shingle else begun
        if len(w) >= shingle:
            grams = map(b" ".join, zip(*[w[i:] for i in range(shingle)]))
            h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype="<u8", count=len(w) - shingle + 1)
            for i in range(0, len(h), 65536):
                bits = np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int32)
            n += len(h)
        carry = w[-(shingle - 1):] if shingle > 1 else []
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(begun), 42) if begun else 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, hash, code): one row for each input row; the text's hash and its fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes.view(np.int64))], ["doc_id", "hash", "code"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(run, "doc_id long, hash long, code long")


def gray_rank(code: Column) -> Column:
    """Rank of ``code`` in the 64-bit Gray order, as a long whose signed order is that order."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def apart(a: str, b: str) -> Column:
    """Number of bits in which every code of node ``a`` differs from every code of node ``b``."""
    return F.expr(f"bit_count(({a}_and & ~{b}_or) | ({b}_and & ~{a}_or))")


def _leaves(codes: DataFrame) -> DataFrame:
    """Gray-sorted runs of at most LEAF codes: (part, seq, n_and, n_or, codes)."""
    def row(part: int, seq: int, c: np.ndarray) -> tuple:
        return part, seq, int(np.bitwise_and.reduce(c)), int(np.bitwise_or.reduce(c)), c.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rest = TaskContext.get().partitionId(), 0, np.empty(0, dtype=np.int64)
        names = ["part", "seq", "n_and", "n_or", "codes"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            rest, out = np.concatenate([rest, b.column(0).to_numpy(zero_copy_only=False)]), []
            while len(rest) >= LEAF:
                out.append(row(part, seq, rest[:LEAF]))
                rest, seq = rest[LEAF:], seq + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names)
        if len(rest):
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row(part, seq, rest), types)], names)

    parts = shuffle_partitions(codes.sparkSession)
    return (codes.select("code", gray_rank(F.col("code")).alias("_rank")).repartitionByRange(parts, "_rank")
            .sortWithinPartitions("_rank").select("code")
            .mapInArrow(run, "part int, seq long, n_and long, n_or long, codes binary"))


def _local_groups(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (code, smallest code of its group) of the codes within ``distance`` of each other."""
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= distance)
    codes = np.concatenate([a, b])
    i, j = i, j + len(a)
    keep = codes[i] != codes[j]
    i, j = i[keep], j[keep]
    if not len(i):
        return codes[:0], codes[:0]
    codes, back = np.unique(codes, return_inverse=True)
    i, j, label = back[i], back[j], np.arange(len(codes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.nonzero(label != np.arange(len(codes)))[0]
    return codes[out], codes[label[out]]


def links(scratch: Scratch, codes: DataFrame, distance: int = 2) -> DataFrame:
    """Spanning links (u, v) between distinct ``code`` values that differ in at most ``distance`` bits."""
    spark = scratch.spark
    leaves = scratch.table(_leaves(codes))
    tops = leaves.groupBy("part").agg(F.max("seq").alias("seq")).collect()  # one row for each partition
    if not tops:
        return spark.createDataFrame([], "u long, v long")
    seq_bits = max(r["seq"] for r in tops).bit_length()
    bits = seq_bits + max(r["part"] for r in tops).bit_length()
    node = F.shiftleft(F.col("part").cast("long"), seq_bits).bitwiseOR(F.col("seq"))
    meta = leaves.select(node.alias("id"), "n_and", "n_or")
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    whole = meta.agg(F.bit_and("n_and").alias("x"), F.bit_or("n_or").alias("y"))
    pairs = pairs.join(whole, F.lit(True)).select("a", "b", F.col("x").alias("a_and"), F.col("y").alias("a_or"),
                                                 F.col("x").alias("b_and"), F.col("y").alias("b_or"))
    depth, about = -(-bits // FAN_BITS), LEAF * sum(r["seq"] + 1 for r in tops)
    for level in range(depth - 1, -1, -1):
        low = FAN_BITS * level
        at = (meta.groupBy(F.shiftright("id", low).alias("id")).agg(F.bit_and("n_and").alias("n_and"), F.bit_or("n_or").alias("n_or"))
              if level else meta)
        up = at.select(F.col("id").alias("c"), F.shiftright("id", FAN_BITS).alias("up"), F.col("n_and").alias("c_and"), F.col("n_or").alias("c_or"))
        pairs = (pairs.join(up, (F.col("a") == F.col("up")) & (apart("c", "b") <= distance))
                 .select(F.col("c").alias("a1"), "a", "b", F.col("c_and").alias("a_and"), F.col("c_or").alias("a_or")))
        pairs = (pairs.join(up, (F.col("b") == F.col("up")) & (apart("a", "c") <= distance)
                            & ((F.col("a") != F.col("b")) | (F.col("a1") <= F.col("c"))))
                 .select(F.col("a1").alias("a"), F.col("c").alias("b"), "a_and", "a_or", F.col("c_and").alias("b_and"), F.col("c_or").alias("b_or")))
        if level and level % 2 == 0:
            pairs = scratch.table(pairs, about)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_local_groups(np.frombuffer(x.as_py(), dtype=np.int64), np.frombuffer(y.as_py(), dtype=np.int64), distance)
                     for x, y in zip(b.column(0), b.column(1))]
            u, v = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    leaf = leaves.select(node.alias("id"), "codes")
    both = (pairs.select("a", "b")
            .join(leaf.select(F.col("id").alias("a"), F.col("codes").alias("x")), "a")
            .join(leaf.select(F.col("id").alias("b"), F.col("codes").alias("y")), "b").select("x", "y"))
    return scratch.table(both.mapInArrow(run, "u long, v long").distinct(), about)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(u, root): every vertex of ``edges`` but the roots, with the smallest vertex of its component."""
    before, now, rows = None, edges, edges.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = (small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        new = scratch.table(small, rows)
        state = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        scratch.drop(now)
        now = new
        if tuple(state) == before:
            return now.select("u", F.col("v").alias("root"))
        before, rows = tuple(state), state[0]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, hash, code, root, component_id): one row for each input row; root is a code that names the component.

    component_id is the smallest doc_id reachable over links, the document
    itself included.  Null text counts as empty (fingerprint zero); a null id
    stays null and its component is named by the other ids (null if there are
    none).  Repeated rows give repeated rows; an empty table gives no rows.
    Only the two named columns are read, so other columns cannot clash.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.table(fingerprints(docs, id_col, text_col, shingle))
    codes = prints.groupBy("code").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    edges = links(scratch, codes.select("code"), distance)
    roots = components(scratch, edges)
    # the linked codes only: the smallest id of each component, the root's own included
    linked = roots.unionByName(roots.select(F.col("root").alias("u"), "root").distinct())
    linked = linked.join(codes, linked["u"] == codes["code"]).select("u", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root").select(F.col("u").alias("code"), "root", "least")
    name = F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id")
    rows = prints.count()
    by_code = scratch.table(codes.join(named, "code", "left").select("code", "n", F.coalesce("root", "code").alias("root"), name), rows)
    # at most HOT codes hold so many rows each: these are broadcast, the others are joined by a shuffle
    hot = F.broadcast(by_code.filter(F.col("n") * HOT > rows))
    found = prints.join(hot, "code").unionByName(prints.join(hot.select("code"), "code", "left_anti").join(by_code, "code"))
    return found.select("doc_id", "hash", "code", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row of ``docs`` (all columns) for each component: that of its smallest id, a null id only if all are null.

    Of rows with this id, the text with the smallest hash stays; of rows that
    repeat id and text, any one.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "hash")).alias("k")
    keep = found.groupBy("root").agg(first).select("k.doc_id", F.col("k.hash").alias("keep_hash"))
    tag = free_name(docs, "_hash")
    tagged = docs.withColumn(tag, F.xxhash64(F.col(text_col).cast("string")))
    same = tagged[id_col].cast("long").eqNullSafe(keep["doc_id"]) & (tagged[tag] == keep["keep_hash"])
    return tagged.join(keep, same, "left_semi").dropDuplicates([id_col, tag]).drop(tag)
