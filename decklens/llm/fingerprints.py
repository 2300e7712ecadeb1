"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the ``K`` smallest distinct 48-bit hashes of a text's five-word
shingles (A-Z lowered; fewer words: the whole sequence is one shingle; no
words: an empty sketch), written as base64 of big-endian 6-byte values.  The
sketch of a union is the ``K`` smallest of the united sketches, so sketches
of parts merge in any order.  Two sketches estimate resemblance (Jaccard),
containment and distinct shingle counts; while both hold fewer than ``K``
hashes the figures are exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import lower_slabs, shuffle_partitions, slices, window_hashes, word_hashes

K = 128
SHINGLE = 5
SPACE = float(1 << 48)
#: Sampled ids a bucket of the order; they only place the cuts.
SAMPLE = 64


def sketch(text: str | None, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    low, carry, seen = np.empty(0, np.uint64), np.empty(0, np.uint64), 0
    for words in lower_slabs(text):
        h = np.concatenate([carry, word_hashes(words)])
        seen += len(words)
        if len(h) >= shingle:
            low = np.unique(np.concatenate([low, window_hashes(h, shingle) >> np.uint64(16)]))[:k]
            h = h[len(h) - shingle + 1:]
        carry = h
    if 0 < seen < shingle:
        low = window_hashes(carry, shingle) >> np.uint64(16)
    return low


def write(s: np.ndarray) -> str:
    return base64.b64encode(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def read(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, 6)
    return np.concatenate([np.zeros((len(raw), 2), np.uint8), raw], axis=1).reshape(-1).view(">u8").astype(np.uint64)


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sketches]))[:k]


def distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(s)) if len(s) < k else (k - 1) * SPACE / (float(s[-1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard resemblance; two empty sketches are alike, one empty sketch is unlike any other."""
    union = np.unique(np.concatenate([a, b]))
    if not len(union):
        return 1.0
    if len(a) >= k or len(b) >= k:
        union = union[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has (1 for an empty a)."""
    if not len(a):
        return 1.0
    both = np.unique(np.concatenate([a, b]))
    union = float(len(both)) if len(a) < k and len(b) < k else distinct(both[:k], k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_distinct): one row for each input row; null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [sketch(t.as_py(), k) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([write(x) for x in s], pa.string()), pa.array([distinct(x, k) for x in s], pa.float64())],
                                             ["doc_id", "fingerprint", "n_distinct"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint string, n_distinct double"))


def merged(prints: DataFrame, key: str, k: int = K, salts: int = 32) -> DataFrame:
    """(key, fingerprint): the sketch of the union of each key's texts; a hot key is merged by ``salts`` tasks first."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "salt": 0, "fingerprint": [write(merge([read(x) for x in pdf["fingerprint"]], k))]})

    kind = prints.schema[key].dataType.simpleString()
    schema = f"key {kind}, salt int, fingerprint string"

    def partly(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:  # combined before the shuffle
            if len(pdf):
                yield pd.concat([add(g).assign(salt=s) for (_, s), g in pdf.groupby(["key", "salt"], dropna=False, sort=False)])

    salted = prints.select(F.col(key).alias("key"), F.pmod(F.xxhash64("fingerprint"), F.lit(salts)).cast("int").alias("salt"), "fingerprint")
    once = salted.mapInPandas(partly, schema).groupBy("key", "salt").applyInPandas(add, schema)
    return once.groupBy("key").applyInPandas(add, schema).select(F.col("key").alias(key), "fingerprint")


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many first code points of ``following``."""
    m = len(text) // 2
    return text[:len(text) - m] + following[:m]


def _bucket(cuts: list[int]):
    """Bucket of (key, hash) in the order of falling key; a key at several cuts spreads over as many buckets by hash."""
    points = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def at(key: pd.Series, h: pd.Series) -> pd.Series:
        x = key.to_numpy(dtype=np.int64)
        right = np.searchsorted(points, x, "right")
        same = right - np.searchsorted(points, x, "left")
        share = h.to_numpy().astype(np.float64) / 2.0 ** 64 + 0.5
        return pd.Series(len(points) - right + np.minimum((share * (same + 1)).astype(np.int64), same)).astype("int32")

    return at


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (bucket, ahead, ...): each row that is not ``ahead`` is compared with the next row of its bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    last = None
    for b in (s for batch in batches for s in slices(batch)):
        out = []
        for bucket, ahead, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            if ahead and (last is None or last[0] != bucket):
                continue  # a repeated copy of the row ahead
            text = text.as_py() or ""
            s = sketch(text)
            if last is not None and last[0] == bucket:
                _, d, t, own = last
                e = edited(t, text)
                es = sketch(e)
                out.append((d, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), write(own), write(es), resemblance(own, es), resemblance(own, s)))
            last = None if ahead else (bucket, doc, text, s)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its text edited with the next document's (by falling doc_id; after the last: the first).

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): one row for each input row.  Null texts are
    empty.  Rows that repeat an id follow each other by the hash of their
    text; null ids come last; a single row follows itself; an empty table
    gives no rows.  Only the two named columns are read.

    Rows are dealt by ranges of the order into buckets; the first row of each
    bucket goes also to the bucket before it, so every row meets its successor
    with one shuffle of the texts and a task holds two texts at a time.  An id
    that fills several buckets is split by text hash.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), key.alias("key"))
    n = 4 * shuffle_partitions(spark)
    # cuts are keys of a bounded sample: neighbouring longs beyond 2**53 would be one double
    share = min(1.0, SAMPLE * n / max(1, rows.count()))
    some = sorted(r["key"] for r in rows.select("key").sample(share, seed=1).collect())
    cuts = [some[len(some) * i // n] for i in range(1, n)] if some else []
    rows = rows.withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("bucket", _bucket(cuts)(F.col("key"), F.col("hash")))
    order = F.struct(F.bitwise_not("key").alias("k"), F.col("hash").alias("h"))
    firsts = sorted((r["bucket"], r["f"]["k"], r["f"]["h"]) for r in rows.groupBy("bucket").agg(F.min(order).alias("f")).collect())  # one for each bucket
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    to = [(k, h, firsts[i - 1][0]) for i, (_, k, h) in enumerate(firsts)]
    to = F.broadcast(spark.createDataFrame(to, "fk long, fh long, target int"))
    rows = rows.join(to, (F.bitwise_not("key") == F.col("fk")) & F.col("hash").eqNullSafe(F.col("fh")), "left")
    own = F.struct(F.col("bucket"), F.lit(0).alias("ahead"))
    also = F.struct(F.col("target").alias("bucket"), F.lit(1).alias("ahead"))
    dealt = rows.withColumn("to", F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, also))))
    dealt = dealt.select("to.bucket", "to.ahead", "doc_id", "text", F.bitwise_not("key").alias("k"), "hash")
    return (dealt.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket", "ahead", "k", "hash")
            .select("bucket", "ahead", "doc_id", "text")
            .mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"))
