"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

Words are runs of letters, digits and bytes beyond ASCII, A-Z lowered.  The
features of a text are the distinct hashes of its words, of their stems (the
first bytes of a word, which inflected forms share), of word pairs and of
pairs that skip one or two words.  FTRL-proximal keeps a rate for every coordinate,
and its L1 term leaves most weights exactly zero, so the model is a short
sparse vector that is broadcast.

Training reads a bounded sample of the labelled rows, dealt by hash to tasks
of about ``SHARD_ROWS`` rows.  Every task learns over its rows in a fixed order
and returns its nonzero weights only, which are averaged (parameter mixing).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import word_hashes

BITS = 22
SHARD_ROWS = 5000
STEMS = (4, 5)
_WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def features(text: str | None) -> Iterator[np.ndarray]:
    """Hashed features of the text with repeats, in parts of bounded size."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    shift, words, tail = np.uint64(64 - BITS), [], np.empty(0, dtype=np.uint64)

    def part(words: list[bytes]) -> np.ndarray:
        h, old = np.concatenate([tail, word_hashes(words)]), len(tail)
        with np.errstate(over="ignore"):
            out = [(h[old:] * _MULT[0]) >> shift]
            for n in STEMS:
                out.append((word_hashes([w[:n] for w in words if len(w) > n]) * _MULT[n % 4]) >> shift)
            for gap in (1, 2, 3):
                lo = max(0, old - gap)  # pairs that end among the new words
                a, b = h[lo:len(h) - gap], h[lo + gap:]
                out.append(((a * _MULT[gap] ^ (b >> np.uint64(7))) * _MULT[0]) >> shift)
        return np.concatenate(out).astype(np.int64)

    for m in _WORDS.finditer(raw):
        words.append(m.group())
        if len(words) >= 1 << 16:
            yield part(words)
            tail, words = word_hashes(words[-3:]), []
    if words:
        yield part(words)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", key: str = "doc_id", text_col: str = "text", max_rows: int = 20_000,
        epochs: int = 5, alpha: float = 3.0, beta: float = 1.0, l1: float = 3.0, l2: float = 0.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(indices, weights, bias) learned from ``labels`` (key, label 0/1) and the texts of ``docs``.

    At most about ``max_rows`` labelled rows, chosen by a hash of the key, are
    used.  Labels that are null are left out; a key labelled twice counts as 1
    if any of its labels is 1.
    """
    given = labels.select(F.col(key).alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
    n = given.count()
    if n == 0:
        return np.empty(0, np.int64), np.empty(0), 0.0
    h = F.pmod(F.xxhash64("k"), F.lit(1 << 30))
    given = given.withColumn("h", h).filter(F.col("h") < int(min(1.0, max_rows / n) * (1 << 30)) + 1)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(np.concatenate([np.empty(0, np.int64), *features(t.as_py())])).astype(np.int32).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary())], ["y", "h", "x"])

    # the sample's keys and labels: at most about max_rows rows of 24 bytes
    rows = docs.select(F.col(key).alias("k"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(given), "k").select("y", "h", "text")
    size, shards = (1 << BITS) + 1, min(n, max_rows) // SHARD_ROWS + 1

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        z, s, pen = np.zeros(size, np.float32), np.zeros(size, np.float32), np.full(size, l1, np.float32)
        pen[-1] = 0.0  # the last coordinate is the bias
        pdf = pdf.sort_values(["h", "y"], kind="stable")
        sets = [np.append(np.frombuffer(raw, np.int32), size - 1) for raw in pdf["x"]]
        for _ in range(epochs):
            for y, i in zip(pdf["y"], sets):
                zi, si = z[i], s[i]
                root = np.sqrt(si)
                w = np.where(np.abs(zi) <= pen[i], 0.0, (np.sign(zi) * pen[i] - zi) / ((beta + root) / alpha + l2))
                g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - min(1, max(0, y))
                z[i] = zi + g - (np.sqrt(si + g * g) - root) / alpha * w
                s[i] = si + g * g
        at = np.flatnonzero(np.abs(z) > pen).astype(np.int32)
        w = (np.sign(z[at]) * pen[at] - z[at]) / ((beta + np.sqrt(s[at])) / alpha + l2)
        return pd.DataFrame({"n": [len(pdf)], "i": [at.tobytes()], "w": [w.astype(np.float64).tobytes()]})

    parts = (rows.mapInArrow(extract, "y int, h long, x binary").withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
             .groupBy("shard").applyInPandas(learn, "n long, i binary, w binary").collect())  # the nonzero weights of each shard
    total = sum(p["n"] for p in parts)
    if not total:
        return np.empty(0, np.int64), np.empty(0), 0.0
    i = np.concatenate([np.frombuffer(bytes(p["i"]), np.int32) for p in parts])
    w = np.concatenate([np.frombuffer(bytes(p["w"])) * (p["n"] / total) for p in parts])
    at, place = np.unique(i, return_inverse=True)
    mean = np.bincount(place, weights=w, minlength=len(at))
    bias = float(mean[at == size - 1].sum())
    keep = (at != size - 1) & (mean != 0)
    return at[keep].astype(np.int64), mean[keep], bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 for each input row.

    Null and empty texts get the score of no features; null and repeated ids
    keep their rows; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # nonzero weights only, at most 2**BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = shared.value
        dense = np.zeros(1 << BITS)
        dense[at] = w
        for b in batches:
            out = np.empty(b.num_rows)
            for r, t in enumerate(b.column(1)):
                hit = [i[dense[i] != 0] for i in features(t.as_py())]
                out[r] = bias + dense[np.unique(np.concatenate(hit))].sum() if hit else bias
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))], ["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))
