"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms: the shapes of a text's words (runs of letters written as ``a`` or
``A``, of digits as ``0``, other characters kept), its words, and how often a
word repeats the one before it or any earlier one.  Shapes, words and repeats
are hashed into a term vector with damped counts; a truncated singular value
decomposition of a bounded sample of labelled rows gives the latent-semantic
space.  The sample's vectors are broadcast, cosine products are computed in
blocks for every document, and the ``NEIGHBOURS`` most similar labelled
vectors vote with their similarity.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import lower_slabs

SHAPES, WORDS, REPEATS = 1024, 2048, 64
RANK, NEIGHBOURS = 48, 15
_RUN = re.compile(rb"a{2,}|A{2,}|0{2,}")
_CLASS = bytes(97 if chr(c).islower() or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_hash = xxhash.xxh32_intdigest


def terms(text: str | None) -> np.ndarray:
    """Hashed term vector: each of the three blocks has unit length unless it is empty."""
    out = np.zeros(SHAPES + WORDS + REPEATS, dtype=np.float32)
    shapes, words, n, again, last = Counter(), Counter(), 0, 0, None
    raw = (text or "").encode("utf-8", "surrogatepass")
    for at in range(0, len(raw), 1 << 20):
        shapes.update(_RUN.sub(lambda m: m.group()[:1], raw[at:at + (1 << 20)].translate(_CLASS)).split())
    for w in lower_slabs(text):
        if w:
            words.update(w)
            n += len(w)
            again += sum(map(eq, w, w[1:])) + (w[0] == last)
            last = w[-1]
    if n:
        for counts, base, size in ((shapes, 0, SHAPES), (words, SHAPES, WORDS)):
            for t, c in counts.items():
                out[base + _hash(t) % size] += c
        out[:SHAPES] = np.sqrt(out[:SHAPES] / n)
        out[SHAPES:SHAPES + WORDS] = np.log1p(out[SHAPES:SHAPES + WORDS])
        base, half = SHAPES + WORDS, REPEATS // 2
        for k, share in enumerate((again / n, (n - len(words)) / n * min(1.0, math.log10(n + 1) / 4))):
            at = share * (half - 1)
            for b in range(half):  # a smooth bump at the share
                out[base + k * half + b] = math.exp(-((b - at) / 2) ** 2)
        for lo, hi in ((0, SHAPES), (SHAPES, SHAPES + WORDS), (SHAPES + WORDS, len(out))):
            norm = np.linalg.norm(out[lo:hi])
            if norm:
                out[lo:hi] /= norm
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", key: str = "doc_id", text_col: str = "text",
        max_rows: int = 3000, rank: int = RANK) -> dict:
    """Model from ``labels`` (key, label 0/1) and the texts of ``docs``.

    At most about ``max_rows`` labelled rows, chosen by a hash of the key, are
    used; their term vectors (max_rows x 3136 numbers) are decomposed on the
    driver.  Null labels are left out; a key labelled twice counts as 1 if any
    of its labels is 1.
    """
    given = labels.select(F.col(key).alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
    n = given.count()
    if n == 0:
        return {"prior": 0.5, "basis": np.zeros((SHAPES + WORDS + REPEATS, 0), np.float32), "vectors": np.zeros((0, 0), np.float32), "labels": np.zeros(0, np.float32)}
    given = given.filter(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int(min(1.0, max_rows / n) * (1 << 30)) + 1)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([terms(t.as_py()).astype(np.float16).tobytes() for t in b.column(2)], pa.binary())], ["k", "y", "x"])

    rows = (docs.select(F.col(key).alias("k"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(given), "k").select(F.col("k").cast("long"), "y", "text")
            .mapInArrow(extract, "k long, y int, x binary").collect())  # at most about max_rows rows
    rows = sorted(((r["k"], r["y"], bytes(r["x"])) for r in rows))
    x = np.array([np.frombuffer(r[2], np.float16) for r in rows], dtype=np.float32).reshape(len(rows), SHAPES + WORDS + REPEATS)
    y = np.array([min(1, max(0, r[1])) for r in rows], dtype=np.float32)
    # randomized range finder with power steps, then a small exact decomposition
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(rank + 16, *x.shape) if len(x) else 0)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt[:rank].T).astype(np.float32)
    return {"prior": float(y.mean()) if len(y) else 0.5, "basis": basis, "vectors": _unit(x @ basis), "labels": y}


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, n, out=np.zeros_like(v), where=n > 1e-9)


def vote(v: np.ndarray, model: dict, k: int = NEIGHBOURS, block: int = 256) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest labelled vectors; the prior where nothing is similar."""
    out = np.full(len(v), model["prior"])
    near, y = model["vectors"], model["labels"]
    k = min(k, len(near))
    for at in range(0, len(v) if k else 0, block):
        cos = _unit(v[at:at + block]) @ near.T
        top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        sim = np.maximum(np.take_along_axis(cos, top, axis=1), 0.0).astype(np.float64) ** 8
        total = sim.sum(axis=1)
        out[at:at + block] = np.where(total > 1e-9, np.clip((sim * y[top]).sum(axis=1) / np.maximum(total, 1e-9), 0, 1), model["prior"])
    return out


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): one row for each input row.

    Null and empty texts have no terms and get the prior of the sample; null
    and repeated ids keep their rows; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_rows x rank and terms x rank numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            parts = []
            for at in range(0, b.num_rows, 256):
                x = np.array([terms(t.as_py()) for t in b.column(1).slice(at, 256)], dtype=np.float32).reshape(-1, m["basis"].shape[0])
                parts.append(vote(x @ m["basis"], m))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([np.empty(0), *parts]))], ["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))
