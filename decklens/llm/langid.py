"""Language identification by hyperdimensional profiles.

Each letter (and the space) has a random vector of +1 and -1, drawn from a
generator seeded by its code point.  A trigram is bound as the product of its
letters' vectors, permuted (rolled) by two, one and no places; the trigrams of
a text are bundled by summation.  A language's prototype is the sum of its
training documents' unit vectors, and a document goes to the prototype with
the highest cosine.

Letters are lowered, runs of anything else become one space, and each text is
framed by spaces.  Texts are counted in blocks: the counts of a block's
distinct trigrams times their vectors give all its documents' vectors in one
matrix product, trigram vectors being made in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.llm.common import slices

DIMS = 512
BLOCK = 1 << 18
SLICE = 4096
#: Prototypes that a block of documents is compared with at once.
PROTOTYPES = 1024


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself if a letter, else the space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)


@lru_cache(maxsize=65536)
def letter(cp: int, dims: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=cp)).integers(0, 2, dims, dtype=np.int8)
    return (2 * bits - 1).astype(np.int8)


def symbols(text: str, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """The framed text as letters and single spaces, in parts that overlap by two symbols."""
    tail = np.array([32], dtype=np.uint32)
    for at in range(0, len(text), size):
        raw = _letters()[np.frombuffer(text[at:at + size].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        s = np.concatenate([tail[-1:], raw])
        new = s[1:][(s[1:] != 32) | (s[:-1] != 32)]
        if at + size >= len(text):
            new = np.append(new, np.uint32(32)) if (new[-1] if len(new) else tail[-1]) != 32 else new
        s = np.concatenate([tail, new])
        if len(s) > 2:
            yield s
        tail = s[-2:]


def has_letter(text: str | None) -> bool:
    return any((s != 32).any() for s in symbols(text or ""))


def _bundle(parts: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
    """Add the trigram vectors of ``parts`` (row of ``out``, symbols) to ``out``."""
    rows = sorted({r for r, _ in parts})
    at = {r: i for i, r in enumerate(rows)}
    flat = np.concatenate([s for _, s in parts])
    known, ids = np.unique(flat, return_inverse=True) if flat.max() >= 1 << 16 else (None, None)
    if known is None:
        known = np.flatnonzero(np.bincount(flat))
        place = np.zeros(known[-1] + 1, dtype=np.int64)
        place[known] = np.arange(len(known))
        ids = place[flat]
    n, keys, docs, begin = len(known), [], [], 0
    for r, s in parts:
        x = ids[begin:begin + len(s)]
        keys.append((x[:-2] * n + x[1:-1]) * n + x[2:])
        docs.append(np.full(len(s) - 2, at[r]))
        begin += len(s)
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    if n ** 3 <= 1 << 20:
        distinct = np.flatnonzero(np.bincount(keys, minlength=n ** 3))
        place = np.zeros(n ** 3, dtype=np.int64)
        place[distinct] = np.arange(len(distinct))
        col = place[keys]
    else:
        distinct, col = np.unique(keys, return_inverse=True)
    dims, total = out.shape[1], np.zeros((len(rows), out.shape[1]), dtype=np.float32)
    base = np.stack([letter(int(c), dims) for c in known])
    two, one = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    order = np.argsort(col, kind="stable") if len(distinct) > SLICE else None
    for lo in range(0, len(distinct), SLICE):
        part = distinct[lo:lo + SLICE]
        if order is None:
            c, d = col, docs
        else:
            a, b = np.searchsorted(col, [lo, lo + SLICE], sorter=order)
            c, d = col[order[a:b]] - lo, docs[order[a:b]]
        counts = np.bincount(d * len(part) + c, minlength=len(rows) * len(part)).reshape(len(rows), len(part)).astype(np.float32)
        total += counts @ (two[part // (n * n)] * one[part // n % n] * base[part % n]).astype(np.float32)
    out[rows] += total


def vectors(texts: Iterator[str | None] | list, dims: int = DIMS) -> np.ndarray:
    """One bundled vector for each text; zero for texts that are null or have no letter."""
    texts = list(texts)
    out, parts, held = np.zeros((len(texts), dims), dtype=np.float32), [], 0
    for r, t in enumerate(texts):
        for s in symbols(t or ""):
            if (s != 32).any():
                parts.append((r, s))
                held += len(s)
            if held >= BLOCK:
                _bundle(parts, out)
                parts, held = [], 0
    if parts:
        _bundle(parts, out)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, n, out=np.zeros_like(v), where=n > 0)


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", per_language: int = 4000,
        dims: int = DIMS, salts: int = 64) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes as unit rows) from the rows of ``docs`` with a language.

    About ``per_language`` rows of each language, chosen by a hash of the key,
    are read; a language with fewer gives all its rows.  Every language keeps
    its prototype: the model takes 4 x ``dims`` bytes (2 KB) a language.
    """
    rows = docs.select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       F.pmod(F.xxhash64(F.col(key_col)), F.lit(1 << 30)).alias("pick")).filter("lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], np.zeros((0, dims), dtype=np.float32)
    share = docs.sparkSession.createDataFrame([(k, min(1.0, per_language / n)) for k, n in counts.items()], "lang string, share double")
    share = F.broadcast(share) if len(counts) <= 100_000 else share  # beyond that the planner decides by size
    rows = rows.join(share, "lang").filter(F.col("pick") < F.col("share") * (1 << 30)).select("lang", "text", (F.col("pick") % salts).cast("int").alias("salt"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for b in (s for batch in batches for s in slices(batch)):
            unit = _unit(vectors([t.as_py() for t in b.column(1)], dims)).astype(np.float64)
            for lang, salt, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), unit):
                total[lang, salt] = total.get((lang, salt), 0.0) + v
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array([total[k].tobytes() for k in keys], pa.binary())], ["lang", "salt", "sum"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "salt": 0, "sum": [sum(np.frombuffer(x) for x in pdf["sum"]).tobytes()]})

    schema = "lang string, salt int, sum binary"
    sums = rows.mapInArrow(partial, schema).groupBy("lang", "salt").applyInPandas(add, schema).groupBy("lang").applyInPandas(add, schema)
    got = sorted((r["lang"], np.frombuffer(bytes(r["sum"]))) for r in sums.select("lang", "sum").collect())  # languages x dims numbers
    got = [(k, v) for k, v in got if v.any()]
    return [k for k, _ in got], _unit(np.array([v for _, v in got], dtype=np.float32).reshape(len(got), dims))


def _scores(texts: list, langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    v = vectors(texts, prototypes.shape[1])
    known = v.any(axis=1)
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    unit, best, top = _unit(v), np.zeros(len(texts), dtype=int), np.full(len(texts), -2.0, dtype=np.float32)
    for lo in range(0, len(langs) if texts else 0, PROTOTYPES):
        cos = unit @ prototypes[lo:lo + PROTOTYPES].T
        at = cos.argmax(axis=1)
        value = cos[np.arange(len(texts)), at]
        better = value > top
        best, top = np.where(better, lo + at, best), np.where(better, value, top)
    score = np.where(known, np.clip(top, 0.0, 1.0), 0.0).astype(np.float64)
    return [langs[b] if k else "und" for b, k in zip(best, known)], score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): one row for each input row.

    ``und`` with score 0 for a text that is null or has no letter, or if no
    language was learned.  Null and repeated ids keep their rows.
    """
    langs, prototypes = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, prototypes))  # languages x dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for batch in batches for s in slices(batch)):
            pred, score = _scores([t.as_py() for t in b.column(1)], *shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def known_language(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", wanted: set[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text has a letter and whose language is in ``wanted`` if given.

    Without learned languages no text can be told from ``wanted``, so every text with a letter stays.
    """
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (s for batch in batches for s in slices(batch)):
            texts, (langs, prototypes) = [t.as_py() for t in b.column(at)], shared.value
            pred = _scores(texts, langs, prototypes)[0] if langs else ["und"] * len(texts)
            yield b.filter(pa.array([(p != "und" or has_letter(t)) and (not langs or wanted is None or p in wanted) for t, p in zip(texts, pred)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
