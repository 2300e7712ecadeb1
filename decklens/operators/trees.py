"""Tree ensembles grown by shared work.

Features are binned once (at most 256 bins: every distinct value of a feature
with few, quantiles otherwise) and a row is its bins as bytes.  One search
fits a whole grid:

* Boosting (second order: gradient and hessian sums, L2 on the leaves, as the
  reference's library): the models of all folds and settings grow in the same
  passes, and a run of 300 rounds is the prefix of the run of 500.
* Forests: bootstrap weights, feature draws and node keys are hashes, so 200
  trees are a prefix of 400, a tree of depth 6 or 10 is the top of the tree of
  unlimited depth, and a larger ``min_samples_split`` cuts the same tree
  earlier.  One unlimited tree serves every setting of the grid.

Nodes of more than ``local_rows`` rows are split by shared histograms: one
aggregate a level, keyed by (model, node, feature, bin), for all models, and
the best split of each node is chosen in Spark.  A node of at most
``local_rows`` rows, the root included, is completed inside one task.  Both
ways give the same trees.

A split sends a row left if its bin is at most the split's bin.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_BINS = 256
#: Rows that one task holds (a few hundred bytes each); their distinct bins are what it works through.
LOCAL_ROWS = 2_000_000
#: Groups that share the trees of a forest or the models of a boosting grid.
JOBS = 40
LAMBDA, MIN_HESSIAN, MIN_GAIN = 1.0, 1.0, 1e-6


# --- bins ----------------------------------------------------------------------------------------

def bin_edges(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """The cuts of each feature; bin b holds the values in (cut b - 1, cut b].  A null feature is an error."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x")) for i, c in enumerate(features)])).alias("e"))
    distinct = each.select("e.f", "e.x").distinct()
    known = {r["f"]: r for r in distinct.groupBy("f").agg(F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("nulls")).collect()}  # one row a feature
    if any(r["nulls"] for r in known.values()):
        raise ValueError(f"null values in {[features[f] for f, r in sorted(known.items()) if r['nulls']]}")
    few = [f for f, r in known.items() if r["n"] <= max_bins]
    values: dict[int, list] = {f: [] for f in few}
    for r in distinct.filter(F.col("f").isin(few)).collect() if few else []:  # at most max_bins rows a feature
        values[r["f"]].append(r["x"])
    edges = {f: (lambda v: (v[1:] + v[:-1]) / 2)(np.sort(np.array(x))) for f, x in values.items()}
    many = [f for f in known if f not in edges]
    if many:
        cuts = df.approxQuantile([features[f] for f in many], [i / max_bins for i in range(1, max_bins)], 0.25 / max_bins)
        edges |= {f: np.unique(c) for f, c in zip(many, cuts)}
    return [edges.get(f, np.empty(0)) for f in range(len(features))]


def binned(df: DataFrame, features: list[str], edges: list[np.ndarray], key: str, label: str | None = None, fold: str | None = None) -> DataFrame:
    """(key, h, y, fold, bins): h is a hash of the key, bins one byte a feature."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([np.searchsorted(e, b.column(4 + f).to_numpy(zero_copy_only=False), side="left") for f, e in enumerate(edges)]).astype(np.uint8)
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(k) for k in range(4)] + [rows], ["id", "h", "y", "fold", "bins"])

    y = F.col(label).cast("double") if label else F.lit(0.0)
    cols = [F.col(key).alias("id"), F.xxhash64(F.col(key)).alias("h"), y.alias("y"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold")]
    return df.select(*cols, *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]).mapInArrow(run, f"id {kind}, h long, y double, fold int, bins binary")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(len(column), -1)


def _distinct(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of ``bins`` and the place of each row among them."""
    _, first, of = np.unique(np.ascontiguousarray(bins).view(np.dtype((np.void, bins.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return bins[first], of


# --- keyed randomness ----------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return h


def _seed(*parts: int) -> np.uint64:
    h = np.zeros(1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            h = _mix(h + np.uint64(p) + np.uint64(0x9E3779B97F4A7C15))
    return h[0]


def _uniform(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    out, h = np.empty(len(h)), h.view(np.uint64)
    for lo in range(0, len(h), 16_384):  # parts that stay in a core's cache
        out[lo:lo + 16_384] = _mix(h[lo:lo + 16_384] ^ seed) >> np.uint64(11)
    out *= 2.0 ** -53
    return out


#: Poisson(1): each row's number of copies in a bootstrap sample, independent of how the rows are dealt.
_POISSON = np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880]))


def bootstrap(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    u, out = _uniform(h, _seed(seed, 1, tree)), np.zeros(len(h))
    for p in _POISSON:
        more = u >= p
        if not more.any():
            break
        out += more
    return out


def _drawn(keys: np.ndarray, features: int, m: int) -> np.ndarray:
    """``m`` features of each node, by the node's key, ascending."""
    with np.errstate(over="ignore"):
        rank = _mix(keys[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argsort(rank, axis=1)[:, :m], axis=1)


def _child_keys(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.column_stack([_mix(keys * np.uint64(2) + np.uint64(s + 1)) for s in (0, 1)]).ravel()


#: Sums differ in their last digits with the order of the rows; gains that are equal but for these are ties.
_TIE = 1e-9


# --- the split of each node ----------------------------------------------------------------------

def _histograms(columns: np.ndarray, rows: np.ndarray, node: np.ndarray, k: int, w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """(2, k, columns, 256): sums of ``w`` and ``s`` in each bin of each of ``columns`` (column by column, as integers) of each node."""
    out, first = np.empty((2, k, len(columns), 256)), node << 8
    for f, column in enumerate(columns):
        cell = column[rows] + first
        for part, x in zip(out, (w, s)):
            part[:, f] = np.bincount(cell, x, k << 8).reshape(k, 256)
    return out


#: Cells whose gains are worked out at a time, so that they stay in a core's cache.
GAIN_CELLS = 1 << 15


def _best_cells(cells: np.ndarray, lam: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, column, bin) of the best split of each node of ``_histograms``; an empty bin repeats the split of the bin before it, which comes first."""
    _, k, m, _ = cells.shape
    out_gain, out_at, step = np.empty(k), np.empty(k, dtype=np.int64), max(1, GAIN_CELLS // (m << 8))
    for lo in range(0, k, step):
        lw, ls = np.cumsum(cells[:, lo:lo + step], axis=3)
        w, s = lw[:, :, -1:].copy(), ls[:, :, -1:].copy()
        rw, rs = w - lw, s - ls
        bad = np.minimum(lw, rw) < least
        with np.errstate(divide="ignore", invalid="ignore"):
            ls *= ls
            ls /= np.add(lw, lam, out=lw)
            rs *= rs
            rs /= np.add(rw, lam, out=rw)
            ls += rs
            ls -= s * s / (w + lam)
        ls[bad] = -np.inf
        gain = ls.reshape(len(ls), -1)
        top = gain.max(axis=1)
        at = (gain >= (top - _TIE * np.abs(top))[:, None]).argmax(axis=1)
        out_gain[lo:lo + step], out_at[lo:lo + step] = gain[np.arange(len(at)), at], at
    return out_gain, out_at >> 8, out_at & 255


def best_splits(bins: np.ndarray, rows: np.ndarray, node: np.ndarray, k: int, drawn: np.ndarray | None, w: np.ndarray, s: np.ndarray,
                lam: float, least: float, cells: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature, bin) of the best split of each of ``k`` nodes; gain is -inf where no split leaves ``least`` weight on both sides.

    ``rows`` with their ``node``, weight ``w`` and weighted target ``s``;
    ``drawn``: the features of each node that are tried (all if None).  The
    gain is the growth of sum(s)^2 / (sum(w) + lam); ties go to the lowest
    feature, then the lowest bin.  ``cells``: the nodes' ``_histograms``, if
    they are known.
    """
    if cells is not None:
        return _best_cells(cells, lam, least)
    m = bins.shape[1] if drawn is None else drawn.shape[1]
    part = bins[rows] if drawn is None else bins[rows[:, None], drawn[node]]
    cell = (node[:, None] * m + np.arange(m)) << 8 | part
    if k * 256 <= len(rows):
        # few nodes: all cells at once
        gain, column, cut = _best_cells(np.stack([np.bincount(cell.ravel(), np.repeat(x, m), k * m << 8).reshape(k, m, 256) for x in (w, s)]), lam, least)
        return gain, column if drawn is None else drawn[np.arange(k), column], cut
    # the rows of each node and column by their bins; a split lies between two bins
    shift = int(len(rows)).bit_length()
    packed = np.sort((cell << shift) | np.arange(len(rows))[:, None], axis=None)
    cell, row = packed >> shift, packed & ((1 << shift) - 1)
    tw, ts = (np.concatenate([[0.0], np.cumsum(x[row])]) for x in (w, s))
    size = np.repeat(np.bincount(node, minlength=k), m)
    end = np.cumsum(size)
    new = cell[1:] != cell[:-1]
    new[end[(end > 0) & (end < len(cell))] - 1] = False
    c = np.flatnonzero(new)
    out_gain, feature, cut = np.full(k, -np.inf), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
    if not len(c):
        return out_gain, feature, cut
    seg, first = cell[c] >> 8, end - size
    of = np.repeat(np.arange(k), m)[seg]
    lw, ls = (t[c + 1] - t[first][seg] for t in (tw, ts))
    W, S = (np.bincount(node, x, k) for x in (w, s))
    rw, rs = W[of] - lw, S[of] - ls
    bad = np.minimum(lw, rw) < least
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls * ls / (lw + lam) + rs * rs / (rw + lam) - (S * S / (W + lam))[of]
    gain[bad] = -np.inf
    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    top = np.zeros(k)
    top[of[begin]] = np.maximum.reduceat(gain, begin)
    at = np.flatnonzero(gain >= (top - _TIE * np.abs(top))[of])
    at = at[np.append(True, of[at][1:] != of[at][:-1])]  # the lowest feature and bin of each node
    nodes, column = of[at], seg[at] % m
    out_gain[nodes], cut[nodes] = gain[at], cell[c[at]] & 255
    feature[nodes] = column if drawn is None else drawn[nodes, column]
    return out_gain, feature, cut


_CELLS = "model int, node int, feature int, bin int, w double, s double, q double, n double"


def splits_in_spark(cells: DataFrame, lam: float, least: float) -> DataFrame:
    """``best_splits`` over many tasks: one row for each (model, node) of ``cells``, with the sums of the node and of its left side.

    ``cells`` (model, node, feature, bin, w, s, q, n): weight, target, squared
    target and rows of part of a cell; ``none`` marks a node without a split.
    """
    total = cells.groupBy("model", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "wsqn"])
    line = Window.partitionBy("model", "node", "feature").orderBy("bin")  # at most 256 rows
    whole = Window.partitionBy("model", "node", "feature")
    left = total.select("model", "node", "feature", "bin", *[F.sum(c).over(line).alias(f"l{c}") for c in "wsqn"],
                        *[F.sum(c).over(whole).alias(c) for c in "wsqn"], F.max("bin").over(whole).alias("last"))
    rw, rs = F.col("w") - F.col("lw"), F.col("s") - F.col("ls")
    gain = F.col("ls") ** 2 / (F.col("lw") + lam) + F.try_divide(rs ** 2, rw + lam) - F.col("s") ** 2 / (F.col("w") + lam)
    scored = left.withColumn("gain", F.when((F.col("bin") < F.col("last")) & (F.col("lw") >= least) & (rw >= least), gain))
    top = F.max("gain").over(Window.partitionBy("model", "node"))  # at most features * 256 rows
    near = scored.withColumn("top", top).filter(F.col("gain").isNull() | (F.col("gain") >= F.col("top") - _TIE * F.abs("top")))
    pick = F.min(F.struct(F.col("gain").isNull().alias("none"), "feature", "bin", "gain", *"wsqn", *[f"l{c}" for c in "wsqn"])).alias("p")
    return near.groupBy("model", "node").agg(pick).select("model", "node", "p.*")


#: (model, node) pairs whose histograms a task holds at once.
PASS_NODES = 512


def _level(rows: DataFrame, read, payload, open_: set, lam: float, least: float, wanted=None) -> list:
    """The splits of the open (model, node) pairs: one aggregate for each ``PASS_NODES`` of them, one row a node to the driver.

    ``read(batch, payload, models)`` yields (model, bins, node, w, s, q) of the
    rows that count for a model; ``wanted[model, node]``: the features tried.
    """
    out, todo = [], sorted(open_)
    for lo in range(0, len(todo), PASS_NODES):
        part = todo[lo:lo + PASS_NODES]
        by_model = {m: np.array([n for x, n in part if x == m]) for m in dict.fromkeys(m for m, _ in part)}
        shared = rows.sparkSession.sparkContext.broadcast((payload, by_model, wanted))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            payload, by_model, wanted = shared.value
            total: dict = {}
            for b in batches:
                for m, bins, node, *sums in read(b, payload, list(by_model)):
                    mine, f = by_model[m], bins.shape[1]
                    place = np.full(max(mine.max(), node.max(initial=0)) + 1, -1)
                    place[mine] = np.arange(len(mine))
                    use = np.flatnonzero(place[node] >= 0)
                    cell = ((place[node[use]][:, None] * f + np.arange(f)) << 8 | bins[use]).ravel()
                    size = len(mine) * f << 8
                    got = np.stack([np.bincount(cell, minlength=size)] + [np.bincount(cell, np.repeat(x[use], f), size) for x in sums])
                    total[m] = total.get(m, 0) + got
            for m, got in total.items():
                mine, f = by_model[m], got.shape[1] // len(by_model[m]) >> 8
                held = np.flatnonzero(got[0])
                node, feature = mine[held // (f << 8)], held // 256 % f
                if wanted is not None:
                    keep = np.zeros((len(mine), f), dtype=bool)
                    for i, n in enumerate(mine.tolist()):
                        keep[i, wanted[m, n]] = True
                    keep = keep[held // (f << 8), feature]
                    held, node, feature = held[keep], node[keep], feature[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), m), pa.int32()), pa.array(node, pa.int32()), pa.array(feature, pa.int32()), pa.array(held % 256, pa.int32()),
                     *[pa.array(got[i][held]) for i in (1, 2, 3)], pa.array(got[0][held].astype(np.float64))], ["model", "node", "feature", "bin", *"wsqn"])

        out += splits_in_spark(rows.mapInArrow(run, _CELLS), lam, least).collect()
    return out


# --- trees ---------------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes as arrays; the children of node i are ``left[i]`` and ``left[i] + 1``, a leaf has ``feature`` -1."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def settle(self, bins: np.ndarray, caps: list[tuple[int | None, int]]) -> np.ndarray:
        """The value of each row for each cap (largest depth, fewest rows that are split)."""
        out = np.repeat(self.value[None], len(caps), axis=0)  # of a row that ends in a node, for each cap
        here, open_, depth = np.zeros(1, dtype=np.int64), np.ones((len(caps), 1), dtype=bool), 0
        while len(here):
            inner = self.feature[here] >= 0
            here, open_ = here[inner], open_[:, inner]
            for i, (deepest, fewest) in enumerate(caps):
                open_[i] &= self.rows[here] >= fewest if deepest is None or depth < deepest else False
            for side in (0, 1):  # below a node that is not split the node's value holds
                below = self.left[here] + side
                out[:, below] = np.where(open_, out[:, below], out[:, here])
            here, open_, depth = np.concatenate([self.left[here], self.left[here] + 1]), np.concatenate([open_, open_], axis=1), depth + 1
        return out[:, _place(self, bins)]

    def importance(self, features: int, cap: tuple[int | None, int]) -> np.ndarray:
        """Share of each feature in the gains of the splits that ``cap`` leaves."""
        depth = np.zeros(len(self.feature), dtype=np.int64)
        inner = np.flatnonzero(self.feature >= 0)
        for i in inner:  # children come after their parent
            depth[self.left[i]:self.left[i] + 2] = depth[i] + 1
        kept = inner[(self.rows[inner] >= cap[1]) & (cap[0] is None or depth[inner] < cap[0])]
        total = np.bincount(self.feature[kept], np.maximum(self.gain[kept], 0), features)
        return total / total.sum() if total.sum() > 0 else total

    def dump(self) -> bytes:
        """The nodes without their row counts, for storage and scoring."""
        n = np.array([len(self.feature)], dtype="<i8")
        return n.tobytes() + b"".join(a.astype(t).tobytes() for a, t in zip((self.feature, self.cut, self.left, self.value, self.gain), _STORED))

    @staticmethod
    def load(raw: bytes) -> "Tree":
        n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
        for t in _STORED:
            out.append(np.frombuffer(raw, t, n, at))
            at += n * np.dtype(t).itemsize
        return Tree(*out[:4], np.zeros(n, np.int64), out[4])


_STORED = ("<i2", "u1", "<i4", "<f8", "<f4")


class _Nodes:
    def __init__(self):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        self.n = 0

    def add(self, k: int, value: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for part, x in zip(self.parts, (np.full(k, -1), np.zeros(k, np.int64), np.zeros(k, np.int64), value, rows, np.zeros(k))):
            part.append(x)
        self.n += k
        return np.arange(self.n - k, self.n)

    def tree(self) -> Tree:
        return Tree(*[np.concatenate(p) for p in self.parts])

    def split(self, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, left: np.ndarray) -> None:
        """Of the nodes added last: those at ``at`` become inner."""
        for part, x in zip((self.parts[0], self.parts[1], self.parts[2], self.parts[5]), (feature, cut, left, gain)):
            part[-1][at] = x


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, key: np.uint64, m: int | None, deepest: int | None = None, fewest: int = 2) -> Tree:
    """A forest's tree over the rows of positive weight ``w``, down to pure nodes, ``fewest`` rows or ``deepest`` levels.

    The criterion is the drop in squared error, for labels 0 and 1 half the
    drop in Gini impurity.  ``m`` features are drawn at each node; if none of
    them can split it, all are tried.
    """
    return _grow(bins, w, w * y, w * y * y, (w > 0).astype(np.float64), key, m, deepest, fewest)


def _grow(bins: np.ndarray, w: np.ndarray, wy: np.ndarray, wyy: np.ndarray, n: np.ndarray, key: np.uint64, m: int | None, deepest: int | None, fewest: int) -> Tree:
    """``grow`` over rows of ``bins`` that stand for ``n`` rows each, with their sums of weight, weighted target and weighted square."""
    rows = np.flatnonzero(w > 0)
    node, keys, nodes, depth = np.zeros(len(rows), dtype=np.int64), np.array([key], dtype=np.uint64), _Nodes(), 0
    while len(keys):
        k, ww, s = len(keys), w[rows], wy[rows]
        W, S, Q = (np.bincount(node, x, k) for x in (ww, s, wyy[rows]))
        count = np.bincount(node, n[rows], k).astype(np.int64)
        here = nodes.add(k, S / np.maximum(W, 1e-300), count)
        # a node of one row of bins has no split
        ok = (count >= fewest) & (np.bincount(node, minlength=k) > 1) & (Q - S * S / np.maximum(W, 1e-300) > 1e-12 * np.maximum(Q, 1e-300)) & (deepest is None or depth < deepest)
        if not ok.any():
            break
        inner = np.flatnonzero(ok)
        place = np.full(k, -1)
        place[inner] = np.arange(len(inner))
        live = ok[node]
        rows, node, ww, s = rows[live], place[node[live]], ww[live], s[live]
        drawn = None if m is None or m >= bins.shape[1] else _drawn(keys[inner], bins.shape[1], m)
        gain, feature, cut = best_splits(bins, rows, node, len(inner), drawn, ww, s, 0.0, 0.5)
        stuck = np.flatnonzero(gain == -np.inf)
        if drawn is not None and len(stuck):
            again = np.full(len(inner), -1)
            again[stuck] = np.arange(len(stuck))
            sub = again[node] >= 0
            gain[stuck], feature[stuck], cut[stuck] = best_splits(bins, rows[sub], again[node[sub]], len(stuck), None, ww[sub], s[sub], 0.0, 0.5)
        good = np.flatnonzero(gain > -np.inf)
        place = np.full(len(inner), -1)
        place[good] = np.arange(len(good))
        nodes.split(inner[good], feature[good], cut[good], gain[good], nodes.n + 2 * np.arange(len(good)))
        live = place[node] >= 0
        rows, node = rows[live], node[live]
        node = 2 * place[node] + (bins[rows, feature[node]] > cut[node])
        keys, depth = _child_keys(keys[inner[good]]), depth + 1
    return nodes.tree()


# --- boosting ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Boosting:
    """One run: its step size, depth and row sample; ``fold`` is left out of its training rows (-1: none)."""
    rate: float
    depth: int
    subsample: float
    fold: int = -1


def _slope(margin: np.ndarray, y: np.ndarray, logistic: bool) -> tuple[np.ndarray, np.ndarray]:
    if not logistic:
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-margin))
    return p - y, np.maximum(p * (1 - p), 1e-16)


def _base(total: float, n: float, logistic: bool) -> float:
    mean = total / n if n else 0.5 * logistic
    return float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6))) if logistic else mean


def _sampled(h: np.ndarray, fold: np.ndarray, run: Boosting, turn: int, seed: int) -> np.ndarray:
    train = fold != run.fold if run.fold >= 0 else np.ones(len(fold), dtype=bool)
    return train if run.subsample >= 1 else train & (_uniform(h, _seed(seed, 2, turn)) < run.subsample)


#: Nodes of a level whose histograms a task keeps for the level below.
KEPT_NODES = 64


def _boosted_tree(bins: np.ndarray, columns: np.ndarray, varied: np.ndarray, rows: np.ndarray, g: np.ndarray, w: np.ndarray, run: Boosting) -> tuple[Tree, np.ndarray]:
    """The next tree and the step it gives every row; ``columns``: the features ``varied`` of ``bins``, column by column.

    Of two children only the smaller is summed up, the other is what is left of their parent.
    """
    nodes, step = _Nodes(), np.zeros(len(bins))
    at, live, node, k = np.zeros(len(bins), dtype=np.int64), rows, np.zeros(len(rows), dtype=np.int64), 1
    cells = parents = None
    for depth in range(run.depth + 1):
        gg, ww, size = g[live], w[live], np.bincount(node, minlength=k)
        value = -run.rate * np.bincount(node, gg, k) / (np.bincount(node, ww, k) + LAMBDA)
        here = nodes.add(k, value, size)
        open_ = at >= 0
        step[open_] = value[at[open_]]
        if depth == run.depth:
            break
        if k > KEPT_NODES:
            cells = None
        elif parents is None:
            cells = _histograms(columns, live, node, k, ww, gg)
        else:
            less = size[1::2] < size[::2]  # of each pair of children
            use = np.flatnonzero(less[node >> 1] == (node & 1))
            cells, pair = np.empty((2, k, *parents.shape[2:])), np.arange(k // 2)
            small = _histograms(columns, live[use], node[use] >> 1, k // 2, ww[use], gg[use])
            cells[:, 2 * pair + less] = small
            cells[:, 2 * pair + 1 - less] = parents - small
        gain, feature, cut = best_splits(bins, live, node, k, None, ww, gg, LAMBDA, MIN_HESSIAN, cells)
        if cells is not None:
            feature = varied[feature]
        good = np.flatnonzero(gain > MIN_GAIN)
        if not len(good):
            break
        parents = None if cells is None else cells[:, good]
        nodes.split(good, feature[good], cut[good], gain[good], nodes.n + 2 * np.arange(len(good)))
        place = np.full(k + 1, -1)  # the last for rows that are settled
        place[good] = np.arange(len(good))
        keep = place[node] >= 0
        live, node = live[keep], node[keep]
        node = 2 * place[node] + (bins[live, feature[node]] > cut[node])
        move = np.flatnonzero(place[at] >= 0)
        was = at[move]
        at[:] = -1
        at[move] = 2 * place[was] + (bins[move, feature[was]] > cut[was])
        k = 2 * len(good)
    return nodes.tree(), step


class _Held:
    """The rows of a task, those of equal features as one: ``bins`` are the distinct ones; rows (of, fold, h, y) lie by their place ``of`` among these, by fold and by h."""

    def __init__(self, bins: np.ndarray, of: np.ndarray, fold: np.ndarray, h: np.ndarray, y: np.ndarray):
        order = np.lexsort((h, fold, of))  # sums do not depend on how the rows arrive
        self.bins, self.of, self.fold, self.h, self.y = bins, of[order], fold[order], h[order], y[order]

    @staticmethod
    def read(batches: list[pa.RecordBatch]) -> "_Held":
        """From ``_groups``, whatever their order."""
        bins = np.concatenate([np.frombuffer(b"".join(b.column("bins").to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1) for b in batches])
        order = np.argsort(bins.view(np.dtype((np.void, bins.shape[1]))).ravel())
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        sizes = np.concatenate([b.column("members").value_lengths().to_numpy(zero_copy_only=False) for b in batches])
        members = [b.column("members").flatten() for b in batches]
        fold, h, y = (np.concatenate([m.field(c).to_numpy(zero_copy_only=False) for m in members]) for c in ("fold", "h", "y"))
        return _Held(bins[order], np.repeat(place, sizes), fold, h, y)

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first row, place, fold) of the rows of equal features and fold."""
        first = np.flatnonzero(np.append(True, (self.of[1:] != self.of[:-1]) | (self.fold[1:] != self.fold[:-1])))
        return first, self.of[first], self.fold[first]


def _raw(bins: np.ndarray) -> pa.Array:
    bins = np.ascontiguousarray(bins)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(bins.shape[1]), len(bins), [None, pa.py_buffer(bins)]).cast(pa.binary())


def _rounds(held: _Held, run: Boosting, rounds: int, logistic: bool, seed: int):
    """Yields (tree, margins of the distinct rows) of each round; rows of equal features have equal margins and are split as one row."""
    bins, train = held.bins, _sampled(held.h, held.fold, Boosting(1, 1, 1, run.fold), 0, seed)
    of, h, y = held.of[train], held.h[train], held.y[train]
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1])[:len(of)])
    base = _base(y.sum(), len(y), logistic)
    margin, n, total = np.full(len(bins), base), np.zeros(len(bins)), np.zeros(len(bins))
    varied = np.flatnonzero((bins != bins[:1]).any(axis=0))
    varied = varied if len(varied) else np.zeros(1, dtype=np.int64)
    columns = np.ascontiguousarray(bins[:, varied].T).astype(np.int64)
    yield Tree(np.array([-1]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([base]), np.array([len(y)]), np.zeros(1)), margin
    for turn in range(rounds):
        if len(first) and (turn == 0 or run.subsample < 1):
            use = np.ones(len(h)) if run.subsample >= 1 else (_uniform(h, _seed(seed, 2, turn)) < run.subsample).astype(np.float64)
            n[of[first]], total[of[first]] = np.add.reduceat(use, first), np.add.reduceat(use * y, first)
        # the slope is linear in y: of n rows of one margin it is n (slope at 0) - sum(y)
        g, w = _slope(margin, np.zeros(len(bins)), logistic)
        tree, step = _boosted_tree(bins, columns, varied, np.flatnonzero(n > 0), n * g - total, n * w, run)
        margin = margin + step
        yield tree, margin


def boost(bins: np.ndarray, y: np.ndarray, h: np.ndarray, fold: np.ndarray, run: Boosting, rounds: int, logistic: bool, seed: int = 42):
    """Yields (tree, margins of all rows) of each round; the first tree is a single leaf with the base margin."""
    bins, of = _distinct(bins)
    for tree, margin in _rounds(_Held(bins, of, fold, h, y), run, rounds, logistic, seed):
        yield tree, margin[of]


def _jobs(rows: DataFrame, n: int) -> DataFrame:
    """The rows by their features, (bins, members (fold, h, y)), for each of ``n`` jobs, a partition each; for tables of at most ``local_rows`` rows."""
    groups = rows.groupBy("bins").agg(F.collect_list(F.struct("fold", "h", "y")).alias("members"))
    return groups.withColumn("job", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).repartitionById(n, "job")


def _each_job(rows: DataFrame, n: int, fit, schema: str) -> DataFrame:
    """``fit(job, rows of the job)`` yields record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict = {}
        for b in batches:
            jobs = b.column("job").to_numpy()
            for job in np.unique(jobs).tolist():
                got.setdefault(job, []).append(b.filter(pa.array(jobs == job)))
        for job in sorted(got):
            yield from fit(job, _Held.read(got.pop(job)))

    return _jobs(rows, n).mapInArrow(run, schema)


def _boost_local(rows: DataFrame, runs: list[Boosting], marks: list[int], logistic: bool, seed: int, trees: bool) -> DataFrame:
    def fit(job: int, held: _Held) -> Iterator[pa.RecordBatch]:
        run, out = runs[job], []
        _, place, fold = held.cells()
        asked = place[fold == run.fold]
        for turn, (tree, margin) in enumerate(_rounds(held, run, max(marks), logistic, seed)):
            if trees:
                out.append((turn, tree.dump()))
            elif turn in marks:
                k = len(asked)
                yield pa.RecordBatch.from_arrays([_raw(held.bins[asked]), pa.array(np.full(k, run.fold), pa.int32()), pa.array(np.full(k, job), pa.int32()),
                                                  pa.array(np.full(k, turn), pa.int32()), pa.array(margin[asked])], ["bins", "fold", "run", "mark", "margin"])
        if trees:
            yield pa.RecordBatch.from_arrays([pa.array([job] * len(out), pa.int32()), pa.array([t for t, _ in out], pa.int32()), pa.array([raw for _, raw in out], pa.binary())],
                                             ["run", "tree", "raw"])

    if trees:
        return _each_job(rows, len(runs), fit, "run int, tree int, raw binary")
    found = _each_job(rows, len(runs), fit, "bins binary, fold int, run int, mark int, margin double")
    margins = found.groupBy("bins", "fold").agg(F.collect_list(F.struct("run", "mark", "margin")).alias("e"))
    return rows.join(margins, ["bins", "fold"]).select("id", "y", "fold", F.explode("e").alias("e")).select("id", "y", "fold", "e.*")


class _Growing:
    """The trees of one round over shared histograms, on the driver: a few numbers a node."""

    def __init__(self, runs: list[Boosting]):
        self.runs, self.nodes = runs, [[[-1, 0, 0, 0.0, 0, 0.0]] for _ in runs]
        self.open = {(m, 0) for m in range(len(runs))}

    def trees(self) -> list[Tree]:
        return [Tree(*[np.array([n[i] for n in nodes]) for i in range(6)]) for nodes in self.nodes]

    def add(self, rows: list, depth: int) -> None:
        """Split the open nodes by ``rows`` of ``splits_in_spark``; the children are open unless they are at the last depth."""
        self.open = set()
        for r in sorted(rows, key=lambda r: (r["model"], r["node"])):
            nodes, run = self.nodes[r["model"]], self.runs[r["model"]]
            node = nodes[r["node"]]
            node[3] = -run.rate * r["s"] / (r["w"] + LAMBDA)
            if r["gain"] is not None and r["gain"] > MIN_GAIN and depth < run.depth:
                node[:3], node[5] = [r["feature"], r["bin"], len(nodes)], r["gain"]
                for w, s in ((r["lw"], r["ls"]), (r["w"] - r["lw"], r["s"] - r["ls"])):
                    if depth + 1 < run.depth:
                        self.open.add((r["model"], len(nodes)))
                    nodes.append([-1, 0, 0, -run.rate * s / (w + LAMBDA), 0, 0.0])


def _place(tree: Tree, bins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bins), dtype=np.int64)
    live, at = np.arange(len(bins)), out.copy()  # the rows that are not in a leaf yet
    while len(live):
        feature = tree.feature[at]
        inner = feature >= 0
        if not inner.all():
            out[live[~inner]] = at[~inner]
            live, at, feature = live[inner], at[inner], feature[inner]
        at = tree.left[at] + (bins[live, feature] > tree.cut[at])
    return out


def _boost_shared(rows: DataFrame, runs: list[Boosting], marks: list[int], logistic: bool, seed: int, trees: bool, cut_every: int = 20) -> DataFrame:
    """All runs in the same passes over the data: one aggregate a level; margins are written every ``cut_every`` rounds."""
    from decklens.session import cut_lineage
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    sums = {r["fold"]: (r["s"], r["n"]) for r in rows.groupBy("fold").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n")).collect()}  # one row a fold
    base = np.array([_base(sum(s for f, (s, _) in sums.items() if f != run.fold or run.fold < 0), sum(n for f, (_, n) in sums.items() if f != run.fold or run.fold < 0), logistic) for run in runs])
    state = rows.withColumn("margins", F.lit(base.tobytes()))
    fields = ["id", "h", "y", "fold", "bins", "margins"]
    layout = f"id {kind}, h long, y double, fold int, bins binary, margins binary"

    def columns(b: pa.RecordBatch):
        _, h, y, fold = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        bins = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(b.num_rows, -1)
        return h, y, fold, bins, np.frombuffer(b"".join(b.column(5).to_pylist())).reshape(b.num_rows, -1).copy()

    def moved(pending):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, _, _, bins, margins = columns(b)
                for forest in pending.value:
                    for m, tree in enumerate(forest):
                        margins[:, m] += tree.value[_place(tree, bins)]
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([x.tobytes() for x in margins], pa.binary())], fields)
        return run

    def read(turn):
        def each(b: pa.RecordBatch, payload, models: list[int]):
            pending, forest = payload
            h, y, fold, bins, margins = columns(b)
            for m in models:
                for earlier in pending:
                    margins[:, m] += earlier[m].value[_place(earlier[m], bins)]
                use = np.flatnonzero(_sampled(h, fold, runs[m], turn, seed))
                g, w = _slope(margins[use, m], y[use], logistic)
                yield m, bins[use], _place(forest[m], bins[use]), w, g, np.zeros(len(use))
        return each

    pending, out, done = [], [], []
    for turn in range(max(marks) + 1):
        if turn in marks or turn % cut_every == 0 or turn == max(marks):
            if pending:
                state = cut_lineage(state.mapInArrow(moved(spark.sparkContext.broadcast(pending)), layout))
                pending = []
            if turn in marks and not trees:
                number = F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run")
                held = F.element_at(F.array(*[F.lit(r.fold) for r in runs]), F.col("run") + 1) == F.col("fold")
                double = F.udf(lambda raw, m: float(np.frombuffer(raw)[m]), "double")
                out.append(state.select("id", "y", "fold", "margins", number).filter(held)
                           .select("id", "y", "fold", "run", F.lit(turn).alias("mark"), double("margins", "run").alias("margin")))
        if turn == max(marks):
            break
        growing, depth = _Growing(runs), 0
        while growing.open:
            growing.add(_level(state, read(turn), (pending, growing.trees()), growing.open, LAMBDA, MIN_HESSIAN), depth)
            depth += 1
        pending.append(growing.trees())
        done.append(pending[-1])
    if trees:
        first = [Tree(np.array([-1]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([b]), np.zeros(1, np.int64), np.zeros(1)) for b in base]
        return spark.createDataFrame([(m, i, t.dump()) for i, forest in enumerate([first, *done]) for m, t in enumerate(forest)], "run int, tree int, raw binary")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def boosted(rows: DataFrame, runs: list[Boosting], marks: list[int], logistic: bool, seed: int = 42, trees: bool = False, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The runs over ``rows`` (see ``binned``).

    (id, y, fold, run, mark, margin): the margin of each row of a run's left-out
    fold after each number of rounds in ``marks``; with ``trees`` the trees
    themselves, (run, tree, raw), tree 0 being the base margin.
    """
    fit = _boost_local if rows.count() <= local_rows else _boost_shared
    return fit(rows, runs, marks, logistic, seed, trees)


# --- forests -------------------------------------------------------------------------------------

def _root_key(tree: int, fold: int, seed: int) -> np.uint64:
    return _seed(seed, 3, tree, fold + 1)


def _forest_local(rows: DataFrame, folds: list[int], marks: list[int], caps: list[tuple[int | None, int]], m: int | None, seed: int, trees: bool) -> DataFrame:
    most, names = max(marks), [f"s{i}" for i in range(len(marks) * len(caps))]
    jobs = min(JOBS, most)

    def fit(job: int, held: _Held) -> Iterator[pa.RecordBatch]:
        bins, (first, place, fold), out = held.bins, held.cells(), []
        asked = {f: place[fold == f] for f in folds}
        sums = {f: np.zeros((len(marks), len(caps), len(asked[f]))) for f in folds}
        deepest = None if any(c[0] is None for c in caps) else max(c[0] for c in caps)
        for t in range(job, most, jobs):
            w = bootstrap(held.h, t, seed)
            wy = w * held.y
            each = [np.add.reduceat(x, first) for x in (w, wy, wy * held.y, (w > 0).astype(np.float64))]  # by features and fold, for all folds' trees
            for f in folds:
                inside = fold != f
                tree = _grow(bins, *(np.bincount(place[inside], x[inside], len(bins)) for x in each), _root_key(t, f, seed), m, deepest, min(c[1] for c in caps))
                if trees:
                    out.append((t, tree.dump()))
                else:
                    value = tree.settle(bins[asked[f]], caps)
                    for total, k in zip(sums[f], marks):
                        if t < k:
                            total += value
        if trees:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int32()), pa.array([raw for _, raw in out], pa.binary())], ["tree", "raw"])
        for f in [] if trees else folds:
            yield pa.RecordBatch.from_arrays([_raw(bins[asked[f]]), pa.array(np.full(len(asked[f]), f), pa.int32()), *(pa.array(x) for x in sums[f].reshape(len(names), -1))],
                                             ["bins", "fold", *names])

    if trees:
        return _each_job(rows, jobs, fit, "tree int, raw binary")
    found = _each_job(rows, jobs, fit, "bins binary, fold int, " + ", ".join(f"{c} double" for c in names))
    return rows.join(found.groupBy("bins", "fold").agg(*[F.sum(c).alias(c) for c in names]), ["bins", "fold"]).select("id", "y", "fold", *names)


#: Models of a forest that are grown over shared histograms at the same time.
SHARED_MODELS = 64


def _forest_shared(rows: DataFrame, folds: list[int], marks: list[int], caps: list[tuple[int | None, int]], m: int | None, seed: int, trees: bool,
                   local_rows: int = LOCAL_ROWS) -> DataFrame:
    models = [(t, f) for t in range(max(marks)) for f in folds]
    parts = [_forest_part(rows, models[lo:lo + SHARED_MODELS], marks, caps, m, seed, trees, local_rows) for lo in range(0, len(models), SHARED_MODELS)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def _columns(b: pa.RecordBatch):
    _, h, y, fold = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
    return h, y, fold, np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(b.num_rows, -1)


def _forest_part(rows: DataFrame, models: list[tuple[int, int]], marks: list[int], caps: list[tuple[int | None, int]], m: int | None, seed: int, trees: bool, local_rows: int) -> DataFrame:
    """The top of each model's tree over shared histograms; what is below a node of at most ``local_rows`` rows in one task."""
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    features = len(rows.select("bins").first()[0])
    deepest, fewest = None if any(c[0] is None for c in caps) else max(c[0] for c in caps), min(c[1] for c in caps)
    size = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a fold
    nodes = [[[-1, 0, 0, 0.0, sum(n for f, n in size.items() if f != fold), 0.0]] for _, fold in models]
    info = {(i, 0): (_root_key(t, f, seed), 0, []) for i, (t, f) in enumerate(models)}  # key, depth, values above

    def read(b: pa.RecordBatch, payload, which: list[int]):
        h, y, fold, bins = _columns(b)
        for i in which:
            t, f = models[i]
            w = np.where(fold != f, bootstrap(h, t, seed), 0.0)
            use = np.flatnonzero(w > 0)
            yield i, bins[use], _place(payload[i], bins[use]), w[use], w[use] * y[use], w[use] * y[use] ** 2

    def arrays() -> list[Tree]:
        return [Tree(*[np.array([n[c] for n in one]) for c in range(6)]) for one in nodes]

    open_, small, wide = set(info), set(), set()
    if sum(size.values()) <= local_rows:
        open_, small = set(), set(info)
    while open_:
        drawn = {x: np.arange(features) if m is None or x in wide else _drawn(np.array([info[x][0]]), features, m)[0] for x in open_}
        now, open_ = _level(rows, read, arrays(), open_, 0.0, 0.5, drawn), set()
        for r in sorted(now, key=lambda r: (r["model"], r["node"])):
            at, one = (r["model"], r["node"]), nodes[r["model"]]
            key, depth, above = info[at]
            node = one[r["node"]]
            node[3], node[4] = r["s"] / r["w"], int(r["n"])
            if r["none"] and at not in wide and m is not None:
                wide.add(at)
                open_.add(at)
            if r["none"]:
                continue
            node[:3], node[5] = [r["feature"], r["bin"], len(one)], r["gain"]
            keys = _child_keys(np.array([key], dtype=np.uint64))
            for side, (w, s, q, n) in enumerate(((r["lw"], r["ls"], r["lq"], r["ln"]), (r["w"] - r["lw"], r["s"] - r["ls"], r["q"] - r["lq"], r["n"] - r["ln"]))):
                child = (r["model"], len(one))
                one.append([-1, 0, 0, s / w, int(n), 0.0])
                info[child] = (keys[side], depth + 1, [*above, node[3]])
                if n >= fewest and q - s * s / w > 1e-12 * max(q, 1e-300) and (deepest is None or depth + 1 < deepest):
                    (small if n <= local_rows else open_).add(child)
    shared = spark.sparkContext.broadcast((arrays(), {x: info[x] for x in small}))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each node that is completed in a task: its sample, and the left-out rows to score (w = 0)."""
        forest, below = shared.value
        for b in batches:
            h, _, fold, bins = _columns(b)
            for i, (t, f) in enumerate(models):
                w = np.where(fold != f, bootstrap(h, t, seed), 0.0)
                node = _place(forest[i], bins)
                inside = np.isin(node, [n for x, n in below if x == i])
                use = np.flatnonzero(inside & ((w > 0) | (fold == f)))
                part = b.take(pa.array(use))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(use), i), pa.int32()), pa.array(node[use], pa.int32()), pa.array(w[use]), *part.columns],
                                                 ["model", "node", "w", "id", "h", "y", "fold", "bins"])

    def complete(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        i, at = int(pdf["model"].iloc[0]), int(pdf["node"].iloc[0])
        key, depth, above = shared.value[1][i, at]
        bins, y, w = _matrix(pdf["bins"]), pdf["y"].to_numpy(), pdf["w"].to_numpy()
        tree = grow(bins, y, w, key, m, None if deepest is None else deepest - depth, fewest)
        if trees:
            return pd.DataFrame([(i, at, tree.dump())], columns=["model", "node", "raw"])
        held = np.flatnonzero(w == 0)
        values = np.stack([np.full(len(held), above[d]) if d is not None and d < depth else tree.settle(bins[held], [(None if d is None else d - depth, n)])[0] for d, n in caps])
        return summed(pdf["id"].to_numpy()[held], y[held], pdf["fold"].to_numpy()[held], models[i][0], values)

    def summed(ids, y, fold, t: int, values: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"id": ids, "y": y, "fold": fold} | {f"s{k * len(caps) + c}": values[c] * (t < mark) for k, mark in enumerate(marks) for c in range(len(caps))})

    def settled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The left-out rows that end in the top of a tree."""
        forest, below = shared.value
        for pdf in frames:
            bins, fold = _matrix(pdf["bins"]) if len(pdf) else np.zeros((0, features), np.uint8), pdf["fold"].to_numpy()
            for i, (t, f) in enumerate(models):
                held = np.flatnonzero(fold == f)
                held = held[~np.isin(_place(forest[i], bins[held]), [n for x, n in below if x == i])]
                yield summed(pdf["id"].to_numpy()[held], pdf["y"].to_numpy()[held], fold[held], t, forest[i].settle(bins[held], caps))

    dealt = rows.mapInArrow(deal, f"model int, node int, w double, id {kind}, h long, y double, fold int, bins binary")
    by_node = dealt.groupBy("model", "node")
    if not trees:
        schema = f"id {kind}, y double, fold int, " + ", ".join(f"s{k} double" for k in range(len(marks) * len(caps)))
        return by_node.applyInPandas(complete, schema).unionByName(rows.mapInPandas(settled, schema))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        """One whole tree: its top with the subtrees put in."""
        i = int(pdf["model"].iloc[0])
        top = shared.value[0][i]
        cols = [[c] for c in (top.feature.copy(), top.cut.copy(), top.left.copy(), top.value.copy(), top.gain.copy())]
        n = len(top.feature)
        for at, raw in zip(pdf["node"], pdf["raw"]):
            if raw is None:
                continue
            sub = Tree.load(raw)
            for col, x in zip(cols, (sub.feature, sub.cut, sub.left.astype(np.int64) + n - 1, sub.value, sub.gain)):
                col[0][at] = x[0]
                col.append(x[1:])
            n += len(sub.feature) - 1
        feature, cut, left, value, gain = (np.concatenate(c) for c in cols)
        return pd.DataFrame([(models[i][0], Tree(feature, cut, left, value, np.zeros(n, np.int64), gain).dump())], columns=["tree", "raw"])

    tops = spark.createDataFrame([(i, -1, None) for i in range(len(models))], "model int, node int, raw binary")
    return by_node.applyInPandas(complete, "model int, node int, raw binary").unionByName(tops).groupBy("model").applyInPandas(join, "tree int, raw binary")


def forest(rows: DataFrame, folds: list[int], marks: list[int], caps: list[tuple[int | None, int]], m: int | None, seed: int = 42, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(id, y, fold, mark, cap, value): the mean over the first ``mark`` trees of the models that leave the row's fold out, for each cap.

    ``caps``: (largest depth or None, fewest rows of a node that is split).
    """
    found = _forest_fit(rows, local_rows)(rows, folds, marks, caps, m, seed, False)
    sums = found.groupBy("id", "y", "fold").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(marks) * len(caps))])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("mark"), F.lit(c).alias("cap"), (F.col(f"s{i * len(caps) + c}") / k).alias("value"))
                               for i, k in enumerate(marks) for c in range(len(caps))])).alias("e")
    return sums.select("id", "y", "fold", each).select("id", "y", "fold", "e.*")


def forest_trees(rows: DataFrame, trees: int, cap: tuple[int | None, int], m: int | None, seed: int = 42, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(tree, raw): the forest of all rows under one cap."""
    return _forest_fit(rows, local_rows)(rows, [-1], [trees], [cap], m, seed, True)


def importances(trees: DataFrame, features: int, boosting: bool) -> np.ndarray:
    """Forests: the mean of the trees' shares of gain; boosting: the mean gain of a feature's splits, made to sum to 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = np.zeros(features), np.zeros(features)
        for b in batches:
            for raw in b.column(0).to_pylist():
                tree = Tree.load(raw)
                inner = tree.feature >= 0
                gains = np.bincount(tree.feature[inner], np.maximum(tree.gain[inner], 0), features)
                total += gains if boosting else gains / max(gains.sum(), 1e-300)
                used += np.bincount(tree.feature[inner], minlength=features)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(features), pa.int64()), pa.array(total), pa.array(used)], ["f", "total", "used"])

    rows = trees.select("raw").mapInArrow(run, "f long, total double, used double").groupBy("f").agg(F.sum("total").alias("total"), F.sum("used").alias("used")).collect()
    out = np.zeros(features)
    for r in rows:  # one row a feature
        out[r["f"]] = r["total"] / max(r["used"], 1) if boosting else r["total"]
    return out / out.sum() if out.sum() > 0 else out


def score(bins: np.ndarray, trees: list[Tree], boosting: bool) -> np.ndarray:
    """The sum (boosting) or mean of the trees' values of each row."""
    total = np.zeros(len(bins))
    for tree in trees:
        total += tree.value[_place(tree, bins)]
    return total if boosting else total / max(len(trees), 1)


def _forest_fit(rows: DataFrame, local_rows: int):
    return _forest_local if rows.count() <= local_rows else partial(_forest_shared, local_rows=local_rows)
