"""Support vectors with the real kernel (H3, H9).

Both machines are one problem: variables a with signs s on rows, minimise
1/2 |sum s a phi(x)|^2 + p.a with 0 <= a <= C and s.a = 0.  C-SVC has one
variable a row (s the label, p = -1), epsilon-SVR two (s = +1, p = eps - y;
s = -1, p = eps + y).  With f(x) = sum s a K, a variable's error is
e = -f - s p, and the optimum is reached when no variable that may still move
up has an error above (by more than the tolerance) one that may move down.

* Linear machines of any number of rows are solved in the primal, all folds
  and settings in the same passes: Newton steps on the loss with its corner
  rounded over a width that shrinks until the duality gap is small enough.  A
  pass is one aggregate of gradients and second moments; rows keep no state.
* RBF: rows with equal features have equal f, so they are one variable, the sum
  of their s a; what it costs to move it is a list of segments (``_segments``).
  Up to ``KERNEL_ROWS`` distinct feature rows, each machine of a fold is one
  task (sequential minimal optimisation with second-order choice of the pair).
  Kernel rows are made when they are needed and at most ``CACHE_BYTES`` of them
  are kept.  Folds and machines run in parallel.
* Beyond that, decomposition over Spark: the rows keep their variables and f
  as columns; in each turn the ``WORK_ROWS`` worst rows of the whole table are
  solved in one task, the rows whose variables changed are broadcast (at most
  ``WORK_ROWS``), and every row updates its f, until no row of the table
  violates the conditions.

The duality gap that is left is part of the result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct feature rows, and rows in all, of which one task solves a machine.
KERNEL_ROWS = 32_768
TASK_ROWS = 1_000_000
#: Kernel rows that a task keeps.
CACHE_BYTES = 512 << 20
WORK_ROWS = 4096
TOLERANCE = 1e-3
#: Turns of the decomposition after which the solution is taken with the gap that is left.
MAX_TURNS = 1000


@dataclass(frozen=True)
class Machine:
    """``epsilon`` None: classification of labels 0 and 1; ``gamma`` None: linear kernel."""
    C: float
    gamma: float | None
    epsilon: float | None = None


def kernel(a: np.ndarray, b: np.ndarray, gamma: float | None, kind=np.float64) -> np.ndarray:
    a, b = a.astype(kind), b.astype(kind)
    k = a @ b.T
    if gamma is None:
        return k
    k *= 2
    k -= (a * a).sum(axis=1)[:, None]
    k -= (b * b).sum(axis=1)[None]
    np.minimum(k, 0, out=k)
    k *= kind(gamma)
    return np.exp(k, out=k)


def _problem(y: np.ndarray, m: Machine) -> tuple[np.ndarray, np.ndarray]:
    """(signs, p) of the variables: of the rows, for SVR of the rows twice."""
    if m.epsilon is None:
        return np.where(y > 0.5, 1.0, -1.0), np.full(len(y), -1.0)
    one = np.ones(len(y))
    return np.concatenate([one, -one]), np.concatenate([m.epsilon - y, m.epsilon + y])


def smo(k: np.ndarray, sign: np.ndarray, p: np.ndarray, C: float, a: np.ndarray, f: np.ndarray, tolerance: float = TOLERANCE, steps: int = 10_000_000) -> None:
    """Solve for ``a`` in place; ``f`` (of the rows of ``k``) is kept equal to K (s a) plus what it had from rows outside."""
    n, diag = len(k), np.ascontiguousarray(k.diagonal()).astype(np.float64)
    twice = len(sign) // n
    e = -np.tile(f, twice) - sign * p
    diags = np.tile(diag, twice)
    up, low = np.where(sign > 0, a < C, a > 0), np.where(sign > 0, a > 0, a < C)
    high, down = np.where(up, 0.0, -np.inf), np.where(low, 0.0, np.inf)
    for _ in range(steps):
        i = int((e + high).argmax())
        gap = e[i] - e
        gap -= down
        if not gap.max() > tolerance or high[i]:
            break
        ki = k[i % n].astype(np.float64)
        kt = np.tile(ki, twice) if twice > 1 else ki
        curve = np.maximum(diag[i % n] + diags - 2 * kt, 1e-12)
        j = int(np.where(gap > 0, gap * gap / curve, -1.0).argmax())
        t = min((e[i] - e[j]) / curve[j], C - a[i] if sign[i] > 0 else a[i], a[j] if sign[j] > 0 else C - a[j])
        a[i] += sign[i] * t
        a[j] -= sign[j] * t
        for v in (i, j):
            if a[v] < 1e-12 * C:
                a[v] = 0.0
            elif a[v] > C * (1 - 1e-12):
                a[v] = C
            plus = sign[v] > 0
            high[v] = 0.0 if (a[v] < C if plus else a[v] > 0) else -np.inf
            down[v] = 0.0 if (a[v] > 0 if plus else a[v] < C) else np.inf
        step = t * (ki - k[j % n])
        f += step
        e -= np.tile(step, twice) if twice > 1 else step


def _bias(e: np.ndarray, sign: np.ndarray, a: np.ndarray, C: float) -> float:
    free = (a > 0) & (a < C)
    if free.any():
        return float(e[free].mean())
    up, low = np.where(sign > 0, a < C, a > 0), np.where(sign > 0, a > 0, a < C)
    return float((e[up].max(initial=-np.inf) + e[low].min(initial=np.inf)) / 2) if up.any() and low.any() else 0.0


def _weights(sign: np.ndarray, a: np.ndarray, n: int) -> np.ndarray:
    return (sign * a).reshape(-1, n).sum(axis=0)


class _Rows:
    """Rows of the kernel matrix of ``x``, made when asked for; the ones used last are kept, up to ``CACHE_BYTES``."""

    def __init__(self, x: np.ndarray, gamma: float | None):
        self.x, self.gamma = x.astype(np.float32), gamma
        self.norms = (self.x * self.x).sum(axis=1)
        self.kept = np.empty((min(len(x), max(2, CACHE_BYTES // (4 * len(x)))), len(x)), np.float32)
        self.at: OrderedDict[int, int] = OrderedDict()

    def diagonal(self) -> np.ndarray:
        return self.norms.astype(np.float64) if self.gamma is None else np.ones(len(self.x))

    def __getitem__(self, i: int) -> np.ndarray:
        if i in self.at:
            self.at.move_to_end(i)
            return self.kept[self.at[i]]
        self.at[i] = self.at.popitem(last=False)[1] if len(self.at) == len(self.kept) else len(self.at)
        k = self.kept[self.at[i]]
        np.dot(self.x, self.x[i], out=k)
        if self.gamma is not None:
            k *= 2
            k -= self.norms
            k -= self.norms[i]
            np.minimum(k, 0, out=k)
            k *= np.float32(self.gamma)
            np.exp(k, out=k)
        return k


@dataclass
class _Segments:
    """What moving the variables of equal feature rows costs, in units of C.

    The variable of group g runs from ``top[g]`` down through the segments
    ``first[g]`` to ``first[g + 1] - 1``, each ``width`` long; inside a segment
    the optimum has f + b = ``value``.  ``of`` is the segment of each variable
    of ``_problem``.
    """
    value: np.ndarray
    width: np.ndarray
    first: np.ndarray
    top: np.ndarray
    of: np.ndarray


def _segments(y: np.ndarray, group: np.ndarray, n: int, epsilon: float | None) -> _Segments:
    if epsilon is None:
        value, of_group, top = np.where(y > 0.5, 1.0, -1.0), group, np.bincount(group[y > 0.5], minlength=n)
    else:
        value, of_group, top = np.concatenate([y - epsilon, y + epsilon]), np.concatenate([group, group]), np.bincount(group, minlength=n)
    order = np.lexsort((value, of_group))
    v, g = value[order], of_group[order]
    new = np.append(True, (v[1:] != v[:-1]) | (g[1:] != g[:-1]))
    of = np.empty(len(order), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    return _Segments(v[new], np.bincount(of).astype(np.float64), np.searchsorted(g[new], np.arange(n + 1)), top.astype(np.float64), of)


def _start(seg: _Segments) -> tuple[np.ndarray, np.ndarray]:
    """(segment, part of its width that is used) where every group's variable is 0."""
    ends = np.concatenate([[0.0], np.cumsum(seg.width)])
    target = ends[seg.first[:-1]] + seg.top
    at = np.clip(np.searchsorted(ends, target) - 1, seg.first[:-1], seg.first[1:] - 1)
    return at, target - ends[at]


def _sums(seg: _Segments, at: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The groups' variables, in units of C."""
    ends = np.concatenate([[0.0], np.cumsum(seg.width)])
    return seg.top - (ends[at] - ends[seg.first[:-1]]) - used


def smo_groups(k: _Rows, seg: _Segments, C: float, at: np.ndarray, used: np.ndarray, f: np.ndarray, tolerance: float = TOLERANCE, steps: int = 10_000_000) -> None:
    """Solve for ``at`` and ``used`` in place; ``f`` is kept equal to the kernel times the groups' variables (C ``_sums``)."""
    n, diag, value, width, first = len(f), k.diagonal(), seg.value, seg.width, seg.first
    up, low, room_up, room_low = np.empty(n), np.empty(n), np.empty(n), np.empty(n)

    def look(g: int) -> None:
        """The segments that g may move up and down in, and how far."""
        s, u = at[g], used[g]
        if u > 0:
            up[g], room_up[g] = value[s], u * C
        elif s > first[g]:
            up[g], room_up[g] = value[s - 1], width[s - 1] * C
        else:
            up[g], room_up[g] = -np.inf, 0.0
        if u < width[s]:
            low[g], room_low[g] = value[s], (width[s] - u) * C
        elif s + 1 < first[g + 1]:
            low[g], room_low[g] = value[s + 1], width[s + 1] * C
        else:
            low[g], room_low[g] = np.inf, 0.0

    def move(g: int, t: float) -> None:
        """``t`` > 0: up."""
        s, u = at[g], used[g]
        if t > 0 and u <= 0:
            s, u = s - 1, width[s - 1]
        elif t < 0 and u >= width[s]:
            s, u = s + 1, 0.0
        u -= t / C
        at[g], used[g] = s, 0.0 if u < 1e-12 else width[s] if u > width[s] - 1e-12 else u
        look(g)

    for g in range(n):
        look(g)
    e_up, e_low, gap, gain, curve = up - f, low - f, np.empty(n), np.empty(n), np.empty(n)
    for _ in range(steps):
        i = int(e_up.argmax())
        np.subtract(e_up[i], e_low, out=gap)
        if not gap.max() > tolerance:
            break
        ki = k[i]
        np.multiply(ki, -2.0, out=curve)
        curve += diag
        curve += diag[i]
        np.maximum(curve, 1e-12, out=curve)
        np.maximum(gap, 0.0, out=gain)
        gain *= gain
        gain /= curve
        j = int(gain.argmax())
        t = 0.0
        while (far := e_up[i] - e_low[j] - t * curve[j]) > 1e-12:  # through as many segments as pay
            part = min(far / curve[j], room_up[i], room_low[j])
            move(i, part)
            move(j, -part)
            t += part
            e_up[i], e_low[j] = up[i] - f[i], low[j] - f[j]
        step = (ki - k[j]) * np.float64(t)
        f += step
        e_up -= step
        e_low -= step
        for g in (i, j):
            e_up[g], e_low[g] = up[g] - f[g], low[g] - f[g]


def times(x: np.ndarray, vectors: np.ndarray, gamma: float | None, weights: np.ndarray) -> np.ndarray:
    """The kernel of ``x`` and ``vectors`` times ``weights``, in blocks."""
    step = max(1, (1 << 23) // max(1, len(vectors)))
    return np.concatenate([kernel(x[i:i + step], vectors, gamma) @ weights for i in range(0, len(x), step)] or [np.zeros((0, *weights.shape[1:]))])


def gap(f: np.ndarray, y: np.ndarray, sign: np.ndarray, p: np.ndarray, a: np.ndarray, b: float, m: Machine) -> tuple[float, float]:
    """(primal, dual) objective; their difference bounds the distance from the optimum."""
    norm = float(_weights(sign, a, len(f)) @ f)
    loss = np.maximum(0, 1 - np.where(y > 0.5, 1.0, -1.0) * (f + b)) if m.epsilon is None else np.maximum(0, np.abs(y - f - b) - m.epsilon)
    return norm / 2 + m.C * loss.sum(), -(norm / 2 + float(p @ a))


def solve_groups(x: np.ndarray, group: np.ndarray, y: np.ndarray, machines: list[Machine]) -> dict[Machine, tuple[np.ndarray, float, float, float]]:
    """{machine: (weights of the rows, bias, primal, dual)} for machines of one kernel, each from the one before; row r has the features ``x[group[r]]``."""
    k, out, before = _Rows(x, machines[0].gamma), {}, None
    for m in sorted(machines, key=lambda m: (-(m.epsilon or 0), m.C)):
        sign, p = _problem(y, m)
        if before is not None and before.epsilon == m.epsilon:
            # the same place in the segments at a larger C
            f = f * (m.C / before.C)
        else:
            seg = _segments(y, group, len(x), m.epsilon)
            at, used = _start(seg)
            f = np.zeros(len(x))
        smo_groups(k, seg, m.C, at, used, f)
        done = np.zeros(len(seg.width))  # used share of every segment
        done[np.arange(len(done)) < np.repeat(at, np.diff(seg.first))] = 1.0
        done[at] = used / seg.width[at]
        a = np.where(sign > 0, 1 - done[seg.of], done[seg.of]) * m.C
        f = times(x, x, m.gamma, m.C * _sums(seg, at, used))
        b = _bias(-np.tile(f[group], len(sign) // len(y)) - sign * p, sign, a, m.C)
        out[m] = (_weights(sign, a, len(y)), b, *gap(f[group], y, sign, p, a, b, m))
        before = m
    return out


def solve_path(x: np.ndarray, y: np.ndarray, machines: list[Machine]) -> dict[Machine, tuple[np.ndarray, float, float, float]]:
    """``solve_groups`` of rows with features ``x``, equal ones found here."""
    distinct, group = np.unique(x, axis=0, return_inverse=True)
    return solve_groups(distinct, group.ravel(), y, machines)


# --- grids ---------------------------------------------------------------------------------------

def fold_moments(df: DataFrame, features: list[str], folds: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """{fold: (mean, population std, share of features that vary)} of the rows outside each fold (-1: of all); a std of 0 counts as 1."""
    cols = [F.count(F.lit(1)).alias("n")] + [x for i, c in enumerate(features) for x in (F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"))]
    parts = {r["fold"]: (r["n"], np.array([r[f"m{i}"] for i in range(len(features))]), np.array([r[f"v{i}"] for i in range(len(features))]))
             for r in df.groupBy("fold").agg(*cols).collect()}  # one row a fold
    out = {}
    for fold in folds:
        use = [v for f, v in parts.items() if f != fold]
        n = sum(u[0] for u in use)
        mean = sum(u[0] * u[1] for u in use) / n
        var = sum(u[0] * (u[2] + (u[1] - mean) ** 2) for u in use) / n
        out[fold] = (mean, np.where(var > 1e-300, np.sqrt(var), 1.0), float((var > 1e-300).mean()))
    return out


def gamma_of(kind: str, kernel_name: str, features: int, varied: float) -> float | None:
    """The reference's gamma on standardised features, of which the share ``varied`` has variance 1; None for the linear kernel."""
    if kernel_name == "linear":
        return None
    if kind == "auto" or kind == "scale" and not varied:
        return 1.0 / features
    return 1.0 / (features * varied) if kind == "scale" else float(kind)


def out_of_fold(df: DataFrame, features: list[str], key: str, machines: list[Machine], folds: list[int], moments: dict,
                kernel_rows: int = KERNEL_ROWS) -> DataFrame:
    """(id, y, fold, machine, margin, gap): every row's margin from the machines that leave its fold out; ``df`` has y and fold.

    Linear machines share their passes.  RBF: for each fold and machine one
    task if the distinct feature rows are at most ``kernel_rows``, else one
    decomposition.
    """
    kind, flat = df.schema[key].dataType.simpleString(), "machine int, margin double, gap double"
    rows = df.select(F.col(key).alias("id"), "y", "fold", F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    linear, parts = [m for m in machines if m.gamma is None], []
    if linear:
        found = linear_machines(rows.select("x", "y", "fold"), len(features), linear, folds, moments)

        def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for (f, i), (w, b, primal, dual) in found.items():
                    part = pdf[pdf["fold"] == f]
                    if len(part):
                        x = (np.stack(part["x"].to_numpy()) - moments[f][0]) / moments[f][1]
                        yield part[["id", "y", "fold"]].assign(machine=machines.index(linear[i]), margin=x @ w + b, gap=(primal - dual) / max(abs(primal), 1e-12))
        parts.append(rows.mapInPandas(margins, f"id {kind}, y double, fold int, {flat}"))
    curved = [m for m in machines if m.gamma is not None]
    if curved and _in_a_task(rows, kernel_rows):
        parts.append(_curved(rows, curved, machines, folds, moments))
    else:
        for f in folds:
            for m in curved:
                vectors, b, primal, dual = fit(df.filter(F.col("fold") != f), features, m, *moments[f][:2], kernel_rows)
                margin = margin_of(vectors, b, m.gamma, *moments[f][:2])
                parts.append(rows.filter(F.col("fold") == f).select("id", "y", "fold", F.lit(machines.index(m)).alias("machine"), margin(F.col("x")).alias("margin"),
                                                                     F.lit((primal - dual) / max(abs(primal), 1e-12)).alias("gap")))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def margin_of(vectors: DataFrame, b: float, gamma: float | None, mean: np.ndarray, std: np.ndarray):
    """A column function over feature arrays: the machine's margin, in blocks against its support vectors."""
    got = vectors.collect()  # the support vectors: the model itself, shipped once
    x, w = np.array([r["x"] for r in got]).reshape(len(got), len(mean)), np.array([r["weight"] for r in got])
    shared = vectors.sparkSession.sparkContext.broadcast((x.T @ w if gamma is None else x, w))

    def margin(rows: pd.Series) -> pd.Series:
        x, w = shared.value
        z = (np.stack(rows.to_numpy()) - mean) / std
        if gamma is None:
            return pd.Series(z @ x + b)
        return pd.Series(times(z, x, gamma, w) + b)

    return F.pandas_udf(margin, "double")


def _in_a_task(rows: DataFrame, kernel_rows: int) -> bool:
    return rows.count() <= TASK_ROWS and rows.select("x").distinct().count() <= kernel_rows


def _curved(rows: DataFrame, curved: list[Machine], machines: list[Machine], folds: list[int], moments: dict) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    jobs = [(f, m) for f in folds for m in curved]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        fold, m = jobs[int(pdf["job"].iloc[0])]
        members = [m[0] for m in pdf["members"]]
        pdf = pdf.assign(first=[m["id"] for m in members]).sort_values("first")
        mean, std, _ = moments[fold]
        x = (np.stack(pdf["x"].to_numpy()) - mean) / std
        group = np.repeat(np.arange(len(pdf)), pdf["members"].map(len))
        ids, y, of = ([r[c] for m in pdf["members"] for r in m] for c in ("id", "y", "fold"))
        ids, y, held = pd.Series(ids), np.array(y, dtype=np.float64), np.array(of) == fold
        inside, own = np.unique(group[~held], return_inverse=True)
        asked, back = np.unique(group[held], return_inverse=True)
        w, b, primal, dual = solve_groups(x[inside], own, y[~held], [m])[m]
        margin = times(x[asked], x[inside], m.gamma, np.bincount(own, weights=w, minlength=len(inside)))[back] + b
        return pd.DataFrame({"id": ids[held].to_numpy(), "y": y[held], "fold": fold, "machine": machines.index(m), "margin": margin,
                             "gap": (primal - dual) / max(abs(primal), 1e-12)})

    # rows of equal features travel as one, at most TASK_ROWS in all; so many partitions that hardly two jobs share one
    groups = rows.groupBy("x").agg(F.sort_array(F.collect_list(F.struct("id", "y", "fold"))).alias("members"))
    groups = groups.withColumn("job", F.explode(F.sequence(F.lit(0), F.lit(len(jobs) - 1)))).repartition(16 * len(jobs), "job")
    return groups.groupBy("job").applyInPandas(fit, f"id {kind}, y double, fold int, machine int, margin double, gap double")


# --- linear machines in the primal ---------------------------------------------------------------

#: Duality gap, as a share of the primal objective, at which a linear machine is done.
LINEAR_GAP = 1e-4
#: Partitions whose sums of a pass are added on the driver; those of more are added by tasks.
PASS_PARTS = 64
STEPS = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001, 0.0)


def _rounded(z: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, z) with its corner rounded over ``width``, its slope and its curvature."""
    inside = (z > 0) & (z < width)
    return np.where(inside, z * z / (2 * width), np.maximum(z - width / 2, 0) * (z >= width)), np.clip(z / width, 0, 1), inside / width


def _losses(y: np.ndarray, f: np.ndarray, m: Machine, width: float | None):
    """(loss, d loss / d f, curvature, share of C in the dual variables' linear term) of each row; ``width`` None: the exact loss only."""
    if m.epsilon is None:
        s = np.where(y > 0.5, 1.0, -1.0)
        z = 1 - s * f
        if width is None:
            return np.maximum(z, 0)
        loss, slope, curve = _rounded(z, width)
        return loss, -s * slope, curve, slope
    r = y - f
    z = np.abs(r) - m.epsilon
    if width is None:
        return np.maximum(z, 0)
    loss, slope, curve = _rounded(z, width)
    g = np.sign(r) * slope
    return loss, -g, curve, y * g - m.epsilon * slope


def _dealt(rows: DataFrame, mean: np.ndarray, std: np.ndarray) -> DataFrame:
    """(y, fold, z), written once for all passes and dealt to all cores: z is the scaled row with a 1 behind, as bytes."""
    from decklens.session import cut_lineage

    def scaled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                z = np.column_stack([(np.stack(pdf["x"].to_numpy()) - mean) / std, np.ones(len(pdf))])
                yield pd.DataFrame({"y": pdf["y"], "fold": pdf["fold"], "z": [v.tobytes() for v in z]})

    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.select("x", "y", "fold")
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)
    return cut_lineage(rows.mapInPandas(scaled, "y double, fold int, z binary"))


def _pass(rows: DataFrame, d: int, work: dict, maps: dict, machines: list[Machine]) -> dict:
    """{(fold, machine): (losses at ``STEPS`` along the direction, sums at the full step)} of one pass over ``_dealt`` rows.

    ``work``: (point, direction or None, width) of the machines that still run;
    without a direction only the sums at the point count.  ``maps[fold]`` takes
    a point to the scale of the rows, and the sums are taken back.
    """
    jobs = sorted(work)
    point = np.column_stack([maps[f] @ work[f, i][0] for f, i in jobs])
    along = np.column_stack([np.zeros(d + 1) if work[f, i][1] is None else maps[f] @ work[f, i][1] for f, i in jobs])
    shared = rows.sparkSession.sparkContext.broadcast((jobs, point, along, [work[j][1] is not None for j in jobs], [work[j][2] for j in jobs]))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        jobs, point, along, moves, width = shared.value
        total = np.zeros((len(jobs), len(STEPS) + 4 + d + (d + 1) ** 2))
        for pdf in frames:
            if not len(pdf):
                continue
            y, fold, z = pdf["y"].to_numpy(), pdf["fold"].to_numpy(), np.frombuffer(b"".join(pdf["z"])).reshape(len(pdf), -1)
            for out in sorted({f for f, _ in jobs}):
                mine = [j for j, (f, _) in enumerate(jobs) if f == out]
                use = np.flatnonzero(fold != out)
                zu, yu = z[use], y[use]
                at, step = zu @ point[:, mine], zu @ along[:, mine]
                for c, j in enumerate(mine):
                    m = machines[jobs[j][1]]
                    tried = [_losses(yu, at[:, c] + t * step[:, c], m, width[j])[0].sum() for t in STEPS] if moves[j] else np.zeros(len(STEPS))
                    here = at[:, c] + step[:, c]
                    loss, slope, curve, dual = _losses(yu, here, m, width[j])
                    on = np.flatnonzero(curve)  # the rows on the rounded corner
                    zc = zu[on]
                    total[j] += np.concatenate([tried, [_losses(yu, here, m, None).sum(), loss.sum(), dual.sum()], zu.T @ slope, ((zc * curve[on][:, None]).T @ zc).ravel()])
        yield pd.DataFrame({"job": np.arange(len(jobs)), "v": [v.tobytes() for v in total]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"job": pdf["job"].iloc[:1], "v": [np.frombuffer(b"".join(pdf["v"])).reshape(len(pdf), -1).sum(axis=0).tobytes()]})

    parts, out = rows.mapInPandas(sums, "job int, v binary"), {}
    if rows.rdd.getNumPartitions() > PASS_PARTS:
        parts = parts.groupBy("job").applyInPandas(add, "job int, v binary")
    got: dict = {}
    for r in parts.collect():  # one row a machine and fold, of each of at most PASS_PARTS partitions
        got[r["job"]] = got.get(r["job"], 0) + np.frombuffer(r["v"])
    for j, v in got.items():
        f, tried, v = jobs[j][0], v[:len(STEPS)], v[len(STEPS):]
        out[jobs[j]] = tried, np.concatenate([v[:3], maps[f].T @ v[3:4 + d], (maps[f].T @ v[4 + d:].reshape(d + 1, d + 1) @ maps[f]).ravel()])
    return out


def linear_machines(rows: DataFrame, d: int, machines: list[Machine], folds: list[int], moments: dict) -> dict[tuple[int, int], tuple[np.ndarray, float, float, float]]:
    """{(fold, machine): (w, b, primal, dual)} on the rows (x, y, fold) outside each fold, on features scaled by ``moments``.

    A pass that tries steps also sums gradients and second moments at the full
    step, so that a pass of their own is needed only after a shorter one.
    """
    mean, std, _ = moments[folds[0]]
    maps = {}  # row scaled by the fold's own moments (with 1) = row of _dealt @ map
    for f in folds:
        maps[f] = np.zeros((d + 1, d + 1))
        maps[f][:d, :d] = np.diag(std / moments[f][1])
        maps[f][d, :d], maps[f][d, d] = (mean - moments[f][0]) / moments[f][1], 1.0
    rows = _dealt(rows, mean, std)
    spread = rows.agg(F.max(F.abs("y"))).first()[0] or 1.0
    point = {(f, i): np.zeros(d + 1) for f in folds for i in range(len(machines))}
    # so wide at first that every row is on the rounded part
    width, damp, out = {j: 8.0 if machines[j[1]].epsilon is None else 8.0 * spread for j in point}, dict.fromkeys(point, 0.0), {}
    ridge, found, ask = np.append(np.ones(d), 0.0), {}, {}
    while point:
        got = _pass(rows, d, {j: ask.get(j, (p, None, width[j])) for j, p in point.items()}, maps, machines)
        for j, (tried, sums) in got.items():
            if j not in ask:
                found[j] = sums
                continue
            p, direction, _ = ask.pop(j)
            value = [(p + t * direction)[:d] @ (p + t * direction)[:d] / 2 + machines[j[1]].C * loss for t, loss in zip(STEPS, tried)]
            best = int(np.argmin(value))
            if STEPS[best] == 0:
                damp[j] = max(1e-3, damp[j] * 100)  # the sums at the point still hold
                continue
            point[j], damp[j] = p + STEPS[best] * direction, damp[j] / 100 if damp[j] > 1e-2 else 0.0
            found.pop(j)
            if STEPS[best] == 1:
                found[j] = sums
        for j, v in list(found.items()):
            p, C = point[j], machines[j[1]].C
            grad = ridge * p + C * v[3:4 + d]
            hess = np.diag(ridge + damp[j]) + C * v[4 + d:].reshape(d + 1, d + 1)
            hess[d, d] += 1e-9 * (1 + C)
            # the slopes are dual variables, feasible once the bias's gradient is 0; their objective uses their own weights
            w_dual = -C * v[3:3 + d]
            primal, dual = p[:d] @ p[:d] / 2 + C * v[0], C * v[2] - w_dual @ w_dual / 2
            flat = np.abs(grad).max() <= 1e-7 * C * max(1.0, v[1]) or damp[j] > 1e12
            if flat and (primal - dual <= LINEAR_GAP * max(abs(primal), 1e-6) or width[j] < 1e-9):
                out[j] = (p[:d], float(p[d]), float(primal), float(dual))
                del point[j], found[j]
            elif flat:
                width[j], damp[j] = width[j] / 4, 0.0
                del found[j]
            else:
                ask[j] = (p, -np.linalg.solve(hess, grad), width[j])
    return out


# --- one machine on all rows ---------------------------------------------------------------------

def fit(df: DataFrame, features: list[str], m: Machine, mean: np.ndarray, std: np.ndarray, kernel_rows: int = KERNEL_ROWS, work_rows: int = WORK_ROWS) -> tuple[DataFrame, float, float, float]:
    """(support vectors (x scaled, weight; written), bias, primal, dual) of ``df`` with y."""
    if m.gamma is None:
        rows = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), "y", F.lit(0).alias("fold"))
        w, b, primal, dual = linear_machines(rows, len(features), [m], [-1], {-1: (mean, std, 1.0)})[-1, 0]
        # the weights as one vector
        return df.sparkSession.createDataFrame([(w.tolist(), 1.0)], "x array<double>, weight double"), b, primal, dual
    from decklens.session import cut_lineage
    z = F.array(*[(F.col(c).cast("double") - F.lit(float(a))) / F.lit(float(s)) for c, a, s in zip(features, mean, std)]).alias("x")
    rows = df.select(F.xxhash64(*features, "y").alias("h"), F.col("y").cast("double").alias("y"), z)
    if _in_a_task(rows, kernel_rows):
        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("h")
            x, y = np.stack(pdf["x"].to_numpy()), np.concatenate(pdf["y"].to_numpy())
            group = np.repeat(np.arange(len(pdf)), pdf["y"].map(len))
            w, b, primal, dual = solve_groups(x, group, y, [m])[m]
            w = np.bincount(group, weights=w, minlength=len(x))
            keep = w != 0
            tail = pd.DataFrame({"x": [[b, primal, dual]], "weight": [np.nan]})
            return pd.concat([pd.DataFrame({"x": list(x[keep]), "weight": w[keep]}), tail])

        rows = rows.groupBy("x").agg(F.min("h").alias("h"), F.sort_array(F.collect_list(F.coalesce("y", F.lit(float("nan"))))).alias("y"))
        # at most kernel_rows feature rows: one task
        got = cut_lineage(rows.groupBy(F.lit(0).alias("all")).applyInPandas(whole, "x array<double>, weight double"))
        b, primal, dual = got.filter("weight is null").first()["x"]
        return got.filter("weight is not null"), b, primal, dual
    return _decomposed(rows, m, work_rows)


def _decomposed(rows: DataFrame, m: Machine, work_rows: int) -> tuple[DataFrame, float, float, float]:
    from decklens.session import cut_lineage
    spark, svr = rows.sparkSession, m.epsilon is not None
    # variables up and down of a row: for classification the label's only
    state = cut_lineage(rows.select(F.monotonically_increasing_id().alias("uid"), "x", "y", F.lit(0.0).alias("a0"), F.lit(0.0).alias("a1"), F.lit(0.0).alias("f")))
    label = F.when(F.col("y") > 0.5, 1.0).otherwise(-1.0)

    def errors(df: DataFrame) -> DataFrame:
        """e_up, e_low: the largest error that may move up and the smallest that may move down, of each row."""
        if not svr:
            e = label - F.col("f")
            up = F.when(label > 0, F.col("a0") < m.C).otherwise(F.col("a0") > 0)
            low = F.when(label > 0, F.col("a0") > 0).otherwise(F.col("a0") < m.C)
            return df.withColumn("e_up", F.when(up, e)).withColumn("e_low", F.when(low, e))
        plus, minus = F.col("y") - m.epsilon - F.col("f"), F.col("y") + m.epsilon - F.col("f")
        return (df.withColumn("e_up", F.greatest(F.when(F.col("a0") < m.C, plus), F.when(F.col("a1") > 0, minus)))
                .withColumn("e_low", F.least(F.when(F.col("a0") > 0, plus), F.when(F.col("a1") < m.C, minus))))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames)).drop_duplicates("uid").sort_values("uid")
        if not len(pdf):
            return
        x, y = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()
        sign, p = _problem(y, m)
        a = np.concatenate([pdf["a0"], pdf["a1"]]) if svr else pdf["a0"].to_numpy().copy()
        before, f = _weights(sign, a, len(y)), pdf["f"].to_numpy().copy()
        smo(kernel(x, x, m.gamma), sign, p, m.C, a, f, TOLERANCE / 2)
        parts = a.reshape(-1, len(y))
        yield pd.DataFrame({"uid": pdf["uid"], "x": pdf["x"], "a0": parts[0], "a1": parts[-1] if svr else 0.0, "change": _weights(sign, a, len(y)) - before})

    for _ in range(MAX_TURNS):
        now = errors(state)
        top, bottom = now.agg(F.max("e_up"), F.min("e_low")).first()
        if top is None or bottom is None or top - bottom <= TOLERANCE:
            break
        half = work_rows // 2
        worst = (now.filter("e_up is not null").orderBy(F.desc("e_up"), "uid").limit(half)
                 .unionByName(now.filter("e_low is not null").orderBy("e_low", "uid").limit(half)))
        moved = worst.select("uid", "x", "y", "a0", "a1", "f").coalesce(1).mapInPandas(solve, "uid long, x array<double>, a0 double, a1 double, change double").collect()  # at most work_rows
        shared = spark.sparkContext.broadcast((np.array([r["uid"] for r in moved]), np.array([r["x"] for r in moved]), np.array([[r["a0"], r["a1"], r["change"]] for r in moved])))

        def update(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            uid, x, values = shared.value
            order = np.argsort(uid)
            some = values[:, 2] != 0
            for pdf in frames:
                if len(pdf) and some.any():
                    pdf["f"] += kernel(np.stack(pdf["x"].to_numpy()), x[some], m.gamma) @ values[some, 2]
                at = np.minimum(np.searchsorted(uid[order], pdf["uid"]), len(uid) - 1)
                hit = uid[order][at] == pdf["uid"].to_numpy()
                for c, name in enumerate(("a0", "a1")):
                    pdf.loc[hit, name] = values[order[at[hit]], c]
                yield pdf
        state = cut_lineage(state.mapInPandas(update, state.schema))
    sign_a = label * F.col("a0") if not svr else F.col("a0") - F.col("a1")
    e = label - F.col("f") if not svr else F.when((F.col("a0") > 0) & (F.col("a0") < m.C), F.col("y") - m.epsilon - F.col("f")).otherwise(F.col("y") + m.epsilon - F.col("f"))
    free = (F.col("a0") > 0) & (F.col("a0") < m.C) | (F.col("a1") > 0) & (F.col("a1") < m.C)
    b = state.filter(free).agg(F.avg(e)).first()[0]
    if b is None:
        top, bottom = errors(state).agg(F.max("e_up"), F.min("e_low")).first()
        b = ((top or 0.0) + (bottom or 0.0)) / 2
    out = F.col("f") + F.lit(b)
    loss = F.greatest(F.lit(0.0), 1 - label * out) if not svr else F.greatest(F.lit(0.0), F.abs(F.col("y") - out) - m.epsilon)
    linear = -F.col("a0") if not svr else F.col("a0") * (m.epsilon - F.col("y")) + F.col("a1") * (m.epsilon + F.col("y"))
    norm, lost, pa_ = state.agg(F.sum(sign_a * F.col("f")), F.sum(loss), F.sum(linear)).first()
    vectors = state.select("x", sign_a.alias("weight")).filter("weight != 0")
    return vectors, float(b), norm / 2 + m.C * lost, -(norm / 2 + pa_)


def sigmoid(oof: DataFrame, steps: int = 50) -> tuple[float, float]:
    """(A, B) of P(1 | margin) = 1 / (1 + exp(A margin + B)) by damped Newton steps on out-of-fold margins (y, margin).

    The targets are smoothed, (n1 + 1) / (n1 + 2) and 1 / (n0 + 2); every
    step is one aggregate.
    """
    n1, n = oof.agg(F.count_if(F.col("y") > 0.5), F.count(F.lit(1))).first()
    hi, lo = (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2)
    t = F.when(F.col("y") > 0.5, hi).otherwise(lo)

    def at(a: float, b: float):
        z = F.lit(a) * F.col("margin") + F.lit(b)
        p = 1 / (1 + F.exp(z))
        w, d = p * (1 - p), t - p
        loss = F.when(z >= 0, t * z + F.log1p(F.exp(-z))).otherwise((t - 1) * z + F.log1p(F.exp(z)))
        f = F.col("margin")
        return oof.agg(F.sum(loss), F.sum(f * d), F.sum(d), F.sum(f * f * w), F.sum(f * w), F.sum(w)).first()

    a, b = 0.0, float(np.log((n - n1 + 1) / (n1 + 1)))
    now = at(a, b)
    for _ in range(steps):
        loss, ga, gb, haa, hab, hbb = now
        if abs(ga) < 1e-5 and abs(gb) < 1e-5:
            break
        step = np.linalg.solve([[haa + 1e-12, hab], [hab, hbb + 1e-12]], [-ga, -gb])
        size = 1.0
        while size > 1e-10:
            new = at(a + size * step[0], b + size * step[1])
            if new[0] < loss + 1e-4 * size * (ga * step[0] + gb * step[1]):
                break
            size /= 2
        if size <= 1e-10:
            break
        a, b, now = a + size * step[0], b + size * step[1], new
    return a, b
