"""Exact nearest neighbours (H6): by blocks of all pairs, or by a pivot index.

All pairs (the default): equal queries are asked once and equal rows travel as
one, with the k smallest ids.  Both are dealt to blocks by a hash of the vector,
and a task holds the queries of one block with their k best while the rows of
another stream past.  One matrix product a batch finds the
few pairs that can be among the k best; their distances are taken by
differences.  Nothing is pruned
beforehand, so the work is queries times rows, in bounded memory, whatever the
dimension.

By a pivot index (``cell_rows`` given), for data that lies in clusters:

Each training row belongs to the cell of its nearest pivot and knows its
distance to it.  By the triangle inequality a row at distance r from the pivot
of a cell is at least |d(q, pivot) - r| from a query, so a cell whose rows have
r from ``near`` to ``far`` is at least max(d - far, near - d, 0) away.

Wave one searches every query's own cell: its k-th distance bounds the true
one.  Wave two sends the query to every other cell whose bound is not beyond
that, and there to the rows whose own bound is not.  A cell's rows meet in one
task (a cell of more than ``PART_ROWS`` rows in several), queries stream past
them, and each search returns at most k rows a query, so nothing is ranked but
the k best of a few cells.  Searches in several spaces (folds with scalers of
their own) run together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.session import cut_lineage

#: Rows a cell should have; the number of pivots of a space is bounded, what a cell has beyond ``PART_ROWS`` is split.
CELL_ROWS = 1024
MAX_PIVOTS = 4096
PART_ROWS = 32_768
#: Query-row pairs compared at once.
PAIRS = 1 << 18
#: All pairs: queries and rows of a block, pairs of a matrix product, blocks there should be to share out.  Queries
#: travel once for each block of rows and rows once for each block of queries, so blocks are as large as memory allows.
BLOCK_QUERIES, BLOCK_ROWS, BLOCK_PAIRS, BLOCKS = 262_144, 262_144, 1 << 21, 96
#: Vectors of the queries that a task holds.
BLOCK_BYTES = 64 << 20
#: Queries whose answers leave a task at a time.
ANSWERS = 4096


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences, so that equal vectors are at 0 and equal distances tie."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        out += (a[:, [i]] - b[None, :, i]) ** 2
    return np.sqrt(out)


def _rows(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def index(train: DataFrame, cell_rows: int = CELL_ROWS, seed: int = 42) -> tuple[DataFrame, dict]:
    """(rows with cell, part and r, written; {space: (pivots, near, far, rows, parts)}) of ``train`` (space, id, x, label)."""
    counts = {r["space"]: r["n"] for r in train.groupBy("space").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a space
    wanted = {s: min(MAX_PIVOTS, n // cell_rows + 1) for s, n in counts.items()}
    share = max((min(1.0, (4 * wanted[s] + 20) / n) for s, n in counts.items()), default=1.0)
    some: dict = {s: [] for s in counts}
    for r in train.select("space", "x").sample(share, seed=seed).collect():  # a bounded sample
        some[r["space"]].append(r["x"])
    pivots = {}
    for s, n in counts.items():
        got = np.array(some[s], dtype=np.float64)
        if not len(got):
            got = np.array([train.filter(F.col("space") == s).first()["x"]], dtype=np.float64)
        # spread out: the next pivot is the sampled row farthest from those taken
        take, dist = [0], _distances(got, got[:1])[:, 0]
        while len(take) < min(wanted[s], len(got)) and dist.max() > 0:
            take.append(int(dist.argmax()))
            dist = np.minimum(dist, _distances(got, got[take[-1:]])[:, 0])
        pivots[s] = got[take]
    shared = train.sparkSession.sparkContext.broadcast(pivots)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for s, part in pdf.groupby("space"):
                x, at = _rows(part["x"]), np.empty(len(part), dtype=np.int64)
                r = np.empty(len(part))
                step = max(1, PAIRS // len(shared.value[s]))
                for lo in range(0, len(x), step):
                    d = _distances(x[lo:lo + step], shared.value[s])
                    at[lo:lo + step], r[lo:lo + step] = d.argmin(axis=1), d.min(axis=1)
                yield part.assign(cell=at, r=r)

    kind = train.schema["id"].dataType.simpleString()
    rows = train.select("space", "id", "x", "label").mapInPandas(assign, f"space int, id {kind}, x array<double>, label double, cell long, r double")
    rows = cut_lineage(rows)
    stats: dict = {s: (pivots[s], np.full(len(pivots[s]), np.inf), np.full(len(pivots[s]), -np.inf), np.zeros(len(pivots[s]), dtype=np.int64)) for s in counts}
    for r in rows.groupBy("space", "cell").agg(F.min("r").alias("near"), F.max("r").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # one row a cell
        _, near, far, n = stats[r["space"]]
        near[r["cell"]], far[r["cell"]], n[r["cell"]] = r["near"], r["far"], r["n"]
    parts = {s: -(-v[3] // PART_ROWS) for s, v in stats.items()}
    by_cell = F.create_map(*[x for s in stats for x in (F.lit(s), F.array(*[F.lit(int(p)) for p in parts[s]]))])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.element_at(by_cell[F.col("space")], (F.col("cell") + 1).cast("int"))).cast("int"))
    return rows, {s: (*v, parts[s]) for s, v in stats.items()}


def _search(rows: DataFrame, asked: DataFrame, k: int, tasks: int) -> DataFrame:
    """(space, qid, found): the best k of each (cell, part) for the queries dealt to it (space, cell, part, qid, x, d, bound)."""
    kind, qkind = rows.schema["id"].dataType.simpleString(), asked.schema["qid"].dataType.simpleString()
    members = rows.select("space", "cell", "part", F.lit(0).alias("kind"), F.col("id"), F.lit(None).cast(qkind).alias("qid"), "x", "label", F.col("r").alias("d"), F.lit(0.0).alias("bound"))
    queries = asked.select("space", "cell", "part", F.lit(1).alias("kind"), F.lit(None).cast(kind).alias("id"), "qid", "x", F.lit(0.0).alias("label"), "d", "bound")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, ready = None, [], None
        for pdf in frames:
            for key, part in pdf.groupby(["space", "cell", "part", "kind"], sort=True):
                if key[:3] != at:
                    at, held, ready = key[:3], [], None
                if key[3] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if ready is None:
                    mine = pd.concat(held).sort_values(["d", "id"])
                    ready = (_rows(mine["x"]), mine["id"].to_numpy(), mine["label"].to_numpy(), mine["d"].to_numpy())
                x, ids, labels, r = ready
                q, d, bound = _rows(part["x"]), part["d"].to_numpy(), part["bound"].to_numpy()
                step = max(1, PAIRS // len(x))
                order = np.argsort(d, kind="stable")
                out = []
                for lo in range(0, len(q), step):
                    some = order[lo:lo + step]
                    # rows whose own bound |d - r| is within reach of one of these queries
                    a = np.searchsorted(r, (d[some] - bound[some]).min() * (1 - 1e-12) - 1e-12, "left")
                    b = np.searchsorted(r, (d[some] + bound[some]).max() * (1 + 1e-12) + 1e-12, "right")
                    if a >= b:
                        continue
                    dist = _distances(q[some], x[a:b])
                    for row, i in zip(dist, some):
                        near = np.flatnonzero(row <= bound[i] * (1 + 1e-12))
                        if len(near) > k:
                            near = near[row[near] <= np.partition(row[near], k - 1)[k - 1]]
                        best = sorted(zip(row[near], ids[a:b][near], labels[a:b][near]))[:k]
                        if best:
                            out.append((key[0], part["qid"].iloc[i], [{"dist": u, "id": v, "label": w} for u, v, w in best], int(b - a)))
                if out:
                    yield pd.DataFrame(out, columns=["space", "qid", "found", "compared"])

    both = members.unionByName(queries).repartition(tasks, "space", "cell", "part").sortWithinPartitions("space", "cell", "part", "kind")
    return both.mapInPandas(run, f"space int, qid {qkind}, found array<struct<dist:double,id:{kind},label:double>>, compared long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """(space, qid, found, compared) with the k best of all parts of a query's answer; at most k rows from each cell."""
    return (found.groupBy("space", "qid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found"), F.sum("compared").alias("compared")))


class _Best:
    """The k best rows of each distinct query of a block."""

    def __init__(self, x: np.ndarray, k: int):
        _, first, self.of = np.unique(_whole(x), return_index=True, return_inverse=True)
        self.x, self.k = x[first], k
        self.norm = (self.x * self.x).sum(axis=1)
        self.dist, self.label, self.ids = np.full((len(first), k), np.inf), np.zeros((len(first), k)), None
        self.rows = 0

    def add(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.rows += len(x)
        if self.ids is None:
            self.ids = np.empty(self.dist.shape, dtype=ids.dtype)
        # of equal rows only the k smallest ids can be among the k best
        _, first, same = np.unique(_whole(x), return_index=True, return_inverse=True)
        order = np.lexsort((_ranks(ids), same))
        order = order[_places(same[order]) < self.k]
        members, x = np.bincount(same[order]), x[first]
        start = np.cumsum(members) - members
        ids, labels, norm = ids[order], labels[order], (x * x).sum(axis=1)
        step = max(1, BLOCK_PAIRS // len(x))
        for lo in range(0, len(self.x), step):
            q, qn, worst = self.x[lo:lo + step], self.norm[lo:lo + step], self.dist[lo:lo + step, -1]
            near = qn[:, None] + norm[None] - 2 * (q @ x.T)
            slack = 1e-10 * (qn + norm.max())
            limit = worst * worst * (1 + 1e-9) + slack
            fresh = np.flatnonzero(np.isinf(worst))
            if len(fresh) and len(x) > self.k:
                limit[fresh] = np.partition(near[fresh], self.k - 1, axis=1)[:, self.k - 1] + 2 * slack[fresh]
            i, j = np.nonzero(near <= limit[:, None])
            dist = np.zeros(len(i))
            for c in range(x.shape[1]):
                dist += (q[i, c] - x[j, c]) ** 2
            dist = np.sqrt(dist)
            keep = dist <= worst[i]
            i, j, dist = i[keep], j[keep], dist[keep]
            if len(i):
                copies = members[j]
                at = np.repeat(start[j] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
                self._merge(lo + np.repeat(i, copies), np.repeat(dist, copies), ids[at], labels[at])

    def _merge(self, query: np.ndarray, dist: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        old, place = np.nonzero(np.isfinite(self.dist[(mine := np.unique(query))]))
        old = mine[old]
        query, dist = np.concatenate([old, query]), np.concatenate([self.dist[old, place], dist])
        ids, labels = np.concatenate([self.ids[old, place], ids]), np.concatenate([self.label[old, place], labels])
        order = np.lexsort((_ranks(ids), dist, query))
        nth = _places(query[order])
        order, nth = order[nth < self.k], nth[nth < self.k]
        at = (query[order], nth)
        self.dist[at], self.ids[at], self.label[at] = dist[order], ids[order], labels[order]

    def found(self, which: np.ndarray, kind: pa.DataType) -> pa.Array:
        """The k best of the queries ``which``, as they were given."""
        mine = self.of[which]
        some = np.isfinite(self.dist[mine])
        best = pa.StructArray.from_arrays([pa.array(self.dist[mine][some]), pa.array(self.ids[mine][some], kind), pa.array(self.label[mine][some])], ["dist", "id", "label"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some.sum(axis=1))]), pa.int32()), best)


def _whole(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, 8 * x.shape[1]))).ravel()


def _ranks(ids: np.ndarray) -> np.ndarray:
    return pd.factorize(ids, sort=True)[0] if ids.dtype == object else ids


def _places(groups: np.ndarray) -> np.ndarray:
    """The place of each element in its run of equal values."""
    first = np.concatenate([[True], groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, dtype=bool)
    return np.arange(len(groups)) - np.maximum.accumulate(np.where(first, np.arange(len(groups)), 0))


def _vectors(column: pa.Array) -> np.ndarray:
    length = column.value_lengths().to_numpy(zero_copy_only=False)
    if (length != length[:1]).any():
        raise ValueError("a vector is null or has another length than the others")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest_groups(train: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(space, uid, found, compared) of ``asked`` (space, uid, x) by blocks of all pairs: each task a block of queries and a block of rows.

    ``train`` (space, x, n, ids, labels): ``n`` equal rows, at least the k of
    smallest id among them by id.  Read more than once, so both are best written.
    """
    spark = train.sparkSession
    kind = train.schema["ids"].dataType.elementType.simpleString()
    most, spaces, width = train.groupBy("space").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).agg(F.max("n"), F.count(F.lit(1)), F.max("d")).first()
    queries = asked.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    most = most or 0
    q_parts = max(1, -(-queries // max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * max(width or 1, 1))))))
    t_parts = max(1, -(-most // BLOCK_ROWS), min(-(-BLOCKS // (q_parts * max(spaces, 1))), most // 4096))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1000, q_parts * t_parts * max(spaces, 1)))

    def part(n, x):
        return F.pmod(F.xxhash64(x), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none = F.array().cast(f"array<{kind}>"), F.array().cast("array<double>")
    asks = asked.select("space", part(q_parts, "x").alias("q_part"), every(t_parts).alias("t_part"), F.lit(0).alias("kind"), F.col("uid").cast("long").alias("uid"), "x", none[0].alias("ids"), none[1].alias("labels"))
    rows = train.select("space", every(q_parts).alias("q_part"), part(t_parts, "x").alias("t_part"), F.lit(1).alias("kind"), F.col("n").cast("long").alias("uid"), "x", "ids", "labels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, best, ids_kind = None, [], None, None

        def answer():
            uid = np.concatenate([u for u, _ in held])
            for lo in range(0, len(uid), ANSWERS):
                which = np.arange(lo, min(lo + ANSWERS, len(uid)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), at[0]), pa.int32()), pa.array(uid[which]), best.found(which, ids_kind), pa.array(np.full(len(which), best.rows))],
                                                 ["space", "uid", "found", "compared"])

        for b in batches:
            keys, ids_kind = np.column_stack([b.column(i).to_numpy() for i in range(4)]), b.column("ids").type.value_type
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                key, some = tuple(keys[lo].tolist()), b.slice(lo, hi - lo)
                if key[:3] != at:
                    if best is not None:
                        yield from answer()
                    at, held, best = key[:3], [], None
                uid, x = some.column("uid").to_numpy(), _vectors(some.column("x"))
                if key[3] == 0:
                    held.append((uid, x))
                elif held:
                    best = best or _Best(np.concatenate([v for _, v in held]), k)
                    ids, labels = some.column("ids"), some.column("labels")
                    copies = ids.value_lengths().to_numpy(zero_copy_only=False)
                    best.add(np.repeat(x, copies, axis=0), ids.flatten().to_numpy(zero_copy_only=False), labels.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                    best.rows += int(uid.sum() - copies.sum())
        if best is not None:
            yield from answer()

    both = asks.unionByName(rows).repartition(tasks, "space", "q_part", "t_part").sortWithinPartitions("space", "q_part", "t_part", "kind", F.xxhash64("x"))
    found = both.mapInArrow(run, f"space int, uid long, found array<struct<dist:double,id:{kind},label:double>>, compared long")
    return _best(found.withColumnRenamed("uid", "qid"), k).withColumnRenamed("qid", "uid")


def _all_pairs(train: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(space, qid, found, compared): equal queries are asked once, equal rows compared as one."""
    members = F.slice(F.array_sort(F.collect_list(F.struct("id", F.col("label").cast("double").alias("label")))), 1, k)
    rows = train.groupBy("space", "x").agg(F.count(F.lit(1)).alias("n"), members.alias("m"))
    rows = cut_lineage(rows.select("space", "x", "n", F.col("m.id").alias("ids"), F.col("m.label").alias("labels")))
    asked = cut_lineage(queries.groupBy("space", "x").agg(F.collect_list(F.struct("qid")).alias("qids")).withColumn("uid", F.monotonically_increasing_id()))
    found = nearest_groups(rows, asked, k)
    return _best(asked.select("uid", F.explode("qids.qid").alias("qid")).join(found, "uid").select("space", "qid", "found", "compared"), k)


def nearest(train: DataFrame, queries: DataFrame, k: int, cell_rows: int | None = None) -> DataFrame:
    """(space, qid, found, compared): the k rows of ``train`` (space, id, x, label) nearest to each query (space, qid, x) of its space.

    ``found``: (dist, id, label), nearest first, equal distances by id; fewer
    if the space has fewer rows.  ``compared``: rows the query was compared
    with.  Vectors hold no nulls.  ``cell_rows``: rows of a cell of the pivot
    index; None compares all pairs by blocks.
    """
    if cell_rows is None:
        return _all_pairs(train, queries, k)
    spark = train.sparkSession
    rows, stats = index(train, cell_rows)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(stats)
    qkind = queries.schema["qid"].dataType.simpleString()
    schema = f"space int, qid {qkind}, x array<double>, cell long, d double, bound double"

    def dealt(df: DataFrame) -> DataFrame:
        by_cell = F.create_map(*[x for s in stats for x in (F.lit(s), F.array(*[F.lit(int(p)) for p in stats[s][4]]))])
        return df.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(by_cell[F.col("space")], (F.col("cell") + 1).cast("int")) - 1)))

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with its nearest cell that has rows, and a first bound from the cells' radii."""
        for pdf in frames:
            for s, part in pdf.groupby("space"):
                if s not in shared.value:
                    continue
                pivots, _, far, n, _ = shared.value[s]
                x = _rows(part["x"])
                d = _distances(x, pivots)
                reach = np.where(n > 0, d + far, np.inf)
                order = np.argsort(reach, axis=1)
                enough = (np.cumsum(n[order], axis=1) >= k).argmax(axis=1)
                most = np.take_along_axis(reach, order, axis=1)[np.arange(len(x)), enough]
                most = np.where(n.sum() >= k, most, np.inf)
                at = np.where(n > 0, d, np.inf).argmin(axis=1)
                yield pd.DataFrame({"space": s, "qid": part["qid"], "x": part["x"], "cell": at, "d": d[np.arange(len(x)), at], "bound": most})

    first = cut_lineage(_best(_search(rows, dealt(queries.select("space", "qid", "x").mapInPandas(own, schema)), k, tasks), k))
    reach = first.select("space", "qid", F.when(F.size("found") >= k, F.element_at("found", -1)["dist"]).alias("bound"))

    def others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with every other cell that may hold a nearer row."""
        for pdf in frames:
            for s, part in pdf.groupby("space"):
                if s not in shared.value:
                    continue
                pivots, near, far, n, _ = shared.value[s]
                x, bound = _rows(part["x"]), part["bound"].to_numpy(dtype=np.float64)
                d = _distances(x, pivots)
                at = np.where(n > 0, d, np.inf).argmin(axis=1)
                low = np.maximum(np.maximum(d - far, near - d), 0)
                limit = np.where(np.isnan(bound), np.inf, bound)
                i, c = np.nonzero((n > 0) & (low <= limit[:, None] * (1 + 1e-12)) & (np.arange(len(n)) != at[:, None]))
                yield pd.DataFrame({"space": s, "qid": part["qid"].to_numpy()[i], "x": part["x"].to_numpy()[i], "cell": c, "d": d[i, c], "bound": limit[i]})

    ask = queries.select("space", "qid", "x").join(reach, ["space", "qid"], "left")
    second = _search(rows, dealt(ask.mapInPandas(others, schema)), k, tasks)
    return _best(first.unionByName(second), k)


def votes(found, k: int, weights: str):
    """P(1): the mean label of the k nearest, by inverse distance with ``distance`` (rows at distance 0 outvote all others)."""
    near = F.slice(found, 1, k)
    if weights == "uniform":
        return F.aggregate(near, F.lit(0.0), lambda a, r: a + r["label"]) / F.size(near)
    zero = F.exists(near, lambda r: r["dist"] == 0)
    w = lambda r: F.when(zero, (r["dist"] == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), r["dist"]))
    return F.aggregate(near, F.lit(0.0), lambda a, r: a + w(r) * r["label"]) / F.aggregate(near, F.lit(0.0), lambda a, r: a + w(r))
