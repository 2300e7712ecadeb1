"""Profiling and reporting operators.

All of them are aggregates with a fixed-size output (one row per column,
bin, grid point or pair), computed with partial aggregation; the driver sees
only cuts, counts and a bounded number of sorted rows of ``describe``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketches that cut ranges of values, and the rows of a range that is sorted.
SKETCH, PICK = 10_000, 10_000


def shape(df: DataFrame, table: str) -> DataFrame:
    """Table, n_rows, n_cols."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order`` (a table has no order of its own)."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def target_profile(df: DataFrame, targets: list[str]) -> DataFrame:
    """count and share of every value of each target; the share of value 1 is the positive share."""
    total = df.agg(F.count(F.lit(1))).scalar()
    each = df.select(F.explode(F.array(*[F.struct(F.lit(t).alias("column"), F.col(t).cast("string").alias("value")) for t in targets])).alias("e"))
    counts = each.groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("column", "value", "n", (F.col("n") / total).alias("share"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, count and share of rows (the total is a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    vc = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return vc.select(F.lit(column).alias("column"), "value", "n", (F.col("n") / total).alias("share"))


def null_fraction(df: DataFrame, top: int | None = 10) -> DataFrame:
    """F8: fraction of NULLs per column, largest first (ties by name)."""
    agg = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "null_fraction")
    if top:
        long = long.orderBy(F.desc("null_fraction"), "column").limit(top)
    return long


def column_info(df: DataFrame) -> DataFrame:
    """column, Spark type, non-NULL count."""
    agg = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")
    return long.join(F.broadcast(types), "column")


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], sizes: dict[str, int] | None = None,
                     sketch: int = SKETCH, pick: int = PICK) -> dict[tuple[str, int], float]:
    """exact values at the 0-based ranks ``wanted`` of each (double) column, NULLs left out.

    Ranks lie in open ranges of values, at first one range a column.  While a
    range holds more than ``pick`` rows, a quantile sketch proposes two cuts
    around each of its ranks and one counting pass tells which part holds it:
    about 6 / ``sketch`` of the rows are left each time, whatever the
    distribution, and a value that many rows share becomes a cut and answers
    by its count.  What is left is sorted.  All columns share their passes;
    state is a sketch or ``pick`` rows for each range.  ``sizes``: the
    numbers of values that are not NULL, counted if absent.
    """
    sizes = sizes or df.agg(*[F.count(c).alias(c) for c in wanted]).first().asDict()
    # (column, low, high, values before it, values in it) -> its ranks
    ranges = {(c, None, None, 0, sizes[c]): {r for r in ranks if 0 <= r < sizes[c]} for c, ranks in wanted.items()}
    ranges, found = {k: ranks for k, ranks in ranges.items() if ranks}, {}

    def inside(c, lo, hi):
        x = F.col(c)
        return x.isNotNull() & (F.lit(True) if lo is None else x > F.lit(lo)) & (F.lit(True) if hi is None else x < F.lit(hi))

    while ranges:
        aggs = []
        for (c, lo, hi, below, n), ranks in ranges.items():
            x = F.when(inside(c, lo, hi), F.col(c))
            near = sorted({min(1.0, max(0.0, (r - below) / n + d)) for r in ranks for d in (-2 / sketch, 2 / sketch)})
            aggs.append(F.array_sort(F.collect_list(x)) if n <= pick else F.percentile_approx(x, near, sketch))
        got, counts = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first(), []
        for i, ((c, lo, hi, below, n), ranks) in enumerate(ranges.items()):
            if n <= pick:
                found |= {(c, r): got[i][r - below] for r in ranks}
            else:
                for j, cut in enumerate(sorted(set(got[i]))):
                    ok = inside(c, lo, hi)
                    counts += [F.count_if(ok & (F.col(c) < F.lit(cut))).alias(f"l{i}_{j}"), F.count_if(ok & (F.col(c) == F.lit(cut))).alias(f"e{i}_{j}")]
        sizes_, left = df.agg(*counts).first() if counts else None, {}
        for i, ((c, lo, hi, below, n), ranks) in enumerate(ranges.items()):
            if n <= pick:
                continue
            at, start = lo, below  # the open part before the next cut begins behind ``at``, at rank ``start``
            parts = [(cut, below + sizes_[f"l{i}_{j}"], sizes_[f"e{i}_{j}"]) for j, cut in enumerate(sorted(set(got[i])))]
            for cut, first, equal in parts + [(hi, below + n, 0)]:
                for r in ranks:
                    if start <= r < first:
                        left.setdefault((c, at, cut, start, first - start), set()).add(r)
                    elif first <= r < first + equal:
                        found[c, r] = cut
                at, start = cut, first + equal
        ranges = left
    return found


def describe(df: DataFrame, columns: list[str], exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 %, max per column.

    ``exact`` quartiles interpolate linearly (as pandas) between order
    statistics, found by a few counting passes with bounded state;
    ``exact=False`` takes them from one ``percentile_approx``."""
    quartiles = (0.25, 0.5, 0.75)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    aggs = []
    for c in columns:
        x = F.col(c)
        q = F.array(*[F.lit(None).cast("double")] * 3) if exact else F.percentile_approx(x, list(quartiles), accuracy)
        aggs.append(F.struct(
            F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), q.alias("q"), F.max(x).alias("max")).alias(c))
    wide = d.agg(*aggs).first()
    at = {c: [p * (wide[c]["count"] - 1) for p in quartiles] if wide[c]["count"] else [] for c in columns}
    ranks = {c: {r for x in at[c] for r in (math.floor(x), math.ceil(x))} for c in columns}
    stats = order_statistics(d, ranks, {c: wide[c]["count"] for c in columns}) if exact else {}
    rows = []
    for c in columns:
        w, q = wide[c], list(wide[c]["q"] or [None] * 3)
        if exact and at[c]:
            q = [stats[c, math.floor(x)] + (stats[c, math.ceil(x)] - stats[c, math.floor(x)]) * (x - math.floor(x)) if x % 1 else stats[c, int(x)] for x in at[c]]
        rows.append((c, w["count"], w["mean"], w["std"], w["min"], *q, w["max"]))
    return df.sparkSession.createDataFrame(rows, "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double")


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """equal-width bins between min and max; the maximum goes into the
    last bin (width_bucket alone would give it bin ``bins + 1``).  min/max are
    scalar subqueries (one aggregate pass), the counts a grouped aggregate."""
    x = F.col(column).cast("double")
    lo, hi = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins)))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = (hi - lo) / bins
    return counts.select("bin", (lo + (F.col("bin") - 1) * w).alias("bin_lo"),
                         (lo + F.col("bin") * w).alias("bin_hi"), "n")


def kde(df: DataFrame, column: str, grid: int = 100, terms: int = 16) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max],
    Scott's bandwidth h (n^-1/5 * sample std).

    Values are grouped into boxes of side h / sqrt(2), each reduced to
    ``terms`` moments about its centre (one aggregate with partial sums).  A
    grid point adds up each box's Hermite series.  With w = sqrt(2) h, u = (v - centre) / w
    and t = (x - centre) / w, exp(-(t - u)^2) = sum of u^k / k! h_k(t), where
    |u| <= 1/4 and |h_k(t)| < 1.09 sqrt(2^k k!); cut after 16 terms, the kernel
    of a value is off by less than 2e-14.  The rows per grid point are the
    occupied boxes, not the values.  A column without spread has NULL density.
    """
    x = F.col(column).cast("double")
    n = df.agg(F.count(x).cast("double")).scalar()
    sd = df.agg(F.stddev_samp(x)).scalar()
    lo, hi = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    h = F.nullif(sd * F.pow(n, F.lit(-0.2)), F.lit(0.0))
    vals = df.where(x.isNotNull()).select(x.alias("v"), F.floor((x - lo) / (h / math.sqrt(2))).alias("box"))
    centre = lo + (F.col("box") + 0.5) * (h / math.sqrt(2))
    vals = vals.select("box", ((F.col("v") - centre) / (h * math.sqrt(2))).alias("u"))
    boxes = vals.groupBy("box").agg(*[(F.sum(F.pow("u", F.lit(float(k)))) / math.factorial(k)).alias(f"a{k}") for k in range(terms)])
    pts = boxes.select("box", F.array(*[f"a{k}" for k in range(terms)]).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    gx = lo + (hi - lo) * F.col("g") / (grid - 1)
    pts = pts.select("g", "a", ((gx - centre) / (h * math.sqrt(2))).alias("t"))

    def state(k, now, before, total):
        return F.struct(k.alias("k"), now.alias("now"), before.alias("before"), total.alias("total"))

    # h_0 = exp(-t^2), h_(k+1) = 2 t h_k - 2 k h_(k-1)
    series = F.aggregate("a", state(F.lit(0.0), F.exp(-F.col("t") * F.col("t")), F.lit(0.0), F.lit(0.0)),
                         lambda s, c: state(s.k + 1, 2 * F.col("t") * s.now - 2 * s.k * s.before, s.now, s.total + c * s.now),
                         lambda s: s.total)
    return (pts.groupBy("g").agg(F.sum(series).alias("s"))
            .select("g", (lo + (hi - lo) * F.col("g") / (grid - 1)).alias("x"),
                    (F.col("s") / (n * h * math.sqrt(2 * math.pi))).alias("density")))


def row_sample(df: DataFrame, key: str, k: int, seed: int = 42, purpose: str = "pairs") -> DataFrame:
    """The ``k`` rows with the smallest keyed hashes: a bounded sample that does
    not depend on partitioning.  Every task keeps its ``k`` smallest rows and
    these are merged (a top-k, no sort of the table); NULL keys come last."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{purpose}-{seed}")))
    return df.orderBy(h.asc_nulls_last(), F.asc_nulls_last(key)).limit(k)


def pair_sample(df: DataFrame, columns: list[str], key: str, k: int = 500, seed: int = 42) -> DataFrame:
    """scatter data of every column pair over ``k`` sampled rows: key, feature_a, feature_b, a, b."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    rows = row_sample(df.select(key, *columns), key, k, seed)
    cells = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")) for a, b in pairs]
    return rows.select(key, F.explode(F.array(*cells)).alias("p")).select(key, "p.*")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL values of each column, one grouping a column.

    Several ``count(DISTINCT)`` in one aggregate would copy every row once a
    column; here each column's values are reduced where they are read."""
    parts = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct") for c in columns]
    return reduce(DataFrame.unionByName, parts)


def correlation(a: str, b: str) -> Column:
    """Pearson correlation as an aggregate, as SQL's corr: NaN if a column does not vary (Spark's own ``corr`` divides by zero there), NULL without rows."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    flat = (F.var_pop(x) == 0) | (F.var_pop(y) == 0)
    return F.when(F.count(x) > 0, F.when(flat, F.lit(float("nan"))).otherwise(F.covar_pop(x, y) / F.stddev_pop(x) / F.stddev_pop(y)))


def pairwise_corr(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    agg = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = agg.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", "\\|")[0].alias("feature_a"),
                       F.split("pair", "\\|")[1].alias("feature_b"), "corr")


def unpivot_metrics(df: DataFrame, id_col: str, metrics: list[str]) -> DataFrame:
    """F2: wide metrics -> (id, metric, score)."""
    return df.unpivot([id_col], metrics, "metric", "score")


def rank_rows(df: DataFrame, by: str, tie: str, ascending: bool = False) -> DataFrame:
    """order by ``by`` (NULLs last) with a tie-break; adds a 1-based rank.

    Meant for small result tables (one row per model)."""
    o = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.withColumn("rank", F.row_number().over(Window.orderBy(o, F.asc(tie))))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """the k first rows by ``by`` descending (TakeOrderedAndProject)."""
    return df.orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(k)
