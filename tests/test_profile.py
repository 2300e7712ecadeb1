"""Profiling operators against brute force on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from decklens.operators import profile as P


@pytest.fixture(scope="module")
def vals(spark):
    xs = [float((i * 7) % 23) + (0.5 if i % 5 == 0 else 0.0) for i in range(200)]
    return xs, spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")


def test_histogram_puts_max_in_last_bin(vals):
    xs, df = vals
    got = {r.bin: r.n for r in P.histogram(df, "x", 15).collect()}
    lo, hi = min(xs), max(xs)
    want = {}
    for x in xs:
        b = min(int(15 * (x - lo) / (hi - lo)) + 1, 15)
        want[b] = want.get(b, 0) + 1
    assert got == want and sum(got.values()) == len(xs)


def test_kde_matches_direct_sum(vals):
    xs, df = vals
    n = len(xs)
    mean = sum(xs) / n
    sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1))
    h = sd * n ** -0.2
    lo, hi = min(xs), max(xs)
    got = {r.g: r.density for r in P.kde(df, "x", 11).collect()}
    for g in range(11):
        gx = lo + (hi - lo) * g / 10
        want = sum(math.exp(-0.5 * ((gx - x) / h) ** 2) for x in xs) / (n * h * math.sqrt(2 * math.pi))
        assert got[g] == pytest.approx(want, rel=1e-9)


def test_describe_quartiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "x double")
    r = P.describe(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"]) == (4, 2.5, 1.0, 4.0)
    assert (r.p25, r.p50, r.p75) == (1.75, 2.5, 3.25)
    assert r["std"] == pytest.approx(math.sqrt(5 / 3))


def test_null_fraction_and_value_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2), ("b", None)], "s string, v int")
    nf = {r.column: r.null_fraction for r in P.null_fraction(df).collect()}
    assert nf == {"s": 0.25, "v": 0.5}
    vc = {r.value: (r.n, r.share) for r in P.value_counts(df, "s").collect()}
    assert vc == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}


def test_pairwise_corr_symmetric_pairs(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2 + 1).cast("double").alias("b"),
                                (-F.col("id")).cast("double").alias("c"))
    got = {(r.feature_a, r.feature_b): r.corr for r in P.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] == pytest.approx(-1.0)
    assert len(got) == 3


@pytest.mark.parametrize("values", [
    [float(i) for i in range(5000)],
    [3.0] * 3000 + [float(i) for i in range(10)],
    [(-1) ** i * 10.0 ** (i % 600 - 300) for i in range(4000)],
    [1e15 + i % 7 for i in range(3000)],
    [2.0], []])
def test_order_statistics_by_passes_equal_a_sort(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(3)
    ranks = {r for r in (0, 1, len(values) // 4, len(values) // 2, len(values) * 3 // 4, len(values) - 1) if 0 <= r < len(values)}
    got = P.order_statistics(df, {"x": ranks}, sketch=50, pick=20)
    assert got == {("x", r): sorted(values)[r] for r in ranks}


def test_describe_of_columns_with_nulls_and_without_rows(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None)], "a double, b double")
    a, b = P.describe(df, ["a", "b"]).collect()
    assert (a["count"], a.p25, a.p50, a.p75) == (2, 1.75, 2.5, 3.25)
    assert (b["count"], b.p25, b.p50, b["max"]) == (0, None, None, None)
    rough = P.describe(df, ["a", "b"], exact=False).collect()
    assert rough[0].p50 in (1.0, 4.0) and rough[1].p50 is None


def test_kde_boxes_stay_within_the_stated_error(spark):
    xs = [math.sin(i) * (1000.0 if i % 50 == 0 else 1.0) for i in range(1000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    mean = sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) * len(xs) ** -0.2
    for r in P.kde(df, "x", 9).collect():
        want = sum(math.exp(-0.5 * ((r.x - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
        assert abs(r.density - want) < 2e-14 / (h * math.sqrt(2 * math.pi)) + 1e-12 * want
    flat = P.kde(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 3).collect()
    assert all(r.density is None for r in flat)


def test_pair_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("a"), (F.col("id") * 2.0).alias("b"), F.lit(1).alias("c"))
    one = sorted(P.pair_sample(df.repartition(7), ["a", "b", "c"], "id", 40).collect())
    assert one == sorted(P.pair_sample(df.coalesce(1), ["a", "b", "c"], "id", 40).collect())
    assert len(one) == 120 and len({r.id for r in one}) == 40
    assert all(r.a == r.id % 7 and r.b == r.id * 2.0 for r in one if (r.feature_a, r.feature_b) == ("a", "b"))


def test_distinct_values_leave_out_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, v int")
    assert {r.column: r.n_distinct for r in P.distinct_values(df, ["s", "v"]).collect()} == {"s": 1, "v": 2}


def test_correlation_with_a_constant_column(spark):
    """SQL's corr is NaN there; Spark's own divides by zero."""
    df = spark.createDataFrame([(1.0, 5.0, 2), (2.0, 5.0, 4), (3.0, 5.0, 6), (None, 5.0, 9)], "a double, b double, c int")
    got = {(r.feature_a, r.feature_b): r.corr for r in P.pairwise_corr(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] != got["a", "b"] and got["b", "c"] != got["b", "c"] and abs(got["a", "c"] - 1) < 1e-12
    assert [r.corr for r in P.pairwise_corr(df.where("c > 99"), ["a", "c"]).collect()] == [None]
