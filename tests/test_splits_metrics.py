"""Splits (G1-G5), metrics (H13-H16) and kNN against brute force."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from decklens.operators import metrics as M
from decklens.operators import split as S


def test_split_is_stable_under_repartition(spark):
    df = spark.range(5000).withColumn("c", (F.col("id") % 3).cast("int"))
    a = {r.id: r.is_test for r in S.split_flag(df, "id", stratify="c").collect()}
    b = {r.id: r.is_test for r in S.split_flag(df.repartition(9), "id", stratify="c").collect()}
    assert a == b
    share = sum(a.values()) / len(a)
    assert abs(share - 0.25) < 0.03


def test_folds_cover_range(spark):
    df = S.fold_column(spark.range(2000), "id")
    got = {r.fold for r in df.select("fold").distinct().collect()}
    assert got == {0, 1, 2, 3, 4}


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_matches_pairwise_count_with_ties(spark):
    rows = [(round((i * 37 % 101) / 101, 1), int(i % 3 == 0)) for i in range(400)]
    df = spark.createDataFrame([("m", i, y, s, int(s >= 0.5)) for i, (s, y) in enumerate(rows)],
                               "model string, row_id long, label int, score double, prediction int")
    got = M.roc_auc(df, buckets=4).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(rows))


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.3, 0), ("m", 2, 1, 0.7, 1)],
                               "model string, row_id long, label int, score double, prediction int")
    assert M.roc_auc(df).first()["roc_auc"] is None


def test_classification_metrics_by_hand(spark):
    rows = [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)]
    df = spark.createDataFrame([("m", i, y, p) for i, (y, p) in enumerate(rows)],
                               "model string, row_id long, label int, prediction int")
    r = M.classification_metrics(df).first()
    assert r.accuracy == pytest.approx(3 / 5)
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)
    assert r.f1 == pytest.approx(2 / 3)


def test_regression_metrics_by_hand(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)]
    df = spark.createDataFrame([("m", i, y, p) for i, (y, p) in enumerate(rows)],
                               "model string, row_id long, label double, prediction double")
    r = M.regression_metrics(df).first()
    sse = 0.25 + 0 + 1
    assert r.r2 == pytest.approx(1 - sse / 2.0)
    assert r.mae == pytest.approx(1.5 / 3) and r.rmse == pytest.approx(math.sqrt(sse / 3))


def test_knn_matches_brute_force(spark):
    from decklens.operators.knn import nearest_neighbours
    pts = [(i, [math.sin(i * 0.7) * 3, math.cos(i * 1.3) * 2, (i % 7) * 0.5]) for i in range(300)]
    train = spark.createDataFrame([p for p in pts if p[0] % 4], "vec_id long, embedding array<double>")
    query = spark.createDataFrame([p for p in pts if p[0] % 4 == 0], "vec_id long, embedding array<double>")
    got = {(r.qid, r.rank): r.nid for r in nearest_neighbours(train, query, 5, block_rows=10).collect()}
    tr = [p for p in pts if p[0] % 4]
    for qi, qv in [p for p in pts if p[0] % 4 == 0]:
        d = sorted((math.dist(qv, tv), ti) for ti, tv in tr)[:5]
        for rank, (_, ti) in enumerate(d, 1):
            assert got[(qi, rank)] == ti


def test_exact_split_counts(spark):
    df = spark.range(1003).withColumn("c", F.when(F.col("id") % 10 < 7, 0).otherwise(1))
    out = S.split_exact(df, "id", stratify="c")
    got = {(r.c, r.is_test): r.n for r in out.groupBy("c", "is_test").agg(F.count("*").alias("n")).collect()}
    n_test = got.get((0, True), 0) + got.get((1, True), 0)
    assert n_test == math.ceil(0.25 * 1003)
    # 703 / 300 rows: floor shares 175 / 75, remainder 1 to the larger fraction
    assert got[(0, True)] == 176 and got[(1, True)] == 75
    again = {r.id: r.is_test for r in S.split_exact(df.repartition(5), "id", stratify="c").collect()}
    assert again == {r.id: r.is_test for r in out.collect()}


def test_exact_folds_are_stratified(spark):
    df = spark.range(523).withColumn("c", (F.col("id") % 25 == 0).cast("int"))
    rows = S.fold_exact(df, "id", 5, stratify="c").groupBy("c", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in rows if r["c"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert S.fold_exact(df, "id", 5).count() == 523


def test_r2_survives_large_offsets_and_constant_labels(spark):
    ys = [1e9 + i / 100 for i in range(101)]
    df = spark.createDataFrame([("m", y, y + 0.001) for y in ys] + [("c", 2.0, 2.0), ("c", 2.0, 2.0), ("d", 2.0, 1.0), ("d", 2.0, 2.0)], "model string, label double, prediction double")
    got = {r.model: r.r2 for r in M.regression_metrics(df).collect()}
    mean = sum(y - 1e9 for y in ys) / 101
    want = 1 - 101 * 1e-6 / sum((y - 1e9 - mean) ** 2 for y in ys)
    assert abs(got["m"] - want) < 1e-6 and got["c"] == 1.0 and got["d"] == 0.0


def test_roc_auc_of_many_distinct_scores_and_groups(spark):
    rows = [(f"m{i % 3}", (i * 7919) % 2003 / 2003 + (1e9 if i % 2 else 0.0), int((i * 31) % 5 < 2)) for i in range(1500)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    for buckets in (None, 1, 7):
        got = {r.model: r.roc_auc for r in M.roc_auc(df, buckets=buckets).collect()}
        for m in got:
            pos = [s for g, s, y in rows if g == m and y]
            neg = [s for g, s, y in rows if g == m and not y]
            want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
            assert got[m] == pytest.approx(want, rel=1e-12)
