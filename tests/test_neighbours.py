"""The pivot index against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from decklens.operators import ml as ML
from decklens.operators import neighbours as N


def _clustered(n, seed, d=4, centres=12):
    rng = np.random.default_rng(seed)
    return np.round(rng.normal(size=(centres, d))[rng.integers(0, centres, n)] * 20 + rng.normal(size=(n, d)), 2)


def _frame(spark, x, space, name):
    return spark.createDataFrame([(int(s), i, list(map(float, r)), float(i % 2)) for i, (r, s) in enumerate(zip(x, space))], f"space int, {name} long, x array<double>, label double")


@pytest.mark.parametrize("cell_rows,k", [(20, 3), (50, 11), (10**6, 5)])
def test_neighbours_equal_brute_force(spark, cell_rows, k, monkeypatch):
    monkeypatch.setattr(N, "PART_ROWS", 64)
    x, q = _clustered(700, 1), np.concatenate([_clustered(60, 2), _clustered(700, 1)[:20]])
    x[100:140] = x[100]  # copies, more than k of them
    space, qspace = np.arange(700) % 2, np.arange(80) % 2
    got = N.nearest(_frame(spark, x, space, "id").repartition(4), _frame(spark, q, qspace, "qid"), k, cell_rows).collect()
    assert len(got) == 80
    for r in got:
        mine = np.flatnonzero(space == r["space"])
        dist = np.sqrt(((x[mine] - q[r["qid"]]) ** 2).sum(axis=1))
        want = sorted(zip(dist, mine.tolist()))[:k]
        assert [f["dist"] for f in r["found"]] == pytest.approx([w[0] for w in want], abs=1e-12)
        assert [f["id"] for f in r["found"]] == [w[1] for w in want]
    if cell_rows == 20:
        assert sum(r["compared"] for r in got) < 0.5 * 80 * 350


def test_fewer_rows_than_k(spark):
    x = np.array([[0.0, 0], [3, 4]])
    got = N.nearest(_frame(spark, x, [0, 0], "id"), _frame(spark, x, [0, 0], "qid"), 5).collect()
    assert [[round(f["dist"], 9) for f in r["found"]] for r in sorted(got, key=lambda r: r["qid"])] == [[0, 5], [0, 5]]


def test_votes(spark):
    df = spark.createDataFrame([([(1.0, 1, 1.0), (2.0, 2, 0.0), (4.0, 3, 0.0)],), ([(0.0, 1, 0.0), (0.0, 2, 1.0), (1.0, 3, 1.0)],)], "found array<struct<dist:double,id:long,label:double>>")
    rows = df.select(N.votes(F.col("found"), 3, "uniform"), N.votes(F.col("found"), 3, "distance"), N.votes(F.col("found"), 2, "distance")).collect()
    assert [pytest.approx(tuple(r)) for r in rows] == [(1 / 3, 1 / 1.75, 1 / 1.5), (2 / 3, 0.5, 0.5)]


def test_grid_of_a_neighbour_vote(spark):
    x = _clustered(300, 4, 3)
    df = spark.createDataFrame([(i, *map(float, r), int(r[0] > 0)) for i, r in enumerate(x)], "row_id long, a double, b double, c double, k int")
    t = ML.grid_search(df, ["a", "b", "c"], "k", "knn", {"n_neighbors": [5, 7], "weights": ["uniform", "distance"]}, "cls")
    assert len(t.cv_metrics) == 4 and max(t.cv_metrics) > 0.95
    p = ML.predict(t, df, ["a", "b", "c"], "k", "cls").collect()
    assert len(p) == 300 and np.mean([r["label"] == r["prediction"] for r in p]) > 0.95


def test_ridge_scores_equal_separate_fits(spark):
    """The shared sums give the scores that a cross-validated pipeline gives."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 2)) * [1, 30] + [1000, 5]
    rows = [(i, *map(float, r), float(r[0] * 0.4 - 0.02 * r[1] + rng.normal() * 0.3)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, t double")
    grid = {"alpha": [0.1, 100], "max_iter": [1000, 2000]}
    shared = ML.grid_search(df, ["a", "b"], "t", "ridge", grid, "reg")
    single = ML.grid_search(df, ["a", "b"], "t", "ridge", grid, "reg", impute=True)  # goes through CrossValidator
    assert shared.cv_metrics == pytest.approx(single.cv_metrics, abs=1e-9) and shared.best_params == single.best_params
    assert ML.grid_search(df, ["a", "b"], "t", "linear_reg", {}, "reg").cv_metrics == pytest.approx(ML.grid_search(df, ["a", "b"], "t", "linear_reg", {}, "reg", impute=True).cv_metrics, abs=1e-9)


@pytest.mark.parametrize("k", [1, 5, 11])
def test_all_pairs_equal_brute_force(spark, k, monkeypatch):
    """Many blocks; copies of rows and queries; ids beyond 2**53."""
    for name, n in (("BLOCK_QUERIES", 40), ("BLOCK_ROWS", 90), ("BLOCK_PAIRS", 500)):
        monkeypatch.setattr(N, name, n)
    x = _clustered(700, 1, 6)
    q = np.concatenate([_clustered(60, 2, 6), x[:20], x[:20]])
    x[100:140] = x[100]
    space, qspace, far = np.arange(700) % 2, np.arange(100) % 2, 2**53 + 1
    train = _frame(spark, x, space, "id").withColumn("id", F.col("id") + far)
    got = N.nearest(train.repartition(4), _frame(spark, q, qspace, "qid"), k).collect()
    assert len(got) == 100
    for r in got:
        mine = np.flatnonzero(space == r["space"])
        dist = np.zeros(len(mine))
        for c in range(6):
            dist += (x[mine, c] - q[r["qid"], c]) ** 2
        want = sorted(zip(np.sqrt(dist).tolist(), (mine + far).tolist()))[:k]
        assert [(f["dist"], f["id"]) for f in r["found"]] == want and r["compared"] == len(mine)


def test_equal_rows_and_queries_travel_once(spark, monkeypatch):
    """Each distinct vector is one row of a block, with the k smallest ids; every row and query counts."""
    seen, real = [], N.nearest_groups

    def watched(train, asked, k):
        seen.append((train.collect(), asked.collect()))
        return real(train, asked, k)
    monkeypatch.setattr(N, "nearest_groups", watched)
    some = _clustered(20, 3)
    x, q = some[np.arange(600) % 20], some[np.arange(90) % 9] + 0.25
    got = N.nearest(_frame(spark, x, np.zeros(600), "id").repartition(5), _frame(spark, q, np.zeros(90), "qid"), 7).collect()
    (rows, asked), = seen
    assert len(rows) == 20 and len(asked) == 9 and all(r["n"] == 30 and len(r["ids"]) == 7 for r in rows)
    assert sorted(r["qid"] for r in got) == list(range(90)) and all(r["compared"] == 600 for r in got)
    for r in got:
        dist = np.zeros(600)
        for c in range(4):
            dist += (x[:, c] - q[r["qid"], c]) ** 2
        want = sorted(zip(np.sqrt(dist).tolist(), range(600)))[:7]
        assert [(f["dist"], f["id"], f["label"]) for f in r["found"]] == [(d, i, float(i % 2)) for d, i in want]


def test_grid_of_a_neighbour_vote_scores_each_fold_by_its_own_rows(spark):
    """Repeated feature rows with labels of their own, against brute force fold by fold."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(40, 2))[rng.integers(0, 40, 240)] * [1, 10]  # distances tie between equal rows only
    y = ((x[:, 0] > 0) ^ (rng.random(240) < 0.25)).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "row_id long, a double, b double, k int")
    t = ML.grid_search(df, ["a", "b"], "k", "knn", {"n_neighbors": [3, 8], "weights": ["uniform", "distance"]}, "cls")
    folds = {r["row_id"]: r["fold"] for r in ML.S.fold_exact(df, "row_id", 5, purpose="cls", stratify="k").collect()}
    fold, want = np.array([folds[i] for i in range(240)]), []
    for k in (3, 8):
        for weights in ("uniform", "distance"):
            f1 = []
            for f in range(5):
                inside = np.flatnonzero(fold != f)
                z = (x - x[inside].mean(axis=0)) / x[inside].std(axis=0)
                said = {}
                for i in np.flatnonzero(fold == f):
                    dist = np.sqrt(((z[inside] - z[i]) ** 2).sum(axis=1)).round(9)
                    near = np.lexsort((inside, dist))[:k]
                    w = np.ones(k) if weights == "uniform" else (dist[near] == 0).astype(float) if (dist[near] == 0).any() else 1 / dist[near]
                    said[i] = (w * y[inside[near]]).sum() / w.sum() > 0.5
                yes, is1 = np.array(list(said.values())), y[list(said)] == 1
                f1.append(2 * (yes & is1).sum() / max(yes.sum() + is1.sum(), 1))
            want.append(np.mean(f1))
    assert t.cv_metrics == pytest.approx(want, abs=1e-9)


def test_null_vectors_are_an_error(spark):
    x = _clustered(40, 3)
    train = _frame(spark, x, np.zeros(40), "id")
    with pytest.raises(Exception, match="null"):
        N.nearest(train.withColumn("x", F.when(F.col("id") % 2 == 0, F.col("x"))), _frame(spark, x, np.zeros(40), "qid"), 3).collect()
