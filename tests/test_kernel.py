"""Support vector machines against their optimality conditions, closed optima and each other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from decklens.operators import kernel as K
from decklens.operators import ml as ML

FEATURES = ["a", "b", "c"]


def _data(n=240, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 20, 0.1] + [0, 5, 1]
    y = 0.4 + 0.3 * np.sin(x[:, 0]) + 0.01 * x[:, 1] + rng.normal(size=n) * 0.1
    return x, y, (y + rng.normal(size=n) * 0.1 > np.median(y)).astype(float)


@pytest.fixture(scope="module")
def frame(spark):
    x, y, c = _data()
    return spark.createDataFrame([(i, *map(float, r), float(t), int(k), i % 3) for i, (r, t, k) in enumerate(zip(x, y, c))],
                                 "row_id long, a double, b double, c double, t double, k int, fold int").repartition(3).cache()


def _scaled():
    x, y, c = _data()
    return (x - x.mean(0)) / x.std(0), y, c


@pytest.mark.parametrize("machine", [K.Machine(0.5, 0.3), K.Machine(2, 0.3), K.Machine(1, None), K.Machine(1, 0.3, 0.05), K.Machine(10, 0.3, 0.1), K.Machine(2, None, 0.1)])
def test_solution_meets_the_optimality_conditions(machine):
    x, y, c = _scaled()
    y = c if machine.epsilon is None else y
    w, b, primal, dual = K.solve_path(x, y, [machine])[machine]
    f = K.kernel(x, x, machine.gamma) @ w + b
    assert abs(w.sum()) < 1e-6 and np.abs(w).max() <= machine.C + 1e-9
    # conditions met to the tolerance bound the gap by C times the tolerance a row
    assert -1e-6 * primal <= primal - dual <= machine.C * len(y) * K.TOLERANCE
    if machine.epsilon is None:
        s = np.where(y > 0.5, 1, -1)
        a = s * w
        assert (a >= 0).all() and (s * f)[a == 0].min() > 1 - 2e-3 and (s * f)[a >= machine.C].max() < 1 + 2e-3
        assert np.allclose((s * f)[(a > 0) & (a < machine.C)], 1, atol=2e-3)
    else:
        r = y - f
        assert np.abs(r)[w == 0].max() < machine.epsilon + 2e-3
        free = (w != 0) & (np.abs(w) < machine.C)
        assert np.allclose(r[free], np.sign(w[free]) * machine.epsilon, atol=2e-3)


def test_svr_of_one_feature_has_a_closed_optimum():
    """Two points (-1, -1) and (1, 1): the tube of width e gives slope min(1 - e, 2C)."""
    x, y = np.array([[-1.0], [1.0]]), np.array([-1.0, 1.0])
    for C, e in ((10, 0.1), (0.2, 0.1), (10, 0.5)):
        w, b, *_ = K.solve_path(x, y, [K.Machine(C, None, e)])[K.Machine(C, None, e)]
        assert float(x[:, 0] @ w) == pytest.approx(min(1 - e, 2 * C), abs=1e-3) and b == pytest.approx(0, abs=1e-3)


@pytest.mark.parametrize("epsilon", [None, 0.05])
def test_linear_passes_reach_the_dual_optimum(frame, epsilon):
    machines = [K.Machine(C, None, epsilon) for C in (0.5, 5)]
    df = frame.withColumn("y", F.col("k" if epsilon is None else "t").cast("double"))
    moments = K.fold_moments(df, FEATURES, [0, -1])
    rows = df.select(F.array(*FEATURES).alias("x"), "y", "fold")
    got = K.linear_machines(rows, 3, machines, [0, -1], moments)
    x, y, c = _data()
    y, fold = (c if epsilon is None else y), np.arange(len(y)) % 3
    for (f, i), (w, b, primal, dual) in got.items():
        use = fold != f
        mean, std, varied = moments[f]
        assert np.allclose(mean, x[use].mean(0)) and np.allclose(std, x[use].std(0)) and varied == 1
        _, _, best, low = K.solve_path((x[use] - mean) / std, y[use], [machines[i]])[machines[i]]
        assert -1e-6 <= primal - dual <= 1.1e-4 * primal and low - 1e-6 <= primal <= best * (1 + 2e-4)


@pytest.mark.parametrize("machine", [K.Machine(1, 0.3), K.Machine(2, 0.3, 0.05)])
def test_decomposition_reaches_the_same_optimum(frame, machine):
    df = frame.withColumn("y", F.col("k" if machine.epsilon is None else "t").cast("double"))
    mean, std, _ = K.fold_moments(df, FEATURES, [-1])[-1]
    _, b, primal, dual = K.fit(df, FEATURES, machine, mean, std)
    vectors, b2, primal2, dual2 = K.fit(df, FEATURES, machine, mean, std, kernel_rows=50, work_rows=120)
    assert primal2 == pytest.approx(primal, rel=2e-3) and dual2 == pytest.approx(dual, rel=2e-3) and b2 == pytest.approx(b, abs=5e-3)
    assert abs(vectors.agg(F.sum("weight")).first()[0]) < 1e-6


def test_sigmoid_is_calibrated(spark):
    rng = np.random.default_rng(5)
    margin = rng.normal(size=6000) * 2
    y = (rng.random(6000) < 1 / (1 + np.exp(-1.5 * margin + 0.4))).astype(float)
    df = spark.createDataFrame(list(zip(map(float, y), map(float, margin))), "y double, margin double")
    a, b = K.sigmoid(df)
    assert a == pytest.approx(-1.5, abs=0.15) and b == pytest.approx(0.4, abs=0.15)
    p = 1 / (1 + np.exp(a * margin + b))
    for lo, hi in ((0, 0.3), (0.3, 0.7), (0.7, 1)):
        inside = (p >= lo) & (p < hi)
        assert p[inside].mean() == pytest.approx(y[inside].mean(), abs=0.05)


def test_grids(frame):
    t = ML.grid_search(frame, FEATURES, "k", "svm", {"C": [0.5, 2], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"], "probability": [True]}, "cls")
    assert len(t.cv_metrics) == 8 and max(t.cv_metrics) > 0.75 and 0 <= t.model.gap < 5e-3
    p = ML.predict(t, frame, FEATURES, "k", "cls").collect()
    assert np.mean([r["label"] == r["prediction"] for r in p]) > 0.75 and all(0 < r["score"] < 1 for r in p)
    t = ML.grid_search(frame, FEATURES, "t", "svr", {"C": [1, 10], "kernel": ["rbf", "linear"], "gamma": ["scale"], "epsilon": [0.01, 0.1]}, "reg")
    assert len(t.cv_metrics) == 8 and max(t.cv_metrics) > 0.7 and t.best_params["kernel"] == "rbf"
    p = ML.predict(t, frame, FEATURES, "t", "reg").collect()
    assert np.mean([(r["label"] - r["prediction"]) ** 2 for r in p]) < 0.03


@pytest.mark.parametrize("epsilon", [None, 0.05])
def test_rows_of_equal_features_are_one_variable(spark, monkeypatch, epsilon):
    """More rows than ``kernel_rows``, but fewer feature rows: one task a fold, with the optimum of the single rows."""
    x, y, c = _data()
    x, y = x[np.arange(len(x)) % 60], c if epsilon is None else y
    rows = [(i, *map(float, r), float(t), i // 60 % 3) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, fold int").repartition(3)
    machines, moments = [K.Machine(C, 0.3, epsilon) for C in (0.5, 2)], K.fold_moments(df, FEATURES, [0, 1, 2])

    def fail(*a, **k):
        raise AssertionError("decomposed")
    monkeypatch.setattr(K, "fit", fail)
    got = {(r["machine"], r["id"]): r for r in K.out_of_fold(df, FEATURES, "row_id", machines, [0, 1, 2], moments, kernel_rows=80).collect()}
    assert len(got) == 2 * len(rows)
    fold = np.arange(len(x)) // 60 % 3
    for f in range(3):
        z, use = (x - moments[f][0]) / moments[f][1], fold != f
        k = K.kernel(z[use], z[use], 0.3)
        for i, m in enumerate(machines):
            sign, p = K._problem(y[use], m)
            a, at = np.zeros(len(sign)), np.zeros(use.sum())
            K.smo(k, sign, p, m.C, a, at, 1e-5)
            w = K._weights(sign, a, len(at))
            b = K._bias(-np.tile(k @ w, len(sign) // len(at)) - sign * p, sign, a, m.C)
            # the rows' own variables need not be free where the feature row's one is
            margin = K.kernel(z[~use], z[use], 0.3) @ w
            found = np.array([got[i, int(r)]["margin"] for r in np.flatnonzero(~use)])
            assert np.ptp(found - margin) < 5e-3 and abs((found - margin).mean() - b) < 2e-2
            assert all(0 <= got[i, int(r)]["gap"] + 1e-9 < 5e-3 for r in np.flatnonzero(~use))


@pytest.mark.parametrize("most", [1, 64])
def test_a_step_and_the_sums_after_it_share_a_pass(frame, monkeypatch, most):
    """About one pass a Newton step (two before), whether tasks or the driver add the sums of the partitions."""
    rows = frame.select(F.array(*FEATURES).alias("x"), F.col("t").alias("y"), F.col("fold").cast("int").alias("fold"))
    moments = K.fold_moments(frame, FEATURES, [0])
    taken, real = [], K._pass

    def counted(rows, d, work, maps, machines):
        got = real(rows, d, work, maps, machines)
        taken.extend(got)
        assert all(len(v) == 2 for v in got.values())
        return got

    monkeypatch.setattr(K, "_pass", counted)
    monkeypatch.setattr(K, "PASS_PARTS", most)
    m = K.Machine(2, None, 0.1)
    w, b, primal, dual = K.linear_machines(rows, 3, [m], [0], moments)[0, 0]
    assert primal - dual <= K.LINEAR_GAP * primal and len(taken) < 70
    x, y = np.array([r.x for r in rows.filter("fold != 0").collect()]), np.array([r.y for r in rows.filter("fold != 0").collect()])
    want, b2, *_ = K.solve_path((x - moments[0][0]) / moments[0][1], y, [m])[m]
    assert np.allclose(((x - moments[0][0]) / moments[0][1]).T @ want, w, atol=0.01) and b == pytest.approx(b2, abs=0.01)
