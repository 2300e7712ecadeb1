"""ML layer: closed-form and behavioural checks on small synthetic data."""

import math

import numpy as np

import pytest
from pyspark.sql import functions as F

from decklens.operators import ml as ML


@pytest.fixture(scope="module")
def linear_data(spark):
    rows = []
    for i in range(400):
        a, b = math.sin(i * 0.37) * 2, math.cos(i * 0.91) * 3
        y = 1.5 * a - 0.5 * b + 0.2 + 0.01 * math.sin(i * 7.1)
        rows.append((i, a, b, y, int(y > 0.2)))
    return spark.createDataFrame(rows, "row_id long, a double, b double, y double, c int")


def test_linear_regression_recovers_coefficients(spark, linear_data):
    out = ML.simple_ols(linear_data.withColumn("b", F.lit(0.0)), "a", "y").first()
    assert out.slope == pytest.approx(1.5, abs=0.05)


def test_epsilon_svr_fits_linear_signal(spark, linear_data):
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        linear_data.select("a", "b", F.col("y").alias("label")))
    m = ML.EpsilonSVR(C=10.0, epsilon=0.01, maxIter=300).fit(data)
    pred = m.transform(data)
    mae = pred.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert mae < 0.25


def test_grid_search_logistic_and_predict(spark, linear_data):
    t = ML.grid_search(linear_data, ["a", "b"], "c", "logreg", {"C": [0.1, 10.0], "max_iter": [100]}, "cls")
    assert len(t.cv_metrics) == 2 and t.best_params["C"] in (0.1, 10.0)
    p = ML.predict(t, linear_data, ["a", "b"], "c", "cls")
    acc = p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc > 0.9


def test_knn_estimator_in_grid(spark, linear_data):
    t = ML.grid_search(linear_data, ["a", "b"], "c", "knn", {"n_neighbors": [5], "weights": ["distance"]}, "cls")
    p = ML.predict(t, linear_data, ["a", "b"], "c", "cls")
    assert p.count() == 400
    assert p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9


def test_registry_rejects_unknown_model():
    with pytest.raises(KeyError):
        ML.build("nope", {})


def test_grid_search_by_roc_auc_and_imputer(spark, linear_data):
    d = linear_data.withColumn("a", F.when(F.col("row_id") % 10 == 0, None).otherwise(F.col("a")))
    t = ML.grid_search(d, ["a", "b"], "c", "logreg", {"C": [1.0], "max_iter": [50]}, "cls",
                       metric="roc_auc", impute=True)
    assert t.cv_metrics[0] > 0.8


def _xy(linear_data):
    rows = linear_data.orderBy("row_id").collect()
    X = np.array([[r.a, r.b] for r in rows])
    return X, np.array([r.y for r in rows]), np.array([r.c for r in rows])


def test_ridge_mapping_matches_closed_form(spark, linear_data):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    X, y, _ = _xy(linear_data)
    n, alpha = len(y), 10.0
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(2), Xc.T @ yc)      # scikit-learn Ridge optimum
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        linear_data.select("a", "b", F.col("y").alias("label")))
    m = LinearRegression(regParam=ML.ridge_reg_param(alpha, n, float(np.std(y))), elasticNetParam=0.0,
                         solver="normal", standardization=False).fit(data)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-8)
    assert m.intercept == pytest.approx(y.mean() - X.mean(0) @ w, abs=1e-8)


def test_logistic_mapping_zero_gradient(spark, linear_data):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    X, _, c = _xy(linear_data)
    C = 0.5
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        linear_data.select("a", "b", F.col("c").alias("label")))
    m = LogisticRegression(regParam=ML.logistic_reg_param(C, len(c)), elasticNetParam=0.0,
                           standardization=False, maxIter=1000, tol=1e-12).fit(data)
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad_w = C * X.T @ (p - c) + w          # gradient of scikit-learn's objective
    assert np.abs(grad_w).max() < 1e-4 and abs(C * (p - c).sum()) < 1e-4


def test_compare_models_results_and_best(spark, linear_data):
    grids = {"logreg": {"C": [1.0], "max_iter": [50]},
             "rf": {"n_estimators": [5], "max_depth": [3], "min_samples_split": [2]}}
    res, best, long = ML.compare_models(linear_data, ["a", "b"], "c", grids, "cls")
    rows = {r.model: r for r in res.collect()}
    assert set(rows) == {"logreg", "rf"}
    top = max(rows.values(), key=lambda r: (r.f1, -list(grids).index(r.model)))
    assert best.name == top.model
    assert long.select("model").distinct().count() == 2
    assert all(0.0 <= r.accuracy <= 1.0 and r.best_params is not None for r in rows.values())


def _small(spark, n=60):
    rows = [(i, float(i % 7), float((i * 13) % 11) * 1000, int((i * 5) % 12 < 4), float((i % 7) * 2 + (i * 13) % 11)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, y int, t double")


def test_scaler_uses_population_std(spark):
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(_small(spark))
    x = np.array([r.scaled.toArray() for r in ML.PopulationScaler().fit(df).transform(df).collect()])
    assert abs(x.mean(0)).max() < 1e-12 and abs(x.std(0) - 1).max() < 1e-12


def test_penalty_is_that_of_the_frame(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(_small(spark)).withColumnRenamed("y", "label")
    est = ML.Penalised(LogisticRegression(standardization=False), "C")
    for part in (df, df.where("row_id < 40")):
        m = est.copy({est.strength: 2.0}).fit(part)
        assert abs(m.getRegParam() - 1 / (2.0 * part.count())) < 1e-15


def test_svm_class_is_the_sign_of_the_margin(spark):
    t = ML.fit_single(_small(spark), ["a", "b"], "y", "svm", {"C": 1.0, "kernel": "linear", "gamma": "scale"})
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    out = t.model.transform(_small(spark).withColumnRenamed("y", "label")).select("prediction", vector_to_array("margin")[1].alias("m")).collect()
    assert all(r.prediction == float(r.m > 0) for r in out)


def test_one_setting_is_cross_validated(spark):
    _, best, _ = ML.compare_models(_small(spark), ["a", "b"], "t", {"linear_reg": {}}, "reg")
    assert len(best.cv_metrics) == 1 and best.cv_metrics[0] > 0.9


def test_training_queries_search_the_whole_grids(spark, monkeypatch):
    from decklens.plans import catalog

    class Searched(Exception):
        pass

    def search(train, features, label, name, grid, task="cls", *args, **options):
        raise Searched({name: grid})

    def compare(df, features, label, grids, task="cls", *args, **options):
        raise Searched(grids)

    monkeypatch.setattr(catalog, "_feature_table", lambda s, d: _small(s).selectExpr("*", "y as competitive", "t as competitiveness_score"))
    monkeypatch.setattr(ML, "grid_search", search)
    monkeypatch.setattr(ML, "compare_models", compare)
    one = {"clf_logistic": "logreg", "clf_svm": "svm", "clf_knn_decks": "knn", "clf_forest": "rf", "clf_boosted": "xgb", "feature_importance": "rf",
           "score_new_decks": "logreg", "model_roundtrip": "logreg", "reg_ridge": "ridge", "reg_svr": "svr", "reg_forest": "rf_reg", "reg_boosted": "xgb_reg"}
    want = {q: {name: (ML.CLS_GRID | ML.REG_GRID)[name]} for q, name in one.items()} | {"compare_classifiers": ML.CLS_GRID, "compare_regressors": ML.REG_GRID}
    for query, grids in want.items():
        with pytest.raises(Searched) as got:
            catalog.REGISTRY[query][0](spark, "")
        assert got.value.args[0] == grids, query


def _noisy(spark, n=600):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=n), rng.normal(3, 40, size=n), np.full(n, 0.1), rng.integers(0, 4, size=n)])
    x = np.column_stack([x, 2 * x[:, 0] + 1])  # collinear, and one column constant
    y = (x[:, 0] + x[:, 1] / 40 + rng.normal(size=n) > 0.5).astype(int)
    return x, y, spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))], "row_id long, a double, b double, c double, d double, e double, y int")


def test_logistic_grid_in_shared_passes(spark, monkeypatch):
    """the whole grid without a fit for each fold and setting; scores as of problems solved one by one."""
    from decklens.operators import split as S
    x, y, df = _noisy(spark)
    cs = [0.001, 0.1, 10.0]
    fold = np.array([r.fold for r in S.fold_exact(df.withColumnRenamed("y", "label"), "row_id", 5, purpose="cls", stratify="label").orderBy("row_id").collect()])
    want = []
    for C in cs:
        f1 = []
        for f in range(5):
            t, h = fold != f, fold == f
            std = x[t].std(axis=0)
            z = np.column_stack([(x - x[t].mean(axis=0)) / np.where(std > 1e-12, std, 1), np.ones(len(x))])
            w, pen = np.zeros(6), np.diag([1.0] * 5 + [0.0])
            for _ in range(60):
                p = 1 / (1 + np.exp(-z[t] @ w))
                w = w - np.linalg.solve(C * (z[t] * (p * (1 - p))[:, None]).T @ z[t] + pen, C * z[t].T @ (p - y[t]) + pen @ w)
            said = z[h] @ w > 0
            f1.append(2 * (said & (y[h] == 1)).sum() / (said.sum() + y[h].sum()))
        want.append(np.mean(f1))

    def refused(*args, **options):
        raise AssertionError("a fit for each fold and setting")
    monkeypatch.setattr(ML, "CrossValidator", refused)
    t = ML.grid_search(df, list("abcde"), "y", "logreg", {"C": cs, "penalty": ["l2"], "max_iter": [1000]}, "cls")
    assert t.cv_metrics == pytest.approx(want, abs=1e-12) and t.best_params["C"] == cs[int(np.argmax(want))]


def test_logistic_grid_with_a_missing_feature_still_fails(spark):
    _, _, df = _noisy(spark, 60)
    with pytest.raises(Exception, match="[Nn]ull"):
        ML.grid_search(df.withColumn("a", F.when(F.col("row_id") != 7, F.col("a"))), ["a", "b"], "y", "logreg", {"C": [1.0]}, "cls")


def test_compared_models_are_searched_side_by_side(spark, linear_data, monkeypatch):
    import threading
    both, real = threading.Barrier(2, timeout=120), ML.grid_search

    def search(*args, **more):
        both.wait()  # breaks if the second search waits for the first to end
        return real(*args, **more)

    monkeypatch.setattr(ML, "grid_search", search)
    grids = {"linear_reg": {}, "ridge": {"alpha": [0.1, 10], "max_iter": [100]}}
    res, best, long = ML.compare_models(linear_data, ["a", "b"], "c", grids, "reg")
    assert {r.model for r in res.collect()} == set(grids) and best.name in grids
    assert [r["n"] for r in long.groupBy("model").agg(F.count("*").alias("n")).collect()] == [long.count() // 2] * 2
