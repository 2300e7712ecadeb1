"""A saved model predicts what the fitted one did, whichever model it is."""

import numpy as np
import pytest

from decklens.operators import ml as ML
from decklens.operators import persist

FEATURES = ["a", "b", "c"]
ONE = {"logreg": {"C": [1], "max_iter": [50]}, "svm": {"C": [1], "kernel": ["rbf"], "gamma": ["scale"], "probability": [True]},
       "rf": {"n_estimators": [5], "max_depth": [None], "min_samples_split": [2]},
       "xgb": {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1], "subsample": [0.8]}, "knn": {"n_neighbors": [5], "weights": ["distance"]},
       "linear_reg": {}, "ridge": {"alpha": [1], "max_iter": [1000]}, "svr": {"C": [1], "kernel": ["linear"], "gamma": ["auto"], "epsilon": [0.1]},
       "rf_reg": {"n_estimators": [5], "max_depth": [4], "min_samples_split": [5]},
       "xgb_reg": {"n_estimators": [5], "max_depth": [3], "learning_rate": [0.1], "subsample": [1.0]}}


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(120, 3)), 2)
    rows = [(i, *map(float, r), float(r[0] + 0.2 * r[1] ** 2), int(r[0] + r[1] > 0)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, t double, k int").cache()


@pytest.mark.parametrize("name", list(ONE))
def test_round_trip(spark, frame, tmp_path, name):
    task, label = ("reg", "t") if name in ML.REG_GRID else ("cls", "k")
    t = ML.grid_search(frame, FEATURES, label, name, ONE[name], task, k=3)
    for _ in range(2):  # the second time over the first
        persist.save(t.model, str(tmp_path / name))
    again = ML.Trained(name, persist.load(spark, str(tmp_path / name)), t.best_params, t.cv_metrics)

    def rows(trained):
        return sorted(tuple(r) for r in ML.predict(trained, frame, FEATURES, label, task).collect())
    first = rows(t)
    assert rows(again) == first and len(first) == 120
    if task == "cls":
        assert np.mean([r[2] == r[3] for r in first]) > 0.8
