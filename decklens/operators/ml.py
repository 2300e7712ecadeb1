"""Model training and comparison on Spark ML.

Folds are a hash-based column (no random split, reproducible under any
partitioning).  Settings whose fits can share work are searched together
(forests and boosted trees: ``trees``; logistic: Newton steps over shared
sums); the others run through
``CrossValidator`` with ``parallelism=2`` like the reference.  The training set is checkpointed into the shared checkpoint
folder first, so the many fits re-read it instead of recomputing the
feature plan, and a lost executor costs one re-read.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decklens.operators import kernel as K
from decklens.operators import metrics as M
from decklens.operators import neighbours as N
from decklens.operators import split as S
from decklens.operators import trees as T
from decklens.session import cut_lineage

SVR_BLOCK_ROWS = 4096

# The reference's model grids (classification and regression).
CLS_GRID = {
    "logreg": {"C": [0.1, 1, 10], "penalty": ["l2"], "solver": ["lbfgs"], "max_iter": [1000]},
    "svm": {"C": [0.5, 1, 2], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"], "probability": [True]},
    "rf": {"n_estimators": [200, 400], "max_depth": [6, 10, None], "min_samples_split": [2, 5]},
    "xgb": {"n_estimators": [300, 500], "max_depth": [4, 6], "learning_rate": [0.05, 0.1],
            "subsample": [0.8, 1.0], "random_state": [42]},
    "knn": {"n_neighbors": [5, 7, 11], "weights": ["uniform", "distance"]},
}
REG_GRID = {
    "linear_reg": {},
    "ridge": {"alpha": [0.1, 1, 10, 100], "max_iter": [1000, 2000]},
    "svr": {"C": [0.5, 1, 2, 10], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"],
            "epsilon": [0.01, 0.1, 0.2]},
    "rf_reg": {"n_estimators": [200, 400], "max_depth": [6, 10, None], "min_samples_split": [2, 5]},
    "xgb_reg": {"n_estimators": [300, 500], "max_depth": [4, 6], "learning_rate": [0.05, 0.1],
                "subsample": [0.8, 1.0], "random_state": [42]},
}
SCALED = {"logreg", "svm", "knn", "linear_reg", "ridge", "svr"}


# ---------------------------------------------------------------------------
# Random Fourier features (Rahimi & Recht 2007) for the RBF kernel
# ---------------------------------------------------------------------------
class _RFFParams(Params):
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.toString)
    numFeatures = Param(Params._dummy(), "numFeatures", "output dimension", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    inputCol = Param(Params._dummy(), "inputCol", "input vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)


class RBFFeatures(Estimator, _RFFParams):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi).

    gamma 'scale' = 1 / (d * Var(X)) and 'auto' = 1 / d, as scikit-learn; the
    variance is one distributed aggregate.  The projection matrix is small
    (D x d) and shipped with the closure; rows are mapped by a pandas UDF."""

    def __init__(self, gamma: str = "scale", numFeatures: int = 256, seed: int = 42,
                 inputCol: str = "features", outputCol: str = "rff"):
        super().__init__()
        self._set(gamma=str(gamma), numFeatures=numFeatures, seed=seed, inputCol=inputCol,
                  outputCol=outputCol)

    def _fit(self, df: DataFrame) -> "RBFModel":
        import numpy as np
        inp = self.getOrDefault(self.inputCol)
        arr = vector_to_array(F.col(inp))
        first = df.select(F.size(arr).alias("d")).first()
        d = int(first["d"])
        g = self.getOrDefault(self.gamma)
        if g == "auto":
            gamma = 1.0 / d
        elif g == "scale":
            ex = df.select(F.explode(arr).alias("v")).agg(F.var_pop("v").alias("v")).first()["v"]
            gamma = 1.0 / (d * ex) if ex else 1.0
        else:
            gamma = float(g)
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        D = self.getOrDefault(self.numFeatures)
        W = rng.normal(0.0, math.sqrt(2 * gamma), size=(D, d))
        b = rng.uniform(0, 2 * math.pi, size=D)
        return RBFModel(W, b, inp, self.getOrDefault(self.outputCol))


class RBFModel(Model):
    def __init__(self, W, b, inputCol: str, outputCol: str):
        super().__init__()
        self.W, self.b, self.inputCol_, self.outputCol_ = W, b, inputCol, outputCol

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        from pyspark.sql.functions import pandas_udf
        W, b = self.W, self.b
        scale = math.sqrt(2.0 / W.shape[0])

        @pandas_udf("array<double>")
        def rff(col: pd.Series) -> pd.Series:
            X = np.stack(col.to_numpy())
            Z = scale * np.cos(X @ W.T + b)
            return pd.Series(list(Z))

        return df.withColumn(self.outputCol_, array_to_vector(rff(vector_to_array(F.col(self.inputCol_)))))


# ---------------------------------------------------------------------------
# Linear epsilon-insensitive regression (SVR, linear kernel) by full-batch
# subgradient descent: each step is one distributed aggregate of the
# subgradient (treeAggregate under the hood), the weights live on the driver.
# ---------------------------------------------------------------------------
class _SVRParams(Params):
    C = Param(Params._dummy(), "C", "inverse regularisation", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "tube width", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)


class EpsilonSVR(Estimator, _SVRParams):
    def __init__(self, C: float = 1.0, epsilon: float = 0.1, maxIter: int = 100,
                 featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(C=C, epsilon=epsilon, maxIter=maxIter, featuresCol=featuresCol, labelCol=labelCol,
                  predictionCol=predictionCol)

    def _fit(self, df: DataFrame) -> "LinearVectorModel":
        """Full-batch subgradient descent with iterate averaging.  The data
        is cut once into numpy blocks of bounded size (cached); every step is
        one ``treeAggregate`` of X_block^T g_block over the blocks, so the
        per-step work is vectorised and only d+1 numbers reach the driver."""
        fc, lc = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        C, eps = self.getOrDefault(self.C), self.getOrDefault(self.epsilon)

        def to_block(rows):
            xs, ys = [], []
            for r in rows:
                xs.append(r[0].toArray())
                ys.append(float(r[1]))
                if len(xs) == SVR_BLOCK_ROWS:
                    yield np.vstack(xs), np.asarray(ys)
                    xs, ys = [], []
            if xs:
                yield np.vstack(xs), np.asarray(ys)

        blocks = df.select(fc, F.col(lc).cast("double")).rdd.mapPartitions(to_block).cache()
        n, d, ysum = blocks.treeAggregate(
            (0, 0, 0.0), lambda acc, blk: (acc[0] + len(blk[1]), blk[0].shape[1], acc[2] + blk[1].sum()),
            lambda a_, b_: (a_[0] + b_[0], max(a_[1], b_[1]), a_[2] + b_[2]))
        w, b = np.zeros(d), ysum / max(n, 1)
        w_avg, b_avg = np.zeros(d), 0.0
        lam = 1.0 / (C * max(n, 1))
        for t in range(1, self.getOrDefault(self.maxIter) + 1):
            def grad(blk, w=w, b=b):
                X, y = blk
                r = y - (X @ w + b)
                g = np.where(r > eps, -1.0, np.where(r < -eps, 1.0, 0.0))
                return X.T @ g, g.sum()
            gw, gb = blocks.map(grad).treeReduce(lambda a_, b_: (a_[0] + b_[0], a_[1] + b_[1]))
            step = 0.5 / math.sqrt(t)  # features are standardised; averaged iterates
            w = w - step * (lam * w + gw / max(n, 1))
            b = b - step * (gb / max(n, 1))
            w_avg += (w - w_avg) / t
            b_avg += (b - b_avg) / t
        blocks.unpersist()
        return LinearVectorModel(w_avg, b_avg, fc, self.getOrDefault(self.predictionCol))


def _dot(vec: str, w, b: float):
    lit_w = F.array(*[F.lit(float(v)) for v in w])
    return F.aggregate(F.zip_with(vector_to_array(F.col(vec)), lit_w, lambda a, c: a * c),
                       F.lit(0.0), lambda acc, v: acc + v) + F.lit(float(b))


class LinearVectorModel(Model):
    def __init__(self, w, b, featuresCol: str, predictionCol: str):
        super().__init__()
        self.w, self.b, self.fc, self.pc = w, b, featuresCol, predictionCol

    @property
    def coefficients(self):
        return self.w

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.pc, _dot(self.fc, self.w, self.b))


# ---------------------------------------------------------------------------
# Estimator registry (H20): config name -> (stage builder, param mapping)
# ---------------------------------------------------------------------------
@dataclass
class Built:
    stages: list
    settings: list[dict] = field(default_factory=list)   # reference params per grid point
    maps: list[dict] = field(default_factory=list)       # Spark param maps per grid point


def _product(grid: dict) -> list[dict]:
    out = [{}]
    for k, vals in grid.items():
        out = [{**o, k: v} for o in out for v in vals]
    return out


def logistic_reg_param(C: float, n: int) -> float:
    """scikit-learn's C * sum(loss) + |w|^2 / 2, divided by C * n, is Spark's
    mean loss + regParam * |w|^2 / 2 with regParam = 1 / (C n)."""
    return 1.0 / (C * max(n, 1))


def ridge_reg_param(alpha: float, n: int, label_std: float) -> float:
    """scikit-learn's |y - Xw|^2 + alpha |w|^2 equals Spark's normal-equation
    solver (which scales the penalty by the label's std) with
    regParam = alpha / n * std_pop(y)."""
    return alpha / max(n, 1) * label_std


def build(name: str, grid: dict, task: str = "cls") -> Built:
    """Pipeline stages after the assembler (+ scaler) and one Spark param map
    per reference setting."""
    settings = _product(grid) or [{}]
    if name == "logreg":
        est = LogisticRegression(featuresCol="scaled", elasticNetParam=0.0, standardization=False)
        fit = Penalised(est, "C")
        maps = [{fit.strength: float(s["C"]), est.maxIter: int(s.get("max_iter", 100))} for s in settings]
        return Built([fit], settings, maps)
    if name == "svm":
        svc = LinearSVC(featuresCol="svm_in", standardization=False, rawPredictionCol="margin",
                        predictionCol="prediction")
        rff = RBFFeatures(inputCol="scaled", outputCol="rff")
        # the class is the sign of the margin; the sigmoid only gives the probability
        platt = LogisticRegression(featuresCol="margin_vec", maxIter=100, predictionCol="platt_prediction")
        fit = Penalised(svc, "C")
        stages = [_SvmInput(rff), fit, _MarginVector(), platt]
        maps = [{fit.strength: float(s["C"]), rff.gamma: str(s.get("gamma", "scale")),
                 stages[0].kernel: s.get("kernel", "rbf")} for s in settings]
        return Built(stages, settings, maps)
    if name == "knn":
        est = KNNClassifier(featuresCol="scaled")
        maps = [{est.k: int(s["n_neighbors"]), est.weights: str(s.get("weights", "uniform"))} for s in settings]
        return Built([est], settings, maps)
    if name == "linear_reg":
        est = LinearRegression(featuresCol="scaled", regParam=0.0, solver="normal", standardization=False)
        return Built([est], settings, [{} for _ in settings])
    if name == "ridge":
        est = LinearRegression(featuresCol="scaled", elasticNetParam=0.0, solver="normal", standardization=False)
        fit = Penalised(est, "alpha")
        maps = [{fit.strength: float(s["alpha"]), est.maxIter: int(s["max_iter"])} for s in settings]
        return Built([fit], settings, maps)
    if name == "svr":
        svr = EpsilonSVR(featuresCol="svm_in", labelCol="label")
        rff = RBFFeatures(inputCol="scaled", outputCol="rff")
        stages = [_SvmInput(rff), svr]
        maps = [{svr.C: float(s["C"]), svr.epsilon: float(s["epsilon"]), rff.gamma: str(s.get("gamma", "scale")),
                 stages[0].kernel: s.get("kernel", "rbf")} for s in settings]
        return Built(stages, settings, maps)
    raise KeyError(f"unknown model {name!r}")


class _PenaltyParams(Params):
    strength = Param(Params._dummy(), "strength", "C or alpha of the reference", TypeConverters.toFloat)


class Penalised(Estimator, _PenaltyParams):
    """Fits ``inner`` with the penalty that ``strength`` means for the frame it
    is given: row count and label spread are read at every fit, so folds and
    the refit each use their own.  The fitted model is the inner one's."""

    def __init__(self, inner, form: str):
        super().__init__()
        self.inner, self.form = inner, form
        self._setDefault(strength=1.0)

    def _fit(self, df: DataFrame):
        n, spread = df.agg(F.count(F.lit(1)), F.stddev_pop(self.inner.getLabelCol())).first()
        s = self.getOrDefault(self.strength)
        reg = logistic_reg_param(s, n) if self.form == "C" else ridge_reg_param(s, n, float(spread or 1.0))
        return self.inner.copy({self.inner.regParam: reg}).fit(df)

    def copy(self, extra=None):
        c = super().copy(extra)
        c.inner = self.inner.copy({p: v for p, v in (extra or {}).items() if p.parent == self.inner.uid})
        return c


class PopulationScaler(Estimator):
    """(x - mean) / population std: Spark's scaler divides by the sample std,
    so its output is multiplied by sqrt(n / (n - 1)) of the frame it is fitted
    on.  Fitted as two built-in stages, which can be saved."""

    def __init__(self, inputCol: str = "features", outputCol: str = "scaled"):
        super().__init__()
        self.src, self.dst = inputCol, outputCol

    def _fit(self, df: DataFrame):
        from pyspark.ml import PipelineModel
        from pyspark.ml.linalg import Vectors
        m = StandardScaler(inputCol=self.src, outputCol=f"{self.dst}_sample", withMean=True, withStd=True).fit(df)
        n = df.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        return PipelineModel([m, ElementwiseProduct(scalingVec=Vectors.dense([factor] * len(m.std)),
                                                    inputCol=f"{self.dst}_sample", outputCol=self.dst)])


class _KernelParams(Params):
    kernel = Param(Params._dummy(), "kernel", "'rbf' or 'linear'", TypeConverters.toString)


class _SvmInput(Estimator, _KernelParams):
    """Chooses the SVM input: scaled features (linear) or RBF features."""

    def __init__(self, rff: RBFFeatures):
        super().__init__()
        self.rff = rff
        self._setDefault(kernel="rbf")

    def _fit(self, df):
        if self.getOrDefault(self.kernel) == "linear":
            return _Rename("scaled", "svm_in")
        m = self.rff.copy(self.rff.extractParamMap())
        return _Chain(m.fit(df), "rff", "svm_in")

    def copy(self, extra=None):
        c = super().copy(extra)
        extra = extra or {}
        rff = self.rff.copy({self.rff.getParam(p.name): v for p, v in extra.items()
                             if self.rff.hasParam(p.name) and p.parent == self.rff.uid})
        c.rff = rff
        return c


class _Rename(Model):
    def __init__(self, src, dst):
        super().__init__()
        self.src, self.dst = src, dst

    def _transform(self, df):
        return df.withColumn(self.dst, F.col(self.src))


class _Chain(Model):
    def __init__(self, model, src, dst):
        super().__init__()
        self.model, self.src, self.dst = model, src, dst

    def _transform(self, df):
        return self.model.transform(df).withColumn(self.dst, F.col(self.src)).drop(self.src)


class _MarginVector(Model):
    """Turns the SVM margin into a 1-d vector for the Platt logistic stage."""

    def _transform(self, df):
        from pyspark.ml.functions import array_to_vector
        return df.withColumn("margin_vec", array_to_vector(F.array(vector_to_array("margin")[1])))

    def _fit(self, df):  # pragma: no cover - Model, not Estimator
        return self


def _front(features: list[str], scaled: bool, impute: bool = False) -> list:
    """Assembler (+ scaler).  NULL features make the assembler fail (S9:
    avg_cmc stays NULL when no card of a deck matched); ``impute`` inserts a
    mean Imputer fitted inside each training fold instead."""
    st = []
    if impute:
        from pyspark.ml.feature import Imputer
        st.append(Imputer(inputCols=features, outputCols=[f"{c}__imp" for c in features], strategy="mean"))
        features = [f"{c}__imp" for c in features]
    st.append(VectorAssembler(inputCols=features, outputCol="features"))
    if scaled:
        st.append(PopulationScaler("features", "scaled"))
    return st


@dataclass
class Trained:
    name: str
    model: object
    best_params: dict
    cv_metrics: list


def _evaluator(task: str, metric: str | None):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    if task == "cls":
        if metric in (None, "f1"):
            return MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
        if metric == "roc_auc":
            return BinaryClassificationEvaluator(metricName="areaUnderROC", rawPredictionCol="probability")
        return MulticlassClassificationEvaluator(metricName=metric)
    return RegressionEvaluator(metricName=metric or "r2")


TREES = {"rf": "forest", "rf_reg": "forest", "xgb": "boosting", "xgb_reg": "boosting"}
#: A forest or boosted model of at most so many bytes is broadcast for scoring.
MODEL_BYTES = 512 << 20


class TreesModel(Model):
    """A fitted forest or boosted model: its trees are a written table (tree, raw), scored from a broadcast of checked size."""

    def __init__(self, trees: DataFrame, edges: list, features: list[str], boosting: bool, task: str, imputer=None):
        super().__init__()
        self.trees, self.edges, self.features, self.boosting, self.task, self.imputer = trees, edges, features, boosting, task, imputer
        size = trees.agg(F.sum(F.length("raw"))).first()[0] or 0
        self.parts = -(-size // MODEL_BYTES) or 1
        self._shared: list | None = None

    def _broadcasts(self) -> list:
        if self._shared is None:
            sc = self.trees.sparkSession.sparkContext
            self._shared = [sc.broadcast([bytes(r["raw"]) for r in self.trees.filter(F.col("tree") % self.parts == k).orderBy("tree").collect()]) for k in range(self.parts)]
        return self._shared

    def _sums(self, df: DataFrame):
        """One column of sums over the trees of each broadcast."""
        from pyspark.sql.functions import pandas_udf
        edges = self.edges

        def over(shared):
            def part(frame: pd.DataFrame) -> pd.Series:
                x = np.column_stack([np.searchsorted(e, frame.iloc[:, i].to_numpy(dtype=np.float64)) for i, e in enumerate(edges)])
                return pd.Series(T.score(x, _loaded(shared), True))
            return pandas_udf(part, "double")
        row = F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])
        return [over(shared)(row) for shared in self._broadcasts()]

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        if self.imputer is not None:
            df = self.imputer.transform(df)
        first, *more = self._sums(df)
        value = sum(more, first)
        if not self.boosting:
            value = value / F.lit(float(self.trees.count()))
        if self.task != "cls":
            return df.withColumn("prediction", value)
        p = 1 / (1 + F.exp(-value)) if self.boosting else value
        return (df.withColumn("probability", p).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))
                .withColumn("probability", array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))).withColumn("rawPrediction", F.col("probability")))

    def importances(self) -> np.ndarray:
        return T.importances(self.trees, len(self.features), self.boosting)


def _loaded(shared):
    """The trees of a broadcast, read once in each Python worker."""
    if getattr(shared, "_trees", None) is None:
        shared._trees = [T.Tree.load(raw) for raw in shared.value]
    return shared._trees


def fold_scores(oof: DataFrame, by: list[str], task: str, metric: str | None = None) -> DataFrame:
    """(*by, score): out-of-fold predictions (fold, y, prediction, score) scored within each fold, then averaged over the folds.

    Binary F1 (0 without a positive), accuracy or exact ROC AUC; R2, MAE or RMSE.
    """
    y, p, n = F.col("y"), F.col("prediction"), F.count(F.lit(1))
    if metric == "roc_auc":
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in [*by, "fold"]])
        auc = M.roc_auc(oof.select(key.alias("model"), F.col("y").cast("int").alias("label"), "score"))
        parts = F.split("model", "/")
        return (auc.select(*[parts[i].cast(oof.schema[c].dataType).alias(c) for i, c in enumerate(by)], "roc_auc").groupBy(*by).agg(F.avg("roc_auc").alias("score")))
    tp = F.count_if((y == 1) & (p == 1))
    form = {"f1": F.coalesce(F.try_divide(2 * tp, F.count_if(y == 1) + F.count_if(p == 1)), F.lit(0.0)), "accuracy": F.count_if(y == p) / n,
            "r2": 1 - F.try_divide(F.sum((y - p) ** 2), F.var_pop(y) * n), "mae": -F.avg(F.abs(y - p)), "rmse": -F.sqrt(F.avg((y - p) ** 2))}
    score = form[metric or ("f1" if task == "cls" else "r2")]
    return oof.groupBy(*by, "fold").agg(score.cast("double").alias("score")).groupBy(*by).agg(F.avg("score").alias("score"))


def _search_trees(data: DataFrame, features: list[str], name: str, grid: dict, task: str, k: int, key: str, metric: str | None, impute: bool) -> Trained:
    """The whole grid of a forest or boosted model in one set of passes (see ``trees``), then the best setting on all rows."""
    spark, settings, imputer = data.sparkSession, _product(grid), None
    if impute:
        from pyspark.ml.feature import Imputer
        imputer = Imputer(inputCols=features, outputCols=features, strategy="mean").fit(data)
        data = imputer.transform(data)
    edges = T.bin_edges(data, features)
    rows = cut_lineage(T.binned(data, features, edges, key, "label", "fold"))
    marks = sorted({int(s["n_estimators"]) for s in settings})
    if TREES[name] == "boosting":
        def run(s, fold=-1):
            return T.Boosting(float(s["learning_rate"]), int(s["max_depth"]), float(s["subsample"]), fold)
        kinds = list(dict.fromkeys(run(s) for s in settings))
        oof = T.boosted(rows, [T.Boosting(r.rate, r.depth, r.subsample, f) for r in kinds for f in range(k)], marks, task == "cls")
        oof = oof.select("fold", "y", "mark", F.floor(F.col("run") / k).cast("int").alias("kind"), F.col("margin").alias("score"))
        value = (F.col("score") > 0).cast("int") if task == "cls" else F.col("score")
        which = [(kinds.index(run(s)), int(s["n_estimators"])) for s in settings]
    else:
        kinds = list(dict.fromkeys((s["max_depth"], int(s["min_samples_split"])) for s in settings))
        m = max(1, math.isqrt(len(features))) if name == "rf" else None
        oof = T.forest(rows, list(range(k)), marks, kinds, m).select("fold", "y", "mark", F.col("cap").alias("kind"), F.col("value").alias("score"))
        value = (F.col("score") > 0.5).cast("int") if task == "cls" else F.col("score")
        which = [(kinds.index((s["max_depth"], int(s["min_samples_split"]))), int(s["n_estimators"])) for s in settings]
    found = {(r["kind"], r["mark"]): r["score"] for r in fold_scores(oof.withColumn("prediction", value), ["kind", "mark"], task, metric).collect()}  # one row a setting
    scores = [found[w] for w in which]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return Trained(name, _tree_model(rows, edges, features, name, settings[best], task, imputer), settings[best], scores)


def _tree_model(rows: DataFrame, edges: list, features: list[str], name: str, setting: dict, task: str, imputer=None) -> TreesModel:
    """One setting on all binned rows."""
    n = int(setting["n_estimators"])
    if TREES[name] == "boosting":
        run = T.Boosting(float(setting["learning_rate"]), int(setting["max_depth"]), float(setting["subsample"]))
        trees = T.boosted(rows, [run], [n], task == "cls", trees=True).select("tree", "raw")
    else:
        m = max(1, math.isqrt(len(features))) if name == "rf" else None
        trees = T.forest_trees(rows, n, (setting["max_depth"], int(setting["min_samples_split"])), m)
    return TreesModel(cut_lineage(trees), edges, features, TREES[name] == "boosting", task, imputer)


class KernelModel(Model):
    """A support vector machine: its vectors are a written table (x scaled, weight); ``sigmoid`` (A, B) gives the probability."""

    def __init__(self, vectors: DataFrame, bias: float, machine, mean, std, features: list[str], task: str, sigmoid=None, gap: float = 0.0, imputer=None):
        super().__init__()
        self.vectors, self.bias, self.machine, self.mean, self.std = vectors, bias, machine, mean, std
        self.features, self.task, self.sigmoid, self.gap, self.imputer = features, task, sigmoid, gap, imputer
        self._margin = None

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        if self.imputer is not None:
            df = self.imputer.transform(df)
        self._margin = self._margin or K.margin_of(self.vectors, self.bias, self.machine.gamma, self.mean, self.std)
        out = df.withColumn("prediction", self._margin(F.array(*[F.col(c).cast("double") for c in self.features])))
        if self.task != "cls":
            return out
        a, b = self.sigmoid
        p = 1 / (1 + F.exp(F.lit(a) * F.col("prediction") + F.lit(b)))
        # the class is the sign of the margin; the sigmoid only gives the probability
        return (out.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("rawPrediction", array_to_vector(F.array(-F.col("prediction"), F.col("prediction"))))
                .withColumn("prediction", (F.col("prediction") > 0).cast("double")))


def _search_kernel(data: DataFrame, features: list[str], task: str, grid: dict, name: str, k: int, key: str, metric: str | None, impute: bool) -> Trained:
    """The whole grid of a support vector machine on shared passes and kernels (see ``kernel``), then the best setting on all rows."""
    settings, imputer = _product(grid), None
    if impute:
        from pyspark.ml.feature import Imputer
        imputer = Imputer(inputCols=features, outputCols=features, strategy="mean").fit(data)
        data = imputer.transform(data)
    data = cut_lineage(data.select(key, "fold", F.col("label").cast("double").alias("y"), *features))
    moments = K.fold_moments(data, features, [*range(k), -1])
    varied = moments[-1][2]
    which = [K.Machine(float(s["C"]), K.gamma_of(str(s.get("gamma", "scale")), s.get("kernel", "rbf"), len(features), varied),
                       float(s["epsilon"]) if task == "reg" else None) for s in settings]
    machines = list(dict.fromkeys(which))
    oof = cut_lineage(K.out_of_fold(data, features, key, machines, list(range(k)), moments))
    value = (F.col("margin") > 0).cast("int") if task == "cls" else F.col("margin")
    scored = oof.select("fold", "y", "machine", F.col("margin").alias("score"), value.alias("prediction"))
    found = {r["machine"]: r["score"] for r in fold_scores(scored, ["machine"], task, metric).collect()}  # one row a machine
    scores = [found[machines.index(m)] for m in which]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    m, (mean, std, _) = which[best], moments[-1]
    vectors, bias, primal, dual = K.fit(data, features, m, mean, std)
    sigmoid = K.sigmoid(oof.filter(F.col("machine") == machines.index(m)).select("y", "margin")) if task == "cls" else None
    model = KernelModel(vectors, bias, m, mean, std, features, task, sigmoid, (primal - dual) / max(abs(primal), 1e-12), imputer)
    return Trained(name, model, settings[best], scores)


class NeighbourModel(Model):
    """Votes of the nearest training rows, which are kept scaled and written (space, id, x, label)."""

    def __init__(self, train: DataFrame, mean, std, features: list[str], k: int, weights: str, key: str):
        super().__init__()
        self.train, self.mean, self.std, self.features, self.k, self.weights, self.key = train, mean, std, features, k, weights, key

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        x = _scaled_array(self.features, self.mean, self.std)
        found = N.nearest(self.train, df.select(F.lit(0).alias("space"), F.col(self.key).alias("qid"), x.alias("x")), self.k)
        voted = found.select(F.col("qid").alias(self.key), N.votes(F.col("found"), self.k, self.weights).alias("_p"))
        p = F.col("_p")
        return (df.join(voted, self.key, "left").withColumn("prediction", (p > 0.5).cast("double"))
                .withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("rawPrediction", F.col("probability")).drop("_p"))


def _scaled_array(features: list[str], mean, std):
    return F.array(*[(F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(features, mean, std)])


def _search_neighbours(data: DataFrame, features: list[str], grid: dict, k: int, key: str, metric: str | None) -> Trained:
    """Every fold's space is searched together, once for the largest k; smaller k and other weights are read off the same lists."""
    settings = _product(grid)
    data = cut_lineage(data.select(key, "fold", F.col("label").cast("double").alias("y"), *features))
    moments = K.fold_moments(data, features, [*range(k), -1])
    most = max(int(s["n_neighbors"]) for s in settings)
    # rows of equal features, once for all spaces: each space scales them by its own moments
    member = F.struct(F.col(key).alias("id"), F.col("y").alias("label"), "fold")
    groups = cut_lineage(data.groupBy(*features).agg(F.array_sort(F.collect_list(member)).alias("members")).withColumn("uid", F.monotonically_increasing_id()))

    def union(parts):
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def space(f: int):
        return F.lit(f).alias("space"), _scaled_array(features, *moments[f][:2]).alias("x")
    inside = [groups.select(*space(f), F.filter("members", partial(lambda f, r: r["fold"] != f, f)).alias("m")).filter(F.size("m") > 0) for f in range(k)]
    train = union(inside).select("space", "x", F.size("m").alias("n"), F.slice("m", 1, most).alias("m")).select("space", "x", "n", F.col("m.id").alias("ids"), F.col("m.label").alias("labels"))
    asked = union([groups.filter(F.exists("members", partial(lambda f, r: r["fold"] == f, f))).select(*space(f), "uid") for f in range(k)])
    found = N.nearest_groups(train, asked, most)
    forms = [F.struct(F.lit(i).alias("setting"), N.votes(F.col("found"), int(s["n_neighbors"]), str(s.get("weights", "uniform"))).alias("score")) for i, s in enumerate(settings)]
    rows = groups.select("uid", F.explode("members").alias("m")).select("uid", F.col("m.fold").alias("space"), F.col("m.label").alias("y"))
    oof = (rows.join(found.select("space", "uid", F.explode(F.array(*forms)).alias("e")), ["space", "uid"])
           .select(F.col("space").alias("fold"), "y", "e.*").withColumn("prediction", (F.col("score") > 0.5).cast("int")))
    got = {r["setting"]: r["score"] for r in fold_scores(oof, ["setting"], "cls", metric).collect()}  # one row a setting
    scores = [got[i] for i in range(len(settings))]
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    mean, std, _ = moments[-1]
    kept = cut_lineage(data.select(F.lit(0).alias("space"), F.col(key).alias("id"), _scaled_array(features, mean, std).alias("x"), F.col("y").alias("label")))
    model = NeighbourModel(kept, mean, std, features, int(settings[best]["n_neighbors"]), str(settings[best].get("weights", "uniform")), key)
    return Trained("knn", model, settings[best], scores)


def fold_sums(data: DataFrame, features: list[str], shift) -> dict[int, np.ndarray]:
    """{fold: sums of (1, x - shift, y) times itself}: one pass, from which every fold's least-squares problem follows."""
    d = len(features)

    def sums(frames):
        total: dict = {}
        for pdf in frames:
            for f, part in pdf.groupby("fold"):
                z = np.column_stack([np.ones(len(part)), part[features].to_numpy(dtype=np.float64) - shift[:d], part["label"].to_numpy(dtype=np.float64) - shift[d]])
                total[f] = total.get(f, 0) + z.T @ z
        yield pd.DataFrame([(f, v.ravel().tolist()) for f, v in total.items()], columns=["fold", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0).tolist()]})

    rows = data.select("fold", *[F.col(c).cast("double").alias(c) for c in features], F.col("label").cast("double").alias("label"))
    got = rows.mapInPandas(sums, "fold int, v array<double>").groupBy("fold").applyInPandas(add, "fold int, v array<double>").collect()  # one row a fold
    return {r["fold"]: np.array(r["v"]).reshape(d + 2, d + 2) for r in got}


def _ridge_scores(data: DataFrame, features: list[str], alphas: list[float], k: int) -> list[float]:
    """Mean R2 over the folds of each penalty: a fold's problem is the whole's sums minus its own."""
    d = len(features)
    shift = np.array(data.agg(*[F.avg(c) for c in features], F.avg("label")).first(), dtype=np.float64)
    parts = fold_sums(data, features, shift)
    whole, out = sum(parts.values()), [[] for _ in alphas]
    for f in sorted(parts):
        g, h = whole - parts[f], parts[f]
        n, mean = g[0, 0], g[0, 1:] / g[0, 0]
        cov = g[1:, 1:] - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(cov.diagonal()[:d] / n, 0))
        scale[scale <= 1e-150] = 1.0
        gram, xy = cov[:d, :d] / np.outer(scale, scale), cov[:d, d] / scale
        for i, alpha in enumerate(alphas):
            w = np.linalg.lstsq(gram + alpha * np.eye(d), xy, rcond=None)[0] / scale
            # residuals y - b - w x of the left-out rows as one quadratic form of their sums
            r = np.concatenate([[-(mean[d] - w @ mean[:d])], -w, [1.0]])
            total = h[d + 1, d + 1] - h[0, d + 1] ** 2 / h[0, 0]
            out[i].append(1 - float(r @ h @ r) / total)
    return [float(np.mean(v)) for v in out]


#: Newton steps after which a logistic problem is handed to ``CrossValidator``.
NEWTON_STEPS = 50
#: Rows of which a task holds the products of all pairs of features at a time.
PAIR_ROWS = 4096


def _fold_frames(data: DataFrame, features: list[str], k: int):
    """{fold: (mean, population std)} of the rows outside each fold, and over all rows; a constant feature's std is 1.

    None if a value is missing or not finite, or a training part has one class only.
    """
    cols = [F.count(F.lit(1)).alias("n"), F.count("label").alias("nl"), F.count_if(F.col("label") == 1).alias("n1"), F.count_if((F.col("label") != 0) & (F.col("label") != 1)).alias("other")]
    for i, c in enumerate(features):
        x = F.col(c).cast("double")
        cols += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.min(x).alias(f"a{i}"), F.max(x).alias(f"z{i}")]
    parts = {r["fold"]: r for r in data.groupBy("fold").agg(*cols).collect()}  # one row a fold
    if sorted(parts) != list(range(k)) or any(r["nl"] < r["n"] or r["other"] for r in parts.values()):
        return None
    if any(r[f"c{i}"] < r["n"] or not math.isfinite(r[f"a{i}"]) or not math.isfinite(r[f"z{i}"]) for r in parts.values() for i in range(len(features))):
        return None
    out = {}
    for fold in [*range(k), -1]:
        use = [r for f, r in parts.items() if f != fold]
        n, n1 = sum(r["n"] for r in use), sum(r["n1"] for r in use)
        if not 0 < n1 < n:
            return None

        def of(name):
            return np.array([[r[f"{name}{i}"] for i in range(len(features))] for r in use], dtype=np.float64)
        size = np.array([[r["n"]] for r in use], dtype=np.float64)
        mean = (size * of("m")).sum(axis=0) / n
        var = (size * (of("v") + (of("m") - mean) ** 2)).sum(axis=0) / n
        out[fold] = (mean, np.where((of("a").min(axis=0) < of("z").max(axis=0)) & (var > 0), np.sqrt(var), 1.0), n, n1 / n)
    return out


def _logistic_scores(data: DataFrame, features: list[str], strengths: list[float], k: int) -> list[float] | None:
    """Mean binary F1 over the folds of each C; the problems of all folds and settings are solved in the same passes.

    Newton steps on C sum(loss) + |w|^2 / 2 over the scaled features of a
    fold's training rows, as ``Penalised`` states it.  A pass sums losses,
    gradients and second moments, on features scaled over all rows; a fold's
    own scaling is a linear map of those.  None where ``_fold_frames`` is, or
    a problem does not settle.
    """
    frames = _fold_frames(data, features, k)
    if frames is None:
        return None
    d, (mean, std, *_) = len(features), frames[-1]
    jobs = [(f, C) for f in range(k) for C in strengths]
    maps = []  # own scaled row (with 1) = common scaled row (with 1) @ map
    for f in range(k):
        m = np.zeros((d + 1, d + 1))
        m[:d, :d] = np.diag(std / frames[f][1])
        m[d, :d], m[d, d] = (mean - frames[f][0]) / frames[f][1], 1.0
        maps.append(m)
    one, two = np.triu_indices(d + 1)
    rows = data.select("fold", F.col("label").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in features])

    def scaled(b):
        x = np.column_stack([b.column(2 + i).to_numpy(zero_copy_only=False) for i in range(d)])
        return np.column_stack([(x - mean) / std, np.ones(len(x))]), b.column(1).to_numpy(zero_copy_only=False), b.column(0).to_numpy(zero_copy_only=False)

    def parts(batches):
        return (b.slice(at, PAIR_ROWS) for b in batches for at in range(0, b.num_rows, PAIR_ROWS))

    def summed(points: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """{job: (loss, gradient, upper half of the second moments)} on the rows outside the job's fold, in common scale."""
        ids = sorted(points)
        theta = np.column_stack([maps[jobs[j][0]] @ points[j] for j in ids])
        out_fold = np.array([jobs[j][0] for j in ids])

        def sums(batches):
            total = np.zeros((len(ids), 1 + d + 1 + len(one)))
            for b in parts(batches):
                z, y, fold = scaled(b)
                use = fold[:, None] != out_fold[None]
                margin = z @ theta
                p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
                total[:, 0] += np.where(use, np.logaddexp(0, margin) - y[:, None] * margin, 0).sum(axis=0)
                total[:, 1:d + 2] += np.where(use, p - y[:, None], 0).T @ z
                total[:, d + 2:] += np.where(use, p * (1 - p), 0).T @ (z[:, one] * z[:, two])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["job", "v"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"job": pdf["job"].iloc[:1], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0).tolist()]})

        schema = "job int, v array<double>"
        got = rows.mapInArrow(sums, schema).groupBy("job").applyInPandas(add, schema).collect()  # one row a job
        return {r["job"]: np.array(r["v"]) for r in got}

    ridge, done = np.append(np.ones(d), 0.0), {}
    point = {j: np.append(np.zeros(d), math.log(frames[f][3] / (1 - frames[f][3]))) for j, (f, _) in enumerate(jobs)}
    last: dict[int, tuple] = {}  # (point, objective, step) a job came from
    for _ in range(NEWTON_STEPS):
        for j, v in summed(point).items():
            f, C = jobs[j]
            theta, m = point[j], maps[f]
            value = C * v[0] + theta[:d] @ theta[:d] / 2
            if j in last and not value <= last[j][1] * (1 + 1e-12):
                before, _, step = last[j]
                last[j] = (before, last[j][1], step / 2)
                point[j] = before + step / 2
                continue
            second = np.zeros((d + 1, d + 1))
            second[one, two] = v[d + 2:]
            second = second + np.triu(second, 1).T
            grad = C * (m.T @ v[1:d + 2]) + ridge * theta
            step = -np.linalg.solve(C * (m.T @ second @ m) + np.diag(ridge), grad)
            last[j], point[j] = (theta, value, step), theta + step
            if -grad @ step <= 1e-12 * value:
                done[j] = point.pop(j)
        if not point:
            break
    if point or not all(np.isfinite(w).all() for w in done.values()):
        return None
    theta = np.column_stack([maps[f] @ done[j] for j, (f, _) in enumerate(jobs)])
    of = np.array([f for f, _ in jobs])

    def counted(batches):
        total = np.zeros((len(jobs), 3), dtype=np.int64)
        for b in parts(batches):
            z, y, fold = scaled(b)
            held, yes, is1 = fold[:, None] == of[None], z @ theta > 0, (y > 0.5)[:, None]
            total += np.column_stack([(held & yes & is1).sum(axis=0), (held & yes).sum(axis=0), (held & is1).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(jobs)), pa.int32()), *(pa.array(total[:, i]) for i in range(3))], ["job", "tp", "said", "is1"])

    got = {r["job"]: r for r in rows.mapInArrow(counted, "job int, tp long, said long, is1 long").groupBy("job").agg(*[F.sum(c).alias(c) for c in ("tp", "said", "is1")]).collect()}
    f1 = [2 * got[j]["tp"] / (got[j]["said"] + got[j]["is1"]) if got[j]["said"] + got[j]["is1"] else 0.0 for j in range(len(jobs))]
    return [float(np.mean([f1[f * len(strengths) + i] for f in range(k)])) for i in range(len(strengths))]


def grid_search(train: DataFrame, features: list[str], label: str, name: str, grid: dict,
                task: str = "cls", k: int = S.CV_FOLDS, parallelism: int = 2, key: str = "row_id",
                metric: str | None = None, impute: bool = False) -> Trained:
    """K-fold CV over the grid, refit on the whole training set.  Scoring
    is binary F1 (classification) or R2 (regression) by default; ``metric``
    may name 'roc_auc' (the notebook's choice, S13) or any Spark evaluator
    metric.  Folds come from a keyed hash (stratified for classifiers).
    Settings whose fits can share work are searched together."""
    data = train.select(key, *features, F.col(label).alias("label"))
    data = cut_lineage(S.fold_exact(data, key, k, purpose=task, stratify="label" if task == "cls" else None))
    if name in TREES:
        return _search_trees(data, features, name, grid, task, k, key, metric, impute)
    if name in ("svm", "svr"):
        return _search_kernel(data, features, task, grid, name, k, key, metric, impute)
    if name == "knn" and not impute:
        return _search_neighbours(data, features, grid, k, key, metric)
    b = build(name, grid, task)
    pipe = Pipeline(stages=_front(features, name in SCALED, impute) + b.stages)
    if name in ("linear_reg", "ridge") and metric in (None, "r2") and not impute:
        scores = _ridge_scores(data, features, [float(s.get("alpha", 0.0)) for s in b.settings], k)
        best_i = max(range(len(scores)), key=lambda i: (scores[i], -i))
        return Trained(name, pipe.fit(data, b.maps[best_i]) if b.maps[best_i] else pipe.fit(data), b.settings[best_i], scores)
    if name == "logreg" and metric in (None, "f1") and not impute:
        scores = _logistic_scores(data, features, [float(s["C"]) for s in b.settings], k)
        if scores is not None:
            best_i = max(range(len(scores)), key=lambda i: (scores[i], -i))
            return Trained(name, pipe.fit(data, b.maps[best_i]), b.settings[best_i], scores)
    maps = [{p: v for p, v in m.items()} for m in b.maps]
    ev = _evaluator(task, metric)
    if len(maps) == 1 and not maps[0]:
        maps = [{}]
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, foldCol="fold",
                        parallelism=parallelism, numFolds=k)
    cvm = cv.fit(data)
    sign = 1 if ev.isLargerBetter() else -1
    best_i = max(range(len(cvm.avgMetrics)), key=lambda i: (sign * cvm.avgMetrics[i], -i))
    return Trained(name, cvm.bestModel, b.settings[best_i] if b.settings else {}, list(cvm.avgMetrics))


def fit_single(train: DataFrame, features: list[str], label: str, name: str, setting: dict,
               task: str = "cls", key: str = "row_id", impute: bool = False) -> Trained:
    """Fit one model with one setting on the whole training set (no
    cross-validation; ``grid_search`` does the selection)."""
    data = cut_lineage(train.select(key, *features, F.col(label).alias("label")))
    if name in TREES and not impute:
        edges = T.bin_edges(data, features)
        rows = cut_lineage(T.binned(data, features, edges, key, "label"))
        return Trained(name, _tree_model(rows, edges, features, name, setting, task), setting, [])
    b = build(name, {k: [v] for k, v in setting.items()}, task)
    pipe = Pipeline(stages=_front(features, name in SCALED, impute) + b.stages)
    model = pipe.fit(data, b.maps[0]) if b.maps and b.maps[0] else pipe.fit(data)
    return Trained(name, model, b.settings[0] if b.settings else {}, [])


def predict(t: Trained, test: DataFrame, features: list[str], label: str, task: str,
            key: str = "row_id") -> DataFrame:
    """Long prediction table (model, row_id, label, prediction[, score])."""
    out = t.model.transform(test.select(key, *features, F.col(label).alias("label")))
    cols = [F.lit(t.name).alias("model"), key, "label", F.col("prediction").cast("double").alias("prediction")]
    if task == "cls":
        cols[-1] = F.col("prediction").cast("int").alias("prediction")
        cols.append(vector_to_array("probability")[1].alias("score"))
    return out.select(*cols)


def feature_importance(t: Trained, features: list[str]) -> DataFrame:
    """Importances (trees) or absolute coefficients (linear) by name."""
    from pyspark.sql import SparkSession
    last = t.model if isinstance(t.model, TreesModel) else t.model.stages[-1]
    if isinstance(last, TreesModel):
        vals, kind = last.importances().tolist(), "importance"
    elif hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
        kind = "importance"
    elif hasattr(last, "coefficients"):
        c = last.coefficients
        vals = [abs(float(x)) for x in (c.toArray() if hasattr(c, "toArray") else c)]
        kind = "abs_coefficient"
    else:
        vals = [None] * len(features)
        kind = "none"
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(f, float(v) if v is not None else None, kind)
                                  for f, v in zip(features, vals[:len(features)])],
                                 "feature string, importance double, kind string")


def compare_models(df: DataFrame, features: list[str], label: str, grids: dict, task: str = "cls",
                   test_size: float = S.TEST_SIZE, key: str = "row_id"):
    """Split, grid-search every configured model, score the test split.

    Returns (results, best Trained, long predictions).  The best model is the
    first with the strictly highest F1 (classification) or R2 (regression)."""
    strat = label if task == "cls" else None
    # the feature plan runs once, for all models, folds and scores
    d = cut_lineage(S.split_exact(cut_lineage(df.select(key, *features, label)), key, strat, test_size, purpose=task))
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    # a model's many short passes leave cores idle, so the models are searched side by side
    with ThreadPoolExecutor(len(grids)) as pool:
        searches = [inheritable_thread_target(df.sparkSession)(partial(grid_search, train, features, label, name, grid, task)) for name, grid in grids.items()]
        trained = list(pool.map(lambda search: search(), searches))
    preds = [predict(t, test, features, label, task, key) for t in trained]
    long = preds[0]
    for p in preds[1:]:
        long = long.unionByName(p)
    long = cut_lineage(long)
    if task == "cls":
        res = M.model_results(long)
        metric = "f1"
    else:
        res = M.regression_metrics(long)
        metric = "r2"
    params = df.sparkSession.createDataFrame(
        [(t.name, {k: str(v) for k, v in t.best_params.items()}, i) for i, t in enumerate(trained)],
        "model string, best_params map<string,string>, position int")
    res = res.join(params, "model")
    top = res.orderBy(F.desc_nulls_last(metric), "position").select("model").first()["model"]
    best = next(t for t in trained if t.name == top)
    return res.drop("position"), best, long


def standardize_column(df: DataFrame, col: str):
    """H1 as a column: (x - mean) / population std (scikit-learn's scaler;
    a zero std leaves x - mean).  Mean and std are scalar subqueries."""
    x = F.col(col).cast("double")
    mu = df.agg(F.avg(x)).scalar()
    sd = df.agg(F.stddev_pop(x)).scalar()
    return (x - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)


def simple_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """H7 with one feature: Spark LinearRegression (normal equations) ->
    (slope, intercept, n); comparable with SQL regr_slope/regr_intercept."""
    data = VectorAssembler(inputCols=[x], outputCol="features").transform(
        df.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias("label")))
    m = LinearRegression(regParam=0.0, solver="normal", standardization=False).fit(data)
    n = m.summary.numInstances
    return df.sparkSession.createDataFrame([(float(m.coefficients[0]), float(m.intercept), int(n))],
                                           "slope double, intercept double, n long")


# ---------------------------------------------------------------------------
# kNN classifier as a Spark ML estimator (H6 inside the grid search)
# ---------------------------------------------------------------------------
class _KNNParams(Params):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "'uniform' or 'distance'", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique row key", TypeConverters.toString)


class KNNClassifier(Estimator, _KNNParams):
    """Lazy learner: the model keeps the (scaled) training rows and answers
    with the exact pruned neighbour join of ``decklens.operators.knn``."""

    def __init__(self, k: int = 5, weights: str = "uniform", featuresCol: str = "scaled",
                 idCol: str = "row_id"):
        super().__init__()
        self._set(k=k, weights=weights, featuresCol=featuresCol, idCol=idCol)

    def _fit(self, df: DataFrame) -> "KNNModel":
        fc, idc = self.getOrDefault(self.featuresCol), self.getOrDefault(self.idCol)
        train = df.select(F.col(idc).alias("vec_id"), vector_to_array(F.col(fc)).alias("embedding"),
                          F.col("label").cast("int").alias("label"))
        return KNNModel(train, self.getOrDefault(self.k), self.getOrDefault(self.weights), fc, idc)


class KNNModel(Model):
    def __init__(self, train, k, weights, featuresCol, idCol):
        super().__init__()
        self.train, self.k_, self.weights_, self.fc, self.idc = train, k, weights, featuresCol, idCol

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        from decklens.operators.knn import knn_predict
        q = df.select(F.col(self.idc).alias("vec_id"), vector_to_array(F.col(self.fc)).alias("embedding"))
        p = knn_predict(self.train, q, self.k_, self.weights_).select(
            F.col("vec_id").alias(self.idc), F.col("prediction").cast("double").alias("prediction"),
            array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("probability"))
        return df.join(p, self.idc, "left").withColumn("rawPrediction", F.col("probability"))
