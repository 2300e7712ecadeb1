"""Saving and loading whichever model wins.

A pipeline of built-in stages is saved by Spark ML itself.  The others are a
table (trees, support vectors or training rows, as Parquet) and parameters
(one JSON text); a mean imputer in front of them is saved beside.  Paths are
read and written by Spark, so they may be on any store.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel
from pyspark.sql import SparkSession

from decklens.operators import kernel as K
from decklens.operators import ml as ML


def save(model, path: str) -> None:
    """Write ``model`` under ``path``, replacing what is there."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, ML.TreesModel):
        table, said = model.trees, {"edges": [e.tolist() for e in model.edges], "features": model.features, "boosting": model.boosting, "task": model.task}
    elif isinstance(model, ML.KernelModel):
        m = model.machine
        table, said = model.vectors, {"machine": [m.C, m.gamma, m.epsilon], "bias": model.bias, "mean": list(model.mean), "std": list(model.std), "features": model.features,
                                      "task": model.task, "sigmoid": model.sigmoid, "gap": model.gap}
    elif isinstance(model, ML.NeighbourModel):
        table, said = model.train, {"mean": list(model.mean), "std": list(model.std), "features": model.features, "k": model.k, "weights": model.weights, "key": model.key}
    else:
        table, said = None, {}
        model.write().overwrite().save(f"{path}/pipeline")
    said |= {"kind": type(model).__name__, "imputer": getattr(model, "imputer", None) is not None}
    if table is not None:
        table.write.mode("overwrite").parquet(f"{path}/table")
    if said["imputer"]:
        model.imputer.write().overwrite().save(f"{path}/imputer")
    spark.createDataFrame([(json.dumps(said, default=float),)], "said string").write.mode("overwrite").parquet(f"{path}/parameters")


def load(spark: SparkSession, path: str):
    """The model that ``save`` wrote."""
    said = json.loads(spark.read.parquet(f"{path}/parameters").first()["said"])
    if said["kind"] == "PipelineModel":
        return PipelineModel.load(f"{path}/pipeline")
    table, imputer = spark.read.parquet(f"{path}/table"), ImputerModel.load(f"{path}/imputer") if said["imputer"] else None
    if said["kind"] == "TreesModel":
        return ML.TreesModel(table, [np.array(e, dtype=np.float64) for e in said["edges"]], said["features"], said["boosting"], said["task"], imputer)
    mean, std = np.array(said["mean"]), np.array(said["std"])
    if said["kind"] == "KernelModel":
        return ML.KernelModel(table, said["bias"], K.Machine(*said["machine"]), mean, std, said["features"], said["task"], said["sigmoid"], said["gap"], imputer)
    return ML.NeighbourModel(table, mean, std, said["features"], said["k"], said["weights"], said["key"])
