"""Exact k-nearest-neighbour classification (H6) of embedding tables.

The search is ``neighbours.nearest``; dense vectors of many dimensions leave
no block or cell out, so all pairs are compared, block by block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decklens.operators import neighbours as N


def _normalize(vec):
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + v * v))
    return F.transform(vec, lambda v: F.when(norm > 0, v / norm).otherwise(v))


def _prep(df: DataFrame, id_col: str, vec_col: str, metric: str) -> DataFrame:
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    if metric == "cosine":
        v = _normalize(v)
    return df.select(F.col(id_col).alias("id"), v.alias("v"), *[c for c in df.columns
                                                               if c not in (id_col, vec_col)])


def nearest_neighbours(train: DataFrame, query: DataFrame, k: int, id_col: str = "vec_id",
                       vec_col: str = "embedding", metric: str = "euclidean",
                       block_rows: int | None = None) -> DataFrame:
    """(qid, nid, dist, rank) for the k nearest training rows of every query
    (ties by training id).  ``metric``: 'euclidean' or 'cosine' (on unit
    vectors the euclidean order equals the cosine order).  ``block_rows``: rows
    of a cell of a pivot index; None compares all pairs by blocks."""
    tr = _prep(train, id_col, vec_col, metric)
    qs = _prep(query, id_col, vec_col, metric)
    found = N.nearest(tr.select(F.lit(0).alias("space"), "id", F.col("v").alias("x"), F.lit(0.0).alias("label")),
                      qs.select(F.lit(0).alias("space"), F.col("id").alias("qid"), F.col("v").alias("x")), k, block_rows)
    return found.select("qid", F.posexplode("found").alias("i", "n")).select(
        "qid", F.col("n.id").alias("nid"), F.col("n.dist").alias("dist"), (F.col("i") + 1).alias("rank"))


def knn_predict(train: DataFrame, query: DataFrame, k: int = 5, weights: str = "uniform",
                id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                metric: str = "euclidean") -> DataFrame:
    """Vote of the k neighbours: 'uniform' or 'distance' (1/d; an exact match
    takes the vote alone, as scikit-learn).  Ties go to the smallest label.
    Output: (id, prediction, score) with score = vote share of label 1."""
    nn = nearest_neighbours(train, query, k, id_col, vec_col, metric)
    labels = train.select(F.col(id_col).alias("nid"), F.col(label_col).alias("nlabel"))
    j = nn.join(labels, "nid")
    if weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
        wgt = F.when(has_zero == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        wgt = F.lit(1.0)
    votes = j.select("qid", "nlabel", wgt.alias("w")).groupBy("qid", "nlabel").agg(F.sum("w").alias("w"))
    tot = F.sum("w").over(Window.partitionBy("qid"))
    best = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("w"), F.asc("nlabel")))
    ranked = votes.select("qid", "nlabel", "w", tot.alias("tot"), best.alias("r"))
    share1 = F.sum(F.when(F.col("nlabel") == 1, F.col("w")).otherwise(F.lit(0.0))).over(
        Window.partitionBy("qid")) / F.col("tot")
    return (ranked.select("*", share1.alias("score")).where(F.col("r") == 1)
            .select(F.col("qid").alias(id_col), F.col("nlabel").alias("prediction"), "score"))
