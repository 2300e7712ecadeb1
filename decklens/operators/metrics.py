"""Model evaluation over long prediction tables.

Prediction tables are long: (model, row_id, label, prediction[, score]).
Every metric is a grouped aggregate per model.  ROC AUC and the ROC curve
need ranks; they are computed exactly without a window over a whole model:
scores are first reduced to distinct values and range-partitioned; cumulative
counts are taken over one row a range and inside each range separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decklens.session import cut_lineage

def classification_metrics(pred: DataFrame, group: str = "model") -> DataFrame:
    """Accuracy, precision, recall, binary F1 (positive class 1; 0 when
    undefined, as scikit-learn's zero_division default)."""
    y, p = F.col("label").cast("int"), F.col("prediction").cast("int")
    c = pred.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def ratio(a, b):
        return F.coalesce(F.when(b != 0, a / b), F.lit(0.0))
    return c.select(group, ratio(tp + tn, F.col("n")).alias("accuracy"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def _score_ranks(pred: DataFrame, group: str, buckets: int | None) -> DataFrame:
    """Per (group, distinct score): pos, neg and counts of strictly lower scores.

    The distinct scores are range-partitioned by (group, score) and
    checkpointed with the number of their partition, so that ranges stay as
    they are if an executor is lost.  ``buckets``: the number of ranges, by
    default that of shuffle partitions."""
    g = pred.groupBy(group, F.col("score").cast("double").alias("score")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum((1 - F.col("label")).cast("long")).alias("neg"))
    ranges = g.repartitionByRange(group, "score") if buckets is None else g.repartitionByRange(buckets, group, "score")
    g = cut_lineage(ranges.withColumn("bucket", F.spark_partition_id()))
    bt = g.groupBy(group, "bucket").agg(F.sum("pos").alias("pb"), F.sum("neg").alias("nb"))
    wb = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(group, "bucket", F.coalesce(F.sum("pb").over(wb), F.lit(0)).alias("pos_pre_b"),
                   F.coalesce(F.sum("nb").over(wb), F.lit(0)).alias("neg_pre_b"))
    wi = Window.partitionBy(group, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    g = g.select("*", F.coalesce(F.sum("pos").over(wi), F.lit(0)).alias("pos_pre_i"),
                 F.coalesce(F.sum("neg").over(wi), F.lit(0)).alias("neg_pre_i"))
    # bt has at most (ranges + groups) rows: ranges are contiguous
    j = g.join(F.broadcast(bt), [group, "bucket"])
    return j.select(group, "score", "pos", "neg",
                    (F.col("pos_pre_b") + F.col("pos_pre_i")).alias("pos_below"),
                    (F.col("neg_pre_b") + F.col("neg_pre_i")).alias("neg_below"))


def roc_auc(pred: DataFrame, group: str = "model", buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney, ties count one half); NULL when a
    group has only one class (the reference stores NaN then)."""
    r = _score_ranks(pred, group, buckets)
    a = r.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(group, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                  F.col("u") / (F.col("P") * F.col("N"))).alias("roc_auc"))


def roc_curve(pred: DataFrame, group: str = "model", buckets: int | None = None) -> DataFrame:
    """One point per distinct score used as threshold (score >= t)."""
    r = _score_ranks(pred, group, buckets)
    tot = pred.groupBy(group).agg(F.sum(F.col("label").cast("long")).alias("P"),
                                  F.sum((1 - F.col("label")).cast("long")).alias("N"))
    j = r.join(tot, group)
    return j.select(group, F.col("score").alias("threshold"),
                    F.when(F.col("N") > 0, (F.col("N") - F.col("neg_below")) / F.col("N")).alias("fpr"),
                    F.when(F.col("P") > 0, (F.col("P") - F.col("pos_below")) / F.col("P")).alias("tpr"))


def regression_metrics(pred: DataFrame, group: str = "model") -> DataFrame:
    """R2, MAE, RMSE per group in one pass; the total sum of squares is
    centred (merged means and second moments), so large label offsets do not
    cancel.  Constant labels: R2 is 1 for a perfect fit, else 0; NULL for
    fewer than two rows."""
    y, p = F.col("label").cast("double"), F.col("prediction").cast("double")
    a = pred.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("var"),
        F.sum((y - p) * (y - p)).alias("sse"), F.sum(F.abs(y - p)).alias("sae"))
    n = F.col("n")
    sst = F.col("var") * n
    r2 = (F.when(n < 2, F.lit(None).cast("double")).when(sst > 0, 1 - F.col("sse") / sst)
          .when(F.col("sse") == 0, 1.0).otherwise(0.0))
    return a.select(group, r2.alias("r2"),
                    (F.col("sae") / n).alias("mae"), F.sqrt(F.col("sse") / n).alias("rmse"))


def confusion_matrix(pred: DataFrame, group: str = "model") -> DataFrame:
    """(group, label, pred_0, pred_1) with a pivot over the prediction."""
    return (pred.groupBy(group, F.col("label").cast("int").alias("label"))
            .pivot("prediction", [0, 1]).agg(F.count(F.lit(1)))
            .na.fill(0, ["0", "1"])
            .withColumnsRenamed({"0": "pred_0", "1": "pred_1"}))


def classification_report(pred: DataFrame, group: str = "model") -> DataFrame:
    """precision/recall/F1/support per class, macro and weighted rows."""
    y, p = F.col("label").cast("int"), F.col("prediction").cast("int")
    c = pred.groupBy(group).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))

    def ratio(a, b):
        return F.coalesce(F.when(b != 0, a / b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    per = {  # class 1: positives; class 0: negatives
        "1": (ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn), tp + fn),
        "0": (ratio(tn, tn + fn), ratio(tn, tn + fp), ratio(2 * tn, 2 * tn + fn + fp), tn + fp),
    }
    wide = c.select(group, *[e.alias(f"{k}_{m}") for k, vals in per.items()
                              for m, e in zip(("precision", "recall", "f1", "support"), vals)])
    rows = []
    for k in ("0", "1"):
        rows.append(F.struct(F.lit(k).alias("class"), *[F.col(f"{k}_{m}").cast("double").alias(m)
                                                          for m in ("precision", "recall", "f1")],
                             F.col(f"{k}_support").cast("long").alias("support")))
    tot = F.col("0_support") + F.col("1_support")
    macro = F.struct(F.lit("macro avg").alias("class"),
                     *[((F.col(f"0_{m}") + F.col(f"1_{m}")) / 2).alias(m) for m in ("precision", "recall", "f1")],
                     tot.cast("long").alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"),
                        *[F.coalesce(F.when(tot != 0, (F.col(f"0_{m}") * F.col("0_support")
                                                       + F.col(f"1_{m}") * F.col("1_support")) / tot),
                                     F.lit(0.0)).alias(m) for m in ("precision", "recall", "f1")],
                        tot.cast("long").alias("support"))
    return (wide.select(group, F.explode(F.array(*rows, macro, weighted)).alias("r"))
            .select(group, "r.*"))


def model_results(cls_pred: DataFrame, group: str = "model") -> DataFrame:
    """Result table of the classifier comparison: model, accuracy, f1, roc_auc."""
    m = classification_metrics(cls_pred, group).select(group, "accuracy", "f1")
    return m.join(roc_auc(cls_pred, group), group, "left")


def metrics_summary(results: DataFrame, by: str = "f1", group: str = "model",
                    metrics: tuple[str, ...] = ("accuracy", "f1", "roc_auc")) -> DataFrame:
    """One row: best model (first by ``by`` desc, ties by name), its
    scores and every model's scores as an ordered text list."""
    best = results.orderBy(F.desc_nulls_last(by), F.asc(group)).limit(1)
    entry = F.concat_ws(":", F.col(group), *[F.coalesce(F.format_string("%.6f", F.col(m)), F.lit("null"))
                                            for m in metrics])
    # one entry per model: the result table is small by construction
    allm = results.agg(F.array_join(F.array_sort(F.collect_list(entry)), ";")).scalar()
    return best.select(F.col(group).alias("best_model"),
                       *[F.col(m).alias(f"best_{m}") for m in metrics], allm.alias("all_models"))


def metrics_records(results: DataFrame, by: str, metrics: list[str], group: str = "model") -> DataFrame:
    """One row: best model (first by ``by`` desc, ties by name), its
    scores and ``all_models``, a record of every model (with ``best_params``
    where the results have them)."""
    best = results.orderBy(F.desc_nulls_last(by), F.asc(group)).limit(1)
    cols = [group, *metrics, *(c for c in ("best_params",) if c in results.columns)]
    # one record per model: the result table is small by construction
    allm = results.agg(F.array_sort(F.collect_list(F.struct(*cols)))).scalar() if "best_params" not in cols else results.agg(F.collect_list(F.struct(*cols))).scalar()
    return best.select(F.col(group).alias("best_model"), *[F.col(m).alias(f"best_{m}") for m in metrics], allm.alias("all_models"))


def chart_series(results: DataFrame, metrics: list[str], group: str = "model") -> DataFrame:
    """Bar-chart data: metric values with NULL -> 0 and a 3-decimal label."""
    long = results.unpivot([group], metrics, "metric", "value")
    v = F.coalesce(F.col("value"), F.lit(0.0))
    return long.select(group, "metric", v.alias("value"), F.format_string("%.3f", v).alias("label"))


def pred_vs_actual(reg_pred: DataFrame, model: str) -> DataFrame:
    """The chosen model's (actual, predicted) pairs plus the ideal line
    bounds (global min/max of both columns, as scalar subqueries)."""
    p = reg_pred.where(F.col("model") == model)
    lo = p.agg(F.least(F.min("label"), F.min("prediction"))).scalar()
    hi = p.agg(F.greatest(F.max("label"), F.max("prediction"))).scalar()
    return p.select("row_id", F.col("label").alias("actual"), F.col("prediction").alias("predicted"),
                    lo.alias("line_lo"), hi.alias("line_hi"))
