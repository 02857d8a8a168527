"""Model-quality metrics as relational aggregates over scored rows.

Each metric is one aggregate pass (confusion counts, RMSE, R²) or a short
plan over per-score counts (exact, tie-aware ROC AUC).  Results are small
DataFrames, so several models can be unioned into one report.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.exprs import safe_ratio
from pixelframe.functions.ranges import running_sum, running_sum_by
from pixelframe.session import cut_lineage


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              positive: float = 1.0, negative: float = 0.0) -> DataFrame:
    """TP, FP, TN, FN in one aggregate (A5)."""
    lab, prd = F.col(label), F.col(prediction)
    p, n = F.lit(positive), F.lit(negative)
    return pred.agg(
        F.count_if((prd == p) & (lab == p)).alias("tp"),
        F.count_if((prd == p) & (lab == n)).alias("fp"),
        F.count_if((prd == n) & (lab == n)).alias("tn"),
        F.count_if((prd == n) & (lab == p)).alias("fn"),
    )


def metrics_from_counts(c: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy of the positive class with zero guards."""
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, tp + fn)
    return (c.select("*", precision.alias("precision"), recall.alias("recall"))
            .withColumn("f1", safe_ratio(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall")))
            .withColumn("accuracy", safe_ratio(tp + tn, tp + tn + fp + fn)))


def binary_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   positive: float = 1.0, negative: float = 0.0) -> DataFrame:
    return metrics_from_counts(confusion(pred, label, prediction, positive, negative))


def label_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per true label: support, precision, recall, F1.

    One shuffle builds the (label, prediction) count matrix; each matrix
    cell is then counted once for its true label (support, tp) and once for
    its predicted label, and re-grouped — #labels² rows, no join, one scan.
    Precision of label L uses all rows predicted L.
    """
    return label_metrics_from_counts(pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")),
                                     label, prediction)


def label_metrics_from_counts(counts: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label_metrics`` from (label, prediction, n) rows, which may repeat a pair."""
    cm = counts.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    roles = F.explode(F.array(
        F.struct(F.col("l").alias("k"), F.col("n").alias("support"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(zero).alias("tp"),
                 zero.alias("n_predicted")),
        F.struct(F.col("p").alias("k"), zero.alias("support"), zero.alias("tp"),
                 F.col("n").alias("n_predicted"))))
    m = (cm.select(roles.alias("r")).select("r.*").groupBy("k")
         .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
              F.sum("n_predicted").alias("n_predicted"))
         .filter(F.col("support") > 0))
    precision = safe_ratio("tp", "n_predicted")
    recall = safe_ratio("tp", "support")
    return (m.select(F.col("k").alias(label), "support", "tp", "n_predicted",
                     precision.alias("precision"), recall.alias("recall"))
            .withColumn("f1", safe_ratio(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall"))))


def weighted_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Support-weighted mean of per-label F1 (A8); also weighted precision/recall."""
    return weighted_from_labels(label_metrics(pred, label, prediction))


def weighted_from_labels(lm: DataFrame, *by: str) -> DataFrame:
    """Support-weighted means of per-label metrics, for each value of ``by``."""
    n = F.sum("support").cast("double")
    return lm.groupBy(*by).agg((F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
                  (F.sum(F.col("precision") * F.col("support")) / n).alias("weighted_precision"),
                  (F.sum(F.col("recall") * F.col("support")) / n).alias("weighted_recall"))


def score_of(raw: str = "rawPrediction", index: int = 1) -> Column:
    """Positive-class score from an ML vector column (what the evaluator ranks)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(raw))[index]


def score_counts(pred: DataFrame, label: str = "label", score: str | Column = "score") -> DataFrame:
    """Positives and negatives per distinct score (label > 0.5 is positive)."""
    s = F.col(score) if isinstance(score, str) else score
    return pred.groupBy(s.alias("score")).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"), F.count_if(F.col(label) <= 0.5).alias("neg"))


def auc_roc(pred: DataFrame, label: str = "label", score: str | Column = "score") -> DataFrame:
    """Exact area under the ROC curve with ties counted half.

    Equals Spark ML's evaluator with ``numBins=0``; the default evaluator
    down-samples the curve.  A null score ranks below every number and a NaN
    above, each tied with its like; rows with a null label do not count.
    """
    return auc_from_counts(score_counts(pred, label, score))


def auc_from_counts(g: DataFrame) -> DataFrame:
    """AUC from ``score, pos, neg`` with one row per distinct score.

    AUC = Σ_s pos_s · (neg_below_s + ½ neg_s) / (P · N).  The negatives below
    each score are a running sum over ranges of scores: any number of scores
    takes the same path, and no task holds more than one range of them.
    """
    ranked = running_sum(g, [F.col("score").asc_nulls_first()], "neg", "neg_below")
    contrib = F.col("pos").cast("double") * (F.col("neg_below") + F.lit(0.5) * F.col("neg"))
    agg = ranked.agg(F.sum(contrib).alias("u"), F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
                     F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"))
    return agg.select(
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"),
        "n_pos", "n_neg")


def auc_by(pred: DataFrame, by: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """``auc_roc`` for every value of ``by``, in one range cut for all of them:
    (by, auc, n_pos, n_neg)."""
    counts = pred.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"), F.count_if(F.col(label) <= 0.5).alias("neg"))
    ranked = running_sum_by(counts, by, [F.col("score").asc_nulls_first()], "neg", "neg_below")
    u = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.lit(0.5) * F.col("neg")))
    pos, neg = F.sum("pos"), F.sum("neg")
    return ranked.groupBy(*by).agg(F.when((pos > 0) & (neg > 0), u / (pos.cast("double") * neg)).alias("auc"),
                                   pos.alias("n_pos"), neg.alias("n_neg"))


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error (A10)."""
    d = F.col(prediction) - F.col(label)
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"))


def r2(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Coefficient of determination 1 − SSE/SST (A11), one pass; null for a constant label."""
    d = F.col(prediction) - F.col(label)
    sse = F.sum(d * d)
    sst = F.var_pop(F.col(label)) * F.count(F.col(label))
    return pred.agg((F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"))


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, R², MAE and n in one aggregate."""
    d = F.col(prediction) - F.col(label)
    return pred.agg(F.sqrt(F.avg(d * d)).alias("rmse"),
                    (F.lit(1.0) - F.try_divide(F.sum(d * d), F.var_pop(F.col(label)) * F.count(F.col(label)))).alias("r2"),
                    F.avg(F.abs(d)).alias("mae"), F.count(F.lit(1)).alias("n_rows"))


def _long(df: DataFrame, model: str, cols: list[str]) -> DataFrame:
    """A one-row metric frame as (model, metric, value) rows."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols]))
        .alias("m")).select(F.lit(model).alias("model"), "m.metric", "m.value")


SUMMARY_METRICS = ["precision", "recall", "f1", "accuracy", "auc"]


def outcome_counts(pred: DataFrame, score: str | Column, label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """(score, prediction, label, n): all that the classifier metrics need, from
    one scan of the scored rows, checkpointed."""
    s = F.col(score) if isinstance(score, str) else score
    return cut_lineage(pred.groupBy(s.alias("score"), F.col(prediction).alias(prediction), F.col(label).alias(label))
                       .agg(F.count(F.lit(1)).alias("n")))


def classifier_summary(models: Mapping[str, tuple[DataFrame, str | Column]], label: str = "label",
                       prediction: str = "prediction", digits: int | None = 4) -> DataFrame:
    """One row per model: precision, recall, F1, accuracy, AUC.

    ``models`` maps a model name to (scored frame, score column/expression).
    """
    return summary_from_counts({n: outcome_counts(df, score, label, prediction) for n, (df, score) in models.items()},
                               label, prediction, digits)


def summary_from_counts(models: Mapping[str, DataFrame], label: str = "label", prediction: str = "prediction",
                        digits: int | None = 4) -> DataFrame:
    """``classifier_summary`` from each model's ``outcome_counts``: the confusion
    counts and the AUC both come from that table.  Models are unioned as
    (model, metric, value) rows and pivoted back, so no join is needed."""
    parts = []
    for name, spl in models.items():
        cm = spl.groupBy(prediction, label).agg(F.sum("n").alias("n"))
        lab, prd = F.col(label), F.col(prediction)
        conf = cm.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(a) for a, c in (
            ("tp", (prd == 1) & (lab == 1)), ("fp", (prd == 1) & (lab == 0)),
            ("tn", (prd == 0) & (lab == 0)), ("fn", (prd == 0) & (lab == 1)))])
        g = spl.groupBy("score").agg(F.sum(F.when(lab > 0.5, F.col("n")).otherwise(0)).alias("pos"),
                                     F.sum(F.when(lab <= 0.5, F.col("n")).otherwise(0)).alias("neg"))
        parts.append(_long(metrics_from_counts(conf), name, SUMMARY_METRICS[:4]))
        parts.append(_long(auc_from_counts(g), name, ["auc"]))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    wide = rows.groupBy("model").pivot("metric", SUMMARY_METRICS).agg(F.first("value"))
    if digits is not None:
        return wide.select("model", *[F.round(c, digits).alias(c) for c in SUMMARY_METRICS])
    return wide.select("model", *SUMMARY_METRICS)


def format_report(df: DataFrame, percent_cols: list[str], fixed_cols: list[str] | None = None,
                  decimals: int = 2, fixed_decimals: int = 4) -> DataFrame:
    """Report text: percentages with ``decimals`` places, fixed-point elsewhere."""
    from pixelframe.functions.exprs import fixed_string, percent_string
    out = []
    for c in df.columns:
        if c in percent_cols:
            out.append(percent_string(c, decimals).alias(c))
        elif fixed_cols and c in fixed_cols:
            out.append(fixed_string(c, fixed_decimals).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
