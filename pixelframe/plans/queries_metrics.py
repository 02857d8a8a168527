"""Queries for relational model metrics on rule-scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelframe.functions.exprs import round_doubles
from pixelframe.operators import metrics as M
from pixelframe.plans.registry import register
from pixelframe.sources.testdata import F3_SQL, scored_table

D = 9  # decimals kept for derived doubles (summation order differs by engine)

F3 = f"({F3_SQL}) f3"


def _confusion_sql(pred: str = "prediction") -> str:
    return f"""
SELECT COUNT(*) FILTER (WHERE {pred} = 1 AND label = 1) AS tp,
       COUNT(*) FILTER (WHERE {pred} = 1 AND label = 0) AS fp,
       COUNT(*) FILTER (WHERE {pred} = 0 AND label = 0) AS tn,
       COUNT(*) FILTER (WHERE {pred} = 0 AND label = 1) AS fn
FROM {F3}"""


def _guard(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0E0 END"


def _binary_sql(pred: str = "prediction", digits: int = D) -> str:
    return f"""
SELECT tp, fp, tn, fn, ROUND(precision, {digits}) AS precision, ROUND(recall, {digits}) AS recall,
       ROUND({_guard('2E0 * precision * recall', 'precision + recall')}, {digits}) AS f1,
       ROUND({_guard('tp + tn', 'tp + tn + fp + fn')}, {digits}) AS accuracy
FROM (SELECT *, {_guard('tp', 'tp + fp')} AS precision, {_guard('tp', 'tp + fn')} AS recall
      FROM ({_confusion_sql(pred)}) c) m"""


def _label_sql() -> str:
    return f"""
WITH cm AS (SELECT label AS l, prediction AS p, COUNT(*) AS n FROM {F3} GROUP BY 1, 2),
a AS (SELECT l, CAST(SUM(n) AS BIGINT) AS support,
             CAST(SUM(CASE WHEN l = p THEN n ELSE 0 END) AS BIGINT) AS tp FROM cm GROUP BY l),
pr AS (SELECT p AS l, CAST(SUM(n) AS BIGINT) AS n_predicted FROM cm GROUP BY p),
m AS (SELECT a.l AS label, support, tp, COALESCE(n_predicted, 0) AS n_predicted,
             {_guard('tp', 'COALESCE(n_predicted, 0)')} AS precision, {_guard('tp', 'support')} AS recall
      FROM a LEFT JOIN pr ON a.l = pr.l)
SELECT *, {_guard('2E0 * precision * recall', 'precision + recall')} AS f1 FROM m"""


def _auc_sql(score: str = "score") -> str:
    return f"""
WITH g AS (SELECT {score} AS score, COUNT(*) FILTER (WHERE label > 0.5) AS pos,
                  COUNT(*) FILTER (WHERE label <= 0.5) AS neg FROM {F3} GROUP BY 1),
r AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS neg_below FROM g)
SELECT ROUND(SUM(CAST(pos AS DOUBLE) * (neg_below + 0.5E0 * neg))
             / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), {D}) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
FROM r"""


@register("confusion", "A5", sql=_confusion_sql())
def confusion(spark, sf_dir):
    return M.confusion(scored_table(spark, sf_dir))


@register("binary_metrics", "A6,P13", sql=_binary_sql())
def binary_metrics(spark, sf_dir):
    return round_doubles(M.binary_metrics(scored_table(spark, sf_dir)), D)


@register("label_metrics", "A7", sql=f"SELECT label, support, tp, n_predicted, ROUND(precision, {D}) AS precision, "
          f"ROUND(recall, {D}) AS recall, ROUND(f1, {D}) AS f1 FROM ({_label_sql()}) x")
def label_metrics(spark, sf_dir):
    return round_doubles(M.label_metrics(scored_table(spark, sf_dir)), D)


@register("weighted_f1", "A8", sql=f"""
SELECT ROUND(SUM(f1 * support) / SUM(support), {D}) AS weighted_f1,
       ROUND(SUM(precision * support) / SUM(support), {D}) AS weighted_precision,
       ROUND(SUM(recall * support) / SUM(support), {D}) AS weighted_recall
FROM ({_label_sql()}) x""")
def weighted_f1(spark, sf_dir):
    return round_doubles(M.weighted_f1(scored_table(spark, sf_dir)), D)


@register("auc_roc", "A9", sql=_auc_sql("score"))
def auc_roc(spark, sf_dir):
    return round_doubles(M.auc_roc(scored_table(spark, sf_dir), score="score"), D)


@register("auc_roc_bucketed", "A9", sql=_auc_sql("score_price"))
def auc_roc_bucketed(spark, sf_dir):
    # a continuous score: nearly as many distinct scores as rows
    return round_doubles(M.auc_roc(scored_table(spark, sf_dir), score="score_price"), D)


@register("rmse", "A10", sql=f"SELECT ROUND(SQRT(AVG((prediction_reg - label) * (prediction_reg - label))), {D}) AS rmse FROM {F3}")
def rmse(spark, sf_dir):
    return round_doubles(M.rmse(scored_table(spark, sf_dir), prediction="prediction_reg"), D)


@register("r2", "A11", sql=f"""
SELECT ROUND(1E0 - SUM((prediction_reg - label) * (prediction_reg - label))
             / (VAR_POP(label) * COUNT(label)), {D}) AS r2 FROM {F3}""")
def r2(spark, sf_dir):
    return round_doubles(M.r2(scored_table(spark, sf_dir), prediction="prediction_reg"), D)


def _rule_models(spark, sf_dir):
    s = scored_table(spark, sf_dir)
    return {
        "quantity_rule": (s.select("label", "prediction", "score"), "score"),
        "price_rule": (s.select("label", F.col("prediction_price").alias("prediction"),
                                F.col("score_price").alias("score")), "score"),
    }


def _summary_sql() -> str:
    parts = []
    for name, pred, score in (("quantity_rule", "prediction", "score"), ("price_rule", "prediction_price", "score_price")):
        parts.append(f"""
SELECT '{name}' AS model, ROUND(b.precision, 4) AS precision, ROUND(b.recall, 4) AS recall,
       ROUND(b.f1, 4) AS f1, ROUND(b.accuracy, 4) AS accuracy, ROUND(a.auc, 4) AS auc
FROM ({_binary_sql(pred, 17)}) b, ({_auc_sql(score)}) a""")
    return " UNION ALL ".join(parts)


@register("model_summary", "A13,E5,P11", sql=_summary_sql())
def model_summary(spark, sf_dir):
    return M.classifier_summary(_rule_models(spark, sf_dir), digits=4)


@register("report_format", "P12", sql=f"""
SELECT model, printf('%.2f%%', precision * 100) AS precision, printf('%.2f%%', recall * 100) AS recall,
       printf('%.2f%%', f1 * 100) AS f1, printf('%.2f%%', accuracy * 100) AS accuracy,
       printf('%.4f', auc) AS auc
FROM ({_summary_sql()}) s""")
def report_format(spark, sf_dir):
    s = M.classifier_summary(_rule_models(spark, sf_dir), digits=4)
    return M.format_report(s, ["precision", "recall", "f1", "accuracy"], ["auc"])
