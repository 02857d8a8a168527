"""Validation of all candidate models of a search in one pass over the rows.

Every model adds its own score column to the same scan.  For AUC each row then
becomes one (map, score) row per model; these are counted by map and score, cut
by range once, and the running sums restart with every map.  For RMSE the
squared errors of all models are one aggregate.  An evaluator per model would
start jobs of its own for each and read the rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelframe.operators.metrics import auc_by, score_of


def one_pass(evaluator: Evaluator) -> bool:
    """Whether the metric of ``evaluator`` can be computed for all maps at once."""
    if isinstance(evaluator, BinaryClassificationEvaluator):
        return evaluator.getMetricName() == "areaUnderROC" and not evaluator.isDefined(evaluator.weightCol)
    return (isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() == "rmse"
            and not evaluator.isDefined(evaluator.weightCol))


def map_scores(models: Sequence[Model], rows: DataFrame, label: str = "label") -> DataFrame:
    """(map, label, score): the positive-class score of every row under every
    classifier, numbered as in ``models``."""
    out = rows
    for i, m in enumerate(models):
        out = m.transform(out, {m.rawPredictionCol: f"_raw{i}", m.probabilityCol: "", m.predictionCol: ""})
    scores = F.array(*[F.struct(F.lit(i).alias("map"), score_of(f"_raw{i}").alias("score")) for i in range(len(models))])
    return out.select(F.col(label).alias("label"), F.explode(scores).alias("_s")).select("_s.map", "label", "_s.score")


def evaluate_maps(models: Sequence[Model], rows: DataFrame, evaluator: Evaluator) -> list[float]:
    """The evaluator's metric for every model: exact AUC (the evaluator's with
    ``numBins=0``) or RMSE.  NaN where it is not defined."""
    label = evaluator.getLabelCol()
    if isinstance(evaluator, BinaryClassificationEvaluator):
        found = {r["map"]: r["auc"] for r in auc_by(map_scores(models, rows, label), ["map"]).collect()}
        return [math.nan if found.get(i) is None else float(found[i]) for i in range(len(models))]
    out = rows
    for i, m in enumerate(models):
        out = m.transform(out, {m.predictionCol: f"_p{i}"})
    off = [F.col(f"_p{i}") - F.col(label) for i in range(len(models))]
    row = out.agg(*[F.sqrt(F.avg(d * d)).alias(f"m{i}") for i, d in enumerate(off)]).first()
    return [math.nan if v is None else float(v) for v in row]
