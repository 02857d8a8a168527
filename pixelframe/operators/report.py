"""Model explanation and scoring tables: coefficients, importances, rankings."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def last_stage(model):
    """The fitted estimator at the end of a pipeline (or the model itself)."""
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def coefficients(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Feature, coefficient, |coefficient| and the intercept of a linear model."""
    m = last_stage(model)
    coef = [float(v) for v in m.coefficients.toArray()]
    rows = [(f, i, c, float(m.intercept)) for i, (f, c) in enumerate(zip(features, coef))]
    df = spark.createDataFrame(rows, "feature STRING, position INT, coefficient DOUBLE, intercept DOUBLE")
    return df.withColumn("abs_importance", F.abs("coefficient"))


def importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Tree-ensemble feature importances (sum to 1)."""
    m = last_stage(model)
    imp = [float(v) for v in m.featureImportances.toArray()]
    rows = [(f, i, v) for i, (f, v) in enumerate(zip(features, imp))]
    df = spark.createDataFrame(rows, "feature STRING, position INT, importance DOUBLE")
    return df.withColumn("abs_importance", F.abs("importance"))


def rank_features(df: DataFrame, by: str = "abs_importance") -> DataFrame:
    """Descending rank by ``by``, feature name as tie-break (O1).  The table has
    one row per feature, so the global window is bounded by the feature count."""
    w = Window.orderBy(F.col(by).desc(), F.col("feature").asc())
    return df.withColumn("rank", F.row_number().over(w))


def best_params(metrics: DataFrame, larger_better: bool, metric: str = "metric") -> DataFrame:
    """The best parameter map, first map on ties (O2): a top-1 report."""
    order = F.col(metric).desc() if larger_better else F.col(metric).asc()
    return metrics.orderBy(order, F.col("map_id").asc()).limit(1)


def score(model, df: DataFrame, label: str = "label", keep: Sequence[str] = (),
          vector: str | None = None) -> DataFrame:
    """Batch scoring of held-out rows (E3); narrow (no shuffle).  ``vector``
    names the feature vector to keep beside the prediction (P9)."""
    out = model.transform(df)
    cols = list(keep) + [label, "prediction"] + ([vector] if vector else [])
    for extra in ("rawPrediction", "probability"):
        if extra in out.columns:
            cols.append(extra)
    return out.select(*cols)


def positive_score(col: str = "rawPrediction") -> Column:
    from pixelframe.operators.metrics import score_of
    return score_of(col, 1)


def scale_columns(scaler, df: DataFrame, features: Sequence[str], prefix: str = "scaled_") -> DataFrame:
    """``df`` with every feature scaled by a fitted min-max scaler (to [0, 1]; a
    constant one to 0.5), as Column expressions over its range."""
    out = []
    for name, low, high in zip(features, scaler.originalMin.toArray(), scaler.originalMax.toArray()):
        width = float(high - low)
        scaled = (F.col(name) - F.lit(float(low))) / F.lit(width) if width else F.lit(0.5)
        out.append(scaled.alias(f"{prefix}{name}"))
    return df.select("*", *out)


def score_columns(model, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the ``prediction`` of a bare linear stage over already scaled
    ``columns`` (E4): a dot product of columns, no ML object in the plan."""
    out = F.lit(float(model.intercept))
    for name, c in zip(columns, model.coefficients.toArray()):
        out = out + F.lit(float(c)) * F.col(name)
    return df.withColumn("prediction", out)
