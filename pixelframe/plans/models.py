"""Spark ML estimators with the reference's settings, and staged estimators
(assembler -> optional min-max scaler -> estimator)."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression

from pixelframe.operators.features import scaling_stages
from pixelframe.operators.prep import WEIGHT_COL

# Forest trees (up to depth 15 in the grids) cache each row's node id,
# cheaper than shipping deep trees to executors every level; measured
# 19 s vs 25 s for depth 15 x 50 trees at sf0.1.  Shallow GBT trees are
# faster without it (14 s vs 20 s).  Both checkpoint every
# CHECKPOINT_INTERVAL iterations into the session's checkpoint folder (the
# node-id cache, and GBT's running predictions), keeping lineage short.
CHECKPOINT_INTERVAL = 10
# Memory for per-node histograms: more nodes split per pass over the data.
TREE_MEMORY_MB = 512


def logistic_regression(weight_col: str | None = WEIGHT_COL, features_col: str = "normFeatures",
                        label: str = "label", max_iter: int = 10, reg_param: float = 0.3,
                        elastic_net: float = 0.0, **kw) -> LogisticRegression:
    """Weighted logistic regression, elastic net (M1); base maxIter 10, regParam 0.3."""
    est = LogisticRegression(labelCol=label, featuresCol=features_col, maxIter=max_iter,
                             regParam=reg_param, elasticNetParam=elastic_net, **kw)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def random_forest(weight_col: str | None = WEIGHT_COL, features_col: str = "features",
                  label: str = "label", num_trees: int = 20, max_depth: int = 5, max_bins: int = 32,
                  seed: int = 42, **kw) -> RandomForestClassifier:
    """Weighted random-forest classifier on unscaled features (M2); Spark defaults."""
    est = RandomForestClassifier(labelCol=label, featuresCol=features_col, numTrees=num_trees,
                                 maxDepth=max_depth, maxBins=max_bins, seed=seed, cacheNodeIds=True,
                                 checkpointInterval=CHECKPOINT_INTERVAL, maxMemoryInMB=TREE_MEMORY_MB, **kw)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def gbt_regressor(weight_col: str | None = None, features_col: str = "normFeatures",
                  label: str = "label", max_iter: int = 20, max_depth: int = 5, max_bins: int = 32,
                  step_size: float = 0.1, seed: int = 42, **kw) -> GBTRegressor:
    """Gradient-boosted regression trees on the 0/1 label, squared loss (M4)."""
    est = GBTRegressor(labelCol=label, featuresCol=features_col, maxIter=max_iter, maxDepth=max_depth,
                       maxBins=max_bins, stepSize=step_size, seed=seed, cacheNodeIds=False,
                       checkpointInterval=CHECKPOINT_INTERVAL, maxMemoryInMB=TREE_MEMORY_MB, **kw)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def linear_regression(weight_col: str | None = None, features_col: str = "normFeatures",
                      label: str = "label", max_iter: int = 10, reg_param: float = 0.3,
                      **kw) -> LinearRegression:
    """L2-regularised linear regression (M3); base maxIter 10, regParam 0.3."""
    est = LinearRegression(labelCol=label, featuresCol=features_col, maxIter=max_iter,
                           regParam=reg_param, **kw)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


KINDS = ("logistic", "forest", "gbt", "linear")


def base_estimator(kind: str, weight_col: str | None = None):
    """The estimator each reference model uses (forest reads unscaled features)."""
    if kind == "logistic":
        return logistic_regression(weight_col=weight_col)
    if kind == "forest":
        return random_forest(weight_col=weight_col)
    if kind == "gbt":
        return gbt_regressor(weight_col=weight_col)
    if kind == "linear":
        return linear_regression(weight_col=weight_col)
    raise ValueError(f"unknown model kind {kind!r}; one of {KINDS}")


def staged_estimator(kind: str, features: Sequence[str], weight_col: str | None = None,
                     estimator=None) -> tuple[Pipeline, object]:
    """Assembler (+ min-max scaler unless forest) + estimator, as one Pipeline (T4).

    Returns (pipeline, estimator) so grids can address the estimator's params.
    """
    est = estimator if estimator is not None else base_estimator(kind, weight_col)
    stages = scaling_stages(features, scale=(kind != "forest")) + [est]
    return Pipeline(stages=stages), est
