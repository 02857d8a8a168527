"""End-to-end plans of the reference scripts, Spark-first.

pixels -> drop zero/null bands -> features + label -> drop missing ->
class weights -> key-hash 70/30 split -> persisted train ->
train/validation search and k-fold CV -> best models -> scored test rows ->
one-pass metrics -> summary / explanation tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.operators import metrics as M
from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import staged_estimator
from pixelframe.session import scratch_path
from pixelframe.sources.pixels import FEATURES

CLASSIFIERS = ("logistic", "forest")
REGRESSORS = ("gbt", "linear")
MODEL_NAMES = ("train_validation", "cross_validation")


def prepare(pixels: DataFrame, features: Sequence[str] = FEATURES, label: str = "burned",
            keys: Sequence[str] = ("row_px", "col_px"), weights: bool = True) -> DataFrame:
    """The shared preparation of every reference script."""
    df = prep.drop_zero_or_null(pixels, features)
    df = prep.select_features(df, features, label=label, keep=list(keys))
    df = prep.drop_missing(df, list(features) + ["label"])
    return prep.with_class_weight(df) if weights else df


def rows_per_task(kind: str) -> int:
    """Training rows of a task in fits of ``kind``."""
    return prep.BOOSTED_ROWS_PER_TASK if kind == "gbt" else prep.ROWS_PER_TASK


def stored_rows(df: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES, split: float = 0.7,
                weights: bool = True, per_task: int = prep.ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """Prepared rows without weights (``prepare(weights=False)``) stored once, and the
    number of tasks for fits on their training part.  Class ratio and row counts are
    one aggregate over the stored rows; the input is read and prepared once."""
    data, stats = prep.stored_with_stats(df, scratch_path(df.sparkSession, "prepared"), features, keys=keys, fraction=split)
    if weights:
        data = prep.with_class_weight(data, ratio=stats["all"].balancing_ratio)
    return data, prep.fit_partitions(stats["train"].n_rows, per_task)


@dataclass
class WorkflowResult:
    kind: str
    searches: dict[str, TU.SearchResult]
    scored: dict[str, DataFrame]
    summary: DataFrame
    explanations: dict[str, DataFrame] = field(default_factory=dict)
    per_label: DataFrame | None = None  # classifiers: every label's precision/recall/F1 (D8)
    weighted: DataFrame | None = None  # classifiers: support-weighted F1, precision and recall (A8)


def run_workflow(spark: SparkSession, data: DataFrame, kind: str, keys: Sequence[str],
                 features: Sequence[str] = FEATURES, grids: dict | None = None, k: int | None = None,
                 weight_col: str | None = "auto", split: float = 0.7, parallelism: int = 1,
                 partitions: int | None = None, ledger: str | None = None) -> WorkflowResult:
    """Tune ``kind`` by train/validation search and by k-fold CV, score the
    held-out rows with both best models and summarise them.

    ``weight_col='auto'`` weights the classifiers by class balance and leaves
    the regressors unweighted, as the reference effectively does.  The linear
    model is searched by moments (``plans.gram``), the others by fits, whose
    metrics are kept under ``ledger`` if given, so that a stopped search goes on.
    """
    grids = grids or TU.GRIDS[kind]
    k = k or TU.FOLDS[kind]
    if weight_col == "auto":
        weight_col = prep.WEIGHT_COL if kind in CLASSIFIERS else None
    train, test = prep.hash_split(data, keys, split)
    if kind == "linear" and weight_col is None:
        searches = dict(zip(MODEL_NAMES, TU.moment_searches(train, features, keys, grids, k)))
        return _finish(spark, kind, searches, test, keys, features)
    train = prep.by_key(train, keys, partitions, rows_per_task(kind)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pipe, est = staged_estimator(kind, features, weight_col)
        classifier = kind in CLASSIFIERS
        evaluator = TU.auc_evaluator() if classifier else TU.rmse_evaluator()
        tvs = TU.train_validation_search(pipe, TU.param_grid(est, grids["tvs"]), evaluator, train, keys,
                                         TU.TRAIN_RATIO, parallelism, ledger=ledger)
        cv = TU.cross_validation_search(pipe, TU.param_grid(est, grids["cv"]), evaluator, train, keys, k,
                                        parallelism, ledger=ledger)
    finally:
        train.unpersist()
    return _finish(spark, kind, dict(zip(MODEL_NAMES, (tvs, cv))), test, keys, features)


def _finish(spark: SparkSession, kind: str, searches: dict[str, TU.SearchResult], test: DataFrame,
            keys: Sequence[str], features: Sequence[str]) -> WorkflowResult:
    """Scores of the held-out rows under both best models, their metrics and explanations."""
    classifier = kind in CLASSIFIERS
    test = test.persist(StorageLevel.MEMORY_AND_DISK)  # prepared once, read by both models
    try:
        scored = {name: RP.score(s.best_model, test, keep=list(keys), vector="features") for name, s in searches.items()}
        if classifier:
            counts = {n: M.outcome_counts(df, RP.positive_score()) for n, df in scored.items()}
        else:
            rows = [(n, *M.regression_metrics(df).first()) for n, df in scored.items()]
    finally:
        test.unpersist()
    explanations = {}
    for name, s in searches.items():
        table = (RP.coefficients(spark, s.best_model, features) if kind in ("logistic", "linear")
                 else RP.importances(spark, s.best_model, features))
        explanations[name] = RP.rank_features(table)
    if not classifier:
        summary = spark.createDataFrame(rows, "model STRING, rmse DOUBLE, r2 DOUBLE, mae DOUBLE, n_rows LONG")
        return WorkflowResult(kind, searches, scored, summary, explanations)
    parts = [M.label_metrics_from_counts(c).select(F.lit(n).alias("model"), "*") for n, c in counts.items()]
    per_label = parts[0].unionByName(parts[1])
    return WorkflowResult(kind, searches, scored, M.summary_from_counts(counts), explanations, per_label,
                          M.weighted_from_labels(per_label, "model"))
