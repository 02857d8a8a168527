"""Hyper-parameter search: de-duplicated grids, deterministic train/validation
search and k-fold cross-validation on a key-hash fold column.

Candidate fits are ordinary distributed Spark ML fits; only the parameter
maps and one metric per map live on the driver.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import BoundedSemaphore
from typing import Any, Callable, Sequence

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.base import Predictor
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.operators.prep import hash_split, with_fold
from pixelframe.plans import forests, gram
from pixelframe.plans.ledger import Ledger, search_id
from pixelframe.plans.selection import evaluate_maps, one_pass


# --- fixed values -----------------------------------------------------------
# The reference's search grids (duplicates removed by ``param_grid``).
GRIDS: dict[str, dict[str, dict[str, list]]] = {
    "logistic": {
        "tvs": {"regParam": [0.01, 0.1, 0.3], "elasticNetParam": [0.0, 0.5, 1.0]},
        "cv": {"regParam": [0.01, 0.1, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0],
               "maxIter": [50, 100]},
    },
    "forest": {
        "tvs": {"maxDepth": [5, 10], "numTrees": [20, 50]},
        "cv": {"maxDepth": [5, 10, 15], "numTrees": [10, 30, 50]},
    },
    "gbt": {
        "tvs": {"maxDepth": [2, 3], "maxBins": [5, 10], "minInfoGain": [0.0]},
        "cv": {"maxDepth": [2], "maxBins": [10], "minInfoGain": [0.0]},
    },
    "linear": {
        "tvs": {"maxIter": [2, 3], "regParam": [0.01, 0.03]},
        "cv": {"maxIter": [2, 3], "regParam": [0.01, 0.03]},
    },
}
FOLDS = {"logistic": 5, "forest": 3, "gbt": 3, "linear": 3}
TRAIN_RATIO = 0.8
# ---------------------------------------------------------------------------
# Candidate fits run concurrently (each is itself a distributed job).
PARALLELISM = 4
# Rounds of tasks that the fits that run concurrently have together, at most.
WAVES = 8
#: Penalty of a map that names none (the reference's base estimator).
REG_PARAM = 0.3


def param_grid(est: Estimator, grid: dict[str, Sequence[Any]]) -> list[dict[Param, Any]]:
    """Cartesian grid over ``{param name: values}`` with duplicate values removed."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        seen: list[Any] = []
        for v in values:
            if v not in seen:
                seen.append(v)
        b = b.addGrid(est.getParam(name), seen)
    return b.build()


def grid_rows(maps: list[dict[Param, Any]]) -> list[dict[str, Any]]:
    return [{p.name: v for p, v in m.items()} for m in maps]


def auc_evaluator(label: str = "label", raw: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Selection metric for classifiers (U4): area under ROC, from all scores (no bins)."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=0)


def rmse_evaluator(label: str = "label", prediction: str = "prediction") -> RegressionEvaluator:
    """Selection metric for regressors (U4): RMSE, smaller is better."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


@dataclass
class SearchResult:
    method: str
    best_model: Model
    maps: list[dict[Param, Any]]
    metrics: list[float]
    larger_better: bool
    extra: dict[str, Any] = field(default_factory=dict)

    @property
    def best_index(self) -> int:
        """First best map on ties (O2)."""
        best = None
        for i, m in enumerate(self.metrics):
            if best is None or (m > self.metrics[best] if self.larger_better else m < self.metrics[best]):
                best = i
        return best if best is not None else 0

    def metrics_frame(self, spark: SparkSession) -> DataFrame:
        """One row per parameter map: map_id, params (as text), metric, is_best."""
        bi = self.best_index
        rows = [(i, self.method, ", ".join(f"{k}={v}" for k, v in sorted(grid_rows([m])[0].items())),
                 float(v), i == bi) for i, (m, v) in enumerate(zip(self.maps, self.metrics))]
        return spark.createDataFrame(rows, "map_id INT, method STRING, params STRING, metric DOUBLE, is_best BOOLEAN")


def _persist(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def _shared_prefix(est: Estimator, maps: list[dict[Param, Any]]):
    """(prefix pipeline, last stage) when every searched param belongs to the
    last stage of a Pipeline, else (None, est)."""
    if isinstance(est, Pipeline):
        stages = est.getStages()
        if len(stages) > 1:
            last = stages[-1]
            if all(p.parent == last.uid for m in maps for p in m):
                return Pipeline(stages=stages[:-1]), last
    return None, est


def _transformed(prefix: Model, last: Estimator, evaluator: Evaluator, rows: DataFrame) -> DataFrame:
    """Rows as the last stage reads them: without the columns that only the stages before it need."""
    out = prefix.transform(rows)
    return out.select(*_read_by([last], evaluator, out))


def _alike(maps: list[dict[Param, Any]], but: str = "maxIter") -> list[list[int]]:
    """Numbers of the maps that differ in the parameter ``but`` alone, together, its smallest value first."""
    groups: dict[tuple, list[tuple[int, int]]] = {}
    for i, m in enumerate(maps):
        key = tuple(sorted((p.parent, p.name, repr(v)) for p, v in m.items() if p.name != but))
        groups.setdefault(key, []).append((next((v for p, v in m.items() if p.name == but), 0), i))
    return [[i for _, i in sorted(g)] for g in groups.values()]


def _settled(model: Model) -> bool:
    """Whether the fit stopped by itself before its iterations were used up: with
    more of them it takes the same steps and gives the same model."""
    return bool(getattr(model, "hasSummary", False)) and len(model.summary.objectiveHistory) - 1 < model.getOrDefault("maxIter")


_KNOWN_STAGES = (VectorAssembler, MinMaxScaler, Predictor)


def _read_by(stages: Sequence, evaluator: Evaluator, rows: DataFrame) -> list[str]:
    """The columns of ``rows`` that the stages and the evaluator name; all of them
    with a stage that may read others."""
    if not all(isinstance(s, _KNOWN_STAGES) for s in stages):
        return rows.columns
    named: set[str] = set()
    for s in (*stages, evaluator):
        for p, v in s.extractParamMap().items():
            named.update([v] if p.name.endswith("Col") else v if p.name.endswith("Cols") else ())
    return [c for c in rows.columns if c in named]


def fits_at_once(fit_part: DataFrame, parallelism: int) -> int:
    """As many of ``parallelism`` fits as have ``WAVES`` rounds of tasks together.  Fits
    side by side fill the gaps between small stages; one whose stages fill all cores
    for longer gains nothing, and each holds all rows a second time while it runs."""
    tasks = fit_part._jdf.rdd().getNumPartitions()
    return max(1, min(parallelism, WAVES * fit_part.sparkSession.sparkContext.defaultParallelism // max(tasks, 1)))


def _light(est: Estimator, rows: DataFrame) -> Estimator:
    """``est`` with forests that do not keep the node of every row and tree where a
    fit fills all cores by itself (``fits_at_once``): the same model.  That cache is
    held twice and checkpointed, on such tables several times the rows themselves."""
    stages = est.getStages() if isinstance(est, Pipeline) else [est]
    caches = {s.cacheNodeIds: False for s in stages if isinstance(s, RandomForestClassifier)}
    return est.copy(caches) if caches and fits_at_once(rows, 2) == 1 else est


def _side_by_side(spark: SparkSession, calls: Sequence[Callable[[], Any]], at_once: int) -> list:
    """Results of ``calls``, ``at_once`` of them at a time."""
    if at_once <= 1 or len(calls) <= 1:
        return [f() for f in calls]
    # each task carries the caller's Spark thread-local properties, as
    # Spark's own tuners do in pinned-thread mode
    wrap = inheritable_thread_target(spark)
    with ThreadPool(min(at_once, len(calls))) as pool:
        return pool.map(lambda f: f(), [wrap(f) for f in calls], chunksize=1)


def _fit(est: Estimator, maps: list[dict[Param, Any]], fit_part: DataFrame, parallelism: int,
         slots: BoundedSemaphore | None = None) -> list[Model]:
    """One model per map; up to ``parallelism`` fits at a time, each a distributed job,
    and no more than there are free ``slots`` of the whole search.  A fit that has
    ``_settled`` also stands for the maps that only allow it more iterations, a
    forest for those that only allow it less depth (``plans.forests``)."""
    models: list[Model] = [None] * len(maps)
    forest = isinstance(est, RandomForestClassifier)

    def fit(group: list[int]) -> None:
        model = None
        for i in group:
            if forest and model is not None and forests.holds(est, maps[i], model):
                models[i] = forests.cut(est, maps[i], model)
                continue
            if forest or model is None or not _settled(model):
                with slots or nullcontext():
                    model = est.fit(fit_part, maps[i])
            models[i] = model

    groups = [g[::-1] for g in _alike(maps, "maxDepth")] if forest else _alike(maps)
    at_once = fits_at_once(fit_part, parallelism) if parallelism > 1 else 1
    _side_by_side(fit_part.sparkSession, [lambda g=g: fit(g) for g in groups], at_once)
    return models


def _evaluate(est: Estimator, maps: list[dict[Param, Any]], evaluator: Evaluator, fit_part: DataFrame,
              val_part: DataFrame, parallelism: int, ledger: Ledger | None = None, fold: int = 0,
              slots: BoundedSemaphore | None = None) -> list[float]:
    """One metric per map, all maps evaluated in one pass over ``val_part`` where
    the metric allows it.  With a ledger, ``parallelism`` maps are fitted,
    evaluated and noted at a time, and those it knows are left out."""
    found: dict[int, float] = {}
    todo = list(range(len(maps))) if ledger is None else ledger.missing(fold, range(len(maps)))
    step = max(parallelism, 1) if ledger is not None else max(len(todo), 1)
    for at in range(0, len(todo), step):
        some = todo[at:at + step]
        models = _fit(est, [maps[i] for i in some], fit_part, parallelism, slots)
        each = {id(m): m for m in models}  # a model that stands for several maps is evaluated once
        if one_pass(evaluator) and not isinstance(est, Pipeline):
            values = evaluate_maps(list(each.values()), val_part, evaluator)
        else:
            values = [evaluator.evaluate(m.transform(val_part)) for m in each.values()]
        value = dict(zip(each, values))
        new = {i: value[id(m)] for i, m in zip(some, models)}
        found.update(new)
        if ledger is not None:
            ledger.append(fold, new)
    return [found[i] for i in range(len(maps))] if ledger is None else ledger.metrics(fold, len(maps))


def _ledger(path: str | None, est, maps, train: DataFrame, evaluator: Evaluator, settings: Sequence) -> Ledger | None:
    if path is None:
        return None
    settings = [*settings, type(evaluator).__name__, evaluator.getMetricName()]
    return Ledger(train.sparkSession, path, search_id(est, maps, train, settings))


def train_validation_search(est: Estimator, maps: list[dict[Param, Any]], evaluator: Evaluator,
                            train: DataFrame, key_cols: Sequence[str], train_ratio: float = 0.8,
                            parallelism: int = 1, offset: int = 9,
                            share_prefix: bool = True, ledger: str | None = None) -> SearchResult:
    """Train/validation search then refit on all training rows.

    The fit/validation cut is a key hash (digits ``offset..offset+3``), so
    it does not depend on partitioning.  All maps are fitted on the fit part,
    scored on the validation part, and the best map is refitted (whole
    pipeline) on all of ``train``.  With ``share_prefix`` the parameter-free
    stages of a Pipeline (assembler, scaler) are fitted once on the fit part
    instead of once per map: same result, one pass less per map.  ``ledger``:
    a shared folder for the metrics of finished fits; a search that is started
    again with it fits only the rest.
    """
    est = _light(est, train)
    notes = _ledger(ledger, est, maps, train, evaluator, ["tvs", train_ratio, offset, *key_cols])
    res = SearchResult("train_validation", None, maps, [], evaluator.isLargerBetter())
    if notes is not None and not notes.missing(0, range(len(maps))):
        res.metrics = notes.metrics(0, len(maps))
    else:
        fit_part, val_part = hash_split(train, key_cols, train_ratio, offset=offset)
        prefix, last = _shared_prefix(est, maps) if share_prefix else (None, est)
        if prefix is not None:
            prefix_model = prefix.fit(fit_part)
            fit_part, val_part = (_transformed(prefix_model, last, evaluator, p) for p in (fit_part, val_part))
        # When the caller already persisted ``train`` and nothing was added to
        # the rows, the parts are cheap filters of that cache; persisting them
        # too would hold the data twice.
        own = prefix is not None or not train.is_cached
        if own:
            fit_part, val_part = _persist(fit_part), _persist(val_part)
        try:
            res.metrics = _evaluate(last, maps, evaluator, fit_part, val_part, parallelism, notes)
        finally:
            if own:
                fit_part.unpersist()
                val_part.unpersist()
    res.best_model = est.fit(train, maps[res.best_index])
    return res


def cross_validation_search(est: Estimator, maps: list[dict[Param, Any]], evaluator: Evaluator,
                            train: DataFrame, key_cols: Sequence[str], k: int,
                            parallelism: int = 1, ledger: str | None = None) -> SearchResult:
    """k-fold CV on a key-hash fold column, then refit.

    The folds are computed once, with the persisted rows.  Per fold, the
    parameter-free stages of a Pipeline are fitted once on the other folds;
    all maps are fitted on these transformed rows and scored on the fold's, in
    one pass.  Metrics are those of ``CrossValidator`` on the same fold column,
    whose every fit repeats the stages.  ``ledger`` as in
    ``train_validation_search``.
    """
    est = _light(est, train)
    notes = _ledger(ledger, est, maps, train, evaluator, ["cv", k, *key_cols])
    prefix, last = _shared_prefix(est, maps)
    stages = est.getStages() if isinstance(est, Pipeline) else [est]
    folded = _persist(with_fold(train, key_cols, k, col="fold").select(*_read_by(stages, evaluator, train), "fold"))

    def metrics_of(i: int) -> list[float]:
        if notes is not None and not notes.missing(i, range(len(maps))):
            return notes.metrics(i, len(maps))
        fit_part, val_part = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
        if prefix is not None:
            fitted = prefix.fit(fit_part)
            fit_part, val_part = (_persist(_transformed(fitted, last, evaluator, p)) for p in (fit_part, val_part))
        try:
            return _evaluate(last, maps, evaluator, fit_part, val_part, parallelism, notes, i, slots)
        finally:
            if prefix is not None:
                fit_part.unpersist()
                val_part.unpersist()

    try:
        at_once = fits_at_once(folded, parallelism) if parallelism > 1 else 1
        slots = BoundedSemaphore(at_once)
        # two folds of forests at a time where several fits are: their evaluation is long and leaves
        # cores idle, so one fold is evaluated while the next is fitted
        folds = min(at_once, 2) if isinstance(last, RandomForestClassifier) and notes is None else 1
        each = _side_by_side(train.sparkSession, [lambda i=i: metrics_of(i) for i in range(k)], folds)
        sums = [sum(v[j] for v in each) for j in range(len(maps))]
    finally:
        folded.unpersist()
    res = SearchResult("cross_validation", None, maps, [v / k for v in sums], evaluator.isLargerBetter(), {"k": k})
    res.best_model = est.fit(train, maps[res.best_index])
    return res


def moment_searches(train: DataFrame, features: Sequence[str], key_cols: Sequence[str], grids: dict[str, dict[str, list]],
                    k: int, train_ratio: float = TRAIN_RATIO) -> tuple[SearchResult, SearchResult]:
    """Train/validation search and k-fold CV of the ridge model from moments:
    one aggregate each, no fits (``plans.gram``).  Metrics are those of the two
    searches above with ``LinearRegression``; ``maxIter`` has no effect there."""
    est = LinearRegression()
    out = []
    for method, grid in (("train_validation", grids["tvs"]), ("cross_validation", grids["cv"])):
        maps = param_grid(est, grid)
        regs = [float(m.get(est.regParam, REG_PARAM)) for m in maps]
        if method == "train_validation":
            metrics, parts = gram.train_validate(train, features, regs, key_cols, train_ratio)
        else:
            metrics, parts = gram.cross_validate(train, features, regs, key_cols, k)
        res = SearchResult(method, None, maps, metrics, False, {} if method == "train_validation" else {"k": k})
        res.best_model = gram.refit(parts, regs[res.best_index], features)
        out.append(res)
    return out[0], out[1]
