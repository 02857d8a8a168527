"""Searches by moments, one-pass evaluation, dealing by rows, resumable searches."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import LinearRegression

from conftest import SF_SMALL
from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.operators.metrics import auc_by, auc_roc
from pixelframe.plans import forests, gram
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import linear_regression, staged_estimator
from pixelframe.plans.queries_prep import prepared, weighted
from pixelframe.plans.selection import evaluate_maps, map_scores, one_pass
from pixelframe.sources.pixels import FEATURES
from pixelframe.sources.testdata import F2_KEYS


@pytest.fixture(scope="module")
def train(spark):
    return prep.hash_split(prepared(spark, SF_SMALL), F2_KEYS, 0.7)[0].cache()


@pytest.fixture(scope="module")
def weighted_train(spark):
    return prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)[0].cache()


@pytest.mark.parametrize("scaled", [True, False])
def test_moment_searches_equal_fits(spark, train, scaled):
    regs = [0.0, 0.01, 0.3, 5.0]
    pipe, est = staged_estimator("linear" if scaled else "forest", FEATURES,
                                 estimator=linear_regression(features_col="normFeatures" if scaled else "features"))
    maps = TU.param_grid(est, {"regParam": regs})
    cv = TU.cross_validation_search(pipe, maps, TU.rmse_evaluator(), train, F2_KEYS, 3)
    tvs = TU.train_validation_search(pipe, maps, TU.rmse_evaluator(), train, F2_KEYS)
    got_cv, folds = gram.cross_validate(train, FEATURES, regs, F2_KEYS, 3)
    got_tvs, parts = gram.train_validate(train, FEATURES, regs, F2_KEYS)
    assert got_cv == pytest.approx(cv.metrics, abs=1e-9) and got_tvs == pytest.approx(tvs.metrics, abs=1e-9)
    reg = regs[cv.best_index]
    want = cv.best_model.stages[-1]
    for model in (gram.refit(folds, reg, FEATURES), gram.refit(parts, reg, FEATURES)):
        assert np.allclose(model.coefficients if scaled else model.raw, want.coefficients, atol=1e-8)
        assert (model.intercept if scaled else model.raw_intercept) == pytest.approx(want.intercept, abs=1e-8)


def test_moments_scan_once(train, spark):
    rows = prep.hash_split(prepared(spark, SF_SMALL), F2_KEYS, 0.7)[0]
    table = gram.moments(prep.with_fold(rows, F2_KEYS, 3, col="part"), FEATURES)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_moments_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, 1e6 + float(a), 7.0, float(b), float(2 * a - b + 1)) for i, (a, b) in enumerate(rng.standard_normal((60, 2)))]
    df = spark.createDataFrame(rows, "k INT, a DOUBLE, same DOUBLE, b DOUBLE, label DOUBLE")
    metrics, parts = gram.cross_validate(df, ["a", "same", "b"], [0.0], ["k"], 4)
    model = gram.refit(parts, 0.0, ["a", "same", "b"])
    assert metrics[0] < 1e-5 and np.allclose(model.raw, [2, 0, -1], atol=1e-8)  # far from the origin, one constant
    assert model.transform(df).selectExpr("max(abs(prediction - label))").first()[0] < 1e-6
    flat = df.selectExpr("k", "a", "5.0D AS label")
    assert gram.cross_validate(flat, ["a"], [0.1], ["k"], 4)[0] == [0.0]
    twins = df.selectExpr("k", "a", "a AS b", "a AS label")
    assert gram.cross_validate(twins, ["a", "b"], [0.0], ["k"], 4)[0][0] < 1e-5
    with pytest.raises(ValueError):
        gram.cross_validate(df.limit(1), ["a"], [0.1], ["k"], 4)


def test_workflow_by_moments(spark, train):
    tvs, cv = TU.moment_searches(train, FEATURES, F2_KEYS, TU.GRIDS["linear"], 3)
    pipe, est = staged_estimator("linear", FEATURES)
    want = TU.cross_validation_search(pipe, TU.param_grid(est, TU.GRIDS["linear"]["cv"]), TU.rmse_evaluator(), train, F2_KEYS, 3)
    assert cv.metrics == pytest.approx(want.metrics, abs=1e-9) and cv.best_index == want.best_index
    a = RP.score(cv.best_model, train, keep=F2_KEYS, vector="features")
    b = RP.score(want.best_model, train, keep=F2_KEYS).withColumnRenamed("prediction", "other")
    assert a.join(b, F2_KEYS).selectExpr("max(abs(prediction - other))").first()[0] < 1e-9
    assert [r.feature for r in RP.rank_features(RP.coefficients(spark, cv.best_model, FEATURES)).orderBy("rank").collect()] == \
        [r.feature for r in RP.rank_features(RP.coefficients(spark, want.best_model, FEATURES)).orderBy("rank").collect()]


@pytest.mark.parametrize("partitions", [1, 7])
def test_auc_by_equals_auc_of_each(spark, partitions):
    rng = np.random.default_rng(3)
    odd = [None, float("nan"), float("inf"), -0.0, 0.0]
    rows = [(m, float(rng.integers(0, 2)), odd[i] if i < 5 else float(rng.integers(0, 40) if m else rng.random()))
            for m in (0, 1, 2) for i in range(300)]
    rows += [(3, 1.0, 0.1), (3, 1.0, 0.2), (None, 1.0, 0.5), (None, 0.0, 0.4), (4, None, 0.5)]
    df = spark.createDataFrame(rows, "map INT, label DOUBLE, score DOUBLE").repartition(partitions)
    got = {r["map"]: (r["auc"], r["n_pos"], r["n_neg"]) for r in auc_by(df, ["map"]).collect()}
    for m in (0, 1, 2, 3, 4, None):
        own = df.where(f"map <=> {'null' if m is None else m}")
        want = auc_roc(own).first()
        assert got[m][1:] == (want.n_pos, want.n_neg)
        assert got[m][0] == want.auc if want.auc is None else got[m][0] == pytest.approx(want.auc, abs=1e-14)


@pytest.mark.parametrize("kind", ["logistic", "forest", "gbt", "linear"])
def test_one_pass_equals_the_evaluator(weighted_train, kind):
    fit, held = prep.hash_split(weighted_train, F2_KEYS, 0.8, offset=9)
    pipe, est = staged_estimator(kind, FEATURES)
    prefix = type(pipe)(stages=pipe.getStages()[:-1]).fit(fit)
    fit, held = prefix.transform(fit), prefix.transform(held).cache()
    grid = {"maxDepth": [1, 3]} if kind in ("forest", "gbt") else {"regParam": [0.01, 2.0], "elasticNetParam": [0.0, 1.0]}
    models = [est.fit(fit, m) for m in TU.param_grid(est, grid)]
    ev = TU.auc_evaluator() if kind in ("logistic", "forest") else TU.rmse_evaluator()
    assert one_pass(ev)
    want = [ev.evaluate(m.transform(held)) for m in models]
    assert evaluate_maps(models, held, ev) == pytest.approx(want, abs=1e-12)
    assert len(set(want)) > 1
    if kind == "logistic":
        plan = map_scores(models, held, "label")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate explode") == 1 and "Join" not in plan and "Union" not in plan


def test_metrics_without_both_classes_are_nan(weighted_train):
    pipe, est = staged_estimator("logistic", FEATURES)
    prefix = type(pipe)(stages=pipe.getStages()[:-1]).fit(weighted_train)
    rows = prefix.transform(weighted_train)
    assert math.isnan(evaluate_maps([est.fit(rows)], rows.where("label = 0"), TU.auc_evaluator())[0])
    assert not one_pass(TU.auc_evaluator().setMetricName("areaUnderPR"))


@pytest.mark.parametrize("copies", [1, 4])
def test_forest_is_the_same_from_any_partitions_and_tasks_grow(weighted_train, copies):
    rows = weighted_train
    for i in range(1, copies):
        rows = rows.unionByName(weighted_train.withColumn("l_linenumber", weighted_train.l_linenumber + 100 * i))
    n = rows.count()
    pipe, _ = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    dealt = [prep.by_key(rows.repartition(p), F2_KEYS, rows_per_task=200) for p in (1, 3, 9)]
    tasks = {d.rdd.getNumPartitions() for d in dealt}
    assert tasks == {max(prep.FIT_PARTITIONS, -(-n // 200))} and (copies == 1 or max(tasks) > prep.FIT_PARTITIONS)
    found = {tuple(pipe.fit(d).stages[-1].featureImportances.toArray()) for d in dealt}
    assert len(found) == 1


def test_fit_partitions():
    assert [prep.fit_partitions(n) for n in (0, 1, 800_000, 800_001, 10**9)] == [8, 8, 8, 9, 10_000]


def test_boosted_trees_get_larger_tasks(spark, train, monkeypatch):
    """Every level of a boosted tree sends the metrics of all its tasks to the driver."""
    from pixelframe.plans import queries_models as Q
    from pixelframe.plans import workflows as W

    assert [prep.fit_partitions(n, W.rows_per_task("gbt")) for n in (1, 800_001, 88_000_000)] == [8, 8, 88]
    assert {W.rows_per_task(k) for k in ("logistic", "forest", "linear")} == {prep.ROWS_PER_TASK}
    n = train.count()
    monkeypatch.setattr(prep, "FIT_PARTITIONS", 1)
    monkeypatch.setattr(prep, "BOOSTED_ROWS_PER_TASK", n // 2)
    monkeypatch.setattr(prep, "ROWS_PER_TASK", n // 10)
    dealt, deal = [], prep.by_key
    monkeypatch.setattr(prep, "by_key", lambda *a, **k: dealt.append(deal(*a, **k)) or dealt[-1])
    Q._search("gbt", "cv", spark, SF_SMALL)
    assert [d.rdd.getNumPartitions() for d in dealt] == [3]


@pytest.mark.parametrize("method", ["tvs", "cv"])
def test_a_stopped_search_goes_on(spark, train, method, tmp_path, monkeypatch):
    pipe, est = staged_estimator("linear", FEATURES)
    maps = TU.param_grid(est, {"regParam": [0.01, 0.1, 0.3, 1.0]})

    def search(path, rows=train, grid=maps):
        if method == "tvs":
            return TU.train_validation_search(pipe, grid, TU.rmse_evaluator(), rows, F2_KEYS, ledger=path)
        return TU.cross_validation_search(pipe, grid, TU.rmse_evaluator(), rows, F2_KEYS, 3, ledger=path)

    want, fits, plain = search(None), [], LinearRegression._fit
    stop = 3 if method == "tvs" else 6

    def counted(self, data):
        if len(fits) == stop:
            raise RuntimeError("stopped")
        fits.append(1)
        return plain(self, data)

    monkeypatch.setattr(LinearRegression, "_fit", counted)
    path = f"file://{tmp_path}/ledger"
    with pytest.raises(RuntimeError):
        search(path)
    stop, done = None, len(fits)
    fits.clear()
    got = search(path)
    assert got.metrics == want.metrics and got.best_index == want.best_index
    total = len(maps) * (1 if method == "tvs" else 3)
    assert len(fits) == total - done + 1  # the rest, and the refit
    fits.clear()
    assert search(path).metrics == want.metrics and len(fits) == 1  # the refit alone
    fits.clear()
    search(path, rows=train.where("lst > 5"))  # other rows: nothing of the ledger fits
    assert len(fits) == total + 1
    fits.clear()
    search(path, grid=maps[:2])
    assert len(fits) == total // 2 + 1


@pytest.mark.parametrize("method", ["tvs", "cv"])
def test_settled_fits_stand_for_more_iterations(weighted_train, method, monkeypatch):
    """A fit that stops by itself is not repeated with more iterations; one that does not, is."""
    pipe, est = staged_estimator("logistic", FEATURES, prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"regParam": [1.0], "maxIter": [200, 1, 100]})
    rows, plain, fits = weighted_train, LogisticRegression._fit, []
    search = ((lambda m, p: TU.train_validation_search(pipe, m, TU.auc_evaluator(), rows, F2_KEYS, parallelism=p)) if method == "tvs"
              else lambda m, p: TU.cross_validation_search(pipe, m, TU.auc_evaluator(), rows, F2_KEYS, 2, p))
    alone = search(maps[:1], 1).metrics[0]
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, data: fits.append(len(data.columns)) or plain(self, data))
    got = search(maps, 2)
    assert [got.metrics[0], got.metrics[2]] == pytest.approx([alone] * 2, abs=1e-12)
    assert len(fits) == 2 * (1 if method == "tvs" else 2) + 1  # 1 and 100 iterations, not 200, in each part; the refit
    assert set(fits[:-1]) == {3}  # label, weight, normFeatures: nothing else is kept for the fits


@pytest.mark.parametrize("parallelism", [1, 4])
def test_deep_forests_stand_for_shallow_ones(weighted_train, parallelism, monkeypatch):
    """One fit for each number of trees; the metrics are those of a fit for every depth."""
    pipe, est = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"maxDepth": [2, 9, 4], "numTrees": [3, 5]})
    plain, fits = RandomForestClassifier._fit, []
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, data: fits.append(self.getMaxDepth()) or plain(self, data))
    got = TU.cross_validation_search(pipe, maps, TU.auc_evaluator(), weighted_train, F2_KEYS, 2, parallelism)
    assert sorted(fits[:-1]) == [9] * 4 and len(fits) == 5  # two folds; the refit
    monkeypatch.setattr(forests, "holds", lambda *a: False)
    want = TU.cross_validation_search(pipe, maps, TU.auc_evaluator(), weighted_train, F2_KEYS, 2, parallelism)
    assert len(fits) == 5 + 13 and got.metrics == pytest.approx(want.metrics, abs=1e-12) and len(set(want.metrics)) > 3


@pytest.mark.parametrize("depth", [0, 1, 3, 6])
def test_a_cut_forest_is_the_shallow_one(weighted_train, depth):
    pipe, est = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    rows = pipe.getStages()[0].transform(weighted_train).cache()
    trees = {est.numTrees: 6}
    deep, own = est.fit(rows, {est.maxDepth: 8, **trees}), est.fit(rows, {est.maxDepth: depth, **trees})
    got = forests.cut(est, {est.maxDepth: depth, **trees}, deep)
    assert forests.holds(est, {est.maxDepth: depth, **trees}, deep)
    assert [(t.numNodes, t.depth) for t in got.trees] == [(t.numNodes, t.depth) for t in own.trees]
    assert got.uid == own.uid and got.getMaxDepth() == depth and got.getNumTrees == 6
    assert got.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-12)
    a, b = (map_scores([m], rows).toPandas()["score"] for m in (got, own))
    assert np.allclose(a, b, atol=1e-12)
    # not where a level to be split may be several groups of nodes, nor from a shallower forest, nor for other models
    small = {est.maxDepth: 6, **trees, est.maxMemoryInMB: 0}
    assert not forests.holds(est, small, deep) and not forests.holds(est, {est.maxDepth: 9}, deep)
    assert not forests.holds(LogisticRegression(), {}, deep)


def test_fits_at_once_follow_the_tasks(spark, train):
    """Fits whose stages fill all cores by themselves run one at a time: each holds the rows again."""
    cores = spark.sparkContext.defaultParallelism
    got = [TU.fits_at_once(train.repartition(n, "l_orderkey"), 4) for n in (1, 2 * cores, 4 * cores, 8 * cores, 30 * cores)]
    assert got == [4, 4, 2, 1, 1] and TU.fits_at_once(train.repartition(1), 1) == 1


@pytest.mark.parametrize("method", ["tvs", "cv"])
def test_large_forests_keep_no_node_of_every_row(weighted_train, method, monkeypatch):
    """Where a fit fills all cores the node cache, several times the rows on disk, is off: the same metrics."""
    pipe, est = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"maxDepth": [3, 12], "numTrees": [4]})
    rows = prep.by_key(weighted_train, F2_KEYS)
    search = ((lambda: TU.train_validation_search(pipe, maps, TU.auc_evaluator(), rows, F2_KEYS)) if method == "tvs"
              else lambda: TU.cross_validation_search(pipe, maps, TU.auc_evaluator(), rows, F2_KEYS, 2))
    plain, caches = RandomForestClassifier._fit, []
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, data: caches.append(self.getCacheNodeIds()) or plain(self, data))
    want = search()
    assert set(caches) == {True}
    caches.clear()
    monkeypatch.setattr(TU, "WAVES", 1)
    got = search()
    assert set(caches) == {False} and len(caches) == (2 if method == "tvs" else 3)
    assert got.metrics == pytest.approx(want.metrics, abs=1e-12)
    assert got.best_model.stages[-1].totalNumNodes == want.best_model.stages[-1].totalNumNodes
    assert pipe.getStages()[-1].getCacheNodeIds()


def test_last_stage_as_columns_equals_the_pipeline(spark, train):
    test = prep.hash_split(prepared(spark, SF_SMALL), F2_KEYS, 0.7)[1]
    pipe, _ = staged_estimator("linear", FEATURES)
    constant = train.withColumn("precip", train.precip * 0 + 3)
    model = pipe.fit(constant)
    scaled = RP.scale_columns(model.stages[1], test, FEATURES)
    mine = RP.score_columns(model.stages[-1], scaled, [f"scaled_{c}" for c in FEATURES]).select(*F2_KEYS, "prediction")
    other = RP.score(model, test, keep=F2_KEYS).withColumnRenamed("prediction", "other").drop("label")
    joined = mine.join(other, F2_KEYS)
    assert joined.count() == test.count() and joined.selectExpr("max(abs(prediction - other))").first()[0] < 1e-12
