import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.tuning import CrossValidator

from conftest import SF_SMALL
from pixelframe.operators import features as FT
from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import staged_estimator
from pixelframe.plans.queries_prep import prepared, weighted
from pixelframe.plans.workflows import run_workflow
from pixelframe.sources.pixels import FEATURES
from pixelframe.sources.testdata import F2_KEYS


def test_grid_dedup_reference_cv_grid(spark):
    _, est = staged_estimator("logistic", FEATURES, prep.WEIGHT_COL)
    maps = TU.param_grid(est, TU.GRIDS["logistic"]["cv"])
    assert len(maps) == 18  # the reference grid has 24 maps, 6 of them duplicates
    assert len({tuple(sorted((p.name, v) for p, v in m.items())) for m in maps}) == 18


def test_scaler_constant_column_and_no_clipping(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE")
    test = spark.createDataFrame([(5.0, 7.0)], "a DOUBLE, b DOUBLE")
    m = FT.fit_scaler(train, ["a", "b"])
    r = FT.vector_columns(m.transform(test), "normFeatures", ["a", "b"]).first()
    assert (r.a, r.b) == (2.0, 0.5)


def test_bare_stage_equals_pipeline(spark):
    # Scoring pre-scaled rows with the last stage equals the pipeline
    train, test = prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, _ = staged_estimator("logistic", FEATURES, prep.WEIGHT_COL)
    model = pipe.fit(train)
    scaled = model.stages[1].transform(model.stages[0].transform(test))
    a = RP.score(model.stages[-1], scaled, keep=F2_KEYS).select(*F2_KEYS, "prediction")
    b = RP.score(model, test, keep=F2_KEYS).select(*F2_KEYS, "prediction")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_forest_learns_signal(spark):
    train, test = prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, _ = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    model = pipe.fit(train)
    from pixelframe.operators.metrics import auc_roc
    auc = auc_roc(RP.score(model, test), score=RP.positive_score()).first().auc
    assert auc > 0.9
    imp = {r.feature: r.importance for r in RP.importances(spark, model, FEATURES).collect()}
    assert sum(imp.values()) == pytest.approx(1.0)
    assert imp["lst"] + imp["humidity"] > 0.8


def test_rank_features_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "feature STRING, abs_importance DOUBLE")
    assert [r.feature for r in RP.rank_features(df).orderBy("rank").collect()] == ["c", "a", "b"]


def test_best_params_first_on_ties(spark):
    m = spark.createDataFrame([(0, 0.3), (1, 0.2), (2, 0.2)], "map_id INT, metric DOUBLE")
    assert RP.best_params(m, larger_better=False).first().map_id == 1
    assert RP.best_params(m, larger_better=True).first().map_id == 0


def test_cv_search_is_reproducible_across_partitionings(spark):
    train, _ = prep.hash_split(prepared(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, est = staged_estimator("linear", FEATURES)
    maps = TU.param_grid(est, TU.GRIDS["linear"]["cv"])
    a = TU.cross_validation_search(pipe, maps, TU.rmse_evaluator(), train, F2_KEYS, 3)
    b = TU.cross_validation_search(pipe, maps, TU.rmse_evaluator(), train.repartition(5), F2_KEYS, 3)
    assert a.metrics == pytest.approx(b.metrics, rel=1e-9)
    assert 0 <= a.best_index < len(maps)


def test_tvs_search_and_workflow(spark):
    res = run_workflow(spark, prepared(spark, SF_SMALL), "linear", F2_KEYS)
    s = {r.model: r for r in res.summary.collect()}
    assert set(s) == {"train_validation", "cross_validation"}
    assert all(0 < r.rmse < 1 for r in s.values())
    ranks = [r.rank for r in res.explanations["cross_validation"].collect()]
    assert sorted(ranks) == list(range(1, 9))


def test_classifier_workflow_reports_every_label(spark):
    grids = {"tvs": {"regParam": [0.01]}, "cv": {"regParam": [0.01, 0.1]}}
    res = run_workflow(spark, weighted(spark, SF_SMALL), "logistic", F2_KEYS, grids=grids, k=2)
    labels = {(r.model, r.label) for r in res.per_label.collect()}
    assert labels == {(m, l) for m in ("train_validation", "cross_validation") for l in (0.0, 1.0)}
    s = {r.model: r for r in res.summary.collect()}
    assert all(0.5 < r.auc <= 1.0 for r in s.values())
    w = {r.model: r.weighted_f1 for r in res.weighted.collect()}
    for name, scored in res.scored.items():
        assert w[name] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(scored))
        assert "features" in scored.columns


def test_tvs_shared_prefix_equals_full_pipeline(spark):
    train, _ = prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, est = staged_estimator("logistic", FEATURES, prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"regParam": [0.01, 0.3], "elasticNetParam": [0.0, 1.0]})
    assert TU._shared_prefix(pipe, maps)[0] is not None
    a = TU.train_validation_search(pipe, maps, TU.auc_evaluator(), train, F2_KEYS, share_prefix=True)
    b = TU.train_validation_search(pipe, maps, TU.auc_evaluator(), train, F2_KEYS, share_prefix=False)
    assert a.metrics == pytest.approx(b.metrics, abs=1e-12)
    assert a.best_index == b.best_index


@pytest.mark.parametrize("kind", ["logistic", "linear"])
def test_cv_equals_cross_validator_and_fits_the_scaler_per_fold(spark, kind, monkeypatch):
    train, _ = prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, est = staged_estimator(kind, FEATURES, prep.WEIGHT_COL if kind == "logistic" else None)
    maps = TU.param_grid(est, {"regParam": [0.01, 0.3]})
    ev = TU.auc_evaluator() if kind == "logistic" else TU.rmse_evaluator()
    folded = prep.with_fold(train, F2_KEYS, 3).cache()
    want = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, numFolds=3, foldCol="fold").fit(folded).avgMetrics
    fits, plain = [], MinMaxScaler._fit
    monkeypatch.setattr(MinMaxScaler, "_fit", lambda self, data: (fits.append(1), plain(self, data))[1])
    got = TU.cross_validation_search(pipe, maps, ev, train, F2_KEYS, 3, parallelism=2)
    assert got.metrics == pytest.approx(list(want), abs=1e-9)
    assert len(fits) == 3 + 1


def test_forest_is_the_same_from_any_partitions(spark):
    train, _ = prep.hash_split(weighted(spark, SF_SMALL), F2_KEYS, 0.7)
    pipe, _ = staged_estimator("forest", FEATURES, prep.WEIGHT_COL)
    found = {tuple(pipe.fit(prep.by_key(train.repartition(n), F2_KEYS)).stages[-1].featureImportances.toArray()) for n in (1, 3, 9)}
    assert len(found) == 1
