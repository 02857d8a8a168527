import random

import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.sql import functions as F

from pixelframe.operators import metrics as M


def counts(spark, tp, fp, tn, fn):
    return spark.createDataFrame([(tp, fp, tn, fn)], "tp LONG, fp LONG, tn LONG, fn LONG")


@pytest.mark.parametrize("cm,expected", [
    # the reference's printed confusion counts and summaries (TVS and CV rows)
    ((77105, 397826, 1095210, 26842), (0.1623, 0.7418, 0.2664, 0.7341)),
    ((77837, 367393, 1125643, 26110), (0.1748, 0.7488, 0.2835, 0.7536)),
])
def test_binary_metrics_reproduce_reference_summary(spark, cm, expected):
    r = M.metrics_from_counts(counts(spark, *cm)).first()
    assert tuple(round(v, 4) for v in (r.precision, r.recall, r.f1, r.accuracy)) == expected


def test_zero_guards(spark):
    r = M.metrics_from_counts(counts(spark, 0, 0, 5, 0)).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.0, 0.0, 0.0, 1.0)
    r = M.metrics_from_counts(counts(spark, 0, 0, 0, 0)).first()
    assert r.accuracy == 0.0


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        label = float(rnd.random() < 0.3)
        score = round(rnd.gauss(1.0 if label else 0.0, 1.0), 1)  # rounded: many ties
        rows.append((i, label, float(score > 0.5), score, score / 3))
    return spark.createDataFrame(rows, "id INT, label DOUBLE, prediction DOUBLE, score DOUBLE, reg DOUBLE")


def test_confusion_sums_to_n(scored):
    c = M.confusion(scored).first()
    assert c.tp + c.fp + c.tn + c.fn == 3000


def test_auc_matches_exact_evaluator_with_ties(spark, scored):
    ours = M.auc_roc(scored, score="score").first().auc
    from pyspark.ml.linalg import Vectors, VectorUDT
    to_vec = F.udf(lambda s: Vectors.dense([-s, s]), VectorUDT())
    raw = scored.withColumn("rawPrediction", to_vec("score"))
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    assert ours == pytest.approx(ev.evaluate(raw), abs=1e-12)
    assert 0.0 <= ours <= 1.0


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_auc_odd_scores_under_any_partitions(spark, partitions):
    # null ranks below every number, NaN above; equal ones tie; no labelled row is lost
    nan, inf = float("nan"), float("inf")
    scores = [None, None, -inf, -1.0, 0.0, -0.0, 0.5, 0.5, 0.5, 2.0, inf, nan, nan, None, 0.25]
    rows = [(float(i % 3 == 0), x) for i, x in enumerate(scores)]
    key = lambda x: (0, 0.0) if x is None else (2, 0.0) if x != x else (1, x + 0.0)
    pos, neg = [key(x) for y, x in rows if y], [key(x) for y, x in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(rows, "label DOUBLE, score DOUBLE").repartition(min(partitions, 16))
        r = M.auc_roc(df).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert (r.n_pos, r.n_neg) == (len(pos), len(neg)) and r.n_pos + r.n_neg == len(rows)
    assert r.auc == pytest.approx(want, abs=1e-12)


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "label DOUBLE, prediction DOUBLE")
    assert M.r2(df).first().r2 is None
    assert M.regression_metrics(df).first().r2 is None and M.rmse(df).first().rmse > 0


def test_auc_undefined_for_one_class(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.4)], "label DOUBLE, score DOUBLE")
    assert M.auc_roc(df).first().auc is None


def test_label_metrics_and_weighted_f1_match_evaluator(scored):
    lm = {r.label: r for r in M.label_metrics(scored).collect()}
    for lab in (0.0, 1.0):
        for metric, field in (("precisionByLabel", "precision"), ("recallByLabel", "recall"),
                              ("fMeasureByLabel", "f1")):
            ev = MulticlassClassificationEvaluator(metricName=metric, metricLabel=lab)
            assert getattr(lm[lab], field) == pytest.approx(ev.evaluate(scored), abs=1e-12)
    wf = M.weighted_f1(scored).first()
    assert wf.weighted_f1 == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(scored))
    assert wf.weighted_precision == pytest.approx(
        MulticlassClassificationEvaluator(metricName="weightedPrecision").evaluate(scored))


def test_default_evaluator_label_is_zero(scored):
    # the reference read precisionByLabel without metricLabel: that is label 0
    lm = {r.label: r for r in M.label_metrics(scored).collect()}
    ev = MulticlassClassificationEvaluator(metricName="precisionByLabel")
    assert ev.evaluate(scored) == pytest.approx(lm[0.0].precision)


def test_rmse_r2_match_evaluator(scored):
    for metric, fn in (("rmse", M.rmse), ("r2", M.r2)):
        ours = fn(scored, prediction="reg").first()[0]
        ev = RegressionEvaluator(labelCol="label", predictionCol="reg", metricName=metric)
        assert ours == pytest.approx(ev.evaluate(scored), rel=1e-9)
    rm = M.regression_metrics(scored, prediction="reg").first()
    assert rm.n_rows == 3000


def test_classifier_summary_and_format(scored):
    s = M.classifier_summary({"a": (scored, "score"), "b": (scored, F.col("score") * -1)})
    rows = {r.model: r for r in s.collect()}
    assert rows["a"].auc == pytest.approx(1 - rows["b"].auc, abs=2e-4)
    txt = M.format_report(s, ["precision"], ["auc"]).collect()[0]
    assert txt.precision.endswith("%") and "." in txt.auc
