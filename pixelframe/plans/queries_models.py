"""Queries for estimators, tuning and model explanation (F2).

Exact oracles exist for special cases with closed forms: weighted logistic
regression on one binary feature (log odds ratio of weight sums), ridge on
one feature (Spark's label-scaled penalty), a one-split GBT (best variance
reduction) and k-fold CV of that ridge.  The full models are rows-only.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.plans import sqltext as S
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import gbt_regressor, linear_regression, logistic_regression, staged_estimator
from pixelframe.plans.queries_prep import prepared, weighted
from pixelframe.plans.registry import register
from pixelframe.plans.workflows import rows_per_task, run_workflow, stored_rows
from pixelframe.sources.pixels import FEATURES
from pixelframe.sources.testdata import F2_KEYS


def _vec(df, cols, out="features"):
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


# ---- exact special cases ------------------------------------------------------

@register("logit_odds", "M1", sql=f"""
SELECT ROUND(LN((w11 * w00) / (w10 * w01)), 6) AS coefficient, ROUND(LN(w01 / w00), 6) AS intercept
FROM (SELECT SUM(class_weight) FILTER (WHERE lst > 40 AND label = 1) AS w11,
             SUM(class_weight) FILTER (WHERE lst > 40 AND label = 0) AS w10,
             SUM(class_weight) FILTER (WHERE NOT lst > 40 AND label = 1) AS w01,
             SUM(class_weight) FILTER (WHERE NOT lst > 40 AND label = 0) AS w00
      FROM ({S.WEIGHTED_SQL}) w) s""")
def logit_odds(spark, sf_dir):
    w = weighted(spark, sf_dir).withColumn("x", (F.col("lst") > 40).cast("double"))
    est = logistic_regression(features_col="features", reg_param=0.0, max_iter=1000, tol=1e-12)
    m = est.fit(_vec(w, ["x"]))
    return spark.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 6))],
                                 "coefficient DOUBLE, intercept DOUBLE")


def _ridge_sql(where: str = "TRUE") -> str:
    return f"""
SELECT reg_param, ROUND(slope, 10) AS slope, ROUND(my - slope * mx, 10) AS intercept
FROM (SELECT g.reg_param, s.mx, s.my, s.cxy / s.vx / (1E0 + g.reg_param / SQRT(s.vy)) AS slope
      FROM (SELECT AVG(lst) AS mx, AVG(label) AS my, VAR_POP(lst) AS vx, VAR_POP(label) AS vy,
                   COVAR_POP(lst, label) AS cxy FROM ({S.PREPARED_SQL}) p WHERE {where}) s,
           (SELECT UNNEST([0E0, 0.3E0]) AS reg_param) g) r"""


@register("ridge_single", "M3", sql=_ridge_sql())
def ridge_single(spark, sf_dir):
    d = _vec(prepared(spark, sf_dir), ["lst"]).cache()
    rows = []
    try:
        for lam in (0.0, 0.3):
            m = linear_regression(features_col="features", reg_param=lam).fit(d)
            rows.append((lam, round(float(m.coefficients[0]), 10), round(float(m.intercept), 10)))
    finally:
        d.unpersist()
    return spark.createDataFrame(rows, "reg_param DOUBLE, slope DOUBLE, intercept DOUBLE")


@register("gbt_stump", "M4", sql=f"""
WITH d AS (SELECT lst, COUNT(*) AS n, SUM(label) AS s FROM ({S.PREPARED_SQL}) p GROUP BY lst),
c AS (SELECT lst, LEAD(lst) OVER (ORDER BY lst) AS nxt,
             SUM(n) OVER (ORDER BY lst) AS nl, SUM(s) OVER (ORDER BY lst) AS sl,
             SUM(n) OVER () AS nt, SUM(s) OVER () AS st FROM d),
cand AS (SELECT (lst + nxt) / 2 AS thr, sl / nl AS lm, (st - sl) / (nt - nl) AS rm,
                sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) AS gain FROM c WHERE nxt IS NOT NULL),
best AS (SELECT * FROM cand ORDER BY gain DESC, thr LIMIT 1)
SELECT d.lst, ROUND(CASE WHEN d.lst <= best.thr THEN best.lm ELSE best.rm END, 9) AS prediction
FROM d, best""")
def gbt_stump(spark, sf_dir):
    d = _vec(prepared(spark, sf_dir), ["lst"])
    model = gbt_regressor(features_col="features", max_iter=1, max_depth=1, max_bins=64).fit(d)
    values = d.select("lst").distinct()
    return (model.transform(_vec(values, ["lst"]))
            .select("lst", F.round("prediction", 9).alias("prediction")))


CV_RIDGE_SQL = f"""
WITH p AS (SELECT lst AS x, label AS y, {S.fold(3)} AS fold FROM ({S.PREPARED_SQL}) q WHERE {S.split_flag(0.7)}),
g AS (SELECT * FROM (VALUES (2, 0.01E0), (2, 0.03E0), (3, 0.01E0), (3, 0.03E0)) t(max_iter, reg_param)),
fs AS (SELECT DISTINCT fold FROM p),
st AS (SELECT fs.fold, AVG(x) AS mx, AVG(y) AS my, VAR_POP(x) AS vx, VAR_POP(y) AS vy, COVAR_POP(x, y) AS cxy
       FROM fs JOIN p ON p.fold <> fs.fold GROUP BY fs.fold),
m AS (SELECT g.max_iter, g.reg_param, st.fold, st.mx, st.my,
             st.cxy / st.vx / (1E0 + g.reg_param / SQRT(st.vy)) AS slope FROM st, g),
e AS (SELECT m.max_iter, m.reg_param, m.fold,
             SQRT(AVG((m.my - m.slope * m.mx + m.slope * p.x - p.y) * (m.my - m.slope * m.mx + m.slope * p.x - p.y))) AS rmse
      FROM m JOIN p ON p.fold = m.fold GROUP BY 1, 2, 3)
SELECT max_iter, reg_param, ROUND(AVG(rmse), 8) AS avg_rmse FROM e GROUP BY 1, 2"""


@register("cv_ridge", "U1,U3,X4", sql=CV_RIDGE_SQL)
def cv_ridge(spark, sf_dir, parallelism=1):
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    pipe, est = staged_estimator("linear", ["lst"], estimator=linear_regression(features_col="features"))
    pipe.setStages(pipe.getStages()[:1] + [est])  # assembler only: closed form is in raw units
    maps = TU.param_grid(est, TU.GRIDS["linear"]["cv"])
    res = TU.cross_validation_search(pipe, maps, TU.rmse_evaluator(), train, F2_KEYS, 3, parallelism)
    rows = [(int(m[est.maxIter]), float(m[est.regParam]), round(float(v), 8))
            for m, v in zip(res.maps, res.metrics)]
    return spark.createDataFrame(rows, "max_iter INT, reg_param DOUBLE, avg_rmse DOUBLE")


@register("cv_ridge_parallel", "U5,U3", sql=CV_RIDGE_SQL)
def cv_ridge_parallel(spark, sf_dir):
    """The same search, four fits at a time."""
    return cv_ridge(spark, sf_dir, parallelism=4)


# ---- full models (rows-only) ----------------------------------------------------

def _train(spark, sf_dir, weights=True, per_task=prep.ROWS_PER_TASK):
    """Persisted training rows, dealt by key (read by every stage and iteration), and test rows."""
    data = weighted(spark, sf_dir) if weights else prepared(spark, sf_dir)
    train, test = prep.hash_split(data, F2_KEYS, 0.7)
    return prep.by_key(train, F2_KEYS, rows_per_task=per_task).persist(StorageLevel.MEMORY_AND_DISK), test


def _fit_explain(kind, spark, sf_dir):
    weights = kind in ("logistic", "forest")
    train, _ = _train(spark, sf_dir, weights, rows_per_task(kind))
    pipe, _ = staged_estimator(kind, FEATURES, prep.WEIGHT_COL if weights else None)
    try:
        model = pipe.fit(train)
    finally:
        train.unpersist()
    table = (RP.coefficients(spark, model, FEATURES) if kind in ("logistic", "linear")
             else RP.importances(spark, model, FEATURES))
    return RP.rank_features(table)


@register("fit_logistic", "M1,T4,E1,P10,O1")
def fit_logistic(spark, sf_dir):
    return _fit_explain("logistic", spark, sf_dir)


@register("fit_forest", "M2,T4,E2,O1")
def fit_forest(spark, sf_dir):
    return _fit_explain("forest", spark, sf_dir)


@register("fit_gbt", "M4,T4,E2,O1")
def fit_gbt(spark, sf_dir):
    return _fit_explain("gbt", spark, sf_dir)


@register("fit_linear", "M3,T4,E1,O1")
def fit_linear(spark, sf_dir):
    return _fit_explain("linear", spark, sf_dir)


@register("score_logistic", "E3,P8,P9")
def score_logistic(spark, sf_dir):
    train, test = _train(spark, sf_dir)
    pipe, _ = staged_estimator("logistic", FEATURES, prep.WEIGHT_COL)
    try:
        model = pipe.fit(train)
    finally:
        train.unpersist()
    scored = RP.score(model, test, keep=F2_KEYS)
    return scored.select(*F2_KEYS, "label", "prediction", RP.positive_score().alias("score"))


def _search(kind, method, spark, sf_dir):
    weights = kind in ("logistic", "forest")
    train, _ = _train(spark, sf_dir, weights, rows_per_task(kind))
    pipe, est = staged_estimator(kind, FEATURES, prep.WEIGHT_COL if weights else None)
    evaluator = TU.auc_evaluator() if weights else TU.rmse_evaluator()
    maps = TU.param_grid(est, TU.GRIDS[kind][method])
    try:
        if method == "tvs":
            res = TU.train_validation_search(pipe, maps, evaluator, train, F2_KEYS, TU.TRAIN_RATIO,
                                             TU.PARALLELISM)
        else:
            res = TU.cross_validation_search(pipe, maps, evaluator, train, F2_KEYS, TU.FOLDS[kind],
                                             TU.PARALLELISM)
    finally:
        train.unpersist()
    return res.metrics_frame(spark)


def _register_search(kind, method):
    items = "U1,U2,U4,X3" if method == "tvs" else "U1,U3,U4,U5,X4"

    @register(f"tune_{method}_{kind}", items)
    def q(spark, sf_dir):
        return _search(kind, method, spark, sf_dir)
    return q


for _kind in ("logistic", "forest", "gbt", "linear"):
    for _method in ("tvs", "cv"):
        _register_search(_kind, _method)


def _register_workflow(kind):
    @register(f"workflow_{kind}", "A13,E1-E5,U2,U3")
    def q(spark, sf_dir):
        data, tasks = prepared(spark, sf_dir), None
        if kind != "linear":  # that one fits nothing and reads its rows once for each search
            data, tasks = stored_rows(data, F2_KEYS, weights=kind in ("logistic", "forest"), per_task=rows_per_task(kind))
        res = run_workflow(spark, data, kind, F2_KEYS, parallelism=TU.PARALLELISM, partitions=tasks)
        if kind != "forest":
            return res.summary
        # the forest's report: weighted F1 and every label's precision and recall, of both models
        return (res.per_label.select("model", "label", "support", "precision", "recall", "f1")
                .join(F.broadcast(res.weighted.select("model", "weighted_f1")), "model")
                .join(F.broadcast(res.summary.select("model", "accuracy", "auc")), "model"))
    return q


for _kind in ("logistic", "forest", "gbt", "linear"):
    _register_workflow(_kind)


def _tvs_ridge_sql() -> str:
    return f"""
WITH p AS (SELECT lst AS x, label AS y, {S.split_flag(0.8, offset=9)} AS is_fit
           FROM ({S.PREPARED_SQL}) q WHERE {S.split_flag(0.7)}),
g AS (SELECT * FROM (VALUES (0, 2, 0.01E0), (1, 2, 0.03E0), (2, 3, 0.01E0), (3, 3, 0.03E0)) t(map_id, max_iter, reg_param)),
st AS (SELECT AVG(x) AS mx, AVG(y) AS my, VAR_POP(x) AS vx, VAR_POP(y) AS vy, COVAR_POP(x, y) AS cxy
       FROM p WHERE is_fit),
m AS (SELECT g.map_id, g.max_iter, g.reg_param, st.mx, st.my,
             st.cxy / st.vx / (1E0 + g.reg_param / SQRT(st.vy)) AS slope FROM st, g)
SELECT m.map_id, m.max_iter, m.reg_param,
       ROUND(SQRT(AVG((m.my - m.slope * m.mx + m.slope * p.x - p.y) * (m.my - m.slope * m.mx + m.slope * p.x - p.y))), 8) AS rmse
FROM m JOIN p ON NOT p.is_fit GROUP BY 1, 2, 3"""


def _tvs_ridge(spark, sf_dir):
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    pipe, est = staged_estimator("linear", ["lst"], estimator=linear_regression(features_col="features"))
    pipe.setStages(pipe.getStages()[:1] + [est])  # assembler only: closed form is in raw units
    maps = TU.param_grid(est, TU.GRIDS["linear"]["tvs"])
    return TU.train_validation_search(pipe, maps, TU.rmse_evaluator(), train, F2_KEYS, TU.TRAIN_RATIO), est


@register("tvs_ridge", "U1,U2,U4,X3", sql=_tvs_ridge_sql())
def tvs_ridge(spark, sf_dir):
    res, est = _tvs_ridge(spark, sf_dir)
    rows = [(i, int(m[est.maxIter]), float(m[est.regParam]), round(float(v), 8))
            for i, (m, v) in enumerate(zip(res.maps, res.metrics))]
    return spark.createDataFrame(rows, "map_id INT, max_iter INT, reg_param DOUBLE, rmse DOUBLE")


@register("best_params", "O2,U2", sql=f"SELECT * FROM ({_tvs_ridge_sql()}) r ORDER BY rmse, map_id LIMIT 1")
def best_params(spark, sf_dir):
    res, est = _tvs_ridge(spark, sf_dir)
    rows = [(i, int(m[est.maxIter]), float(m[est.regParam]), round(float(v), 8))
            for i, (m, v) in enumerate(zip(res.maps, res.metrics))]
    table = spark.createDataFrame(rows, "map_id INT, max_iter INT, reg_param DOUBLE, rmse DOUBLE")
    return RP.best_params(table, larger_better=False, metric="rmse")
