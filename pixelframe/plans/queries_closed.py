"""Models, tuning and explanation against closed forms (F2).

Each query fits the real estimator on a problem whose answer SQL can state: a
one-split forest by weighted Gini, its importances, a regularised logistic fit
by its gradient, two-feature least squares by the normal equations, one-feature
ridge predictions, AUC selection for a one-feature logistic.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.plans import sqltext as S
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import linear_regression, logistic_regression, random_forest, staged_estimator
from pixelframe.plans.queries_prep import prepared, weighted
from pixelframe.plans.registry import register
from pixelframe.sources.testdata import F2_KEYS


def _vec(df, cols):
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


# ---- forest (M2, E2) --------------------------------------------------------------

def _split_sql(feature: str) -> str:
    """Best weighted-Gini cut of one feature: threshold, class-1 share on both sides, score."""
    return f"""
SELECT thr, l1 / (l0 + l1) AS left_p, (t1 - l1) / (t0 - l0 + t1 - l1) AS right_p,
       (l0 * l0 + l1 * l1) / (l0 + l1)
       + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / (t0 - l0 + t1 - l1) AS purity
FROM (SELECT (x + LEAD(x) OVER (ORDER BY x)) / 2 AS thr, SUM(w0) OVER (ORDER BY x) AS l0, SUM(w1) OVER (ORDER BY x) AS l1,
             SUM(w0) OVER () AS t0, SUM(w1) OVER () AS t1
      FROM (SELECT {feature} AS x, SUM(CASE WHEN label = 0 THEN class_weight ELSE 0E0 END) AS w0,
                   SUM(CASE WHEN label = 1 THEN class_weight ELSE 0E0 END) AS w1
            FROM ({S.WEIGHTED_SQL}) p GROUP BY 1) g) c
WHERE thr IS NOT NULL ORDER BY purity DESC, thr LIMIT 1"""


def _one_split(spark, sf_dir, features):
    data = _vec(prep.by_key(weighted(spark, sf_dir), F2_KEYS), features)
    est = random_forest(num_trees=1, max_depth=1, max_bins=64, featureSubsetStrategy="all", bootstrap=False)
    return est.fit(data), data


@register("forest_stump", "M2,E3", sql=f"""
WITH best AS ({_split_sql('lst')})
SELECT d.lst, ROUND(CASE WHEN d.lst <= thr THEN left_p ELSE right_p END, 9) AS p_positive
FROM (SELECT DISTINCT lst FROM ({S.PREPARED_SQL}) p) d, best""")
def forest_stump(spark, sf_dir):
    model, data = _one_split(spark, sf_dir, ["lst"])
    scored = model.transform(data.select("lst", "features").dropDuplicates(["lst"]))
    return scored.select("lst", F.round(vector_to_array("probability")[1], 9).alias("p_positive"))


@register("forest_importance", "E2,M2,O1", sql=f"""
WITH a AS ({_split_sql('lst')}), b AS ({_split_sql('slope')})
SELECT 'lst' AS feature, 0 AS position, CASE WHEN a.purity >= b.purity THEN 1E0 ELSE 0E0 END AS importance,
       CASE WHEN a.purity >= b.purity THEN 1 ELSE 2 END AS rank FROM a, b
UNION ALL
SELECT 'slope', 1, CASE WHEN a.purity >= b.purity THEN 0E0 ELSE 1E0 END,
       CASE WHEN a.purity >= b.purity THEN 2 ELSE 1 END FROM a, b""")
def forest_importance(spark, sf_dir):
    model, _ = _one_split(spark, sf_dir, ["lst", "slope"])
    ranked = RP.rank_features(RP.importances(spark, model, ["lst", "slope"]))
    return ranked.select("feature", "position", "importance", "rank")


# ---- logistic with a penalty (M1) ---------------------------------------------------

@register("logistic_gradient", "M1", sql=f"""
SELECT COUNT(*) AS n_rows, 0E0 AS slope_gradient, 0E0 AS intercept_gradient FROM ({S.PREPARED_SQL}) p""")
def logistic_gradient(spark, sf_dir):
    """Both derivatives of the penalised weighted log-loss at the fitted model,
    computed from the rows: zero to five places at the optimum."""
    lam, d = 0.1, weighted(spark, sf_dir).withColumn("x", F.col("lst") / 50)
    est = logistic_regression(features_col="features", reg_param=lam, max_iter=500, tol=1e-12)
    m = est.fit(_vec(prep.by_key(d, F2_KEYS), ["x"]))
    slope, intercept = float(m.coefficients[0]), float(m.intercept)
    w, x = F.col(prep.WEIGHT_COL), F.col("x")
    miss = 1 / (1 + F.exp(-(F.lit(slope) * x + F.lit(intercept)))) - F.col("label")
    total = F.sum(w)
    mean = F.sum(w * x) / total
    # Spark penalises the coefficient of the standardised feature; its variance is the unbiased weighted one
    var = (F.sum(w * x * x) / total - mean * mean) * total / (total - F.sum(w * w) / total)
    zero = lambda c: F.round(F.abs(c), 5)
    return d.agg(F.count(F.lit(1)).alias("n_rows"),
                 zero(F.sum(w * miss * x) / total + F.lit(lam * slope) * var).alias("slope_gradient"),
                 zero(F.sum(w * miss) / total).alias("intercept_gradient"))


# ---- linear models (E1, E3, P8-P10, O1) ----------------------------------------------

@register("score_ridge", "E3,E4,P8,P9", sql=f"""
WITH p AS (SELECT {S.KEYS}, lst, label, {S.split_flag(0.7)} AS is_train FROM ({S.PREPARED_SQL}) q),
s AS (SELECT AVG(lst) AS mx, AVG(label) AS my,
             COVAR_POP(lst, label) / VAR_POP(lst) / (1E0 + 0.3E0 / SQRT(VAR_POP(label))) AS slope FROM p WHERE is_train)
SELECT {S.KEYS}, label, lst AS feature, ROUND(my + slope * (lst - mx), 8) AS prediction FROM p, s WHERE NOT is_train""")
def score_ridge(spark, sf_dir):
    train, test = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    pipe, _ = staged_estimator("forest", ["lst"], estimator=linear_regression(features_col="features"))  # unscaled
    scored = RP.score(pipe.fit(train), test, keep=F2_KEYS, vector="features")
    return scored.select(*F2_KEYS, "label", vector_to_array("features")[0].alias("feature"),
                         F.round("prediction", 8).alias("prediction"))


@register("ols_two_features", "E1,P10,O1", sql=f"""
WITH s AS (SELECT VAR_POP(lst) AS a, VAR_POP(slope) AS b, COVAR_POP(lst, slope) AS c, COVAR_POP(lst, label) AS u,
                  COVAR_POP(slope, label) AS v, AVG(lst) AS ma, AVG(slope) AS mb, AVG(label) AS my FROM ({S.PREPARED_SQL}) p),
f AS (SELECT (u * b - v * c) / (a * b - c * c) AS ka, (v * a - u * c) / (a * b - c * c) AS kb, ma, mb, my FROM s)
SELECT 'lst' AS feature, 0 AS position, ROUND(ka, 8) AS coefficient, ROUND(ABS(ka), 8) AS abs_importance,
       ROUND(my - ka * ma - kb * mb, 8) AS intercept, CASE WHEN ABS(ka) >= ABS(kb) THEN 1 ELSE 2 END AS rank FROM f
UNION ALL
SELECT 'slope', 1, ROUND(kb, 8), ROUND(ABS(kb), 8), ROUND(my - ka * ma - kb * mb, 8),
       CASE WHEN ABS(ka) >= ABS(kb) THEN 2 ELSE 1 END FROM f""")
def ols_two_features(spark, sf_dir):
    est = linear_regression(features_col="features", reg_param=0.0)
    model = est.fit(_vec(prepared(spark, sf_dir), ["lst", "slope"]))
    ranked = RP.rank_features(RP.coefficients(spark, model, ["lst", "slope"]))
    return ranked.select("feature", "position", *[F.round(c, 8).alias(c) for c in (
        "coefficient", "abs_importance", "intercept")], "rank")


# ---- splits, grids and selection (X1, U1, U4) -----------------------------------------

@register("random_split_parts", "X1", sql=f"""
SELECT label, COUNT(*) AS n_input, COUNT(*) AS n_parts, CAST(0 AS BIGINT) AS n_both FROM ({S.PREPARED_SQL}) p GROUP BY label""")
def random_split_parts(spark, sf_dir):
    """Both parts of a random split together are the input, with no row in both."""
    data = prep.by_key(prepared(spark, sf_dir), F2_KEYS).select(*F2_KEYS, "label")
    parts = prep.random_split(data, (0.7, 0.3), seed=42)
    tagged = parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1)))
    by_row = tagged.groupBy(*F2_KEYS, "label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("parts"))
    counts = by_row.groupBy("label").agg(F.sum("n").alias("n_parts"), F.count_if(F.col("parts") > 1).alias("n_both"))
    inputs = data.groupBy("label").agg(F.count(F.lit(1)).alias("n_input"))
    return inputs.join(counts, "label").select("label", "n_input", "n_parts", "n_both")


def _distinct(values) -> list:
    return list(dict.fromkeys(values))


_CV_GRID = [(r, e, i) for r in _distinct(TU.GRIDS["logistic"]["cv"]["regParam"])
            for e in _distinct(TU.GRIDS["logistic"]["cv"]["elasticNetParam"])
            for i in _distinct(TU.GRIDS["logistic"]["cv"]["maxIter"])]


@register("logistic_grid_folds", "U1,X4", sql=f"""
SELECT g.reg_param, g.elastic_net, g.max_iter, f.fold, f.n_rows AS n_validation, t.n - f.n_rows AS n_fit
FROM (VALUES {', '.join(f'({float(r)!r}E0, {float(e)!r}E0, {i})' for r, e, i in _CV_GRID)}) g(reg_param, elastic_net, max_iter),
     (SELECT {S.fold(5)} AS fold, COUNT(*) AS n_rows FROM ({S.PREPARED_SQL}) p WHERE {S.split_flag(0.7)} GROUP BY 1) f,
     (SELECT COUNT(*) AS n FROM ({S.PREPARED_SQL}) p WHERE {S.split_flag(0.7)}) t""")
def logistic_grid_folds(spark, sf_dir):
    """The de-duplicated 18-map grid by the 5 folds it is searched on."""
    _, est = staged_estimator("logistic", ["lst"], prep.WEIGHT_COL)
    maps = TU.grid_rows(TU.param_grid(est, TU.GRIDS["logistic"]["cv"]))
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    folds = prep.with_fold(train, F2_KEYS, 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n_validation"))
    total = train.count()
    grid = F.array(*[F.struct(F.lit(float(m["regParam"])).alias("reg_param"), F.lit(float(m["elasticNetParam"])).alias("elastic_net"),
                              F.lit(int(m["maxIter"])).alias("max_iter")) for m in maps])
    return folds.select(F.explode(grid).alias("g"), "fold", "n_validation").select(
        "g.*", "fold", "n_validation", (F.lit(total) - F.col("n_validation")).alias("n_fit"))


def _validation_auc_sql() -> str:
    return f"""
SELECT SUM(CAST(pos AS DOUBLE) * (below + 0.5E0 * neg)) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) AS auc
FROM (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY lst ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT lst, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg
            FROM ({S.PREPARED_SQL}) p WHERE {S.split_flag(0.7)} AND NOT {S.split_flag(0.8, offset=9)} GROUP BY lst) g) r"""


@register("tvs_auc_selection", "U2,U4,O2", sql=f"""
SELECT m.map_id, m.reg_param, ROUND(a.auc, 8) AS auc, m.map_id = 0 AS is_best
FROM (VALUES (0, 0.01E0), (1, 0.1E0), (2, 0.3E0)) m(map_id, reg_param), ({_validation_auc_sql()}) a""")
def tvs_auc_selection(spark, sf_dir):
    """AUC as selection metric: a one-feature logistic ranks by that feature
    whatever its penalty, so all maps tie and the first is best."""
    train, _ = prep.hash_split(weighted(spark, sf_dir), F2_KEYS, 0.7)
    pipe, est = staged_estimator("logistic", ["lst"], prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"regParam": [0.01, 0.1, 0.3]})
    res = TU.train_validation_search(pipe, maps, TU.auc_evaluator(), train, F2_KEYS, TU.TRAIN_RATIO)
    rows = [(i, float(m[est.regParam]), round(float(v), 8), i == res.best_index)
            for i, (m, v) in enumerate(zip(res.maps, res.metrics))]
    return spark.createDataFrame(rows, "map_id INT, reg_param DOUBLE, auc DOUBLE, is_best BOOLEAN")
