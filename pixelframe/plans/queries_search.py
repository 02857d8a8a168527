"""Searches without repeated passes: ridge from moments, AUC of all maps at once,
selection among maps that differ, scoring with the bare last stage (F2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelframe.operators import prep
from pixelframe.operators import report as RP
from pixelframe.operators.metrics import auc_by
from pixelframe.plans import gram
from pixelframe.plans import sqltext as S
from pixelframe.plans import tuning as TU
from pixelframe.plans.models import staged_estimator
from pixelframe.plans.queries_closed import _validation_auc_sql
from pixelframe.plans.queries_prep import prepared, weighted
from pixelframe.plans.registry import register
from pixelframe.sources.testdata import F2_KEYS, F2_SQL, sample_table

PAIR = ["lst", "slope"]
REG_PARAMS = [0.01, 0.03, 0.3]


# ---- ridge searches from moments (M3, U2, U3) ------------------------------------------

@register("fold_moments", "U3,X4", sql=f"""
SELECT {S.fold(3)} AS fold, COUNT(*) AS n, ROUND(AVG(lst), 9) AS mean_lst, ROUND(AVG(slope), 9) AS mean_slope,
       ROUND(AVG(label), 9) AS mean_label, ROUND(VAR_POP(lst), 6) AS var_lst, ROUND(COVAR_POP(lst, slope), 6) AS cov_features,
       ROUND(COVAR_POP(lst, label), 6) AS cov_lst_label, ROUND(VAR_POP(label), 9) AS var_label,
       MIN(lst) AS low_lst, MAX(lst) AS high_lst
FROM ({S.PREPARED_SQL}) p WHERE {S.split_flag(0.7)} GROUP BY 1""")
def fold_moments(spark, sf_dir):
    """All that a ridge search needs of its rows, one row per fold."""
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    m = gram.moments(prep.with_fold(train, F2_KEYS, 3, col="fold"), PAIR, part="fold")
    per_row = lambda i: F.col("scatter")[i] / F.col("n")
    return m.select("fold", "n", *[F.round(F.col("mean")[i], 9).alias(f"mean_{c}") for i, c in enumerate([*PAIR, "label"])],
                    F.round(per_row(0), 6).alias("var_lst"), F.round(per_row(1), 6).alias("cov_features"),
                    F.round(per_row(2), 6).alias("cov_lst_label"), F.round(per_row(5), 9).alias("var_label"),
                    F.col("low")[0].alias("low_lst"), F.col("high")[0].alias("high_lst"))


def _pair_fit_sql(rows: str, by: str) -> str:
    """Ridge on two features for every penalty and group ``by`` of ``rows``: the
    standardised 2 x 2 system solved by its determinant."""
    regs = ", ".join(f"({r!r}E0)" for r in REG_PARAMS)
    return f"""
SELECT part, reg_param, b1 * sy / s1 AS k1, b2 * sy / s2 AS k2, my - b1 * sy / s1 * m1 - b2 * sy / s2 * m2 AS k0
FROM (SELECT part, reg_param, m1, m2, my, s1, s2, sy, (d * r1 - r12 * r2) / (d * d - r12 * r12) AS b1,
             (d * r2 - r12 * r1) / (d * d - r12 * r12) AS b2
      FROM (SELECT {by} AS part, g.reg_param, AVG(x1) AS m1, AVG(x2) AS m2, AVG(y) AS my, STDDEV_POP(x1) AS s1,
                   STDDEV_POP(x2) AS s2, STDDEV_POP(y) AS sy, 1E0 + g.reg_param / STDDEV_POP(y) AS d,
                   COVAR_POP(x1, x2) / STDDEV_POP(x1) / STDDEV_POP(x2) AS r12,
                   COVAR_POP(x1, y) / STDDEV_POP(x1) / STDDEV_POP(y) AS r1,
                   COVAR_POP(x2, y) / STDDEV_POP(x2) / STDDEV_POP(y) AS r2
            FROM {rows}, (VALUES {regs}) g(reg_param) GROUP BY 1, 2) m) s"""


_PAIR_ROWS = f"SELECT lst AS x1, slope AS x2, label AS y, {{}} AS part FROM ({S.PREPARED_SQL}) q WHERE {S.split_flag(0.7)}"
_MISS = "(k0 + k1 * x1 + k2 * x2 - y)"


@register("cv_moments", "U3,M3,U4", sql=f"""
WITH p AS ({_PAIR_ROWS.format(S.fold(3))}),
fit AS ({_pair_fit_sql("(SELECT f.part AS held, p.x1, p.x2, p.y FROM p, (SELECT DISTINCT part FROM p) f WHERE f.part <> p.part) t", "held")}),
e AS (SELECT reg_param, p.part, SQRT(AVG({_MISS} * {_MISS})) AS rmse FROM fit JOIN p ON p.part = fit.part GROUP BY 1, 2)
SELECT reg_param, ROUND(AVG(rmse), 9) AS avg_rmse FROM e GROUP BY 1""")
def cv_moments(spark, sf_dir):
    """3-fold CV of the two-feature ridge for all penalties, from one scan."""
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    metrics, _ = gram.cross_validate(train, PAIR, REG_PARAMS, F2_KEYS, 3)
    return spark.createDataFrame([(r, round(v, 9)) for r, v in zip(REG_PARAMS, metrics)], "reg_param DOUBLE, avg_rmse DOUBLE")


@register("tvs_moments", "U2,M3,U4,E1", sql=f"""
WITH p AS ({_PAIR_ROWS.format(f"CASE WHEN {S.split_flag(0.8, offset=9)} THEN 1 ELSE 0 END")}),
fit AS ({_pair_fit_sql("(SELECT * FROM p WHERE part = 1) t", "1")}),
whole AS ({_pair_fit_sql("p", "2")}),
e AS (SELECT reg_param, SQRT(AVG({_MISS} * {_MISS})) AS rmse FROM fit, p WHERE p.part = 0 GROUP BY 1)
SELECT e.reg_param, ROUND(rmse, 9) AS rmse, ROUND(k1, 9) AS lst, ROUND(k2, 9) AS slope, ROUND(k0, 9) AS intercept
FROM e JOIN whole ON whole.reg_param = e.reg_param""")
def tvs_moments(spark, sf_dir):
    """Train/validation search from one scan, with each penalty's refit on all training rows."""
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    metrics, parts = gram.train_validate(train, PAIR, REG_PARAMS, F2_KEYS)
    rows = []
    for r, v in zip(REG_PARAMS, metrics):
        m = gram.refit(parts, r, PAIR)
        rows.append((r, round(v, 9), *[round(float(c), 9) for c in m.raw], round(m.raw_intercept, 9)))
    return spark.createDataFrame(rows, "reg_param DOUBLE, rmse DOUBLE, lst DOUBLE, slope DOUBLE, intercept DOUBLE")


# ---- all maps in one evaluation pass (A9, U4) --------------------------------------------

_SCORES = ["lst", "humidity", "lst * humidity", "-precip"]
_SCORES_SQL = " UNION ALL ".join(f"SELECT {i} AS map, burned, {s} AS score FROM ({F2_SQL}) t{i}" for i, s in enumerate(_SCORES))


@register("auc_by_map", "A9,U4", sql=f"""
SELECT map, ROUND(SUM(CAST(pos AS DOUBLE) * (below + 0.5E0 * neg)) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 10) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
FROM (SELECT map, pos, neg,
             COALESCE(SUM(neg) OVER (PARTITION BY map ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT map, score, COUNT(*) FILTER (WHERE burned = 1) AS pos, COUNT(*) FILTER (WHERE burned = 0) AS neg
            FROM ({_SCORES_SQL}) u
            GROUP BY map, score) g) r
GROUP BY map""")
def auc_by_map(spark, sf_dir):
    """AUC of four rule scores, by one range cut on (map, score)."""
    scores = F.array(*[F.struct(F.lit(i).alias("map"), F.expr(s).alias("score")) for i, s in enumerate(_SCORES)])
    long = sample_table(spark, sf_dir).select(F.col("burned").alias("label"), F.explode(scores).alias("s")).select("label", "s.*")
    return auc_by(long, ["map"]).withColumn("auc", F.round("auc", 10))


@register("tvs_auc_choice", "U2,U4,O2", sql=f"""
SELECT m.map_id, m.reg_param, ROUND(CASE WHEN m.map_id = 0 THEN 0.5E0 ELSE a.auc END, 8) AS auc, m.map_id = 1 AS is_best
FROM (VALUES (0, 10E0), (1, 0.01E0), (2, 0.001E0)) m(map_id, reg_param), ({_validation_auc_sql()}) a""")
def tvs_auc_choice(spark, sf_dir):
    """Selection among maps that differ: an L1 penalty of 10 removes the only
    feature, so all scores tie (AUC 0.5); the others rank by the feature, and
    the first of them is best."""
    train, _ = prep.hash_split(weighted(spark, sf_dir), F2_KEYS, 0.7)
    pipe, est = staged_estimator("logistic", ["lst"], prep.WEIGHT_COL)
    maps = TU.param_grid(est, {"regParam": [10.0, 0.01, 0.001], "elasticNetParam": [1.0]})
    res = TU.train_validation_search(pipe, maps, TU.auc_evaluator(), train, F2_KEYS, TU.TRAIN_RATIO)
    rows = [(i, float(m[est.regParam]), round(float(v), 8), i == res.best_index)
            for i, (m, v) in enumerate(zip(res.maps, res.metrics))]
    return spark.createDataFrame(rows, "map_id INT, reg_param DOUBLE, auc DOUBLE, is_best BOOLEAN")


# ---- the bare last stage on scaled rows (E4) -----------------------------------------------

@register("score_last_stage", "E4,E3,T2", sql=f"""
WITH p AS (SELECT {S.KEYS}, lst AS x1, slope AS x2, label AS y, {S.split_flag(0.7)} AS is_train FROM ({S.PREPARED_SQL}) q),
s AS (SELECT MIN(x1) AS l1, MAX(x1) AS h1, MIN(x2) AS l2, MAX(x2) AS h2 FROM p WHERE is_train),
fit AS (SELECT * FROM ({_pair_fit_sql("(SELECT * FROM p WHERE is_train) t", "1")}) f WHERE reg_param = 0.3E0)
SELECT {S.KEYS}, y AS label, ROUND((x1 - l1) / (h1 - l1), 9) AS scaled_lst, ROUND((x2 - l2) / (h2 - l2), 9) AS scaled_slope,
       ROUND(k0 + k1 * x1 + k2 * x2, 8) AS prediction
FROM p, s, fit WHERE NOT is_train""")
def score_last_stage(spark, sf_dir):
    """Held-out rows scaled by the fitted scaler's range and scored by the bare
    linear stage, both as Column expressions: no ML object in the scoring plan."""
    train, test = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    pipe, _ = staged_estimator("linear", PAIR)
    model = pipe.fit(train)
    scaled = RP.scale_columns(model.stages[1], test, PAIR)
    out = RP.score_columns(model.stages[-1], scaled, [f"scaled_{c}" for c in PAIR])
    return out.select(*F2_KEYS, "label", *[F.round(f"scaled_{c}", 9).alias(f"scaled_{c}") for c in PAIR],
                      F.round("prediction", 8).alias("prediction"))
