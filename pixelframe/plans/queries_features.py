"""Queries for feature statistics and min-max scaling (F2)."""

from __future__ import annotations

from pixelframe.functions.exprs import round_doubles
from pixelframe.operators import features as FT
from pixelframe.operators import prep
from pixelframe.plans import sqltext as S
from pixelframe.plans.queries_prep import prepared
from pixelframe.plans.registry import register
from pixelframe.sources.pixels import FEATURES
from pixelframe.sources.testdata import F2_KEYS

D = 9


def _stats_sql(where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS position, CAST(MIN({c}) AS DOUBLE) AS min_value, "
        f"CAST(MAX({c}) AS DOUBLE) AS max_value FROM ({S.PREPARED_SQL}) p WHERE {where}"
        for i, c in enumerate(FEATURES))


def _scaled_sql(stats_where: str, rows_where: str) -> str:
    mins = ", ".join(f"MIN({c}) AS mn_{c}, MAX({c}) AS mx_{c}" for c in FEATURES)
    cols = ", ".join(
        f"ROUND(CASE WHEN mx_{c} - mn_{c} <> 0 THEN ({c} - mn_{c}) * (1E0 / (mx_{c} - mn_{c})) + 0E0 "
        f"ELSE 0.5E0 END, {D}) AS {c}" for c in FEATURES)
    return f"""
SELECT {S.KEYS}, {cols}
FROM ({S.PREPARED_SQL}) p, (SELECT {mins} FROM ({S.PREPARED_SQL}) q WHERE {stats_where}) s
WHERE {rows_where}"""


@register("minmax_stats", "A12", sql=_stats_sql())
def minmax_stats(spark, sf_dir):
    return FT.minmax_stats(prepared(spark, sf_dir), FEATURES)


@register("minmax_scaled", "T1,T2", sql=_scaled_sql("TRUE", "TRUE"))
def minmax_scaled(spark, sf_dir):
    p = prepared(spark, sf_dir)
    model = FT.fit_scaler(p, FEATURES)
    return round_doubles(FT.vector_columns(model.transform(p), "normFeatures", FEATURES, keep=F2_KEYS), D)


@register("minmax_train_to_test", "T3,X2", sql=_scaled_sql(S.split_flag(0.7), f"NOT {S.split_flag(0.7)}"))
def minmax_train_to_test(spark, sf_dir):
    train, test = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    model = FT.fit_scaler(train, FEATURES)
    return round_doubles(FT.vector_columns(model.transform(test), "normFeatures", FEATURES, keep=F2_KEYS), D)
