"""Feature transformers: per-feature statistics, vector assembly, min-max scaling."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def minmax_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min and max of every column in one aggregate, as (feature, position, min, max) rows."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"mn{i}"), F.max(c).cast("double").alias(f"mx{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"),
                 F.col(f"mn{i}").alias("min_value"), F.col(f"mx{i}").alias("max_value"))
        for i, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


def assembler(features: Sequence[str], output: str = "features",
              handle_invalid: str = "error") -> VectorAssembler:
    """Dense feature vector (T1).  ``handleInvalid='error'`` fails on nulls, so
    run ``drop_missing`` first (or pass 'skip'/'keep')."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid)


def minmax_scaler(input_col: str = "features", output: str = "normFeatures") -> MinMaxScaler:
    """Scale each slot to [0, 1] on the fitted range (T2); constant slots -> 0.5,
    values outside the fitted range are not clipped."""
    return MinMaxScaler(inputCol=input_col, outputCol=output)


def scaling_stages(features: Sequence[str], scale: bool = True) -> list:
    stages = [assembler(features)]
    if scale:
        stages.append(minmax_scaler())
    return stages


def fit_scaler(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assembler + scaler fitted on ``train`` only (T3): one summarizer pass."""
    return Pipeline(stages=scaling_stages(features)).fit(train)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpack a vector column into named double columns (for SQL-comparable output)."""
    arr = vector_to_array(F.col(vector))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])
