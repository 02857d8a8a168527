"""Ridge regression searches from moments: one scan for every penalty and fold.

A penalised least-squares fit and its error on other rows depend on the rows
only through counts, means and products of deviations.  One aggregate by part
(fold, or fit/validation) gives these; parts are put together by adding their
moments, so leaving a fold out needs no pass of its own, and each penalty is one
small linear system.  What reaches the driver is one row of (p + 1)(p + 4) / 2
numbers for each part.

The penalty is that of Spark's ``LinearRegression``: features and label are
standardised (population deviations), the penalty ``regParam / deviation of the
label`` is added to the diagonal, the intercept is free.  Such a fit does not
change when a feature is scaled, so one solution serves scaled and unscaled
features; constant features get coefficient 0.  Iteration limits do not matter,
as the system is solved exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelframe.operators.features import assembler
from pixelframe.operators.prep import split_flag, with_fold

PART = "part"


def moments(df: DataFrame, features: Sequence[str], label: str = "label", part: str = PART) -> DataFrame:
    """(part, n, mean, scatter, low, high) for each value of ``part``, in one
    aggregate: means of the features and the label, sums of products of their
    deviations (upper triangle by rows), least and greatest values."""
    cols = [F.col(c).cast("double") for c in [*features, label]]
    n = F.count(F.lit(1))
    products = [F.covar_pop(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    out = df.groupBy(F.col(part).alias("_part")).agg(
        n.alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[c.alias(f"s{i}") for i, c in enumerate(products)],
        *[F.min(c).alias(f"l{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"h{i}") for i, c in enumerate(cols)])
    k = range(len(cols))
    return out.select(F.col("_part").alias(part), "n", F.array(*[f"m{i}" for i in k]).alias("mean"),
                      F.array(*[F.col(f"s{i}") * F.col("n") for i in range(len(products))]).alias("scatter"),
                      F.array(*[f"l{i}" for i in k]).alias("low"), F.array(*[f"h{i}" for i in k]).alias("high"))


@dataclass
class Moments:
    """Count, means, products of deviations and extremes of a set of rows; the label comes last."""
    n: int
    mean: np.ndarray
    scatter: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, row) -> Moments:
        p = len(row["mean"])
        scatter = np.zeros((p, p))
        scatter[np.triu_indices(p)] = row["scatter"]
        scatter += np.triu(scatter, 1).T
        return cls(row["n"], np.array(row["mean"]), scatter, np.array(row["low"]), np.array(row["high"]))

    def __add__(self, other: Moments) -> Moments:
        n, off = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + off * (other.n / n),
                       self.scatter + other.scatter + np.outer(off, off) * (self.n * other.n / n),
                       np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    def squared_error(self, model: RidgeModel) -> float:
        """Sum of squared errors of ``model`` over these rows."""
        w = np.append(model.raw, -1.0)
        bias = model.raw_intercept + w @ self.mean
        return float(w @ self.scatter @ w + self.n * bias * bias)

    def ridge(self, reg_param: float, features: Sequence[str]) -> RidgeModel:
        """The penalised fit of these rows."""
        p = len(self.mean) - 1
        spread = np.sqrt(np.diag(self.scatter) / self.n)
        spread[self.low == self.high] = 0.0  # constant: no rounding rest
        raw = np.zeros(p)
        used = np.flatnonzero(spread[:p] > 0)
        if spread[p] > 0 and len(used):
            x = self.scatter[np.ix_(used, used)] / self.n / np.outer(spread[used], spread[used])
            y = self.scatter[used, p] / self.n / (spread[used] * spread[p])
            penalty = reg_param / spread[p]
            if penalty > 0:
                solved = np.linalg.solve(x + penalty * np.eye(len(used)), y)
            else:  # dependent features: the shortest solution
                solved = np.linalg.lstsq(x, y, rcond=None)[0]
            raw[used] = solved * spread[p] / spread[used]
        return RidgeModel(list(features), raw, float(self.mean[p] - raw @ self.mean[:p]), self.low[:p], self.high[:p])


@dataclass
class RidgeModel:
    """A linear model in the units of the table.  ``coefficients`` and
    ``intercept`` are those over min-max scaled features (range of the rows it
    was fitted on), as a pipeline with a scaler reports them."""
    features: list[str]
    raw: np.ndarray
    raw_intercept: float
    low: np.ndarray
    high: np.ndarray

    @property
    def coefficients(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(self.raw * (self.high - self.low))

    @property
    def intercept(self) -> float:
        return float(self.raw_intercept + self.raw @ self.low)

    def prediction(self) -> Column:
        """The prediction as an expression over the feature columns."""
        out = F.lit(float(self.raw_intercept))
        for name, c in zip(self.features, self.raw):
            out = out + F.lit(float(c)) * F.col(name)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its feature vector and ``prediction``, as a pipeline model adds them."""
        return assembler(self.features).transform(df).withColumn("prediction", self.prediction())


def parts_of(table: DataFrame, part: str = PART) -> dict:
    """Moments by part: as many rows as there are folds."""
    return {r[part]: Moments.of(r) for r in table.collect()}


def left_out(by_part: Mapping, part) -> Moments:
    """The moments of all other parts together."""
    total = None
    for key in sorted(by_part):
        if key != part:
            total = by_part[key] if total is None else total + by_part[key]
    return total


def _rmse(fit: Moments, held: Moments, reg_params: Sequence[float], features: Sequence[str]) -> list[float]:
    fitted = {r: fit.ridge(r, features) for r in dict.fromkeys(reg_params)}
    return [float(np.sqrt(max(held.squared_error(fitted[r]), 0.0) / held.n)) for r in reg_params]


def cross_validate(train: DataFrame, features: Sequence[str], reg_params: Sequence[float], key_cols: Sequence[str],
                   k: int, label: str = "label") -> tuple[list[float], dict]:
    """Mean RMSE over ``k`` key-hash folds for each penalty, and the moments of
    the folds (their sum gives the refit).  Empty folds do not count."""
    folded = with_fold(train.select(*dict.fromkeys([*key_cols, *features, label])), key_cols, k, col=PART)
    by_fold = parts_of(moments(folded, features, label))
    if len(by_fold) < 2:
        raise ValueError(f"{len(by_fold)} of {k} folds have rows: at least two are needed")
    errors = [_rmse(left_out(by_fold, i), by_fold[i], reg_params, features) for i in sorted(by_fold)]
    return [float(v) for v in np.mean(errors, axis=0)], by_fold


def train_validate(train: DataFrame, features: Sequence[str], reg_params: Sequence[float], key_cols: Sequence[str],
                   train_ratio: float = 0.8, label: str = "label", offset: int = 9) -> tuple[list[float], dict]:
    """RMSE on the validation rows of the key-hash cut for each penalty, and the
    moments of both parts (0 validation, 1 fit)."""
    flag = split_flag(key_cols, train_ratio, offset).cast("int").alias(PART)
    cut = train.select(*dict.fromkeys([*features, label]), flag)
    both = parts_of(moments(cut, features, label))
    if len(both) < 2:
        raise ValueError("one of the two parts has no rows")
    return _rmse(both[1], both[0], reg_params, features), both


def refit(by_part: Mapping, reg_param: float, features: Sequence[str]) -> RidgeModel:
    """The fit of all parts together."""
    return left_out(by_part, None).ridge(reg_param, features)
