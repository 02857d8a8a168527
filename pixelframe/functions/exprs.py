"""Scalar Column expressions shared by the operators."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``default``."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(float(default)))


def percent_string(c: str | Column, decimals: int = 2) -> Column:
    """``0.9318`` -> ``'93.18%'``."""
    return F.format_string(f"%.{int(decimals)}f%%", _c(c) * F.lit(100.0))


def fixed_string(c: str | Column, decimals: int = 4) -> Column:
    """Fixed-point text with ``decimals`` places."""
    return F.format_string(f"%.{int(decimals)}f", _c(c))


def key_hash(key_cols: Iterable[str | Column]) -> Column:
    """Lower-case hex md5 of the keys joined by '-', null as ``\\N`` (engine-independent)."""
    parts = [F.coalesce(_c(k).cast("string"), F.lit("\\N")) for k in key_cols]
    return F.md5(F.concat_ws("-", *parts))


def hash_bucket(key_cols: Iterable[str | Column], offset: int, width: int = 4) -> Column:
    """Integer value of ``width`` hex digits of the key hash, from 1-based ``offset``."""
    return F.conv(F.substring(key_hash(key_cols), offset, width), 16, 10).cast("long")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column to ``digits`` places (HALF_UP)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
