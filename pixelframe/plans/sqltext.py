"""Small generators of ANSI-SQL fragments used by the oracle texts."""

from __future__ import annotations

from typing import Sequence

from pixelframe.operators.prep import split_threshold
from pixelframe.sources.pixels import FEATURES
from pixelframe.sources.testdata import F2_KEYS, F2_SQL


def nonzero(cols: Sequence[str] = FEATURES) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND {c} <> 0" for c in cols)


def present(cols: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)


def key_hash(keys: Sequence[str] = F2_KEYS) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"COALESCE(CAST({k} AS VARCHAR), '\\N')" for k in keys) + "))"


def split_flag(fraction: float, offset: int = 1, keys: Sequence[str] = F2_KEYS) -> str:
    return f"(SUBSTRING({key_hash(keys)}, {offset}, 4) < '{split_threshold(fraction)}')"


def fold(k: int, offset: int = 5, keys: Sequence[str] = F2_KEYS) -> str:
    return f"CAST((('0x' || SUBSTRING({key_hash(keys)}, {offset}, 4))::INTEGER) % {k} AS INTEGER)"


KEYS = ", ".join(F2_KEYS)
FEATS = ", ".join(FEATURES)

# F2 -> drop zero/null bands -> features + label -> drop missing
PREPARED_SQL = f"""
SELECT {KEYS}, {FEATS}, burned AS label
FROM ({F2_SQL}) f2
WHERE {nonzero()} AND {present(FEATURES + ['burned'])}"""

# ... -> class weight
WEIGHTED_SQL = f"""
SELECT p.*, CASE WHEN p.label = 1 THEN r.ratio ELSE 1 - r.ratio END AS class_weight
FROM ({PREPARED_SQL}) p,
     (SELECT COUNT(*) FILTER (WHERE label = 0) /
             COUNT(*) FILTER (WHERE label IN (0, 1)) AS ratio
      FROM ({PREPARED_SQL}) q) r"""
