"""Ledger of a search: the metric of every finished fit, kept in a shared folder.

A search that is stopped is started again with the same ledger and fits only
what is missing.  Entries carry a fingerprint of the search (estimator, maps,
folds, metric) and of its rows, so a ledger is never used for anything else;
several searches may share a folder.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "search STRING, fold INT, map INT, metric DOUBLE"


def _params(stage) -> list:
    return [type(stage).__name__, sorted((p.name, str(v)) for p, v in stage.extractParamMap().items() if p.name != "stages")]


def search_id(est: Estimator, maps: Sequence[dict], rows: DataFrame, settings: Sequence) -> str:
    """Fingerprint of a search over ``rows``: its stages, maps and settings, and
    the count and an order-free hash of the rows (one aggregate)."""
    stages = est.getStages() if isinstance(est, Pipeline) else [est]
    n, bits, total = rows.select(F.xxhash64(*rows.columns).alias("h")).agg(
        F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.pmod("h", F.lit(1 << 31)))).first()
    what = [[_params(s) for s in stages], [sorted((p.name, str(v)) for p, v in m.items()) for m in maps],
            [str(s) for s in settings], rows.columns, n, bits, total]
    return hashlib.sha256(json.dumps(what).encode()).hexdigest()


class Ledger:
    """The finished fits of one search under ``path`` (a folder that the driver
    and all executors share)."""

    def __init__(self, spark: SparkSession, path: str, search: str):
        self.spark, self.path, self.search = spark, path.rstrip("/"), search
        self.known = self._read()

    def _read(self) -> dict[tuple[int, int], float]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return {}
        rows = self.spark.read.schema(_SCHEMA).parquet(self.path).where(F.col("search") == self.search)
        return {(r["fold"], r["map"]): r["metric"] for r in rows.collect()}  # folds x maps numbers

    def missing(self, fold: int, maps: Iterable[int]) -> list[int]:
        return [i for i in maps if (fold, i) not in self.known]

    def append(self, fold: int, found: dict[int, float]) -> None:
        """Note finished fits at once: each call writes one file."""
        rows = [(self.search, fold, i, float(v)) for i, v in found.items()]
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        self.known.update({(fold, i): float(v) for i, v in found.items()})

    def metrics(self, fold: int, n_maps: int) -> list[float]:
        return [self.known[fold, i] for i in range(n_maps)]
