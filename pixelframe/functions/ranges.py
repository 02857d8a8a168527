"""Order statistics over a whole table without a one-task sort.

The table is cut by range on the ordering columns, so equal keys share a
partition; each partition is sorted by itself, and its totals (one row per
partition) are added up to offsets that are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pixelframe.session import scratch_path


def range_parts(df: DataFrame, order: Sequence[Column], part: str = "_part") -> DataFrame:
    """``df`` cut by range, with the number of the partition in ``part``.

    Written once to the shared scratch folder: the range bounds are drawn from
    a sample, so a second evaluation could cut elsewhere."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    cut = df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id())
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def global_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in the given order as ``name``."""
    part = f"_{name}_part"
    cut = range_parts(df, order, part)
    local = cut.withColumn(name, F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long") - 1)
    offsets = _before(cut.groupBy(part).agg(F.count("*").alias("_n")), part, ["_n"])
    return (local.join(F.broadcast(offsets), part)
            .withColumn(name, F.col(name) + F.col("_n_before")).drop(part, "_n_before"))


def running_sum(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before each one as ``name``.  Rows
    that are equal in ``order`` must not occur (group by it first)."""
    part = f"_{name}_part"
    cut = range_parts(df, order, part)
    before = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    offsets = _before(cut.groupBy(part).agg(F.sum(value).alias("_n")), part, ["_n"])
    return (local.join(F.broadcast(offsets), part)
            .withColumn(name, F.col(name) + F.col("_n_before")).drop(part, "_n_before"))


def running_sum_by(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """``running_sum`` that starts again with every value of ``by``, all in one
    range cut: a large group lies in several ranges, small ones share one.  The
    totals joined back are a row for each range and each value of ``by``."""
    part = f"_{name}_part"
    cut = range_parts(df, [*[F.col(b).asc_nulls_first() for b in by], *order], part)
    before = Window.partitionBy(part, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(part, *by).agg(F.sum(value).alias("_n")).select(
        F.col(part).alias("_p"), *[F.col(b).alias(f"_by_{b}") for b in by],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"))
    same = F.col(part) == F.col("_p")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return (local.join(F.broadcast(offsets), same)
            .withColumn(name, F.col(name) + F.col("_n_before")).select(*df.columns, name))


def _before(totals: DataFrame, part: str, cols: Sequence[str]) -> DataFrame:
    """Sum of ``cols`` over the partitions before each one: one row per range
    partition, never more than ``spark.sql.shuffle.partitions``."""
    w = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_before") for c in cols])
