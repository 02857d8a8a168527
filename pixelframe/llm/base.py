"""Helpers shared by the operators: table access, shared scratch tables, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pixelframe.session import checkpoint_dir, read_table, scratch_path

__all__ = ["WS", "checkpoint_dir", "read_table", "stored", "discard", "lower_ascii", "split_words", "ROW", "with_row_key"]

#: White space between words: space and U+0009 to U+000D.
WS = r"[\x20\x09-\x0D]+"
#: Name of the row key that ``with_row_key`` adds.
ROW = "__row_key"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the plan is
    cut there, later branches do not repeat it, and a lost executor costs only
    the tasks that read the table.  The shuffle files of the write go with it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the scratch tables that the frames read, when nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/pixelframe-scratch/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does that at once when the text is pure
    ASCII; other texts take the slower character map."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def split_words(text: Column, separators: str = WS) -> Column:
    """Array of the non-empty words between ``separators``; null text: empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def with_row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its own for every row (``ROW``), written once so
    that the keys never change: doc_id may be null or repeated."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
