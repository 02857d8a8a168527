"""Raster metadata as a table, band scans and partitioned pixel sinks."""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RasterMeta:
    """Georeferencing of a north-up raster: top-left origin, positive pixel sizes."""

    crs: str
    left: float
    top: float
    xres: float
    yres: float
    width: int
    height: int
    count: int
    nodata: float | None = None
    dtype: str = "float64"

    @property
    def right(self) -> float:
        return self.left + self.width * self.xres

    @property
    def bottom(self) -> float:
        return self.top - self.height * self.yres

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        """(left, bottom, right, top)."""
        return self.left, self.bottom, self.right, self.top

    @property
    def transform(self) -> tuple[float, float, float, float, float, float]:
        """Affine (a, b, c, d, e, f): x = a*col + b*row + c, y = d*col + e*row + f."""
        return self.xres, 0.0, self.left, 0.0, -self.yres, self.top

    @property
    def n_pixels(self) -> int:
        return self.width * self.height

    def with_(self, **kw) -> "RasterMeta":
        return replace(self, **kw)


def raster_meta_frame(spark: SparkSession, meta: RasterMeta) -> DataFrame:
    """One-row metadata table."""
    row = asdict(meta)
    row.update(dict(zip(("bound_left", "bound_bottom", "bound_right", "bound_top"), meta.bounds)))
    row["transform"] = list(meta.transform)
    schema = ("crs STRING, left DOUBLE, top DOUBLE, xres DOUBLE, yres DOUBLE, width INT, "
              "height INT, count INT, nodata DOUBLE, dtype STRING, bound_left DOUBLE, "
              "bound_bottom DOUBLE, bound_right DOUBLE, bound_top DOUBLE, transform ARRAY<DOUBLE>")
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(row[c] for c in cols)], schema)


def read_band(tiles: DataFrame, band: int) -> DataFrame:
    """Band ``band`` (1-based) of a tile or long table.

    On a table written with ``partitionBy("band")`` this is a partition
    prune: only that band's files are listed and read.
    """
    if band < 1:
        raise ValueError("bands are numbered from 1")
    return tiles.filter(F.col("band") == F.lit(int(band)))


def write_pixels(df: DataFrame, path: str, partition_by: str | None = "band",
                 mode: str = "overwrite") -> None:
    """Partitioned Parquet sink for long pixels or tiles."""
    w = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def rewrite_bands(df: DataFrame, path: str, partition_by: str = "band") -> None:
    """Replace the bands that ``df`` holds in a table of ``write_pixels`` and leave
    the files of all others (S9): a sink that stopped is run again for what is
    missing.  A band without rows in ``df`` stays as it is."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_by).parquet(path))


def _spread(v: Column) -> Column:
    """The 32 bits of a non-negative number on the even places of 64."""
    v = v.cast("long")
    # fixed values: shift and mask of each doubling step
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton_key(row: str | Column = "row_px", col: str | Column = "col_px") -> Column:
    """Place on the Z-order curve: pixels near each other in both directions are
    mostly near each other in this order."""
    row, col = (F.col(c) if isinstance(c, str) else c for c in (row, col))
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(col))


def write_pixels_ordered(df: DataFrame, path: str, rows_per_file: int = 2_000_000,
                         row_group_bytes: int = 8 * 1024 * 1024, mode: str = "overwrite") -> None:
    """Wide pixels along the Z-order curve (S9): files are ranges of it and sorted
    by it, so row groups are compact areas and a window of rows and columns skips
    the others by their statistics: fewer rows are read than from a row-by-row sink
    where a window spans many row groups.  The number of files follows from a count."""
    files = max(1, -(-df.count() // rows_per_file))
    key = "__place"
    (df.withColumn(key, morton_key()).repartitionByRange(files, key).sortWithinPartitions(key).drop(key)
       .write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path))


def read_window(spark: SparkSession, path: str, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Pixels of the rows and columns [first, last) of a stored pixel table."""
    r, c = F.col("row_px"), F.col("col_px")
    return spark.read.parquet(path).where((r >= rows[0]) & (r < rows[1]) & (c >= cols[0]) & (c < cols[1]))


def write_pixels_bucketed(df: DataFrame, table: str, path: str, buckets: int,
                          keys: tuple[str, str] = ("row_px", "col_px")) -> DataFrame:
    """Wide pixels as an external Parquet table bucketed (and sorted) by the
    pixel index, at ``path`` in shared storage.  Rows are dealt by bucket
    before the write, so there is one file per bucket.  Take ``buckets`` by
    the table's size (about 256 MB each) and join with as many shuffle
    partitions: then only the other side moves.

    Joins on the pixel index against this table (resampling the same source
    onto several grids) shuffle only the other side; the pixel side is read
    bucket by bucket in place.
    """
    (df.repartition(int(buckets), *keys).write.mode("overwrite").option("path", path)
       .bucketBy(int(buckets), *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)
