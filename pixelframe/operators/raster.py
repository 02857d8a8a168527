"""Raster algebra as DataFrame work.

A raster is either a *wide* pixel table (one row per pixel, one column per
band, ``row_px``/``col_px`` index), a *long* table (``band, row_px, col_px,
value``) or a *tile* table (``band, tile_row, tile_col, values
ARRAY<ARRAY<DOUBLE>>``).  Reprojection is: target grid (tiny aggregate) ->
cell centres from ``spark.range`` -> inverse projection as Column math ->
``floor`` to a source pixel -> equi-join on the pixel index.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.functions.albers import CONUS_ALBERS, AlbersParams, albers_forward, albers_inverse
from pixelframe.sources.raster import RasterMeta

ROW, COL = "row_px", "col_px"

# Rows of the source pixel table that may be broadcast for the resampling
# join; the bound is proven by the raster metadata (width * height).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Destination cells per partition of the generated grid.
CELLS_PER_PARTITION = 2_000_000
# Pixel values of the long table that one task gathers into tiles or stacks.
VALUES_PER_TASK = 500_000


# ---- pixel index, names, long/wide/tiles ------------------------------------

def with_pixel_index(df: DataFrame, width: int, idx: str = "idx") -> DataFrame:
    """Row-major linear index ``row * width + col`` as BIGINT."""
    return df.withColumn(idx, F.col(ROW).cast("long") * F.lit(int(width)) + F.col(COL).cast("long"))


def from_pixel_index(df: DataFrame, width: int, idx: str = "idx") -> DataFrame:
    """Inverse of ``with_pixel_index``: row = idx div width, col = idx mod width."""
    w = F.lit(int(width))
    return (df.withColumn(ROW, F.floor(F.col(idx) / w).cast("int"))
              .withColumn(COL, (F.col(idx) % w).cast("int")))


def name_bands(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of all columns (G10); the arity must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def to_long(wide: DataFrame, band_cols: Sequence[str]) -> DataFrame:
    """Wide pixels -> ``band, row_px, col_px, value`` (band numbers from 1)."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("band"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(band_cols)]))
    return wide.select(ROW, COL, cells.alias("b")).select("b.band", ROW, COL, "b.value")


def _band_columns(n_bands: int, names: Sequence[str] | None) -> list[Column]:
    """One aggregate per band: the pivot on known band numbers, written as
    conditional aggregates so it is a single aggregation (``pivot`` plans two)."""
    names = list(names) if names else [f"Band_{i}" for i in range(1, n_bands + 1)]
    if len(names) != n_bands:
        raise ValueError(f"{len(names)} names for {n_bands} bands")
    return [F.max(F.when(F.col("band") == F.lit(i + 1), F.col("value"))).alias(n)
            for i, n in enumerate(names)]


def value_tasks(spark: SparkSession, n_values: int) -> int:
    """Tasks that gather ``n_values`` rows of a long table: their number grows with
    the rows, so that what a task holds does not."""
    return max(spark.sparkContext.defaultParallelism, -(-n_values // VALUES_PER_TASK))


def stack_bands(long: DataFrame, n_bands: int, names: Sequence[str] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Long -> wide: one column per band, ``Band_1..Band_n`` by default.

    One shuffle on (row_px, col_px) with map-side partial aggregation; each
    group holds at most ``n_bands`` rows (one value per band and pixel).  With
    ``partitions`` (``value_tasks``) the rows are dealt to so many tasks first:
    where the bands of a pixel come from different tasks, a map-side table would
    hold a group for almost every row and merge nothing.
    """
    cols = _band_columns(n_bands, names)
    if partitions is not None:
        long = long.repartition(partitions, ROW, COL)
    wide = long.groupBy(ROW, COL).agg(*cols)
    return wide.select(*[c for c in wide.columns if c not in (ROW, COL)], ROW, COL)


def to_tiles(long: DataFrame, tile: int = 50, partitions: int | None = None) -> DataFrame:
    """Long -> ``band, tile_row, tile_col, values ARRAY<ARRAY<DOUBLE>>``.

    One shuffle on (band, tile_row, tile_col); both collect steps reuse
    that partitioning and every collected group is bounded by the tile size.
    Values are placed by their offset in the tile: an absent pixel leaves a
    null, not a gap that moves the rest.  A repeated pixel is an error.  A tile
    without absent pixels is its sorted values; only others are looked up place by
    place.  ``partitions``: tasks of the shuffle (``value_tasks``).
    """
    t = F.lit(int(tile))
    keys = ["band", "tile_row", "tile_col"]
    keyed = (long.withColumn("tile_row", F.floor(F.col(ROW) / t).cast("int"))
                 .withColumn("tile_col", F.floor(F.col(COL) / t).cast("int"))
                 .repartition(*keys if partitions is None else (partitions, *keys)))

    def placed(offset: Column, value: str) -> Column:
        entries = F.sort_array(F.collect_list(F.struct(offset.alias("at"), F.col(value).alias("v"))))
        at = F.map_from_entries(entries)
        looked_up = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys(at))), lambda i: F.element_at(at, i))
        whole = entries["at"] == F.sequence(F.lit(0), F.array_max(entries["at"]))
        return F.when(whole, entries["v"]).otherwise(looked_up)

    rows = (keyed.groupBy("band", "tile_row", "tile_col", ROW)
            .agg(placed(F.col(COL) - F.col("tile_col") * t, "value").alias("vals")))
    return (rows.groupBy("band", "tile_row", "tile_col")
            .agg(placed(F.col(ROW) - F.col("tile_row") * t, "vals").alias("values")))


def flatten_tiles(tiles: DataFrame, tile: int = 50, keep_tile: bool = False) -> DataFrame:
    """Tiles -> long ``band, row_px, col_px, value`` (G7): two ``posexplode``s, no shuffle."""
    t = F.lit(int(tile))
    r = tiles.select("band", "tile_row", "tile_col", F.posexplode("values").alias("r", "row_vals"))
    c = r.select("band", "tile_row", "tile_col", "r", F.posexplode("row_vals").alias("c", "value"))
    extra = ["tile_row", "tile_col"] if keep_tile else []
    return c.select("band", *extra, (F.col("tile_row") * t + F.col("r")).cast("int").alias(ROW),
                    (F.col("tile_col") * t + F.col("c")).cast("int").alias(COL), "value")


def stack_tiles(tiles: DataFrame, n_bands: int, tile: int = 50,
                names: Sequence[str] | None = None) -> DataFrame:
    """Tiles of all bands -> wide pixels with a single shuffle of the compact tiles.

    Tiles are co-located by (tile_row, tile_col); flattening is narrow and
    the band pivot groups by keys that include the tile key, so it needs no
    second exchange.
    """
    cols = _band_columns(n_bands, names)
    long = flatten_tiles(tiles.repartition("tile_row", "tile_col"), tile, keep_tile=True)
    wide = long.groupBy("tile_row", "tile_col", ROW, COL).agg(*cols)
    return wide.select(*[c for c in wide.columns if c not in ("tile_row", "tile_col", ROW, COL)], ROW, COL)


def band_overview(pixels: DataFrame, band: str, block: int) -> DataFrame:
    """Coarse picture of one band (G11): stats per ``block`` x ``block`` pixels.

    Map-side partial aggregation; output is (rows/block) x (cols/block).
    """
    b = F.lit(int(block))
    v = F.col(band)
    return (pixels.groupBy(F.floor(F.col(ROW) / b).cast("int").alias("block_row"),
                           F.floor(F.col(COL) / b).cast("int").alias("block_col"))
            .agg(F.count(F.lit(1)).alias("n_pixels"), F.count(v).alias("n_values"),
                 F.min(v).alias("min_value"), F.max(v).alias("max_value"),
                 F.avg(v).alias("avg_value")))


# ---- target grid and resampling ---------------------------------------------

@dataclass(frozen=True)
class TargetGrid:
    left: float
    top: float
    res: float
    width: int
    height: int

    @property
    def n_cells(self) -> int:
        return self.width * self.height


def boundary_points(spark: SparkSession, meta: RasterMeta, densify: int = 21) -> DataFrame:
    """``densify`` evenly spaced points on each edge of the source bounds."""
    if densify < 2:
        raise ValueError("densify must be at least 2")
    left, bottom, right, top = meta.bounds
    i = F.col("id")
    t = (i % densify).cast("double") / F.lit(float(densify - 1))
    edge = F.floor(i / densify)
    x = (F.when(edge <= 1, F.lit(left) + t * F.lit(right - left))
         .when(edge == 2, F.lit(left)).otherwise(F.lit(right)))
    y = (F.when(edge == 0, F.lit(bottom)).when(edge == 1, F.lit(top))
         .otherwise(F.lit(bottom) + t * F.lit(top - bottom)))
    return spark.range(0, 4 * densify, numPartitions=1).select(x.alias("lon"), y.alias("lat"))


def target_grid_frame(spark: SparkSession, meta: RasterMeta, resolution: float | None = None,
                      params: AlbersParams = CONUS_ALBERS, densify: int = 21) -> DataFrame:
    """Target grid (G1): projected extent of the densified source bounds,
    top-left anchored, ``ceil`` to whole cells.  One row.

    ``resolution=None`` keeps the cell count close to the source pixel
    count: res = sqrt(projected extent area / (width * height)), so the
    grid grows with the source raster.
    """
    pts = boundary_points(spark, meta, densify)
    x, y = albers_forward("lon", "lat", params)
    ext = pts.select(x.alias("x"), y.alias("y")).agg(
        F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        F.min("y").alias("min_y"), F.max("y").alias("max_y"))
    if resolution is None:
        r = F.sqrt((F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y"))
                   / F.lit(float(meta.n_pixels)))
    else:
        r = F.lit(float(resolution))
    ext = ext.withColumn("res", r)
    return ext.select(
        F.col("min_x").alias("left"), F.col("max_y").alias("top"), "res",
        F.ceil((F.col("max_x") - F.col("min_x")) / F.col("res")).cast("int").alias("width"),
        F.ceil((F.col("max_y") - F.col("min_y")) / F.col("res")).cast("int").alias("height"))


def target_grid(spark: SparkSession, meta: RasterMeta, resolution: float | None = None,
                params: AlbersParams = CONUS_ALBERS, densify: int = 21) -> TargetGrid:
    row = target_grid_frame(spark, meta, resolution, params, densify).first()
    return TargetGrid(float(row["left"]), float(row["top"]), float(row["res"]),
                      int(row["width"]), int(row["height"]))


def grid_cells(spark: SparkSession, grid: TargetGrid, num_partitions: int | None = None) -> DataFrame:
    """Every destination cell with its centre coordinates (G3), from ``spark.range``."""
    n = grid.n_cells
    parts = num_partitions or max(spark.sparkContext.defaultParallelism,
                                  math.ceil(n / CELLS_PER_PARTITION))
    w = F.lit(int(grid.width))
    cells = spark.range(0, n, numPartitions=parts)
    return cells.select(
        F.floor(F.col("id") / w).cast("int").alias(ROW), (F.col("id") % w).cast("int").alias(COL),
    ).select(ROW, COL,
             (F.lit(grid.left) + (F.col(COL) + F.lit(0.5)) * F.lit(grid.res)).alias("x"),
             (F.lit(grid.top) - (F.col(ROW) + F.lit(0.5)) * F.lit(grid.res)).alias("y"))


def source_pixel(lon: Column, lat: Column, meta: RasterMeta) -> tuple[Column, Column]:
    """Source (row, col) containing a point; fractional positions are rounded
    to 6 decimals before ``floor`` so edge ties do not depend on trig ulps."""
    col = F.floor(F.round((lon - F.lit(meta.left)) / F.lit(meta.xres), 6)).cast("int")
    row = F.floor(F.round((F.lit(meta.top) - lat) / F.lit(meta.yres), 6)).cast("int")
    return row, col


def resample_nearest(cells: DataFrame, pixels: DataFrame, meta: RasterMeta,
                     band_cols: Sequence[str], params: AlbersParams = CONUS_ALBERS,
                     nodata: float | None = None, broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
                     join_hint: str | None = None) -> DataFrame:
    """Nearest-neighbour reprojection of all bands at once.

    Each destination centre is inverse-projected once and floored to the
    source pixel containing it; the lookup is a left equi-join on that
    pixel index.  Cells outside the source get out-of-range (never null)
    indices, so they spread over partitions like any other key, match
    nothing and carry ``nodata``, as do source nulls.  No filter is put on
    the projected index: Catalyst would push it below the projection and
    evaluate the trigonometry twice.  The pixel side is broadcast only if
    both its metadata (width * height rows) and a count of its rows, which
    stops at the bound, are under the bound; otherwise both sides shuffle on the pixel key (AQE splits the
    hot keys of upsampling, where one pixel feeds many cells), or, with
    ``join_hint="merge"`` on a table bucketed by the pixel index, only the
    cells shuffle.
    """
    nodata = meta.nodata if nodata is None else nodata
    fill = F.lit(None).cast("double") if nodata is None else F.lit(float(nodata))
    lon, lat = albers_inverse("x", "y", params)
    src_row, src_col = source_pixel(lon, lat, meta)
    located = cells.select(ROW, COL, src_row.alias("src_row"), src_col.alias("src_col"))
    src = pixels.select(ROW, COL, *[F.col(b).cast("double").alias(b) for b in band_cols])
    most = broadcast_max_bytes // (8 * (len(band_cols) + 2))  # rows under the bound
    if meta.n_pixels <= most and src.limit(most + 1).count() <= most:  # the table itself, not its metadata alone
        src = F.broadcast(src)
    elif join_hint:
        src = src.hint(join_hint)
    # join on the source's own index columns, so a table bucketed by
    # (row_px, col_px) keeps its bucketing and only the cells are shuffled
    on = (F.col("c.src_row") == F.col("s." + ROW)) & (F.col("c.src_col") == F.col("s." + COL))
    joined = located.alias("c").join(src.alias("s"), on, "left")
    return joined.select(F.col("c." + ROW).alias(ROW), F.col("c." + COL).alias(COL),
                         *[F.coalesce(F.col("s." + b), fill).alias(b) for b in band_cols])


def resample_tiles(cells: DataFrame, tiles: DataFrame, meta: RasterMeta, tile: int, band_names: Sequence[str],
                   params: AlbersParams = CONUS_ALBERS, nodata: float | None = None, block: int = 64) -> DataFrame:
    """Nearest-neighbour reprojection straight from stored tiles (G4, G5, S8):
    the result of ``resample_nearest`` without flattening the tiles.

    Cells are binned to the source tile they hit, in groups of at most ``block`` x
    ``block`` destination cells, so that neither a group nor a key grows with the
    data; the join is by tile, and a cell takes its values from the tile's arrays by
    offset.  One aggregate finds the tile rows that are hit; with tiles stored by
    ``partitionBy("tile_row")`` only those partitions are scanned.  Cells outside
    the source hit tiles that are not there.
    """
    nodata = meta.nodata if nodata is None else nodata
    lon, lat = albers_inverse("x", "y", params)
    src_row, src_col = source_pixel(lon, lat, meta)
    t, b = F.lit(int(tile)), F.lit(int(block))
    located = cells.select(ROW, COL, src_row.alias("r"), src_col.alias("c"))
    binned = located.select(ROW, COL, F.floor(F.col("r") / t).cast("int").alias("tile_row"),
                            F.floor(F.col("c") / t).cast("int").alias("tile_col"), "r", "c")
    groups = binned.groupBy("tile_row", "tile_col", F.floor(F.col(ROW) / b).alias("block_row"),
                            F.floor(F.col(COL) / b).alias("block_col")).agg(
        F.collect_list(F.struct(ROW, COL, (F.col("r") - F.col("tile_row") * t).alias("dr"),
                                (F.col("c") - F.col("tile_col") * t).alias("dc"))).alias("cells"))
    hit = located.agg(F.min("r").alias("low"), F.max("r").alias("high")).first()
    if hit["low"] is not None:
        low, high = max(0, hit["low"]) // tile, min(meta.height - 1, hit["high"]) // tile
        tiles = tiles.where(F.col("tile_row").between(low, high))
    stacked = tiles.groupBy("tile_row", "tile_col").agg(*[
        F.first(F.when(F.col("band") == i + 1, F.col("values")), ignorenulls=True).alias(f"v{i}")
        for i in range(len(band_names))])
    joined = groups.join(stacked, ["tile_row", "tile_col"], "left")

    def taken(cell: Column) -> Column:
        return F.struct(cell[ROW].alias(ROW), cell[COL].alias(COL), *[
            F.get(F.get(F.col(f"v{i}"), cell["dr"]), cell["dc"]).alias(n) for i, n in enumerate(band_names)])

    one = joined.select(F.explode(F.transform("cells", taken)).alias("p")).select("p.*")
    fill = F.lit(None).cast("double") if nodata is None else F.lit(float(nodata))
    return one.select(ROW, COL, *[F.coalesce(n, fill).alias(n) for n in band_names])
