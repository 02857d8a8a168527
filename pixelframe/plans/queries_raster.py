"""Queries for raster algebra and reprojection (F1 pixel grid, F4 tiles)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelframe.functions.albers import albers_forward, albers_inverse, sql_forward, sql_inverse
from pixelframe.functions.exprs import round_doubles
from pixelframe.operators import raster as R
from pixelframe.plans.registry import register
from pixelframe.session import scratch_path, scratch_table
from pixelframe.sources.pixels import BAND_NAMES, pixel_schema, read_pixels_csv, write_pixels_csv
from pixelframe.sources.raster import read_band, write_pixels
from pixelframe.sources.testdata import (
    F1_CRS, F1_LEFT, F1_NODATA, F1_SPAN_X, F1_SPAN_Y, F1_SQL, F1_TOP, F1_WIDTH, band_tiles, band_value_tasks,
    pixel_grid, pixel_grid_meta,
)

TILE = 50
FIXED_RESOLUTION = 10_000.0  # metres
RESOLUTION = None  # cell count ~ source pixel count, so the grid grows with the data
DENSIFY = 21
F1 = f"({F1_SQL}) f1"
BANDS = ", ".join(f"{b} AS Band_{i + 1}" for i, b in enumerate(BAND_NAMES))


def _long_sql(bands=None) -> str:
    idx = bands or range(1, len(BAND_NAMES) + 1)
    return " UNION ALL ".join(
        f"SELECT {i} AS band, row_px, col_px, {BAND_NAMES[i - 1]} AS value FROM {F1}" for i in idx)


# ---- index, names, long/wide/tiles ------------------------------------------

@register("pixel_index", "G8", sql=f"SELECT CAST(row_px AS BIGINT) * {F1_WIDTH} + col_px AS idx, row_px, col_px FROM {F1}")
def pixel_index(spark, sf_dir):
    idx = R.with_pixel_index(pixel_grid(spark, sf_dir), F1_WIDTH).select("idx")
    return R.from_pixel_index(idx, F1_WIDTH)


@register("flatten_tiles", "G7", sql=_long_sql())
def flatten_tiles(spark, sf_dir):
    return R.flatten_tiles(band_tiles(spark, sf_dir, TILE), TILE)


@register("stack_bands", "G9", sql=f"SELECT {BANDS}, row_px, col_px FROM {F1}")
def stack_bands(spark, sf_dir):
    return R.stack_bands(R.flatten_tiles(band_tiles(spark, sf_dir, TILE), TILE), len(BAND_NAMES),
                         partitions=band_value_tasks(spark, sf_dir))


@register("stack_tiles", "G7,G9", sql=f"SELECT {BANDS}, row_px, col_px FROM {F1}")
def stack_tiles(spark, sf_dir):
    return R.stack_tiles(band_tiles(spark, sf_dir, TILE), len(BAND_NAMES), TILE)


@register("name_bands", "G10,G9", sql=F1_SQL)
def name_bands(spark, sf_dir):
    wide = R.stack_bands(R.flatten_tiles(band_tiles(spark, sf_dir, TILE), TILE), len(BAND_NAMES),
                         partitions=band_value_tasks(spark, sf_dir))
    return R.name_bands(wide, BAND_NAMES + ["row_px", "col_px"])


@register("band_scan", "S8,G7", sql=_long_sql([2]))
def band_scan(spark, sf_dir):
    return R.flatten_tiles(read_band(band_tiles(spark, sf_dir, TILE), 2), TILE)


@register("write_band_tiles", "S9,S8", sql=_long_sql())
def write_band_tiles(spark, sf_dir):
    path = scratch_path(spark, "band-tiles")
    write_pixels(band_tiles(spark, sf_dir, TILE), path, partition_by="band")
    back = spark.read.parquet(path)
    bands = [R.flatten_tiles(read_band(back, b), TILE) for b in range(1, len(BAND_NAMES) + 1)]
    return reduce(DataFrame.unionByName, bands).select("band", "row_px", "col_px", "value")


@register("band_overview", "G11", sql=f"""
SELECT CAST(FLOOR(row_px / 10) AS INTEGER) AS block_row, CAST(FLOOR(col_px / 10) AS INTEGER) AS block_col,
       COUNT(*) AS n_pixels, COUNT(lst) AS n_values, MIN(lst) AS min_value, MAX(lst) AS max_value,
       ROUND(AVG(lst), 6) AS avg_value
FROM {F1} GROUP BY 1, 2""")
def band_overview(spark, sf_dir):
    return round_doubles(R.band_overview(pixel_grid(spark, sf_dir), "lst", 10), 6)


# ---- projection, grid, resampling -------------------------------------------

def _meta_sql() -> str:
    return f"""
SELECT {F1_LEFT!r}E0 AS left_, {F1_TOP!r}E0 AS top_, {F1_SPAN_X!r}E0 / {F1_WIDTH} AS xres,
       {F1_SPAN_Y!r}E0 / (MAX(row_px) + 1) AS yres, {F1_WIDTH} AS width, MAX(row_px) + 1 AS height
FROM {F1}"""


def _grid_sql(resolution: float | None = None) -> str:
    res = (f"{float(resolution)!r}E0" if resolution else
           "SQRT((MAX(x) - MIN(x)) * (MAX(y) - MIN(y)) / CAST(ANY_VALUE(m.width * m.height) AS DOUBLE))")
    fx, fy = sql_forward("lon", "lat")
    return f"""
WITH meta AS ({_meta_sql()}),
b AS (SELECT left_ AS l, top_ - height * yres AS bo, left_ + width * xres AS r, top_ AS t FROM meta),
ids AS (SELECT UNNEST(RANGE(0, {4 * DENSIFY})) AS i),
pts AS (SELECT CASE WHEN FLOOR(i / {DENSIFY}) <= 1 THEN l + (CAST(i % {DENSIFY} AS DOUBLE) / {float(DENSIFY - 1)!r}E0) * (r - l)
                    WHEN FLOOR(i / {DENSIFY}) = 2 THEN l ELSE r END AS lon,
               CASE WHEN FLOOR(i / {DENSIFY}) = 0 THEN bo WHEN FLOOR(i / {DENSIFY}) = 1 THEN t
                    ELSE bo + (CAST(i % {DENSIFY} AS DOUBLE) / {float(DENSIFY - 1)!r}E0) * (t - bo) END AS lat
        FROM ids, b),
xy AS (SELECT {fx} AS x, {fy} AS y FROM pts),
ext AS (SELECT MIN(x) AS min_x, MAX(x) AS max_x, MIN(y) AS min_y, MAX(y) AS max_y,
               {res} AS res
        FROM xy, meta m)
SELECT min_x AS left_, max_y AS top_, res,
       CAST(CEIL((max_x - min_x) / res) AS INTEGER) AS width,
       CAST(CEIL((max_y - min_y) / res) AS INTEGER) AS height
FROM ext"""


def _cells_sql(resolution: float | None = None) -> str:
    return f"""
SELECT CAST(FLOOR(id / width) AS INTEGER) AS row_px, CAST(id % width AS INTEGER) AS col_px,
       left_ + (CAST(id % width AS INTEGER) + 0.5E0) * res AS x,
       top_ - (CAST(FLOOR(id / width) AS INTEGER) + 0.5E0) * res AS y
FROM (SELECT UNNEST(RANGE(0, width * height)) AS id, * FROM ({_grid_sql(resolution)}) g) c"""


def _resample_sql(resolution: float | None = None) -> str:
    ix, iy = sql_inverse("x", "y")
    fill = ", ".join(f"COALESCE(f1.{b}, {F1_NODATA!r}E0) AS {b}" for b in BAND_NAMES)
    outside = ", ".join(f"{F1_NODATA!r}E0 AS {b}" for b in BAND_NAMES)
    return f"""
WITH meta AS ({_meta_sql()}),
loc AS (SELECT c.row_px, c.col_px,
               CAST(FLOOR(ROUND((meta.top_ - {iy}) / meta.yres, 6)) AS INTEGER) AS src_row,
               CAST(FLOOR(ROUND(({ix} - meta.left_) / meta.xres, 6)) AS INTEGER) AS src_col,
               meta.width AS sw, meta.height AS sh
        FROM ({_cells_sql(resolution)}) c, meta),
inside AS (SELECT * FROM loc WHERE src_row BETWEEN 0 AND sh - 1 AND src_col BETWEEN 0 AND sw - 1)
SELECT inside.row_px, inside.col_px, {fill}
FROM inside LEFT JOIN {F1} ON inside.src_row = f1.row_px AND inside.src_col = f1.col_px
UNION ALL
SELECT row_px, col_px, {outside} FROM loc WHERE NOT (src_row BETWEEN 0 AND sh - 1 AND src_col BETWEEN 0 AND sw - 1)"""


def _grid(spark, sf_dir, resolution=RESOLUTION):
    meta = pixel_grid_meta(spark, sf_dir)
    return meta, R.target_grid(spark, meta, resolution, densify=DENSIFY)


@register("raster_meta", "S7", sql=f"""
SELECT '{F1_CRS}' AS crs, left_ AS "left", top_ AS top, xres, yres, width, height, 9 AS count,
       {F1_NODATA!r}E0 AS nodata, 'float64' AS dtype,
       left_ AS bound_left, top_ - height * yres AS bound_bottom, left_ + width * xres AS bound_right,
       top_ AS bound_top, xres AS t_a, 0E0 AS t_b, left_ AS t_c, 0E0 AS t_d, -yres AS t_e, top_ AS t_f
FROM ({_meta_sql()}) m""")
def raster_meta(spark, sf_dir):
    from pixelframe.sources.raster import raster_meta_frame
    m = raster_meta_frame(spark, pixel_grid_meta(spark, sf_dir))
    return m.select(*[c for c in m.columns if c != "transform"],
                    *[F.col("transform")[i].alias(f"t_{k}") for i, k in enumerate("abcdef")])


@register("albers_forward", "G2", sql=f"""
SELECT row_px, col_px, lon, lat, ROUND({sql_forward('lon', 'lat')[0]}, 3) AS x, ROUND({sql_forward('lon', 'lat')[1]}, 3) AS y
FROM (SELECT row_px, col_px, {F1_LEFT!r}E0 + (col_px + 0.5E0) * m.xres AS lon,
             {F1_TOP!r}E0 - (row_px + 0.5E0) * m.yres AS lat
      FROM {F1}, ({_meta_sql()}) m) p""")
def albers_forward_q(spark, sf_dir):
    meta = pixel_grid_meta(spark, sf_dir)
    p = pixel_grid(spark, sf_dir).select(
        "row_px", "col_px",
        (F.lit(meta.left) + (F.col("col_px") + F.lit(0.5)) * F.lit(meta.xres)).alias("lon"),
        (F.lit(meta.top) - (F.col("row_px") + F.lit(0.5)) * F.lit(meta.yres)).alias("lat"))
    x, y = albers_forward("lon", "lat")
    return p.select("*", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@register("albers_inverse", "G2,G3", sql=f"""
SELECT row_px, col_px, ROUND({sql_inverse('x', 'y')[0]}, 7) AS lon, ROUND({sql_inverse('x', 'y')[1]}, 7) AS lat
FROM ({_cells_sql()}) c""")
def albers_inverse_q(spark, sf_dir):
    _, grid = _grid(spark, sf_dir)
    lon, lat = albers_inverse("x", "y")
    return R.grid_cells(spark, grid).select("row_px", "col_px", F.round(lon, 7).alias("lon"),
                                            F.round(lat, 7).alias("lat"))


@register("target_grid", "G1,S7", sql=f"SELECT ROUND(left_, 3) AS left, ROUND(top_, 3) AS top, ROUND(res, 6) AS res, width, height FROM ({_grid_sql()}) g")
def target_grid(spark, sf_dir):
    meta = pixel_grid_meta(spark, sf_dir)
    g = R.target_grid_frame(spark, meta, RESOLUTION, densify=DENSIFY)
    return g.select(F.round("left", 3).alias("left"), F.round("top", 3).alias("top"),
                    F.round("res", 6).alias("res"), "width", "height")


@register("grid_cells", "G3", sql=f"SELECT row_px, col_px, ROUND(x, 3) AS x, ROUND(y, 3) AS y FROM ({_cells_sql()}) c")
def grid_cells(spark, sf_dir):
    _, grid = _grid(spark, sf_dir)
    return round_doubles(R.grid_cells(spark, grid), 3)


@register("resample_nearest", "G4,G5,G6", sql=_resample_sql())
def resample_nearest(spark, sf_dir):
    meta, grid = _grid(spark, sf_dir)
    return R.resample_nearest(R.grid_cells(spark, grid), pixel_grid(spark, sf_dir), meta, BAND_NAMES)


@register("resample_bucketed", "G4,G5,S9", sql=_resample_sql())
def resample_bucketed(spark, sf_dir):
    """The large-raster path: source pixels in a table bucketed by pixel index,
    no broadcast; only the destination cells are shuffled."""
    from pixelframe.sources.raster import write_pixels_bucketed
    meta, grid = _grid(spark, sf_dir)
    path = scratch_path(spark, "pixels-bucketed")
    table = scratch_table(spark, "pixels_bucketed_" + path.rsplit("-", 1)[-1])
    # as many buckets as a shuffle has partitions: the cells meet them in place
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pixels = write_pixels_bucketed(pixel_grid(spark, sf_dir), table, path, buckets)
    return R.resample_nearest(R.grid_cells(spark, grid), pixels, meta, BAND_NAMES, broadcast_max_bytes=0,
                              join_hint="merge")


@register("resample_shuffled", "G4,G5,G6", sql=_resample_sql())
def resample_shuffled(spark, sf_dir):
    """The plain path beyond the broadcast bound: both sides shuffle on the pixel index."""
    meta, grid = _grid(spark, sf_dir)
    return R.resample_nearest(R.grid_cells(spark, grid), pixel_grid(spark, sf_dir), meta, BAND_NAMES,
                              broadcast_max_bytes=0, join_hint="merge")


@register("target_grid_fixed", "G1", sql=f"SELECT ROUND(left_, 3) AS left, ROUND(top_, 3) AS top, res, width, height FROM ({_grid_sql(FIXED_RESOLUTION)}) g")
def target_grid_fixed(spark, sf_dir):
    """The grid at a given resolution (10 km)."""
    g = R.target_grid_frame(spark, pixel_grid_meta(spark, sf_dir), FIXED_RESOLUTION, densify=DENSIFY)
    return g.select(F.round("left", 3).alias("left"), F.round("top", 3).alias("top"), "res", "width", "height")


@register("raster_to_pixel_csv", "G1,G3,G4,G5,G6,G8,S3,S1", sql=f"SELECT {', '.join(BAND_NAMES)}, row_px, col_px FROM ({_resample_sql(FIXED_RESOLUTION)}) r")
def raster_to_pixel_csv(spark, sf_dir):
    """A raster to a pixel table end to end: 10 km grid, cells, nearest pixel of
    all bands, nodata, pixel index, CSV with a header, read again."""
    meta, grid = _grid(spark, sf_dir, FIXED_RESOLUTION)
    cells = R.resample_nearest(R.grid_cells(spark, grid), pixel_grid(spark, sf_dir), meta, BAND_NAMES)
    path = scratch_path(spark, "pixel-csv")
    write_pixels_csv(cells.select(*BAND_NAMES, "row_px", "col_px"), path)
    return read_pixels_csv(spark, path, schema=pixel_schema())


@register("raster_to_pixel_csv_full", "G1,G3,G4,G5,G6,G8,S3,S1", sql=f"SELECT {', '.join(BAND_NAMES)}, row_px, col_px FROM ({_resample_sql()}) r")
def raster_to_pixel_csv_full(spark, sf_dir):
    """The same chain on the grid that keeps one cell per source pixel: cells,
    table and file grow with the raster."""
    meta, grid = _grid(spark, sf_dir)
    cells = R.resample_nearest(R.grid_cells(spark, grid), pixel_grid(spark, sf_dir), meta, BAND_NAMES)
    path = scratch_path(spark, "pixel-csv")
    write_pixels_csv(cells.select(*BAND_NAMES, "row_px", "col_px"), path)
    return read_pixels_csv(spark, path, schema=pixel_schema())


@register("resample_nodata", "G6", sql=" UNION ALL ".join(
    f"SELECT '{b}' AS band, COUNT(*) AS n_cells, COUNT(*) FILTER (WHERE {b} = {F1_NODATA!r}E0) AS n_nodata, "
    f"ROUND(SUM({b}) FILTER (WHERE {b} <> {F1_NODATA!r}E0), 6) AS valid_sum FROM ({_resample_sql()}) r"
    for b in BAND_NAMES))
def resample_nodata(spark, sf_dir):
    meta, grid = _grid(spark, sf_dir)
    r = R.resample_nearest(R.grid_cells(spark, grid), pixel_grid(spark, sf_dir), meta, BAND_NAMES)
    nd = F.lit(F1_NODATA)
    aggs = []
    for i, b in enumerate(BAND_NAMES):
        aggs += [F.count(F.lit(1)).alias(f"c{i}"), F.count_if(F.col(b) == nd).alias(f"n{i}"),
                 F.round(F.sum(F.when(F.col(b) != nd, F.col(b))), 6).alias(f"s{i}")]
    wide = r.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"c{i}").alias("n_cells"),
                                        F.col(f"n{i}").alias("n_nodata"), F.col(f"s{i}").alias("valid_sum"))
                               for i, b in enumerate(BAND_NAMES)]))
    return wide.select(rows.alias("r")).select("r.*")
