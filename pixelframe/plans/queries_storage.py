"""Queries for stored tables: rescued CSV rows, restarted and ordered sinks, tiles
read by offset, statistics of stored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelframe.operators import prep
from pixelframe.operators import raster as R
from pixelframe.plans import sqltext as S
from pixelframe.plans.queries_prep import FEATURES, prepared
from pixelframe.plans.queries_raster import F1, TILE, _grid, _grid_sql, _long_sql, _resample_sql
from pixelframe.plans.registry import register
from pixelframe.session import scratch_path
from pixelframe.sources import pixels as px
from pixelframe.sources import raster as rs
from pixelframe.sources.pixels import BAND_NAMES, PIXEL_COLUMNS, pixel_schema
from pixelframe.sources.testdata import F1_WIDTH, F2_KEYS, band_tiles, band_value_tasks, pixel_grid

# --- fixed values -----------------------------------------------------------
# Planted faults of the CSV queries, by pixel index: rows without their last
# field, with one field more, and with text for a number.
SHORT, LONG, TEXT = 97, 89, 83
# ---------------------------------------------------------------------------
IDX = f"(CAST(row_px AS BIGINT) * {F1_WIDTH} + col_px)"
STATE_SQL = f"""CASE WHEN {IDX} % {SHORT} = 0 OR {IDX} % {LONG} = 0 THEN 'malformed'
     WHEN {IDX} % {TEXT} = 0 THEN 'cast_failed' ELSE 'good' END"""


def _faulty_csv(spark, sf_dir):
    idx = F.col("row_px").cast("long") * F1_WIDTH + F.col("col_px")
    fields = [F.coalesce(F.when(idx % TEXT == 0, "n/a").otherwise(F.col(c).cast("string")) if c == "lst"
                         else F.col(c).cast("string"), F.lit("")) for c in PIXEL_COLUMNS]
    line = (F.when(idx % SHORT == 0, F.concat_ws(",", *fields[:-1]))
            .when(idx % LONG == 0, F.concat_ws(",", *fields, F.lit("1"))).otherwise(F.concat_ws(",", *fields)))
    path = scratch_path(spark, "faulty-csv")
    pixel_grid(spark, sf_dir).select(line.alias("value")).write.text(path)
    return px.read_pixels_csv_rescued(spark, path, pixel_schema(), header=False)


@register("csv_rescue_report", "S1,S2", sql=f"""
WITH s AS (SELECT {STATE_SQL} AS state FROM {F1})
SELECT state, CAST(NULL AS VARCHAR) AS column_name, COUNT(*) AS n_rows FROM s GROUP BY state
UNION ALL SELECT state, 'lst', COUNT(*) FROM s WHERE state = 'cast_failed' GROUP BY state""")
def csv_rescue_report(spark, sf_dir):
    return px.rescue_report(_faulty_csv(spark, sf_dir))


@register("csv_rescued", "S1,S2", sql=f"""
SELECT {', '.join(PIXEL_COLUMNS)} FROM {F1} WHERE {STATE_SQL} = 'good'""")
def csv_rescued(spark, sf_dir):
    """The good rows of a file with malformed ones, values whole."""
    rows = _faulty_csv(spark, sf_dir)
    return rows.where(px.row_state() == "good").select(*PIXEL_COLUMNS)


@register("rewrite_band", "S9,S8", sql=f"""
SELECT band, row_px, col_px, CASE WHEN band = 3 THEN value * 2 ELSE value END AS value FROM ({_long_sql()}) l""")
def rewrite_band(spark, sf_dir):
    """All bands written, band 3 written again with other values, all read back."""
    path = scratch_path(spark, "rewritten-band")
    long = R.to_long(pixel_grid(spark, sf_dir), BAND_NAMES)
    rs.write_pixels(long, path)
    rs.rewrite_bands(rs.read_band(long, 3).withColumn("value", F.col("value") * 2), path)
    return spark.read.parquet(path).select("band", "row_px", "col_px", "value")


@register("window_ordered", "S9,S8", sql=f"""
SELECT {', '.join(PIXEL_COLUMNS)} FROM {F1}
WHERE row_px < (SELECT MAX(row_px) + 1 FROM {F1}) / 2 AND col_px >= {F1_WIDTH // 3} AND col_px < {F1_WIDTH * 2 // 3}""")
def window_ordered(spark, sf_dir):
    """The middle third of the upper half, read from the sink along the Z-order curve."""
    grid = pixel_grid(spark, sf_dir)
    path = scratch_path(spark, "ordered-pixels")
    rs.write_pixels_ordered(grid, path)
    height = spark.read.parquet(path).agg(F.max("row_px")).first()[0] + 1
    return rs.read_window(spark, path, (0, -(-height // 2)), (F1_WIDTH // 3, F1_WIDTH * 2 // 3)).select(*PIXEL_COLUMNS)


def _stored_tiles(spark, sf_dir):
    """Tiles stored by tile row, dealt by it first: one file for each row of tiles
    instead of one for almost every tile."""
    path = scratch_path(spark, "tiles-by-row")
    tiles = band_tiles(spark, sf_dir, TILE).repartition(band_value_tasks(spark, sf_dir), "tile_row")
    rs.write_pixels(tiles, path, partition_by="tile_row")
    return spark.read.parquet(path)


@register("resample_tiles", "G4,G5,G6,S8", sql=_resample_sql())
def resample_tiles(spark, sf_dir):
    """The whole grid from stored tiles, by offset in the tile."""
    meta, grid = _grid(spark, sf_dir)
    return R.resample_tiles(R.grid_cells(spark, grid), _stored_tiles(spark, sf_dir), meta, TILE, BAND_NAMES)


@register("resample_tiles_window", "G4,G5,G6,S8", sql=f"""
SELECT r.* FROM ({_resample_sql()}) r, ({_grid_sql()}) g WHERE r.row_px < g.height / 4""")
def resample_tiles_window(spark, sf_dir):
    """The upper quarter of the grid: partitions of tiles further down are not scanned."""
    meta, grid = _grid(spark, sf_dir)
    cells = R.grid_cells(spark, grid).where(F.col("row_px") < -(-grid.height // 4))
    return R.resample_tiles(cells, _stored_tiles(spark, sf_dir), meta, TILE, BAND_NAMES)


@register("stored_stats", "A1,A2,A3,A12", sql=f"""
WITH p AS (SELECT *, {S.split_flag(0.7)} AS in_train FROM ({S.PREPARED_SQL}) q)
""" + " UNION ALL ".join(f"""
SELECT '{part}' AS part, '{c}' AS feature, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE label = 0) AS n_label0,
       COUNT(*) FILTER (WHERE label = 1) AS n_label1, MIN(CAST({c} AS DOUBLE)) AS min_value, MAX(CAST({c} AS DOUBLE)) AS max_value
FROM p WHERE {where}""" for part, where in (("all", "TRUE"), ("train", "in_train")) for c in FEATURES))
def stored_stats(spark, sf_dir):
    """Counts, class counts and ranges of the prepared rows, stored once."""
    _, stats = prep.stored_with_stats(prepared(spark, sf_dir), scratch_path(spark, "prepared"), FEATURES, keys=F2_KEYS, fraction=0.7)
    rows = [(part, c, s.n_rows, s.n_label0, s.n_label1, *s.ranges[c]) for part, s in stats.items() for c in FEATURES]
    return spark.createDataFrame(rows, "part STRING, feature STRING, n_rows LONG, n_label0 LONG, n_label1 LONG, "
                                       "min_value DOUBLE, max_value DOUBLE")
