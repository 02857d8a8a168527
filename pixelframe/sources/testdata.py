"""Pixel-shaped fixtures derived from the driver's TPC-H-like tables.

F1  pixel grid from ``orders``  (150 columns, dense key -> row/col)
F2  sample table from ``lineitem`` (learnable label, zeros and nulls)
F3  F2 plus rule predictions and scores
F4  F1 cut into band tiles

Each builder has an ANSI-SQL twin (``F1_SQL`` ...) so DuckDB can check
results computed on top of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelframe.session import read_table
from pixelframe.sources.raster import RasterMeta

# --- fixed values -----------------------------------------------------------
# F1 geometry: 150 pixel columns; the grid covers lon -124.5..-114.0 and
# lat 32.5..42.0 (EPSG:4326), so pixel sizes are 10.5/150 by 9.5/rows
# degrees; nodata is -9999.
F1_WIDTH = 150
F1_LEFT, F1_TOP = -124.5, 42.0
F1_SPAN_X, F1_SPAN_Y = 10.5, 9.5
F1_NODATA = -9999.0
F1_CRS = "EPSG:4326"
# F1 label threshold on o_totalprice; F2 label threshold on quantity*price.
F1_BURN_PRICE = 467000
F2_BURN_PRODUCT = 3500000
# F2 row key (unique per row) and 0.7 hash split threshold ('b333').
F2_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# ---------------------------------------------------------------------------


def pixel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per pixel, bands first then ``row_px``, ``col_px``."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(F.col("o_totalprice") > F1_BURN_PRICE, 1.0).otherwise(0.0).alias("burned"),
        F.col("o_totalprice").alias("lst"),
        F.col("o_custkey").cast("double").alias("humidity"),
        F.month("o_orderdate").cast("double").alias("precip"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("landcover"),
        F.dayofmonth("o_orderdate").cast("double").alias("elevation"),
        (k % 7).cast("double").alias("slope"),
        (F.col("o_custkey") % 11).cast("double").alias("aspect"),
        F.nullif(F.col("o_custkey") % 13, F.lit(5)).cast("double").alias("pop_density"),
        F.floor(k / F1_WIDTH).cast("int").alias("row_px"),
        (k % F1_WIDTH).cast("int").alias("col_px"),
    )


def pixel_grid_meta(spark: SparkSession, sf_dir: str) -> RasterMeta:
    """Georeferencing of F1; the height comes from the data (one tiny aggregate)."""
    o = read_table(spark, sf_dir, "orders")
    height = int(o.agg(F.max(F.floor(F.col("o_orderkey") / F1_WIDTH))).first()[0]) + 1
    return RasterMeta(crs=F1_CRS, left=F1_LEFT, top=F1_TOP, xres=F1_SPAN_X / F1_WIDTH,
                      yres=F1_SPAN_Y / height, width=F1_WIDTH, height=height, count=9,
                      nodata=F1_NODATA, dtype="float64")


def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pixel-shaped sample table from lineitem (key, label, 8 features)."""
    return sample_rows(read_table(spark, sf_dir, "lineitem"))


def sample_rows(li: DataFrame) -> DataFrame:
    """F2 projection of lineitem rows ."""
    return li.select(
        *F2_KEYS,
        F.when(F.col("l_quantity") * F.col("l_extendedprice") > F2_BURN_PRODUCT, 1.0)
         .otherwise(0.0).alias("burned"),
        F.col("l_quantity").alias("lst"),
        F.col("l_extendedprice").alias("humidity"),
        F.col("l_discount").alias("precip"),
        F.col("l_linenumber").cast("double").alias("landcover"),
        F.col("l_tax").alias("elevation"),
        (F.col("l_partkey") % 7).cast("double").alias("slope"),
        (F.col("l_suppkey") % 11).cast("double").alias("aspect"),
        F.nullif(F.col("l_partkey") % 13, F.lit(5)).cast("double").alias("pop_density"),
    )


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with a rule classifier and a rule regressor attached."""
    s = sample_table(spark, sf_dir)
    return s.select(
        *F2_KEYS, F.col("burned").alias("label"),
        (F.col("lst") > 30).cast("double").alias("prediction"),
        F.col("lst").alias("score"),
        (F.col("lst") / 50).alias("prediction_reg"),
        (F.col("humidity") > 60000).cast("double").alias("prediction_price"),
        F.col("humidity").alias("score_price"),
    )


def band_tiles(spark: SparkSession, sf_dir: str, tile: int = 50) -> DataFrame:
    """F1 as ``band, tile_row, tile_col, values ARRAY<ARRAY<DOUBLE>>``."""
    from pixelframe.operators.raster import to_long, to_tiles
    from pixelframe.sources.pixels import BAND_NAMES
    return to_tiles(to_long(pixel_grid(spark, sf_dir), BAND_NAMES), tile, band_value_tasks(spark, sf_dir))


def band_value_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for all values of F1 as a long table (one count of its pixels)."""
    from pixelframe.operators.raster import value_tasks
    from pixelframe.sources.pixels import BAND_NAMES
    return value_tasks(spark, len(BAND_NAMES) * read_table(spark, sf_dir, "orders").count())


# ---- SQL twins (ANSI SQL accepted by Spark SQL and DuckDB) ------------------

F1_SQL = f"""
SELECT CAST(CASE WHEN o_totalprice > {F1_BURN_PRICE} THEN 1 ELSE 0 END AS DOUBLE) AS burned,
       o_totalprice AS lst, CAST(o_custkey AS DOUBLE) AS humidity,
       CAST(EXTRACT(MONTH FROM o_orderdate) AS DOUBLE) AS precip,
       CAST(SUBSTRING(o_orderpriority, 1, 1) AS DOUBLE) AS landcover,
       CAST(EXTRACT(DAY FROM o_orderdate) AS DOUBLE) AS elevation,
       CAST(o_orderkey % 7 AS DOUBLE) AS slope, CAST(o_custkey % 11 AS DOUBLE) AS aspect,
       CAST(NULLIF(o_custkey % 13, 5) AS DOUBLE) AS pop_density,
       CAST(FLOOR(o_orderkey / {F1_WIDTH}) AS INTEGER) AS row_px,
       CAST(o_orderkey % {F1_WIDTH} AS INTEGER) AS col_px
FROM orders"""

F2_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(CASE WHEN l_quantity * l_extendedprice > {F2_BURN_PRODUCT} THEN 1 ELSE 0 END AS DOUBLE) AS burned,
       l_quantity AS lst, l_extendedprice AS humidity, l_discount AS precip,
       CAST(l_linenumber AS DOUBLE) AS landcover, l_tax AS elevation,
       CAST(l_partkey % 7 AS DOUBLE) AS slope, CAST(l_suppkey % 11 AS DOUBLE) AS aspect,
       CAST(NULLIF(l_partkey % 13, 5) AS DOUBLE) AS pop_density
FROM lineitem"""

F3_SQL = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, burned AS label,
       CAST(lst > 30 AS DOUBLE) AS prediction, lst AS score, lst / 50 AS prediction_reg,
       CAST(humidity > 60000 AS DOUBLE) AS prediction_price, humidity AS score_price
FROM ({F2_SQL}) f2"""
