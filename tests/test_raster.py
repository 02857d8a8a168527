import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pixelframe.functions.albers import CONUS_ALBERS as P, albers_forward, albers_inverse
from pixelframe.operators import raster as R
from pixelframe.sources.raster import RasterMeta, raster_meta_frame, read_band


def test_albers_check_values():
    x, y = P.forward_py(-119.5, 37.0)
    assert (round(x, 3), round(y, 3)) == (-2050723.526, 1805609.660)
    assert P.n == pytest.approx(0.6029027690654364, abs=1e-15)
    assert P.rho0 == pytest.approx(9928937.004233573, abs=1e-6)


@settings(max_examples=200, deadline=None)
@given(st.floats(-125.0, -114.0), st.floats(32.0, 42.5))
def test_albers_roundtrip(lon, lat):
    lon2, lat2 = P.inverse_py(*P.forward_py(lon, lat))
    assert abs(lon2 - lon) < 1e-9 and abs(lat2 - lat) < 5e-8


def test_albers_columns_match_python(spark):
    pts = [(-124.0 + i * 0.5, 32.5 + j * 0.5) for i in range(21) for j in range(20)]
    df = spark.createDataFrame(pts, "lon DOUBLE, lat DOUBLE")
    x, y = albers_forward("lon", "lat")
    xy = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lo, la = albers_inverse("x", "y")
    for r in xy.select("*", lo.alias("lon2"), la.alias("lat2")).collect():
        px, py = P.forward_py(r.lon, r.lat)
        assert r.x == pytest.approx(px, abs=1e-6) and r.y == pytest.approx(py, abs=1e-6)
        assert r.lon2 == pytest.approx(r.lon, abs=1e-9) and r.lat2 == pytest.approx(r.lat, abs=5e-8)


@pytest.fixture()
def small_raster(spark):
    # 7 x 11 raster with 2 bands (partial tiles at tile size 4)
    rows = [(r, c, float(r * 100 + c), None if (r + c) % 5 == 0 else float(-r - c))
            for r in range(7) for c in range(11)]
    return spark.createDataFrame(rows, "row_px INT, col_px INT, b1 DOUBLE, b2 DOUBLE")


def test_tiles_roundtrip(small_raster):
    long = R.to_long(small_raster, ["b1", "b2"])
    tiles = R.to_tiles(long, 4)
    assert tiles.count() == 2 * 2 * 3
    back = R.flatten_tiles(tiles, 4)
    assert sorted(back.collect()) == sorted(long.collect())


def test_tasks_of_tiles_and_stacks_grow_with_the_rows(spark, small_raster):
    long = R.to_long(small_raster, ["b1", "b2"])
    least = spark.sparkContext.defaultParallelism
    assert [R.value_tasks(spark, n) for n in (0, 1, 10**9)] == [least, least, 2_000]
    tiles = R.to_tiles(long, 4, partitions=13)
    wide = R.stack_bands(long, 2, ["b1", "b2"], partitions=13)
    for df in (tiles, wide):
        assert df.rdd.getNumPartitions() == 13
    assert sorted(R.flatten_tiles(tiles, 4).collect()) == sorted(long.collect())
    assert sorted(wide.collect()) == sorted(R.stack_bands(long, 2, ["b1", "b2"]).collect())


def test_tiles_with_absent_and_repeated_pixels(spark):
    long = spark.createDataFrame([(1, 0, 0, 5.0), (1, 0, 2, None), (1, 2, 1, 7.0)], "band INT, row_px INT, col_px INT, value DOUBLE")
    assert [r["values"] for r in R.to_tiles(long, 4).collect()] == [[[5.0, None, None], None, [None, 7.0]]]
    # as many values as places, but one of them twice and one absent
    twice = long.union(spark.createDataFrame([(1, 0, 0, 6.0)], "band INT, row_px INT, col_px INT, value DOUBLE"))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        R.to_tiles(twice, 4).collect()


def test_stack_bands_inverts_long(small_raster):
    long = R.to_long(small_raster, ["b1", "b2"])
    wide = R.stack_bands(long, 2, ["b1", "b2"])
    assert sorted(wide.collect()) == sorted(small_raster.select("b1", "b2", "row_px", "col_px").collect())
    tiles = R.to_tiles(long, 4)
    wide2 = R.stack_tiles(tiles, 2, 4, ["b1", "b2"])
    assert sorted(wide2.collect()) == sorted(wide.collect())


def test_read_band(small_raster):
    tiles = R.to_tiles(R.to_long(small_raster, ["b1", "b2"]), 4)
    assert {r.band for r in read_band(tiles, 2).collect()} == {2}
    with pytest.raises(ValueError):
        read_band(tiles, 0)


def test_pixel_index_roundtrip(small_raster):
    idx = R.with_pixel_index(small_raster, 11)
    back = R.from_pixel_index(idx.select("idx"), 11)
    assert sorted(back.select("row_px", "col_px").collect()) == sorted(small_raster.select("row_px", "col_px").collect())
    assert idx.agg(F.max("idx")).first()[0] == 76


def test_name_bands_arity(small_raster):
    assert R.name_bands(small_raster, list("abcd")).columns == list("abcd")
    with pytest.raises(ValueError):
        R.name_bands(small_raster, ["a"])


def test_band_overview(small_raster):
    ov = {(r.block_row, r.block_col): r for r in R.band_overview(small_raster, "b2", 4).collect()}
    assert sum(r.n_pixels for r in ov.values()) == 77
    assert ov[(0, 0)].max_value == -1.0


def test_raster_meta_frame(spark):
    m = RasterMeta("EPSG:4326", -124.5, 42.0, 0.07, 0.095, 150, 100, 9, -9999.0)
    r = raster_meta_frame(spark, m).first()
    assert r.bound_right == pytest.approx(-114.0) and r.bound_bottom == pytest.approx(32.5)
    assert r.transform == [0.07, 0.0, -124.5, 0.0, -0.095, 42.0]


def test_resample_matches_pointwise_lookup(spark, small_raster):
    meta = RasterMeta("EPSG:4326", -120.0, 38.0, 0.3, 0.4, 11, 7, 2, -9999.0)
    grid = R.target_grid(spark, meta, 25000.0)
    cells = R.grid_cells(spark, grid)
    out = {(r.row_px, r.col_px): r for r in
           R.resample_nearest(cells, small_raster, meta, ["b1", "b2"]).collect()}
    assert len(out) == grid.n_cells
    src = {(r.row_px, r.col_px): r for r in small_raster.collect()}
    hits = 0
    for (row, col), r in out.items():
        x = grid.left + (col + 0.5) * grid.res
        y = grid.top - (row + 0.5) * grid.res
        lon, lat = P.inverse_py(x, y)
        sc = math.floor(round((lon - meta.left) / meta.xres, 6))
        sr = math.floor(round((meta.top - lat) / meta.yres, 6))
        if 0 <= sr < 7 and 0 <= sc < 11:
            hits += 1
            s = src[(sr, sc)]
            assert r.b1 == s.b1
            assert r.b2 == (s.b2 if s.b2 is not None else -9999.0)
        else:
            assert (r.b1, r.b2) == (-9999.0, -9999.0)
    assert 0 < hits < len(out)


def test_resample_uses_shuffle_join_beyond_broadcast_bound(spark, small_raster):
    meta = RasterMeta("EPSG:4326", -120.0, 38.0, 0.3, 0.4, 11, 7, 2, -9999.0)
    grid = R.target_grid(spark, meta, 25000.0)
    cells = R.grid_cells(spark, grid)
    small = R.resample_nearest(cells, small_raster, meta, ["b1"])
    big = R.resample_nearest(cells, small_raster, meta, ["b1"], broadcast_max_bytes=0)
    plan_small = small._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan_small
    assert sorted(small.collect()) == sorted(big.collect())


def test_absent_pixels_do_not_move_the_others(spark):
    rows = [(1, r, c, float(10 * r + c)) for r in range(5) for c in range(5) if (r, c) not in {(1, 0), (2, 1), (4, 4)} and r != 3]
    long = spark.createDataFrame(rows, "band INT, row_px INT, col_px INT, value DOUBLE")
    back = R.flatten_tiles(R.to_tiles(long, 3), 3).where("value IS NOT NULL")
    assert sorted(map(tuple, back.select("band", "row_px", "col_px", "value").collect())) == sorted(rows)


def test_bucketed_join_moves_only_the_cells(spark):
    from pixelframe.session import scratch_path, scratch_table
    from pixelframe.sources.raster import write_pixels_bucketed
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    try:
        px = spark.range(400).selectExpr("CAST(id / 20 AS INT) AS row_px", "CAST(id % 20 AS INT) AS col_px", "id * 1.0D AS lst")
        path = scratch_path(spark, "bucket-test")
        table = scratch_table(spark, "bucket_test_" + path.rsplit("-", 1)[-1])
        src = write_pixels_bucketed(px, table, path, 12)
        joined = px.select("row_px", "col_px").join(src.hint("merge"), ["row_px", "col_px"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and ", 12)" in plan
        assert joined.count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
