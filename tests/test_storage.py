"""Stored tables: rescued CSV rows, restarted and ordered sinks, tiles by offset, statistics of stored rows."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.operators import features as FT
from pixelframe.operators import prep
from pixelframe.operators import raster as R
from pixelframe.session import scratch_path
from pixelframe.sources import pixels as px
from pixelframe.sources import raster as rs


def local(path):
    return path.removeprefix("file:")


def test_rescued_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2.5,x\n2,,y\n3,oops,z\n4,1.0\n5,1.0,w,more\nsix,bad,v\n\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    rows = px.read_pixels_csv_rescued(spark, str(tmp_path), schema)
    got = {(r.a, r.b, r.c, tuple(r[px.FAILED]), r.state) for r in rows.withColumn("state", px.row_state()).collect() if r.state != "malformed"}
    assert got == {(1, 2.5, "x", (), "good"), (2, None, "y", (), "good"), (3, None, "z", ("b",), "cast_failed"),
                   (None, None, "v", ("a", "b"), "cast_failed")}
    assert sorted(r[px.MALFORMED] for r in rows.where(F.col(px.MALFORMED).isNotNull()).collect()) == ["4,1.0", "5,1.0,w,more"]
    report = {(r.state, r.column_name): r.n_rows for r in px.rescue_report(rows).collect()}
    assert report == {("good", None): 2, ("cast_failed", None): 2, ("malformed", None): 2,
                      ("cast_failed", "a"): 1, ("cast_failed", "b"): 2}
    # a projection that needs one column counts the width of the whole row
    assert rows.select(px.row_state().alias("s")).where("s = 'malformed'").count() == 2


def test_rescued_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n")
    rows = px.read_pixels_csv_rescued(spark, str(tmp_path), T.StructType([T.StructField("a", T.IntegerType())]))
    assert rows.count() == 0 and px.rescue_report(rows).count() == 0


def test_rewritten_band_leaves_the_others(spark):
    path = scratch_path(spark, "rewrite-test")
    long = spark.range(300).selectExpr("CAST(id % 3 + 1 AS INT) AS band", "CAST(id AS INT) AS row_px", "0 AS col_px", "id * 1.0D AS value")
    rs.write_pixels(long, path)
    files = lambda b: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(path)}/band={b}/*.parquet")}
    before = {b: files(b) for b in (1, 2, 3)}
    rs.rewrite_bands(rs.read_band(long, 3).withColumn("value", -F.col("value")), path)
    assert files(1) == before[1] and files(2) == before[2] and not set(files(3)) & set(before[3])
    back = spark.read.parquet(path)
    assert back.count() == 300 and back.where("band = 3 AND value > 0").count() == 0
    rs.rewrite_bands(long.where("false"), path)
    assert spark.read.parquet(path).count() == 300


def test_morton_key(spark):
    rows = spark.range(64).selectExpr("CAST(id / 8 AS INT) AS row_px", "CAST(id % 8 AS INT) AS col_px")
    for r in rows.withColumn("k", rs.morton_key()).collect():
        assert r.k == sum((r.row_px >> i & 1) << 2 * i + 1 | (r.col_px >> i & 1) << 2 * i for i in range(3))
    big = spark.createDataFrame([(2**31 - 1, 2**31 - 1), (2**31 - 1, 0), (0, 2**31 - 1)], "row_px INT, col_px INT")
    assert [r.k for r in big.select(rs.morton_key().alias("k")).collect()] == [
        2**62 - 1, int("10" * 31, 2), int("01" * 31, 2)]


def test_windows_skip_row_groups(spark):
    px_rows = spark.range(512 * 512).selectExpr("CAST(id / 512 AS INT) AS row_px", "CAST(id % 512 AS INT) AS col_px", "rand(3) AS lst")
    plain, ordered = scratch_path(spark, "plain"), scratch_path(spark, "ordered")
    px_rows.repartitionByRange(256, "row_px", "col_px").sortWithinPartitions("row_px", "col_px").write.parquet(plain)
    rs.write_pixels_ordered(px_rows, ordered, rows_per_file=512 * 512 // 256)
    window = (100, 164), (100, 164)

    def groups(path):
        n = 0
        for f in glob.glob(f"{local(path)}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            names = meta.schema.names
            for g in range(meta.num_row_groups):
                hit = True
                for name, (lo, hi) in zip(("row_px", "col_px"), window):
                    s = meta.row_group(g).column(names.index(name)).statistics
                    hit &= s.max >= lo and s.min < hi
                n += meta.row_group(g).num_rows if hit else 0
        return n

    assert groups(ordered) <= groups(plain) * 0.75
    assert rs.read_window(spark, ordered, *window).count() == 64 * 64
    assert spark.read.parquet(ordered).exceptAll(spark.read.parquet(plain)).count() == 0


@pytest.mark.parametrize("block", [2, 64])
def test_tiles_resample_like_pixels(spark, block):
    rows = [(r, c, float(r * 100 + c), None if (r + c) % 5 == 0 else float(-r - c)) for r in range(7) for c in range(11)]
    wide = spark.createDataFrame(rows, "row_px INT, col_px INT, b1 DOUBLE, b2 DOUBLE").where("NOT (row_px = 3 AND col_px = 4)")
    meta = rs.RasterMeta("EPSG:4326", -120.0, 38.0, 0.3, 0.4, 11, 7, 2, -9999.0)
    path = scratch_path(spark, "tiles")
    rs.write_pixels(R.to_tiles(R.to_long(wide, ["b1", "b2"]), 4), path, partition_by="tile_row")
    tiles = spark.read.parquet(path)
    cells = R.grid_cells(spark, R.target_grid(spark, meta, 25000.0))
    want = sorted(R.resample_nearest(cells, wide, meta, ["b1", "b2"]).collect())
    got = R.resample_tiles(cells, tiles, meta, 4, ["b1", "b2"], block=block)
    assert sorted(got.collect()) == want
    part = R.resample_tiles(cells.where("row_px < 3"), tiles, meta, 4, ["b1", "b2"], block=block)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "tile_row" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Generate explode" in plan and plan.count("Join") == 1
    assert sorted(part.collect()) == [r for r in want if r.row_px < 3]
    assert R.resample_tiles(cells.where("false"), tiles, meta, 4, ["b1", "b2"]).count() == 0


def test_stored_tiles_have_one_file_for_each_row_of_tiles(spark):
    from conftest import SF_MID
    from pixelframe.plans.queries_storage import _stored_tiles
    tiles = _stored_tiles(spark, SF_MID)
    assert len(tiles.inputFiles()) == tiles.select("tile_row").distinct().count() == 2


def test_stored_stats(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 4 = 0 AS DOUBLE) AS label", "IF(id % 10 = 0, NULL, id * 1.5D) AS x", "CAST(7 AS INT) AS y")
    path = scratch_path(spark, "stats")
    back, stats = prep.stored_with_stats(df.repartition(5), path, ["x", "y"], keys=["id"], fraction=0.7)
    train, _ = prep.hash_split(df, ["id"], 0.7)
    assert back.exceptAll(df).count() == 0 and back.count() == 1000
    for part, rows in (("all", df), ("train", train)):
        s, c = stats[part], prep.class_counts(rows).first()
        assert (s.n_rows, s.n_label0, s.n_label1) == (c.n_rows, c.n_label0, c.n_label1)
        assert s.balancing_ratio == prep.compute_balance_ratio(rows)
        assert s.ranges == {r.feature: (r.min_value, r.max_value) for r in FT.minmax_stats(rows, ["x", "y"]).collect()}
    _, none = prep.stored_with_stats(df.where("false"), scratch_path(spark, "stats"), ["x"])
    assert none["all"].n_rows == 0 and none["all"].balancing_ratio is None and none["all"].ranges == {"x": (None, None)}


def test_workflow_rows_take_ratio_and_tasks_from_one_aggregate(spark):
    from pixelframe.plans.workflows import stored_rows
    df = spark.range(3000).selectExpr("id", "CAST(id % 5 = 0 AS DOUBLE) AS label", "id * 1.5D AS x")
    data, tasks = stored_rows(df, ["id"], ["x"])
    assert data.exceptAll(prep.with_class_weight(df)).count() == 0 and data.count() == 3000
    assert tasks == prep.by_key(prep.hash_split(df, ["id"], 0.7)[0], ["id"]).rdd.getNumPartitions()
    plain, _ = stored_rows(df, ["id"], ["x"], weights=False)
    assert plain.columns == df.columns
