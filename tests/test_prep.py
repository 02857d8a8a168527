
import pytest
from pyspark.sql import functions as F

from pixelframe.operators import prep
from pixelframe.sources import pixels as px

FEATS = ["lst", "humidity", "slope"]
NAN = float("nan")


@pytest.fixture()
def r1(spark):
    # six hand rows: all present; one zero; one null; one NaN; null label; constant column
    rows = [
        (1, 1.0, 300.0, 40.0, 2.0),
        (2, 0.0, 310.0, 0.0, 2.0),
        (3, 0.0, None, 45.0, 2.0),
        (4, 1.0, NAN, 42.0, 2.0),
        (5, None, 305.0, 41.0, 2.0),
        (6, 0.0, 299.0, 43.0, 2.0),
    ]
    return spark.createDataFrame(rows, "id INT, burned DOUBLE, lst DOUBLE, humidity DOUBLE, slope DOUBLE")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_drop_zero_or_null_keeps_nan_and_null_label(r1):
    kept = prep.drop_zero_or_null(r1, FEATS)
    assert ids(kept) == [1, 4, 5, 6]  # zero and null dropped; NaN passes != 0; label unchecked


def test_drop_missing_removes_nan_and_null_label(r1):
    kept = prep.drop_zero_or_null(r1, FEATS)
    clean = prep.drop_missing(prep.select_features(kept, FEATS, keep=["id"]), FEATS + ["label"])
    assert ids(clean) == [1, 6]


def test_rename_is_case_insensitive_and_ignores_absent(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3, 4)], "Band_1 DOUBLE, band_2 DOUBLE, Row INT, Col INT")
    out = prep.rename_bands(df)
    assert out.columns == ["burned", "lst", "row_px", "col_px"]
    assert prep.rename_bands(df, {"nope": "x"}).columns == df.columns


def test_class_weight_ratio_and_other_labels(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)] + [(2.0,)], "label DOUBLE")
    c = prep.balance_ratio(df).first()
    assert (c.n_label0, c.n_label1) == (3, 1)
    assert c.balancing_ratio == pytest.approx(0.75)
    w = {r.label: r.class_weight for r in prep.with_class_weight(df).distinct().collect()}
    assert w[1.0] == pytest.approx(0.75) and w[0.0] == pytest.approx(0.25) and w[2.0] == pytest.approx(0.25)


def test_class_weight_undefined_without_labels(spark):
    df = spark.createDataFrame([(2.0,)], "label DOUBLE")
    with pytest.raises(ValueError):
        prep.with_class_weight(df)


def test_split_threshold_values():
    assert prep.split_threshold(0.7) == "b333"
    assert prep.split_threshold(0.8) == "cccd"
    assert prep.split_threshold(0.0) == "0000"
    assert prep.split_threshold(1.0) == "g"


def test_hash_split_is_partition_independent(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("label"))
    a_train, a_test = prep.hash_split(df, ["k"], 0.7)
    b_train, _ = prep.hash_split(df.repartition(13), ["k"], 0.7)
    ta = {r.k for r in a_train.select("k").collect()}
    tb = {r.k for r in b_train.select("k").collect()}
    assert ta == tb
    assert a_train.count() + a_test.count() == 20000
    assert abs(len(ta) / 20000 - 0.7) < 0.02


def test_folds_cover_range_and_are_balanced(spark):
    df = spark.range(30000).select(F.col("id").alias("k"))
    f = prep.with_fold(df, ["k"], 5).groupBy("fold").count().collect()
    counts = {r.fold: r["count"] for r in f}
    assert sorted(counts) == [0, 1, 2, 3, 4]
    assert all(abs(c / 6000 - 1) < 0.06 for c in counts.values())


def test_fold_independent_of_split(spark):
    df = spark.range(30000).select(F.col("id").alias("k"))
    train, test = prep.hash_split(df, ["k"], 0.7)
    for part in (train, test):
        n = part.count()
        for r in prep.with_fold(part, ["k"], 3).groupBy("fold").count().collect():
            assert abs(r["count"] / n - 1 / 3) < 0.03


def test_apply_schema_and_violations(spark):
    df = spark.createDataFrame([(1.0, 2.5), (None, 3.0), (4.0, 1e12)], "burned DOUBLE, lst DOUBLE")
    cast = px.apply_schema(df, px.pixel_schema(band_type=__import__("pyspark.sql.types", fromlist=["x"]).IntegerType()))
    assert dict(cast.dtypes) == {"burned": "int", "lst": "int"}
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("burned", T.IntegerType(), False),
                           T.StructField("lst", T.IntegerType(), True)])
    rep = {r.column_name: r for r in px.schema_violations(df, schema).collect()}
    assert rep["burned"].n_null == 1 and rep["burned"].n_not_null_violations == 1
    assert rep["lst"].n_cast_failed == 1 and rep["lst"].n_lossy == 1 and rep["lst"].n_not_null_violations == 0


def test_preview_is_top_k(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"))
    assert [r.k for r in px.preview(df.repartition(7), 3, ["k"]).collect()] == [0, 1, 2]


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.5, None, 3, 4)], "lst DOUBLE, humidity DOUBLE, row_px INT, col_px INT")
    path = str(tmp_path / "pix")
    px.write_pixels_csv(df, path)
    back = px.read_pixels_csv(spark, path, schema=df.schema)
    assert back.collect() == df.collect()
    inferred = px.read_pixels_csv(spark, path)
    assert set(inferred.columns) == set(df.columns)


def test_schema_report(spark):
    df = spark.createDataFrame([(1.0, 2)], "a DOUBLE, b INT")
    rows = px.schema_report(df).collect()
    assert [(r.column_name, r.data_type) for r in rows] == [("a", "double"), ("b", "int")]


def test_split_summary_equals_weight_column_sums(spark):
    rows = [(i, float(i % 7 == 0), "train" if i % 3 else "test") for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, label DOUBLE, split STRING")
    fast = {r.split: r for r in prep.split_summary(df).collect()}
    w = prep.with_class_weight(df)
    slow = {r.split: r.s for r in w.groupBy("split").agg(F.sum(prep.WEIGHT_COL).alias("s")).collect()}
    for k in ("train", "test"):
        assert fast[k].weight_sum == pytest.approx(slow[k], rel=1e-12)
    assert sum(r.n_rows for r in fast.values()) == 500


def test_by_key_deals_the_same_rows_from_any_partitions(spark):
    def parts(df):
        tagged = prep.by_key(df, ["k"], 5).select(F.spark_partition_id().alias("p"), "k").collect()
        return [[r.k for r in tagged if r.p == p] for p in range(5)]

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert parts(df.repartition(1)) == parts(df.repartition(9)) == parts(df.repartition(3))


def test_split_summary_without_known_labels(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k INT, label DOUBLE")
    rows = prep.split_summary(prep.with_split(df, ["k"], 0.5)).collect()
    assert sum(r.n_rows for r in rows) == 2 and all(r.weight_sum is None for r in rows)


def test_null_keys_hash_apart(spark):
    from pixelframe.functions.exprs import key_hash
    df = spark.createDataFrame([(1, None, 2), (1, 2, None), (None, 1, 2), (1, 2, 2)], "a INT, b INT, c INT")
    assert df.select(key_hash(["a", "b", "c"]).alias("h")).distinct().count() == 4
