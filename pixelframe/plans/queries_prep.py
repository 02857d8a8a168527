"""Queries for scans, projections, filters, class balance and splits (F2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelframe.operators import prep
from pixelframe.operators.raster import name_bands
from pixelframe.plans import sqltext as S
from pixelframe.plans.registry import register
from pixelframe.session import scratch_path
from pixelframe.sources import pixels as px
from pixelframe.sources.testdata import F1_SQL, F2_KEYS, F2_SQL, F3_SQL, pixel_grid, sample_table, scored_table

FEATURES = px.FEATURES


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 -> P3 -> P2 -> P4: the cleaned, labelled sample table."""
    s = prep.drop_zero_or_null(sample_table(spark, sf_dir), FEATURES)
    s = prep.select_features(s, FEATURES, label="burned", keep=F2_KEYS)
    return prep.drop_missing(s, FEATURES + ["label"])


def weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.with_class_weight(prepared(spark, sf_dir))


@register("prepared_split_counts", "P2,P3,P4,A1,A2,A4,X2", sql=f"""
SELECT split, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE label = 0) AS n_label0,
       COUNT(*) FILTER (WHERE label = 1) AS n_label1,
       ROUND(SUM(class_weight), 6) AS weight_sum
FROM (SELECT w.*, CASE WHEN {S.split_flag(0.7)} THEN 'train' ELSE 'test' END AS split
      FROM ({S.WEIGHTED_SQL}) w) s
GROUP BY split""")
def prepared_split_counts(spark, sf_dir):
    s = prep.split_summary(prep.with_split(prepared(spark, sf_dir), F2_KEYS, 0.7))
    return s.withColumn("weight_sum", F.round("weight_sum", 6))


@register("drop_zero_or_null", "P3", sql=f"SELECT * FROM ({F2_SQL}) f2 WHERE {S.nonzero()}")
def drop_zero_or_null(spark, sf_dir):
    return prep.drop_zero_or_null(sample_table(spark, sf_dir), FEATURES)


@register("drop_missing", "P2,P4", sql=f"""
SELECT {S.KEYS}, {S.FEATS}, burned AS label FROM ({F2_SQL}) f2
WHERE {S.present(FEATURES + ['burned'])}""")
def drop_missing(spark, sf_dir):
    s = prep.select_features(sample_table(spark, sf_dir), FEATURES, keep=F2_KEYS)
    return prep.drop_missing(s, FEATURES + ["label"])


@register("select_features", "P2", sql=f"SELECT {S.KEYS}, {S.FEATS}, burned AS label FROM ({F2_SQL}) f2")
def select_features(spark, sf_dir):
    return prep.select_features(sample_table(spark, sf_dir), FEATURES, keep=F2_KEYS)


@register("rename_bands", "P1,G10", sql=F1_SQL)
def rename_bands(spark, sf_dir):
    raw = name_bands(pixel_grid(spark, sf_dir), [f"Band_{i}" for i in range(1, 10)] + ["Row", "Col"])
    return prep.rename_bands(raw)  # 'row'/'col' match 'Row'/'Col' case-insensitively


# The reference's declared schema: every band and index as a non-null INT.
DECLARED_INT_SCHEMA = T.StructType([T.StructField(c, T.IntegerType(), False) for c in px.PIXEL_COLUMNS])


def _violations_sql() -> str:
    parts = []
    for i, c in enumerate(px.BAND_NAMES):
        cast = f"TRY_CAST({c} AS INTEGER)"
        parts.append(f"""
SELECT '{c}' AS column_name, {i} AS position,
       COUNT(*) FILTER (WHERE {cast} IS NULL) AS n_null,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {cast} IS NULL) AS n_cast_failed,
       COUNT(*) FILTER (WHERE {cast} IS NOT NULL AND CAST({cast} AS DOUBLE) <> {c}) AS n_lossy,
       COUNT(*) FILTER (WHERE {cast} IS NULL) AS n_not_null_violations
FROM ({F2_SQL}) f2""")
    return " UNION ALL ".join(parts)


@register("apply_schema", "S2", sql=_violations_sql())
def apply_schema(spark, sf_dir):
    s = sample_table(spark, sf_dir).select(*px.BAND_NAMES)
    return px.schema_violations(s, DECLARED_INT_SCHEMA)


@register("schema_cast", "S2", sql="SELECT " + ", ".join(f"TRY_CAST(TRUNC({c}) AS INTEGER) AS {c}" for c in px.BAND_NAMES[:-1])
          + f", CAST(TRY_CAST(TRUNC(pop_density) AS INTEGER) AS DOUBLE) AS pop_density, l_orderkey FROM ({F2_SQL}) f2")
def schema_cast(spark, sf_dir):
    """The declared INT schema enforced; the undeclared key passes."""
    out = px.apply_schema(sample_table(spark, sf_dir).select(*px.BAND_NAMES, "l_orderkey"), DECLARED_INT_SCHEMA)
    # integers with nulls have no common form in result comparisons: shown as double
    return out.withColumn("pop_density", F.col("pop_density").cast("double"))


@register("csv_inferred", "S1,S3", sql=f"SELECT {', '.join(px.BAND_NAMES)}, CAST(l_orderkey AS INTEGER) AS l_orderkey FROM ({F2_SQL}) f2")
def csv_inferred(spark, sf_dir):
    """Scan with inferred types and ';' between fields, as the pixel CSV is first read."""
    path = scratch_path(spark, "csv-inferred")
    px.write_pixels_csv(sample_table(spark, sf_dir).select(*px.BAND_NAMES, "l_orderkey"), path, sep=";")
    return px.read_pixels_csv(spark, path, sep=";")


@register("csv_roundtrip", "S1,S3", sql=f"SELECT * FROM ({F2_SQL}) f2 WHERE {S.nonzero()}")
def csv_roundtrip(spark, sf_dir):
    df = prep.drop_zero_or_null(sample_table(spark, sf_dir), FEATURES)
    path = scratch_path(spark, "csv-roundtrip")
    px.write_pixels_csv(df, path)
    return px.read_pixels_csv(spark, path, schema=df.schema)


@register("view_select", "S4", sql=f"SELECT * FROM ({F2_SQL}) f2 WHERE {S.nonzero()}")
def view_select(spark, sf_dir):
    df = prep.drop_zero_or_null(sample_table(spark, sf_dir), FEATURES)
    return px.register(df, "pixels_kept")


@register("filter_sql", "P6,P7", sql=f"SELECT * FROM ({F3_SQL}) f3 WHERE prediction = 1.0 AND label = 1.0")
def filter_sql(spark, sf_dir):
    return prep.filter_sql(scored_table(spark, sf_dir), "prediction == 1.0 AND label == 1.0")


@register("preview_rows", "S5", sql=f"""
SELECT * FROM ({S.PREPARED_SQL}) p ORDER BY {S.KEYS} LIMIT 5""")
def preview_rows(spark, sf_dir):
    return px.preview(prepared(spark, sf_dir), 5, order_by=F2_KEYS)


@register("class_counts", "A2", sql=f"""
SELECT COUNT(*) FILTER (WHERE label = 0) AS n_label0,
       COUNT(*) FILTER (WHERE label = 1) AS n_label1, COUNT(*) AS n_rows
FROM ({S.PREPARED_SQL}) p""")
def class_counts(spark, sf_dir):
    return prep.class_counts(prepared(spark, sf_dir))


@register("balance_ratio", "A3", sql=f"""
SELECT n_label0, n_label1, n_label0 / (n_label0 + n_label1) AS balancing_ratio
FROM (SELECT COUNT(*) FILTER (WHERE label = 0) AS n_label0,
             COUNT(*) FILTER (WHERE label = 1) AS n_label1
      FROM ({S.PREPARED_SQL}) p) c""")
def balance_ratio(spark, sf_dir):
    return prep.balance_ratio(prepared(spark, sf_dir))


@register("class_weights", "A4,P5", sql=S.WEIGHTED_SQL)
def class_weights(spark, sf_dir):
    return weighted(spark, sf_dir)


@register("hash_split_counts", "X2,A1", sql=f"""
SELECT CASE WHEN {S.split_flag(0.7)} THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE label = 0) AS n_label0,
       COUNT(*) FILTER (WHERE label = 1) AS n_label1
FROM ({S.PREPARED_SQL}) p GROUP BY 1""")
def hash_split_counts(spark, sf_dir):
    return prep.split_counts(prep.with_split(prepared(spark, sf_dir), F2_KEYS, 0.7))


@register("tvs_split_counts", "X3", sql=f"""
SELECT CASE WHEN NOT {S.split_flag(0.7)} THEN 'test'
            WHEN {S.split_flag(0.8, offset=9)} THEN 'fit' ELSE 'validation' END AS subset,
       COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE label = 1) AS n_label1
FROM ({S.PREPARED_SQL}) p GROUP BY 1""")
def tvs_split_counts(spark, sf_dir):
    p = prepared(spark, sf_dir)
    subset = (F.when(~prep.split_flag(F2_KEYS, 0.7), F.lit("test"))
              .when(prep.split_flag(F2_KEYS, 0.8, offset=9), F.lit("fit"))
              .otherwise(F.lit("validation")))
    return p.groupBy(subset.alias("subset")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_label1"))


@register("fold_counts", "X4", sql=" UNION ALL ".join(f"""
SELECT {k} AS k, {S.fold(k)} AS fold, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE label = 1) AS n_label1
FROM ({S.PREPARED_SQL}) p WHERE {S.split_flag(0.7)} GROUP BY 1, 2""" for k in (3, 5)))
def fold_counts(spark, sf_dir):
    train, _ = prep.hash_split(prepared(spark, sf_dir), F2_KEYS, 0.7)
    f3 = prep.with_fold(train, F2_KEYS, 3, col="f3")
    both = prep.with_fold(f3, F2_KEYS, 5, col="f5")
    tagged = both.select(F.explode(F.array(
        F.struct(F.lit(3).alias("k"), F.col("f3").alias("fold")),
        F.struct(F.lit(5).alias("k"), F.col("f5").alias("fold")))).alias("t"), "label")
    return (tagged.groupBy("t.k", "t.fold")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_label1")))


@register("random_split_counts", "X1")
def random_split_counts(spark, sf_dir):
    train, test = prep.random_split(prepared(spark, sf_dir), (0.7, 0.3), seed=42)
    return prep.split_counts(train.withColumn("split", F.lit("train"))
                             .unionByName(test.withColumn("split", F.lit("test"))))
