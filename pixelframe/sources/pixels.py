"""Pixel-table scans and sinks (CSV interchange, schema, catalog, preview)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Band names of the pixel table, in band order 1..9, then the pixel index
# columns (header of the reference's CSV, index columns renamed row_px/col_px).
BAND_NAMES = ["burned", "lst", "humidity", "precip", "landcover", "elevation",
              "slope", "aspect", "pop_density"]
PIXEL_COLUMNS = BAND_NAMES + ["row_px", "col_px"]
# Model features (every band but the label), in the reference's order.
FEATURES = ["lst", "humidity", "precip", "landcover", "elevation", "slope", "aspect",
            "pop_density"]
# ---------------------------------------------------------------------------


def pixel_schema(band_type: T.DataType = T.DoubleType(), nullable_bands: bool = True) -> T.StructType:
    """Explicit pixel schema: bands as ``band_type``, pixel index as INT."""
    fields = [T.StructField(b, band_type, nullable_bands) for b in BAND_NAMES]
    fields += [T.StructField("row_px", T.IntegerType(), False),
               T.StructField("col_px", T.IntegerType(), False)]
    return T.StructType(fields)


def read_pixels_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    sep: str = ",", header: bool = True) -> DataFrame:
    """CSV scan (S1).  With ``schema`` no inference pass is made over the file.

    Without a schema the reader infers types, which costs a full extra read;
    pass ``pixel_schema()`` at scale.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_pixels_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """CSV sink with header and no index column (S3)."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every declared column with ``try_cast`` (S2); undeclared columns pass.

    Values that cannot be represented become null rather than failing the
    job; ``schema_violations`` reports how many.
    """
    declared = {f.name.lower(): f for f in schema.fields}
    out = []
    for name in df.columns:
        f = declared.get(name.lower())
        if f is None:
            out.append(F.col(name))
        else:
            out.append(F.col(name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def schema_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared column: nulls after the cast, failed casts, lossy casts
    and (for non-nullable fields) null violations — computed in one pass."""
    present = {c.lower(): c for c in df.columns}
    aggs, names = [], []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            continue
        raw = F.col(src)
        cast = raw.try_cast(f.dataType)
        back = cast.cast(df.schema[src].dataType)
        i = len(names)
        names.append(f.name)
        aggs += [
            F.count_if(cast.isNull()).alias(f"n{i}"),
            F.count_if(raw.isNotNull() & cast.isNull()).alias(f"f{i}"),
            F.count_if(cast.isNotNull() & (back != raw)).alias(f"l{i}"),
            (F.count_if(cast.isNull()) if not f.nullable else F.lit(0).cast("long")).alias(f"v{i}"),
        ]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("position"),
                 F.col(f"n{i}").alias("n_null"), F.col(f"f{i}").alias("n_cast_failed"),
                 F.col(f"l{i}").alias("n_lossy"), F.col(f"v{i}").alias("n_not_null_violations"))
        for i, n in enumerate(names)]))
    return wide.select(rows.alias("r")).select("r.*")


MALFORMED, FAILED = "_malformed", "_failed_columns"


def read_pixels_csv_rescued(spark: SparkSession, path: str, schema: T.StructType,
                            sep: str = ",", header: bool = True) -> DataFrame:
    """CSV scan that keeps every row (S1, S2): the declared columns, the text of a
    row with too few or too many fields in ``_malformed`` (null for others), and in
    ``_failed_columns`` the columns whose text could not be cast.

    Fields are read as text, so a malformed row is one of the wrong width and a
    failed cast is told from an empty field; an empty field is null.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(MALFORMED, T.StringType())])
    raw = (spark.read.schema(text).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(path))
    failed = F.array_compact(F.array(*[
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields]))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], MALFORMED,
                      F.when(F.col(MALFORMED).isNull(), failed).otherwise(F.array().cast("array<string>")).alias(FAILED))


def row_state() -> Column:
    """``malformed``, ``cast_failed`` or ``good`` for rows of ``read_pixels_csv_rescued``."""
    return (F.when(F.col(MALFORMED).isNotNull(), "malformed").when(F.size(FAILED) > 0, "cast_failed")
            .otherwise("good"))


def rescue_report(rescued: DataFrame) -> DataFrame:
    """Rows by state, and failed casts by column: (state, column_name, n_rows) in one
    pass; ``column_name`` is null for the counts of whole rows."""
    rows = rescued.select(row_state().alias("state"), FAILED)
    each = F.explode(F.concat(F.array(F.lit(None).cast("string")), FAILED))
    return rows.select("state", each.alias("column_name")).groupBy("state", "column_name").agg(
        F.count(F.lit(1)).alias("n_rows"))


def register(df: DataFrame, name: str) -> DataFrame:
    """Register a temp view and read it back through SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT * FROM `{name}`")


def preview(df: DataFrame, n: int = 5, order_by: Iterable[str] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (S5): a top-k, not a scan prefix."""
    keys = list(order_by) if order_by else list(df.columns)
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """Column names and types as a table."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN")
