"""Data preparation: rename, project, row filters, class balance, splits.

All operators are narrow (no shuffle) except the class-count aggregate,
which is one partial+final aggregate producing a single row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelframe.functions.exprs import hash_bucket, key_hash

# --- fixed values -----------------------------------------------------------
# Positional band names of a raw raster export and the semantic names the
# scripts give them (band 1 is the label); "row"/"col" are pixel indices.
RAW_TO_SEMANTIC = {
    "Band_1": "burned", "Band_2": "lst", "Band_3": "humidity", "Band_4": "precip",
    "Band_5": "landcover", "Band_6": "elevation", "Band_7": "slope", "Band_8": "aspect",
    "Band_9": "pop_density", "row": "row_px", "col": "col_px",
}
# ---------------------------------------------------------------------------

WEIGHT_COL = "class_weight"


def rename_bands(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename by mapping (P1).  Names are matched case-insensitively and
    mapping entries whose source column is absent are ignored."""
    mapping = RAW_TO_SEMANTIC if mapping is None else mapping
    lower = {k.lower(): v for k, v in mapping.items()}
    renames = {c: lower[c.lower()] for c in df.columns if c.lower() in lower and lower[c.lower()] != c}
    return df.withColumnsRenamed(renames) if renames else df


def select_features(df: DataFrame, features: Sequence[str], label: str = "burned",
                    label_alias: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """Project the features and the label under ``label_alias``."""
    return df.select(*keep, *features, F.col(label).alias(label_alias))


def drop_zero_or_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every checked column is non-null and non-zero.

    One filter per column: a comparison with null is not true, so nulls go
    with the zeros.  Catalyst merges the filters and pushes them into the
    Parquet scan.  NaN passes; ``drop_missing`` removes it.
    """
    for c in cols:
        df = df.filter(F.col(c) != 0)
    return df


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    """Filter by a SQL predicate string."""
    return df.filter(predicate)


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """n0, n1 and n in one aggregate (A2): one job instead of one per class."""
    lab = F.col(label)
    return df.agg(
        F.count_if(lab == 0).alias("n_label0"),
        F.count_if(lab == 1).alias("n_label1"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def balance_ratio(df: DataFrame, label: str = "label") -> DataFrame:
    """n0 / (n0 + n1) as a one-row table (A3); rows with other labels excluded."""
    c = class_counts(df, label)
    return c.select("n_label0", "n_label1",
                    F.when(F.col("n_label0") + F.col("n_label1") > 0,
                           F.col("n_label0") / (F.col("n_label0") + F.col("n_label1")))
                     .alias("balancing_ratio"))


def compute_balance_ratio(df: DataFrame, label: str = "label") -> float:
    """The balancing ratio as a driver scalar (one aggregate job, one row back)."""
    r = balance_ratio(df, label).first()["balancing_ratio"]
    if r is None:
        raise ValueError("no rows with label 0 or 1: class weights are undefined")
    return float(r)


def with_class_weight(df: DataFrame, label: str = "label", ratio: float | None = None,
                      weight_col: str = WEIGHT_COL) -> DataFrame:
    """Class weight (A4): label 1 -> ratio, any other label -> 1 - ratio.

    The ratio is a single aggregate collected as one number and inlined as
    a literal, so the weighted frame is a plain projection (no join).
    """
    r = compute_balance_ratio(df, label) if ratio is None else float(ratio)
    return df.withColumn(weight_col, F.when(F.col(label) == 1, F.lit(r)).otherwise(F.lit(1.0 - r)))


def split_threshold(fraction: float) -> str:
    """Four-hex-digit threshold so that ``prefix < threshold`` holds for ``fraction`` of keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    v = int(round(fraction * 65536))
    return "g" if v >= 65536 else format(v, "04x")  # 'g' sorts after every hex digit


def split_flag(key_cols: Sequence[str | Column], fraction: float, offset: int = 1) -> Column:
    """True for the ``fraction`` side of a reproducible key-hash split."""
    return F.substring(key_hash(key_cols), offset, 4) < F.lit(split_threshold(fraction))


def with_split(df: DataFrame, key_cols: Sequence[str], fraction: float = 0.7,
               col: str = "split", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Tag each row ``train``/``test`` by key hash (X2): independent of partitioning."""
    return df.withColumn(col, F.when(split_flag(key_cols, fraction), F.lit(names[0]))
                         .otherwise(F.lit(names[1])))


def hash_split(df: DataFrame, key_cols: Sequence[str], fraction: float = 0.7,
               offset: int = 1) -> tuple[DataFrame, DataFrame]:
    """Reproducible (train, test) split by md5 of the key.

    ``offset`` picks which hex digits are used, so nested splits (train ->
    train/validation) use independent bits of the same hash.
    """
    flag = split_flag(key_cols, fraction, offset)
    return df.filter(flag), df.filter(~flag)


def with_fold(df: DataFrame, key_cols: Sequence[str], k: int, col: str = "fold",
              offset: int = 5) -> DataFrame:
    """k-fold assignment from hash digits independent of the train/test split."""
    if k < 2:
        raise ValueError("k must be at least 2")
    return df.withColumn(col, (hash_bucket(key_cols, offset) % F.lit(int(k))).cast("int"))


def random_split(df: DataFrame, fractions: Sequence[float] = (0.7, 0.3),
                 seed: int | None = None) -> list[DataFrame]:
    """Spark's ``randomSplit`` (X1); reproducible only for a fixed partitioning."""
    return df.randomSplit(list(fractions), seed)


def split_counts(df: DataFrame, split_col: str = "split", label: str = "label",
                 extra: Sequence[Column] = ()) -> DataFrame:
    """Rows and class counts per split value (A1 with A2), plus any ``extra``
    aggregates, in one aggregate over one scan."""
    lab = F.col(label)
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lab == 0).alias("n_label0"),
        F.count_if(lab == 1).alias("n_label1"),
        *extra,
    )


def split_summary(df: DataFrame, split_col: str = "split", label: str = "label",
                  weight_col: str = "weight_sum") -> DataFrame:
    """Per-split rows, class counts and class-weight sums from a single scan.

    The class weights depend on the global ratio n0 / (n0 + n1), but their
    per-split sum does not need a weight column: it is
    n1 * r + (n - n1) * (1 - r).  The ratio comes from a window over the
    per-split aggregate (a handful of rows), so the pixel table is read once
    instead of once for the ratio and once for the counts.
    """
    per = split_counts(df, split_col, label)
    every = Window.partitionBy()
    n0, n1 = F.sum("n_label0").over(every), F.sum("n_label1").over(every)
    r = F.try_divide(n0.cast("double"), n0 + n1)  # null when no label is 0 or 1
    w = F.col("n_label1") * r + (F.col("n_rows") - F.col("n_label1")) * (F.lit(1.0) - r)
    return per.withColumn(weight_col, w)


# Tasks of a fit.  Trees draw their samples by partition, so their number is part
# of the model: it follows from the rows alone, not from the machine or from how
# the input was partitioned.
FIT_PARTITIONS = 8  # at least
ROWS_PER_TASK = 100_000
# Boosted trees draw no rows: a level of a tree is two stages of as many tasks, each
# with its metrics sent to the driver, so they get larger tasks.
BOOSTED_ROWS_PER_TASK = 1_000_000


def fit_partitions(n_rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for a fit on ``n_rows`` rows."""
    return max(FIT_PARTITIONS, -(-n_rows // rows_per_task))


def by_key(df: DataFrame, key_cols: Sequence[str], partitions: int | None = None,
           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows dealt by key hash to ``partitions`` tasks, by default as many as the
    number of rows asks for (one count), and sorted by key there: whatever the
    input's partitions, every task gets the same rows in the same order."""
    n = fit_partitions(df.count(), rows_per_task) if partitions is None else partitions
    return df.repartition(n, *key_cols).sortWithinPartitions(*key_cols)


@dataclass(frozen=True)
class PassStats:
    """Statistics of stored rows from one aggregate: rows, class counts, and the
    range (min, max) of every feature."""

    n_rows: int
    n_label0: int
    n_label1: int
    ranges: dict[str, tuple[float | None, float | None]]

    @property
    def balancing_ratio(self) -> float | None:
        n = self.n_label0 + self.n_label1
        return self.n_label0 / n if n else None


def stored_with_stats(df: DataFrame, path: str, features: Sequence[str], label: str = "label",
                      keys: Sequence[str] = (), fraction: float = 1.0) -> tuple[DataFrame, dict[str, PassStats]]:
    """Store the rows at ``path`` (Parquet, in the shared folder) and take all their
    statistics (A1, A2, A12) by one aggregate over what was stored, so the plan that
    prepares the rows runs once, whatever is asked of them.

    Returns the stored rows and the statistics of ``all`` of them and, with
    ``keys``, of the ``train`` part of the key-hash split.  ``DataFrame.observe``
    would spare the aggregate, but a session that has observed a frame can no longer
    be serialised, which logistic models do with their training summary.
    """
    lab = F.col(label)
    parts = {"all": F.lit(True)}
    if keys:
        parts["train"] = split_flag(keys, fraction)
    aggs = []
    for part, rows in parts.items():
        aggs += [F.count_if(rows).alias(f"{part}_n"), F.count_if(rows & (lab == 0)).alias(f"{part}_0"),
                 F.count_if(rows & (lab == 1)).alias(f"{part}_1")]
        for i, c in enumerate(features):
            value = F.when(rows, F.col(c).cast("double"))
            aggs += [F.min(value).alias(f"{part}_low{i}"), F.max(value).alias(f"{part}_high{i}")]
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    got = back.agg(*aggs).first()
    stats = {part: PassStats(got[f"{part}_n"], got[f"{part}_0"], got[f"{part}_1"],
                             {c: (got[f"{part}_low{i}"], got[f"{part}_high{i}"]) for i, c in enumerate(features)})
             for part in parts}
    return back, stats
