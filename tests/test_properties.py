"""Property-based checks from the survey's test plan (hypothesis)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pixelframe.operators import metrics as M
from pixelframe.operators import prep

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(n=st.integers(50, 3000), parts=st.integers(1, 17), frac=st.sampled_from([0.5, 0.7, 0.8]))
def test_hash_split_invariant_under_repartition(spark, n, parts, frac):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7).alias("j"))
    a, _ = prep.hash_split(df, ["k", "j"], frac)
    b, _ = prep.hash_split(df.repartition(parts), ["k", "j"], frac)
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.sampled_from([0.0, 1.0]), st.sampled_from([0.0, 1.0]),
                               st.integers(-5, 5)), min_size=1, max_size=200))
def test_confusion_sums_and_auc_bounds(spark, rows):
    df = spark.createDataFrame([(l, p, float(s)) for l, p, s in rows], "label DOUBLE, prediction DOUBLE, score DOUBLE")
    c = M.confusion(df).first()
    assert c.tp + c.fp + c.tn + c.fn == len(rows)
    a = M.auc_roc(df).first()
    pos = sum(1 for l, _, _ in rows if l == 1.0)
    assert (a.n_pos, a.n_neg) == (pos, len(rows) - pos)
    if 0 < pos < len(rows):
        assert 0.0 <= a.auc <= 1.0
        flipped = M.auc_roc(df.withColumn("score", -F.col("score"))).first().auc
        assert a.auc + flipped == pytest.approx(1.0, abs=1e-12)
    else:
        assert a.auc is None
