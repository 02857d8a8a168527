"""Driver contract: entry() smoke, registry consistency, oracle agreement."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
# slow, model-fitting queries are exercised in test_models / tools/check_oracle.py
SKIP = ("tune_", "workflow_", "fit_", "stream_", "score_", "best_params", "random_split")


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2
    assert set(df.columns) == {"split", "n_rows", "n_label0", "n_label1", "weight_sum"}


def test_oracles_are_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    import math
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return format(v, ".9g")
    return str(v)


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.startswith(SKIP)))
def test_query_matches_oracle(spark, duck, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    cols = sorted(sp.columns)
    a = sorted("|".join(_canon(v) for v in r) for r in sp[cols].itertuples(index=False, name=None))
    b = sorted("|".join(_canon(v) for v in r) for r in dk[cols].itertuples(index=False, name=None))
    assert a == b
