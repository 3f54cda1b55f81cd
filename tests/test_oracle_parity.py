"""Registered queries vs their DuckDB oracle on the smallest tables (the driver checks sf0.01)."""
import math

import duckdb
import pytest
from conftest import SF001

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["flatten_career", "flatten_signals", "features_dim2", "features_dim4", "integrity_counts",
          "engagement_score", "explain_topk", "sample_cascade", "audit_contract", "profile_signals",
          "schema_conformance", "regression_metrics"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def canon(df):
    cols = sorted(df.columns)
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9))
        return str(x.item() if hasattr(x, "item") else x)
    return cols, sorted(tuple(v(r[c]) for c in cols) for r in df.to_dict("records"))


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    got = canon(queries()[name](spark, SF001).toPandas())
    want = canon(con.execute(oracle_sql()[name]).df())
    assert got == want


def test_every_query_is_registered_with_callable():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_entry_smoke(spark):
    rows = entry(spark).collect()
    assert len(rows) == 100 and rows[0]["rank"] == 1
