"""Every registered query against its DuckDB statement (row multiset,
column names and types), as the driver's correctness gate does."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from voltaic.adapters import TABLES

from .conftest import SF_SMALL

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda t: tuple("" if x is None else x for x in t))


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


from voltaic.plans.oracle import SQL  # noqa: E402


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    got = sdf.toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({E.oracle_sql()[key]})").fetchall()}
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(st, st.upper()) == duck_types[f.name], (key, f.name)
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["reading_id", "sensor_id", "recorded_at", "value", "z_score",
                          "was_flagged_in_source", "facility_name", "sensor_type", "unit"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    """The library's own queries; those of the optional part are tested in its folder."""
    from voltaic.plans.catalog import REGISTRY
    from voltaic.plans.oracle import SQL
    assert set(REGISTRY) == set(SQL)
