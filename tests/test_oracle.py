"""Every query with a SQL twin equals DuckDB's answer on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def _canon(df):
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False):
        out.append(tuple(("NULL" if v is None or v != v else f"{v:.9g}") if isinstance(v, float) or v is None
                         else str(v) for v in r))
    return cols, sorted(out)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql_twin(spark, con, name):
    s = entry.queries()[name](spark, SF001).toPandas()
    d = con.execute(entry.oracle_sql()[name]).df()
    assert _canon(s) == _canon(d)
