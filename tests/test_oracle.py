"""Every registered query equals its DuckDB oracle on the sf0.001 driver tables."""
import duckdb
import pytest

from __spark_entry__ import entry
from contactlake.plans.catalog import queries
from contactlake.plans.oracle import oracle_sql
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["lead_source", "total_leads", "unique_contacts", "converted_leads",
                          "conversion_rate_pct", "avg_annual_revenue", "total_revenue"]
