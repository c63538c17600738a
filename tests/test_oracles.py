"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive value hash), on the smallest driver scale."""

import pytest

import __spark_entry__ as E
from tools.compare import digest
from tramspark.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
KEYS = sorted(REGISTRY)
ORACLES = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(ORACLES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_sf001, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck_sf001.execute(ORACLES[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]
