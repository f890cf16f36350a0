"""Every registered query against its DuckDB twin on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import duck, rows_of  # noqa: E402
from tessera.plans.registry import load_all  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    if name not in ORACLES:
        assert s_rows is not None
        return
    cur = con.execute(ORACLES[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    os_ = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    od = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = rows_of([tuple(r[i] for i in os_) for r in s_rows])
    b = rows_of([tuple(r[i] for i in od) for r in cur.fetchall()])
    assert a == b
