"""Plan shape guards: filters and column pruning reach the parquet scan."""

import os

import pytest

from tessera.plans.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES, _ = load_all()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_split_filter_is_pushed_and_columns_pruned(spark):
    plan = physical(QUERIES["ridge_mse"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_linenumber), EqualTo(l_linenumber,7)]" in plan
    assert "l_orderkey" not in plan and "l_shipdate" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_documents_scan_reads_two_columns(spark):
    plan = physical(QUERIES["doc_tfidf"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "n_chars" not in plan and "lang" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_no_static_broadcast_from_estimates(spark):
    # registered queries switch estimate-based broadcasting off; only AQE
    # (measured sizes) or explicit bounded hints may broadcast
    QUERIES["degree"](spark, SF)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
