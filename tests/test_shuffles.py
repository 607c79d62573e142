"""What is shuffled of large tables, by the plans that joins get when no table is small enough to be broadcast unasked."""

import pytest

from ledgerloom.catalogue import load_all
from ledgerloom.operators import joins

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return load_all()[0][name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["trade_transaction", "job_shipments_by_name", "link_bol_load"])
def test_line_items_do_not_travel_for_their_supplier(spark, name):
    assert "hashpartitioning(l_suppkey" not in plan(spark, name)


@pytest.mark.parametrize("name", ["entity_edges", "edge_union"])
def test_edges_are_made_distinct_by_numbers(spark, name):
    assert "hashpartitioning(dv_hashkey_l_company_company_relationship" not in plan(spark, name)


@pytest.mark.parametrize("name", ["levenshtein_all", "levenshtein_top1"])
def test_candidates_are_measured_once(spark, name):
    assert not [line for line in plan(spark, name).splitlines() if "Join" in line and "levenshtein(" in line]


def test_either_key_reads_line_items_once_and_sorts_nothing(spark, monkeypatch):
    small = plan(spark, "or_join")
    monkeypatch.setattr(joins, "plan_bytes", lambda df: 1 << 40)
    large = plan(spark, "or_join")
    for text in (small, large):
        assert text.count("lineitem.parquet") == 1 and "SortMergeJoin" not in text
    assert large.count("ShuffledHashJoin") == 2


def test_either_key_keeps_repeats_and_drops_nulls(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 7, 8), (1, 7, 8), (2, 7, 7), (3, None, 8), (4, None, None), (5, 9, None)], "id int, a long, b long")
    listed = spark.createDataFrame([(7,), (8,), (8,), (None,)], "k long")
    for size in (0, 1 << 40):
        monkeypatch.setattr(joins, "plan_bytes", lambda df: size)
        got = sorted(tuple(r) for r in joins.on_either(rows, listed, "a", "b", "k").select("id", "k").collect())
        assert got == [(1, 7), (1, 7), (1, 8), (1, 8), (1, 8), (1, 8), (2, 7), (3, 8), (3, 8)]
