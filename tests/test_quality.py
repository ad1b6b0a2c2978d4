"""Check engine on good and deliberately bad data."""

import pytest

from mercato.operators.quality import (DataQualityError, accepted_values, assert_passed, not_null,
                                       relationships, run_checks, unique, unique_combination)
from mercato.plans.checks import ALL_CHECKS, check_report
from mercato.plans.layers import Layers
from mercato.sources.testdata import load_source
from tests.helpers import item, make_raw, order


def _failures(report):
    return {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect()}


def test_check_types_count_failures(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 1), (2, None, 2), (3, "zz", 3), (3, "zz", None), (None, "yy", 9)],
        "k long, s string, p long")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    checks = [not_null("t", "df", "s"), not_null("t", "df", "k"), unique("t", "df", "k"),
              accepted_values("t", "df", "s", ["a", "b"]),
              relationships("t", "df", "p", "parent", "p"),
              unique_combination("t", "df", ["k", "s"])]
    got = _failures(run_checks({"df": df, "parent": parent}, checks))
    assert got[("df", "s", "not_null")] == 1
    assert got[("df", "k", "not_null")] == 1
    assert got[("df", "k", "unique")] == 2          # values 1 and 3 repeat
    assert got[("df", "s", "accepted_values")] == 2  # 'zz' and 'yy'
    assert got[("df", "p", "relationships")] == 2    # rows with p = 3 and p = 9
    assert got[("df", "k,s", "unique_combination")] == 1


def test_suite_has_71_checks_and_passes_on_synthetic_data(spark):
    p = Layers.from_testdata(spark, "/root/testdata/sf0.001")
    report = check_report(p)
    rows = report.collect()
    assert len(rows) == len(ALL_CHECKS) == 71
    assert {r.status for r in rows} == {"pass"}
    assert_passed(report)


def test_bad_data_fails_gate(spark):
    raw = make_raw(spark, orders=[order(1), order(1, status="weird"), order(2, customer_id=99)],
                   order_items=[item(1, 1), item(1, 1)])
    report = check_report(Layers(raw))
    got = _failures(report)
    assert got[("stg_orders", "order_id", "unique")] == 1
    assert got[("stg_orders", "order_status", "accepted_values")] == 1
    assert got[("stg_orders", "customer_id", "relationships")] == 1
    assert got[("stg_order_items", "order_id,order_item_id", "unique_combination")] == 1
    with pytest.raises(DataQualityError):
        assert_passed(report, layer="staging")


def test_lineitem_raw_keys_are_not_unique(spark):
    li = load_source(spark, "/root/testdata/sf0.01", "lineitem")
    got = _failures(run_checks({"lineitem": li},
                               [unique_combination("raw", "lineitem", ["l_orderkey", "l_linenumber"])]))
    assert got[("lineitem", "l_orderkey,l_linenumber", "unique_combination")] > 0
