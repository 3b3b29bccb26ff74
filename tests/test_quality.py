from decimal import Decimal as D

import pytest
from builders import day, prices, rows, trades

from tidemark.operators import quality
from tidemark.operators.quality import Between, GreaterThan, NotNull, Unique


def found(df):
    return {r["rule"]: (r["evaluated"], r["failed"], r["passed"]) for r in df.collect()}


def test_trade_rules(spark):
    df = trades(
        spark,
        {"trade_id": "a"}, {"trade_id": "a", "trade_type": "XFER"}, {"trade_id": None, "quantity": None},
        {"trade_id": None, "quantity": D(1_000_000), "price": D(0)}, {"trade_id": "b", "quantity": D(1_000_001)},
        {"trade_id": "c", "price": D("100000.01"), "trade_type": None}, {"trade_id": "d", "quantity": D(-1)})
    assert found(quality.report(df, "trades")) == {
        "trades_unique_id": (5, 1, False),
        "trades_no_null_id": (7, 2, False),
        "trades_valid_type": (6, 1, False),
        "trades_positive_quantity": (6, 2, False),
        "trades_positive_price": (7, 1, False),
    }


def test_price_rules_are_strict_where_they_compare(spark):
    df = prices(
        spark,
        {"price_id": "1", "high_price": D(2), "low_price": D(1)},
        {"price_id": "2", "high_price": D(2), "low_price": D(2), "close_price": D(1_000_000)},
        {"price_id": "3", "high_price": None, "low_price": D(2), "close_price": D(0)},
        {"price_id": "4", "close_price": None})
    assert found(quality.report(df, "prices")) == {
        "prices_unique_id": (4, 0, True),
        "prices_no_null_close": (4, 1, False),
        "prices_positive_close": (3, 0, True),
        "prices_high_low_check": (2, 1, False),
    }


def test_gold_rules(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, None), (-1.0, -2.0, D(50_000_000)), (1e8, 2e8, D(-50_000_001)), (None, 3.0, D(0))],
        "var_95 double, var_99 double, daily_pnl decimal(18,2)")
    assert found(quality.report(df, "risk_metrics")) == {
        "var_95_bounds": (3, 1, False),
        "var_99_greater_than_95": (3, 2, False),
        "pnl_reasonable_bounds": (3, 1, False),
    }


def test_empty_table_passes_with_zero_counts(spark):
    df = quality.report(trades(spark, {}).filter("false"), "trades")
    assert set(found(df).values()) == {(0, 0, True)}


def test_several_unique_columns(spark):
    rules = (Unique("one", "trade_id"), NotNull("two", "book_id"), Unique("three", "instrument_id"))
    df = trades(spark, {"trade_id": "a"}, {"trade_id": "b"}, {"trade_id": "c", "instrument_id": "B"})
    assert found(quality.report(df, "trades", rules)) == {
        "one": (3, 0, True), "two": (3, 0, True), "three": (3, 1, False)}


def test_rules_without_unique_need_no_shuffle_of_rows(spark):
    rules = (Between("b", "price", 0, 1), GreaterThan("g", "price", "quantity"))
    plan = quality.report(trades(spark, {}), "trades", rules)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_checkpoints(spark):
    tables = {"trades": trades(spark, {}), "prices": prices(spark, {})}
    df = quality.checkpoint_report(tables, "bronze_validation")
    assert [(r[0], r[1]) for r in rows(df, "checkpoint", "table")] == (
        [("bronze_validation", "prices")] * 4 + [("bronze_validation", "trades")] * 5)
    assert quality.checkpoint_report(tables, "silver_validation").count() == 5
    with pytest.raises(KeyError):
        quality.checkpoint_report(tables, "gold_validation")


def test_thresholds(spark):
    df = trades(spark, *[{"trade_id": str(i)} for i in range(98)], {"trade_id": "0"}, {"trade_id": None})
    gate = {r["metric"]: (r["value"], r["passed"])
            for r in quality.threshold_gate(df, "trade_id", ["trade_id", "status"]).collect()}
    assert gate == {
        "null_ratio": (pytest.approx(101 / 200), False),
        "row_count": (100.0, True),
        "duplicate_ratio": (pytest.approx(0.01), True),
    }


def test_thresholds_of_an_empty_table(spark):
    df = quality.threshold_gate(trades(spark, {}).filter("false"), "trade_id", ["trade_id"])
    assert {r["metric"]: r["passed"] for r in df.collect()} == {
        "null_ratio": True, "row_count": False, "duplicate_ratio": True}


def test_trade_warnings_treat_null_as_a_key(spark):
    df = trades(spark, {"trade_id": None}, {"trade_id": None, "trade_date": None}, {"instrument_id": None}, {"trade_id": "x"})
    assert dict(rows(quality.trade_warnings(df))) == {
        "rows": 4, "duplicate_trade_id": 1, "null_trade_id": 2, "null_trade_date": 1, "null_instrument_id": 1}


def test_price_warnings(spark):
    df = prices(
        spark, {"close_price": D(-1)}, {"close_price": D(0)}, {"high_price": D(1), "low_price": D(2)},
        {"high_price": None, "low_price": D(2)}, {"high_price": D(2), "low_price": D(2)})
    assert dict(rows(quality.price_warnings(df))) == {"rows": 5, "negative_close": 1, "high_below_low": 1}


def test_small_checks(spark):
    df = trades(spark, {}, {}, {"trade_id": "x", "instrument_id": None, "trade_date": day(3)})
    assert rows(quality.duplicate_keys(df, "trade_id")) == [("t1", 2)]
    assert rows(quality.null_count(df, "instrument_id", "missing")) == [(1,)]
    assert rows(quality.row_counts({"a": df, "b": df.filter("false")})) == [(3, 0)]
