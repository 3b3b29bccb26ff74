from datetime import date
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from builders import prices, rows, trades

from tidemark.operators import views
from tidemark.plans import queries

T = date(2024, 1, 31)
U = date(2024, 2, 29)
SUMMARY = ("as_of_date", "asset_class", "sector", "instrument_count", "total_market_value",
           "total_unrealized_pnl", "avg_var_95", "total_daily_pnl")


def model(spark):
    held = spark.createDataFrame(
        [(T, "A", D(100), D(1)), (T, "A", D(200), D(2)), (T, "B", D(50), None), (T, "Z", D(5), D(5)), (U, "A", D(7), D(7)),
         (T, None, D(1), D(1))],
        "as_of_date date, instrument_id string, market_value decimal(18,2), unrealized_pnl decimal(18,2)")
    risk = spark.createDataFrame(
        [(T, "A", 10.0, D(3)), (T, "A", 30.0, None), (T, "B", None, D(4)), (T, None, 9.0, D(9))],
        "as_of_date date, instrument_id string, var_95 double, daily_pnl decimal(18,2)")
    known = spark.createDataFrame(
        [("A", "EQ", "tech"), ("B", "EQ", "tech"), ("C", "FX", "g10")],
        "instrument_id string, asset_class string, sector string")
    return held, known, risk


def test_published_summary_equals_the_row_level_join(spark):
    held, known, risk = model(spark)
    for name, df in (("p", held), ("i", known), ("r", risk)):
        df.createOrReplaceTempView(f"v1_{name}")
    expected = spark.sql("""
        SELECT p.as_of_date, i.asset_class, i.sector, count(DISTINCT p.instrument_id), sum(p.market_value),
               sum(p.unrealized_pnl), avg(r.var_95), sum(r.daily_pnl)
        FROM v1_p p LEFT JOIN v1_i i ON p.instrument_id = i.instrument_id
        LEFT JOIN v1_r r ON p.instrument_id = r.instrument_id AND p.as_of_date = r.as_of_date
        GROUP BY 1, 2, 3""")
    found = rows(views.portfolio_summary(held, known, risk), *SUMMARY)
    assert found == rows(expected)
    assert (T, "EQ", "tech", 2, D(650), D(6), 20.0, D(10)) in found


def test_corrected_summary_counts_rows_once(spark):
    found = rows(views.portfolio_summary_once(*model(spark)), *SUMMARY)
    assert (T, "EQ", "tech", 2, D(350), D(3), 20.0, D(7)) in found


def test_counterparty_view(spark):
    risk = spark.createDataFrame(
        [(T, "c1", D(10), 1.0), (T, "c1", D(20), 3.0), (T, None, D(5), None), (T, "ghost", D(6), 8.0), (U, "c1", None, None)],
        "as_of_date date, counterparty_id string, credit_exposure decimal(18,2), var_95 double")
    known = spark.createDataFrame(
        [("c1", "One", "AA"), ("c2", "Two", "B")], "counterparty_id string, counterparty_name string, credit_rating string")
    df = views.counterparty_risk(risk, known)
    assert rows(df, "as_of_date", "counterparty_id", "counterparty_name", "credit_rating", "total_credit_exposure", "avg_var_95") == [
        (T, "c1", "One", "AA", D(30), 2.0), (T, None, None, None, D(11), 8.0), (U, "c1", "One", "AA", None, None)]


@pytest.mark.parametrize("build", [views.portfolio_summary, views.portfolio_summary_once])
def test_many_books_do_not_multiply_rows_in_the_join(spark, build):
    """A hot instrument in k books: the join must see one row per side, not k * k."""
    held = spark.range(2000).selectExpr(
        f"date'{T}' as as_of_date", "'A' as instrument_id", "cast(1 as decimal(18,2)) as market_value",
        "cast(1 as decimal(18,2)) as unrealized_pnl")
    risk = spark.range(2000).selectExpr(
        f"date'{T}' as as_of_date", "'A' as instrument_id", "2.0D as var_95", "cast(1 as decimal(18,2)) as daily_pnl")
    known = model(spark)[1]
    row = build(held, known, risk).first()
    times = 2000 if build is views.portfolio_summary else 1
    assert row["total_market_value"] == row["total_daily_pnl"] == 2000 * times and row["avg_var_95"] == 2.0


def test_portfolio_history_works_where_the_snapshots_lie(spark):
    """Positions get their VaR, are summed and their instruments counted without being sent anywhere again."""
    dates = {"trade_date": T, "settlement_date": U}
    bought = trades(spark, dates, {**dates, "trade_id": "t2", "instrument_id": "B", "book_id": "b2"})
    quoted = prices(spark, {"price_date": T}, {"price_date": U, "instrument_id": "B"})
    known = spark.createDataFrame([("A", "EQ", "tech")], "instrument_id string, asset_class string, sector string")
    given = SimpleNamespace(
        raw_trades=lambda: bought, raw_prices=lambda: quoted, daily_prices=lambda: quoted, instruments=lambda: known,
        last_day=date(2024, 5, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = queries.portfolio_history(given)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Generate explode" in plan and plan.split("Generate explode")[0].count("Exchange hash") == 1
        assert df.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_instruments_listed_twice_are_counted_once(spark):
    held, _, risk = model(spark)
    known = spark.createDataFrame(
        [("A", "EQ", "tech"), ("A", "EQ", "tech"), ("A", "FX", "g10"), ("B", "EQ", "tech"), (None, "EQ", "tech")],
        "instrument_id string, asset_class string, sector string")
    found = rows(views.portfolio_summary_once(held, known, risk), *SUMMARY[:5])
    assert [r for r in found if r[0] == T] == [
        (T, "EQ", "tech", 2, D(650)), (T, "FX", "g10", 1, D(300)), (T, None, None, 1, D(6))]
