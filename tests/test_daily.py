"""Jobs that continue from stored state against the same computed from all history."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from builders import day, prices, rows, trades
from pyspark.sql import functions as F

from tidemark.operators import pnl, positions, returns, silver, var
from tidemark.plans import daily
from tidemark.sources import tables


def quotes(spark, first, last, seed=1):
    rng = random.Random(seed)
    made = []
    for offset in range((last - first).days + 1):
        for name in "ABCD":
            if rng.random() < {"A": 0.9, "B": 0.3, "C": 0.02, "D": 0.6}[name]:
                close = rng.choice([None, D(0), D(rng.randint(1, 99)), D(rng.randint(1, 99)), D(rng.randint(1, 99))])
                made.append({"price_id": f"{name}{offset}{rng.random()}", "instrument_id": name,
                             "price_date": first + timedelta(days=offset), "close_price": close})
    df = prices(spark, *made)
    return df.withColumns({"year": F.year("price_date"), "month": F.month("price_date"),
                           "ingestion_timestamp": F.lit("2024-01-01").cast("timestamp")})


def expected_returns(bronze):
    whole = returns.continue_returns(silver.silver_prices(bronze), None)
    kept = whole.filter("daily_return is not null")
    assert rows(kept, "instrument_id", "price_date", "prev_close", "daily_return") == rows(
        returns.daily_returns(silver.silver_prices(bronze)), "instrument_id", "price_date", "prev_close", "daily_return")
    return rows(whole, "instrument_id", "price_date", "close_price", "prev_close", "daily_return")


def test_prices_extended_month_by_month(spark, tmp_path):
    bronze, target, carry = (str(tmp_path / n) for n in ("bronze", "target", "carry"))
    history = quotes(spark, date(2022, 11, 3), date(2023, 9, 20))
    tables.replace_partitioned(history, bronze, daily.YEAR_MONTH)
    names = ("instrument_id", "price_date", "close_price", "prev_close", "daily_return")
    daily.extend_prices(spark, bronze, target, carry, date(2023, 1, 31))
    written = daily.extend_prices(spark, bronze, target, carry, date(2023, 5, 2))
    assert {(r.year, r.month) for r in written.select("year", "month").distinct().collect()} == {(2023, m) for m in (2, 3, 4, 5)}
    daily.extend_prices(spark, bronze, target, carry, date(2023, 9, 1))
    assert rows(tables.read_table(spark, target), *names) == expected_returns(history)
    again = daily.extend_prices(spark, bronze, target, carry, date(2023, 8, 1))  # already there
    assert again.count() == 0 and rows(tables.read_table(spark, target), *names) == expected_returns(history)

    # Late prices: the run begins at the carry before them and goes on to the last month.
    late = quotes(spark, date(2023, 3, 5), date(2023, 3, 9), seed=2).withColumn("ingestion_timestamp", F.lit("2024-02-01").cast("timestamp"))
    tables.append_partitioned(late, bronze, daily.YEAR_MONTH)
    daily.extend_prices(spark, bronze, target, carry, date(2023, 3, 9), since=date(2023, 3, 5))
    whole = tables.read_table(spark, bronze)
    assert rows(tables.read_table(spark, target), *names) == expected_returns(whole)
    silver_rows = returns.continue_returns(silver.silver_prices(whole), None)
    for end in (date(2023, 2, 1), date(2023, 6, 1), date(2023, 10, 1)):
        kept = tables.read_table(spark, carry).filter(F.col("before") == F.lit(end)).drop("before")
        assert rows(kept) == rows(returns.carry_before(end, silver_rows, None))
    assert tables.newest_partition(spark, carry, "before") == date(2023, 10, 1)


def test_extended_prices_are_shuffled_once_by_instrument(spark, tmp_path, monkeypatch):
    """Copies, lag and carry share a shuffle of the prices; the carry alone is sent to them."""
    bronze, target, carry = (str(tmp_path / n) for n in ("bronze", "target", "carry"))
    tables.replace_partitioned(quotes(spark, date(2022, 12, 3), date(2023, 2, 20)), bronze, daily.YEAR_MONTH)
    daily.extend_prices(spark, bronze, target, carry, date(2022, 12, 31))
    plans, write = [], tables.replace_touched_partitions

    def seen(df, path, *args):
        if path == target:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, *args)

    monkeypatch.setattr(tables, "replace_touched_partitions", seen)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily.extend_prices(spark, bronze, target, carry, date(2023, 2, 28))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 2  # the prices, and the carry


def test_var_from_stored_returns_prunes_and_has_no_lag(spark, tmp_path):
    bronze, target, carry = (str(tmp_path / n) for n in ("bronze", "target", "carry"))
    history = quotes(spark, date(2021, 11, 3), date(2023, 9, 20))
    tables.replace_partitioned(history, bronze, daily.YEAR_MONTH)
    daily.extend_prices(spark, bronze, target, carry, date(2022, 12, 31))
    daily.extend_prices(spark, bronze, target, carry, date(2023, 9, 30))
    recent = daily.stored_returns(spark, target, carry, 90)
    expected = returns.lookback_returns(silver.silver_prices(history), 90)
    assert rows(recent, "instrument_id", "price_date", "daily_return") == rows(expected, "instrument_id", "price_date", "daily_return")
    plan = var.instrument_var(recent)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters and "lag(" not in plan
    found = rows(var.instrument_var(recent, min_returns=5))
    assert found == rows(var.instrument_var(expected, min_returns=5))
    assert found == rows(var.instrument_var_tail(recent, min_returns=5, longest=91))
    scan = [line for line in plan.splitlines() if "Scan parquet" in line]
    assert len(scan) == 1


def test_no_return_yet(spark, tmp_path):
    bronze, target, carry = (str(tmp_path / n) for n in ("bronze", "target", "carry"))
    one = quotes(spark, date(2023, 1, 1), date(2023, 1, 1)).limit(1)
    tables.replace_partitioned(one, bronze, daily.YEAR_MONTH)
    daily.extend_prices(spark, bronze, target, carry, date(2023, 1, 1))
    assert daily.stored_returns(spark, target, carry).count() == 0


@pytest.fixture(scope="module")
def book(spark):
    rng = random.Random(5)
    made = [
        {"trade_id": f"t{i}", "trade_date": day(rng.randint(300, 420)), "instrument_id": rng.choice("ABCDE"), "book_id": rng.choice(["b1", "b2", None]),
         "currency": rng.choice(["USD", "EUR"]), "trade_type": rng.choice(["BUY", "SELL"]), "quantity": D(rng.randint(1, 999)) / 7, "price": D(rng.randint(1, 999)) / 3}
        for i in range(300)]
    held = trades(spark, *made).withColumns({"year": F.year("trade_date"), "month": F.month("trade_date")})
    return held, quotes(spark, day(330), day(425), seed=9)


SNAPSHOT = ("position_id", "as_of_date", "quantity", "cost_basis", "market_value", "unrealized_pnl")


def test_positions_advanced_day_by_day(spark, tmp_path, book):
    held, quoted = book
    sold, priced, state, target = (str(tmp_path / n) for n in ("trades", "prices", "state", "positions"))
    tables.replace_partitioned(held, sold, daily.YEAR_MONTH)
    tables.replace_partitioned(quoted, priced, daily.YEAR_MONTH)

    def expected(when):
        return rows(positions.snapshot_at(held, quoted, when), *SNAPSHOT)

    for offset in (350, 395, 396, 397):  # the first adds up all trades once; 395 closes a gap over month ends
        found = daily.advance_positions(spark, sold, priced, state, target, day(offset))
        assert rows(found, *SNAPSHOT) == expected(day(offset)) and len(expected(day(offset))) > 10
    daily.advance_positions(spark, sold, priced, state, target, day(397))  # repeated
    assert tables.read_table(spark, target).groupBy("as_of_date").count().count() == 4
    assert rows(tables.read_table(spark, target).filter(F.col("as_of_date") == F.lit(day(397))), *SNAPSHOT) == expected(day(397))

    # Late trades: from the last state before them.
    extra = held.limit(20).withColumns({"trade_id": F.concat("trade_id", F.lit("x")), "trade_date": F.lit(day(396)), "year": F.lit(2025), "month": F.lit(1)})
    tables.append_partitioned(extra, sold, daily.YEAR_MONTH)
    found = daily.advance_positions(spark, sold, priced, state, target, day(397), since=day(396))
    assert rows(found, *SNAPSHOT) == rows(positions.snapshot_at(tables.read_table(spark, sold), quoted, day(397)), *SNAPSHOT)


def test_a_day_reads_one_base_and_its_own_trades(spark, tmp_path, book):
    held, quoted = book
    sold, priced, state, target = (str(tmp_path / n) for n in ("trades", "prices", "state", "positions"))
    tables.replace_partitioned(held, sold, daily.YEAR_MONTH)
    tables.replace_partitioned(quoted, priced, daily.YEAR_MONTH)
    daily.advance_positions(spark, sold, priced, state, target, day(396))
    base = tables.read_table(spark, f"{state}/holdings").filter(F.col("as_of_date") == F.lit(day(396)))
    new = daily._between(tables.read_table(spark, sold), "trade_date", day(396), day(397))
    assert {r.trade_date for r in new.collect()} <= {day(397)}
    plan = positions.advanced_holdings(base, new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and plan.count("Scan parquet") >= 2 and "Join" not in plan
    assert "as_of_date" in plan and "month" in plan.split("PartitionFilters: [")[1] + plan.split("PartitionFilters: [")[2]


def test_pnl_advanced_day_by_day(spark, tmp_path, book):
    held, quoted = book
    state, positions_table, target = (str(tmp_path / n) for n in ("state", "held", "pnl"))
    history = positions.position_snapshots(held, quoted, day(400), "day").cache()
    # Some days without a value or without the position, as a stored table may have them.
    history = history.withColumn("unrealized_pnl", F.when(F.xxhash64("position_id", "as_of_date") % 5 != 0, F.col("unrealized_pnl")))
    history = history.filter(F.xxhash64("as_of_date", "position_id") % 7 != 0)
    tables.append_partitioned(history, positions_table, ["as_of_date"])
    expected = pnl.position_pnl(history)
    daily.start_pnl(spark, tables.read_table(spark, positions_table).filter(F.col("as_of_date") <= F.lit(day(362))), state, day(362))
    names = ("position_id", "as_of_date", "unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")
    # day(366) is the first of a year; a gap of some days, and of a month's end, follows
    for offset in (363, 364, 365, 366, 367):
        found = daily.advance_pnl(spark, positions_table, state, target, day(offset))
        assert rows(found, *names) == rows(expected.filter(F.col("as_of_date") == F.lit(day(offset))), *names)
        assert found.count() > 10
    kept = tables.read_table(spark, state).filter(F.col("as_of_date") == F.lit(day(367)))
    assert rows(kept.select(*sorted(kept.columns))) == rows(
        pnl.pnl_state_at(history, day(367)).select(*sorted(kept.columns)))


def test_pnl_without_a_state_begins_at_zero(spark, tmp_path, book):
    held, quoted = book
    state, positions_table, target = (str(tmp_path / n) for n in ("state", "held", "pnl"))
    tables.append_partitioned(positions.snapshot_at(held, quoted, day(400)), positions_table, ["as_of_date"])
    found = daily.advance_pnl(spark, positions_table, state, target, day(400))
    assert found.filter("not daily_pnl <=> unrealized_pnl or not mtd_pnl <=> unrealized_pnl").count() == 0
    first = rows(found)
    assert rows(daily.advance_pnl(spark, positions_table, state, target, day(400))) == first
