from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from builders import prices, rows, trades
from pyspark.sql import functions as F

from tidemark.operators import exposure, pnl, positions

JAN, FEB, MAR, APR = date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)


def history(spark):
    held = trades(
        spark,
        {"trade_date": date(2024, 1, 10)},
        {"trade_date": date(2024, 1, 20), "trade_type": "SELL", "quantity": D(4), "price": D(7)},
        {"trade_date": date(2024, 4, 2), "quantity": D(1), "price": D(8)},
        {"trade_date": date(2024, 2, 5), "instrument_id": "B", "quantity": D(3), "price": D(2)},
        {"trade_date": date(2024, 2, 6), "book_id": "b2"},
        {"trade_date": date(2024, 2, 7), "currency": "EUR", "quantity": D(2)},
    )
    quoted = prices(
        spark,
        {"price_date": date(2024, 1, 5), "close_price": D(6)},
        {"price_date": date(2024, 3, 1), "close_price": D(9)},
        {"price_date": date(2024, 3, 9), "close_price": D(10)},
        {"price_date": date(2024, 3, 20), "close_price": None},
        {"price_date": date(2024, 4, 3), "instrument_id": "B", "close_price": D(5)},
    )
    return held, quoted


def test_month_end_snapshots(spark):
    df = positions.position_snapshots(*history(spark), as_of=date(2024, 4, 10))
    wanted = df.filter("book_id = 'b1' and currency = 'USD'")
    assert rows(wanted, "instrument_id", "as_of_date", "quantity", "cost_basis", "market_value", "unrealized_pnl") == [
        ("A", JAN, D(6), D(22), D(36), D(14)),
        ("A", FEB, D(6), D(22), D(36), D(14)),
        ("A", MAR, D(6), D(22), D(60), D(38)),
        ("A", APR, D(7), D(30), D(70), D(40)),
        ("B", FEB, D(3), D(6), None, None),
        ("B", MAR, D(3), D(6), None, None),
        ("B", APR, D(3), D(6), D(15), D(9)),
    ]
    ids = {r["position_id"] for r in df.select("position_id").collect()}
    assert ids == {"A|b1|USD", "B|b1|USD", "A|b2|USD", "A|b1|EUR"}


def test_default_end_is_the_newest_date(spark):
    df = positions.position_snapshots(*history(spark))
    assert max(r[0] for r in rows(df, "as_of_date")) == APR


@pytest.mark.parametrize("frequency, steps", [("day", 92), ("week", 14), ("month", 4)])
def test_every_period_is_present(spark, frequency, steps):
    df = positions.position_snapshots(*history(spark), as_of=date(2024, 4, 10), frequency=frequency)
    dates = [r[0] for r in rows(df.filter("position_id = 'A|b1|USD'"), "as_of_date")]
    assert len(dates) == len(set(dates)) == steps
    if frequency != "month":
        gap = timedelta(days=1 if frequency == "day" else 7)
        assert all(b - a == gap for a, b in zip(dates, dates[1:]))


def test_unknown_frequency(spark):
    with pytest.raises(ValueError):
        positions.position_snapshots(*history(spark), frequency="hour")


@pytest.mark.parametrize("when", [date(2024, 1, 31), date(2024, 3, 31), date(2024, 4, 30)])
def test_single_snapshot_equals_that_date_of_the_series(spark, when):
    held, quoted = history(spark)
    series = positions.position_snapshots(held, quoted, as_of=when).filter(f"as_of_date = '{when}'")
    assert rows(positions.snapshot_at(held, quoted, when)) == rows(series)


@pytest.mark.parametrize("frequency", ["day", "week", "month"])
def test_every_snapshot_has_the_last_close_up_to_it(spark, frequency):
    """Closes before, between and after the trades, with gaps, none at all, and without an instrument."""
    start, end = date(2023, 11, 29), date(2024, 3, 5)
    bought = [("A", 3), ("A", 9), ("A", 40), ("B", 0), ("B", 61), ("C", 5), (None, 7), ("D", 50)]
    quotes = [("A", 0, 5), ("A", 3, 6), ("A", 37, None), ("A", 38, 7), ("B", 30, 8), ("B", 90, 9), (None, 2, 4), ("D", 1, 3), ("D", 400, 2)]
    held = trades(spark, *[{"trade_date": start + timedelta(d), "instrument_id": i, "quantity": D(1), "price": D(2)} for i, d in bought])
    quoted = prices(spark, *[
        {"price_date": start + timedelta(d), "instrument_id": i, "close_price": None if c is None else D(c)} for i, d, c in quotes])
    found = rows(
        positions.position_snapshots(held, quoted, end, frequency), "instrument_id", "as_of_date", "quantity", "market_value")

    def last_day_of(when):
        if frequency == "day":
            return when
        if frequency == "week":
            return when + timedelta(6 - when.weekday())
        return (when.replace(day=1) + timedelta(32)).replace(day=1) - timedelta(1)

    expected = set()
    for name in {i for i, _ in bought}:
        dates = [start + timedelta(d) for i, d in bought if i == name]
        for n in range((end - min(dates)).days + 1):
            until = last_day_of(min(dates) + timedelta(n))
            quantity = sum(d <= min(until, end) for d in dates)
            known = [c for i, d, c in sorted(quotes, key=lambda q: q[1]) if i == name and name and c and start + timedelta(d) <= min(until, end)]
            expected.add((name, until, D(quantity), D(quantity * known[-1]) if known else None))
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("frequency", ["day", "week", "month"])
def test_repeated_snapshots_are_not_shuffled(spark, frequency):
    """P&L windows and the P&L of one date work where the snapshots were expanded."""
    series = positions.position_snapshots(*history(spark), as_of=date(2024, 4, 10), frequency=frequency)
    for df in (pnl.position_pnl(series), pnl.pnl_at(series, date(2024, 4, 30))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Generate explode")[0] and plan.count("Generate explode") == 1


def odd_history(spark):
    """Closes before, between and after the trades, with gaps, none at all, and without an instrument; no book, two a day."""
    start = date(2023, 11, 29)
    bought = [("A", 3, "b1"), ("A", 9, "b1"), ("A", 40, "b2"), ("A", 40, "b1"), ("B", 0, "b1"), ("B", 61, None), ("C", 5, "b3"), (None, 7, "b1"), ("D", 50, None)]
    quotes = [("A", 0, 5), ("A", 3, 6), ("A", 37, None), ("A", 38, 7), ("B", 30, 8), ("B", 33, 8), ("B", 90, 9), (None, 2, 4), ("D", 1, 3), ("D", 400, 2)]
    held = trades(spark, *[
        {"trade_date": start + timedelta(d), "instrument_id": i, "book_id": b, "quantity": D(d + 1), "price": D(2)} for i, d, b in bought])
    quoted = prices(spark, *[
        {"price_date": start + timedelta(d), "instrument_id": i, "close_price": None if c is None else D(c)} for i, d, c in quotes])
    return held, quoted, date(2024, 3, 5)


def test_stretches_stand_for_the_daily_snapshots(spark):
    daily = positions.position_snapshots(*odd_history(spark), "day")
    stretches = positions.position_snapshots(*odd_history(spark), "day", stretches=True)
    assert rows(positions.every_day(stretches)) == rows(daily)
    told = rows(stretches, "as_of_date", "until", "market_value")
    assert len(told) < daily.count() / 10
    assert all(a <= b and (value is None or (a.year, a.month) == (b.year, b.month)) for a, b, value in told)
    with pytest.raises(ValueError):
        positions.position_snapshots(*odd_history(spark), "week", stretches=True)


def test_pnl_of_stretches(spark):
    """The first day of a stretch has its daily P&L; the sums to date hold on all its days."""
    daily = pnl.position_pnl(positions.position_snapshots(*odd_history(spark), "day"))
    stretches = pnl.position_pnl(positions.position_snapshots(*odd_history(spark), "day", stretches=True))
    begins = stretches.select("position_id", F.col("as_of_date").alias("begin"), "until", *[F.col(c).alias(f"s_{c}") for c in ("daily_pnl", "mtd_pnl", "ytd_pnl")])
    both = daily.join(begins, "position_id").filter("as_of_date between begin and until")
    assert both.count() == daily.count()
    wrong = "not (s_mtd_pnl <=> mtd_pnl and s_ytd_pnl <=> ytd_pnl and daily_pnl <=> if(as_of_date = begin, s_daily_pnl, s_daily_pnl * 0))"
    assert both.filter(wrong).count() == 0


def test_book_pnl_of_stretches_is_that_of_the_days(spark):
    """The positions are not repeated for every day, and books are added up with the same figures, missing ones too."""
    by_day = pnl.book_pnl(pnl.position_pnl(positions.position_snapshots(*odd_history(spark), "day")))
    by_stretch = pnl.book_pnl(pnl.position_pnl(positions.position_snapshots(*odd_history(spark), "day", stretches=True)))
    assert by_stretch.schema["mtd_pnl"].dataType == by_day.schema["mtd_pnl"].dataType
    wanted = rows(by_day, "book_id", "currency", "as_of_date", "daily_pnl", "mtd_pnl", "ytd_pnl")
    assert any(r[3] is None for r in wanted)
    assert rows(by_stretch, "book_id", "currency", "as_of_date", "daily_pnl", "mtd_pnl", "ytd_pnl") == wanted


def test_pnl_of_many_gaps(spark):
    """Every figure against plain sums of the daily changes, with missing values at ends of months and years."""
    start = date(2023, 11, 25)
    known = {0: 5, 3: 7, 5: None, 6: None, 7: 4, 20: None, 36: 9, 37: None, 40: None, 66: None, 68: 1, 69: 1, 99: None}
    found = rows(pnl.position_pnl(snapshots(spark, *[(start + timedelta(d), v) for d, v in known.items()])), "as_of_date", "daily_pnl", "mtd_pnl", "ytd_pnl")
    last, changes, expected = D(0), [], []
    for d, v in sorted(known.items()):
        when = start + timedelta(d)
        if v is not None:
            changes.append((when, D(v) - last))
            last = D(v)
        of = lambda parts: [c for w, c in changes if parts(w) == parts(when)]
        sums = [sum(x) if x else None for x in (of(lambda w: (w.year, w.month)), of(lambda w: w.year))]
        expected.append((when, None if v is None else changes[-1][1], *sums))
    assert found == expected


@pytest.mark.parametrize("frequency", ["day", "week", "month"])
def test_partitions_are_not_joined_before_rows_are_repeated(spark, frequency):
    """Their size before that says nothing about the rows a task then sorts."""
    series = positions.position_snapshots(*history(spark), as_of=date(2024, 4, 10), frequency=frequency)
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "REPARTITION_BY_COL" not in plan


def snapshots(spark, *values):
    """One position with the given (date, unrealised P&L)."""
    return spark.createDataFrame(
        [("p", d, "A", "b", "USD", None if v is None else D(v)) for d, v in values],
        "position_id string, as_of_date date, instrument_id string, book_id string, currency string, "
        "unrealized_pnl decimal(28,2)")


def test_pnl_runs_within_month_and_year(spark):
    df = pnl.position_pnl(snapshots(
        spark, (date(2023, 12, 30), 5), (date(2023, 12, 31), 7), (date(2024, 1, 1), 4), (date(2024, 1, 2), None),
        (date(2024, 1, 3), 10), (date(2024, 2, 1), 11)))
    assert rows(df, "as_of_date", "daily_pnl", "mtd_pnl", "ytd_pnl") == [
        (date(2023, 12, 30), D(5), D(5), D(5)),
        (date(2023, 12, 31), D(2), D(7), D(7)),
        (date(2024, 1, 1), D(-3), D(-3), D(-3)),
        (date(2024, 1, 2), None, D(-3), D(-3)),
        (date(2024, 1, 3), D(6), D(3), D(3)),
        (date(2024, 2, 1), D(1), D(1), D(4)),
    ]


@pytest.mark.parametrize("when", [date(2023, 12, 30), date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 1), date(2024, 2, 3)])
def test_one_day_of_pnl_equals_the_series(spark, when):
    series = [(date(2023, 12, 30), 5), (date(2023, 12, 31), 7), (date(2024, 1, 1), None), (date(2024, 1, 2), None),
              (date(2024, 1, 3), 10), (date(2024, 2, 1), None), (date(2024, 2, 3), 11)]
    history = snapshots(spark, *series)
    expected = pnl.position_pnl(history).filter(f"as_of_date = '{when}'")
    found = pnl.pnl_at(history, when)
    assert found.columns == expected.columns and found.dtypes == expected.dtypes
    assert rows(found) == rows(expected)


def test_all_pnl_windows_share_one_sort(spark):
    plan = pnl.position_pnl(snapshots(spark, (date(2024, 1, 1), 5)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_daily_pnl_adds_up_to_unrealised(spark):
    df = pnl.position_pnl(positions.position_snapshots(*history(spark), frequency="week"))
    totals = df.groupBy("position_id").agg({"daily_pnl": "sum"}).collect()
    newest = {r["position_id"]: r["unrealized_pnl"] for r in df.orderBy("as_of_date").collect()}
    assert {r[0]: r[1] for r in totals} == newest


def test_book_pnl(spark):
    df = pnl.book_pnl(pnl.position_pnl(positions.position_snapshots(*history(spark))))
    found = {(r["book_id"], r["currency"], r["as_of_date"]): r["ytd_pnl"] for r in df.collect()}
    assert found["b1", "USD", APR] == D(49)


def test_exposures(spark):
    held = spark.createDataFrame(
        [(APR, "A", D(10)), (APR, "A", D(-4)), (APR, "B", D(7)), (APR, "C", None), (MAR, "A", D(1))],
        "as_of_date date, instrument_id string, market_value decimal(28,2)").withColumn("currency", F.lit("USD"))
    known = spark.createDataFrame(
        [("A", "EQUITY", "tech"), ("B", "EQUITY", "tech")],
        "instrument_id string, asset_class string, sector string")
    assert rows(exposure.instrument_exposure(held)) == [
        (MAR, "A", "USD", D(1), D(1), 1), (APR, "A", "USD", D(6), D(14), 2), (APR, "B", "USD", D(7), D(7), 1),
        (APR, "C", "USD", None, None, 1)]
    assert rows(exposure.sector_exposure(held, known)) == [
        (MAR, "EQUITY", "tech", "USD", D(1), D(1), 1), (APR, "EQUITY", "tech", "USD", D(13), D(21), 3),
        (APR, None, None, "USD", None, None, 1)]


def test_counterparty_exposure(spark):
    from tidemark.operators.silver import silver_trades

    clean = silver_trades(trades(
        spark, {"trade_id": "1"}, {"trade_id": "2", "trade_type": "SELL", "quantity": D(4)},
        {"trade_id": "3", "counterparty_id": "c9"}))
    known = spark.createDataFrame([("c1", "One", "AA")], "counterparty_id string, counterparty_name string, credit_rating string")
    assert rows(exposure.counterparty_exposure(clean, known)) == [
        ("c1", "USD", D(30), D(70), 2, "One", "AA"), ("c9", "USD", D(50), D(50), 1, None, None)]


def test_small_amounts_are_added_exactly(spark):
    one = trades(spark, {"quantity": D("0.0001"), "price": D("0.0005")})
    many = one.crossJoin(spark.range(400_000)).drop("id")
    held = positions.snapshot_at(many, prices(spark, {}), APR)
    assert rows(held, "quantity", "cost_basis") == [(D(40), D("0.02"))]


def test_different_keys_have_different_ids(spark):
    keys = [("A|B", "C"), ("A", "B|C"), ("A", None), ("A", ""), ("A", r"\N"), ("A\\", "|C")]
    traded = trades(spark, *({"trade_id": str(n), "instrument_id": i, "book_id": b} for n, (i, b) in enumerate(keys)))
    held = positions.snapshot_at(traded, prices(spark, {}), APR)
    assert held.select("position_id").distinct().count() == len(keys)


def test_a_large_position_keeps_its_quantity(spark):
    bought = trades(spark, *({"trade_id": str(n), "quantity": D("90000000000000"), "price": D(1)} for n in range(3)))
    held = positions.snapshot_at(bought, prices(spark, {"close_price": D(2)}), APR)
    assert rows(held, "quantity", "cost_basis", "market_value") == [
        (D("270000000000000"), D("270000000000000"), D("540000000000000"))]


def test_currencies_are_not_added(spark):
    held = spark.createDataFrame(
        [(APR, "A", D(10), "USD"), (APR, "A", D(5), "EUR")],
        "as_of_date date, instrument_id string, market_value decimal(28,2), currency string")
    assert rows(exposure.instrument_exposure(held), "currency", "net_exposure") == [("EUR", D(5)), ("USD", D(10))]
