import random
from decimal import Decimal

import pytest
from builders import closes, day, nulls_last, prices, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import level_tag
from tidemark.operators import returns, var
from tidemark.schemas import FCT_RISK_METRICS


def as_returns(spark, series):
    data = [(k, float(v)) for k, values in series.items() for v in values]
    return spark.createDataFrame(data, "instrument_id string, daily_return double")


def expected_returns(quotes, lookback=None):
    """Sorted-list oracle for returns and the lookback window."""
    found = []
    by_instrument = {}
    for instrument, when, close in sorted(quotes, key=lambda q: (q[0], q[1])):
        previous = by_instrument.get(instrument)
        if close is not None and previous:
            found.append((instrument, when, (close - previous) / previous))
        by_instrument[instrument] = close
    if lookback is not None and found:
        first = max(w for _, w, _ in found).toordinal() - lookback
        found = [f for f in found if f[1].toordinal() >= first]
    return sorted(found, key=nulls_last)


def test_daily_returns_skip_first_missing_and_zero(spark):
    quotes = [("A", day(0), 10.0), ("A", day(1), 11.0), ("A", day(3), None), ("A", day(4), 5.0),
              ("A", day(5), 0.0), ("A", day(6), 3.0), ("A", day(7), 6.0), ("B", day(9), 1.0)]
    df = returns.daily_returns(closes(spark, quotes))
    assert rows(df, "instrument_id", "price_date", "daily_return") == [
        ("A", day(1), pytest.approx(0.1)), ("A", day(5), -1.0), ("A", day(7), 1.0)]


def test_decimal_closes(spark):
    df = returns.daily_returns(
        prices(spark, {}, {"price_date": day(1), "close_price": Decimal("101.5")}))
    assert rows(df, "daily_return") == [(pytest.approx(0.015),)]


def test_lookback_is_inclusive_calendar_days(spark):
    quotes = [("A", day(d), 1.0 + d) for d in (0, 1, 2, 253, 254)]
    df = returns.within_lookback(returns.daily_returns(closes(spark, quotes)))
    assert [r[0] for r in rows(df, "price_date")] == [day(2), day(253), day(254)]


def check_same(spark, quotes, lookback):
    source = closes(spark, quotes)
    plain = returns.within_lookback(returns.daily_returns(source), lookback)
    folded = returns.lookback_returns(source, lookback)
    columns = ("instrument_id", "price_date", "daily_return")
    want = expected_returns(quotes, lookback)
    assert rows(plain, *columns) == want
    assert rows(folded, *columns) == want


@settings(max_examples=6, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    quotes=st.dictionaries(
        st.tuples(st.sampled_from("ABCDE"), st.integers(0, 60)),
        st.one_of(st.sampled_from([None, 0.0]), st.integers(1, 50).map(float)),
        min_size=1, max_size=60),
    lookback=st.integers(0, 40))
def test_folded_history_equals_the_plain_form(spark, quotes, lookback):
    check_same(spark, [(i, day(d), c) for (i, d), c in quotes.items()], lookback)


@pytest.mark.parametrize(
    "name, quotes",
    [
        ("no instrument is clean", [("A", 0, 1), ("A", 1, 0), ("A", 50, 4), ("A", 51, 5), ("B", 2, None), ("B", 3, 7), ("B", 60, 8)]),
        ("newest prices give no return", [("A", 0, 2), ("A", 9, 3), ("A", 30, None), ("B", 1, 1), ("B", 2, 2)]),
        ("price before the window is missing", [("A", 0, 2), ("A", 9, None), ("A", 30, 5), ("B", 29, 1), ("B", 31, 2)]),
        ("price before the window is old", [("A", 0, 2), ("A", 1, 4), ("A", 30, 5), ("B", 29, 1), ("B", 31, 2)]),
        ("one price only", [("A", 0, 2)]),
    ],
)
def test_folded_history_edge_cases(spark, name, quotes):
    check_same(spark, [(i, day(d), None if c is None else float(c)) for i, d, c in quotes], 10)


def test_as_of_caps_the_prices(spark):
    quotes = [("A", day(d), 1.0 + d) for d in range(30)]
    df = returns.lookback_returns(closes(spark, quotes), 5, day(20))
    assert [r[0] for r in rows(df, "price_date")] == [day(d) for d in range(15, 21)]


def test_minimum_number_of_returns(spark):
    df = var.instrument_var(as_returns(spark, {"few": range(29), "enough": range(30)}))
    found = {r["instrument_id"]: r for r in df.collect()}
    assert found["few"]["var_95_pct"] is None and found["few"]["cvar_99_pct"] is None
    assert found["few"]["returns"] == 29
    assert (found["enough"]["var_95_pct"], found["enough"]["var_99_pct"]) == (1.0, 0.0)


def test_var_takes_the_indexed_return(spark):
    series = [round(-0.5 + 0.01 * i, 2) for i in range(100)]
    random.Random(1).shuffle(series)
    row = var.instrument_var(as_returns(spark, {"A": series})).first()
    assert (row["var_95_pct"], row["var_99_pct"]) == (-0.45, -0.49)
    assert row["cvar_95_pct"] == pytest.approx(-0.475) and row["cvar_99_pct"] == pytest.approx(-0.495)


def test_var_matches_sorted_lists_for_many_sizes(spark):
    rng = random.Random(7)
    series = {f"i{n}": [rng.choice((rng.gauss(0, 1), 0.25)) for _ in range(n)]
              for n in [*range(28, 70), 80, 100, 120, 200, 253]}
    levels = (0.9, 0.95, 0.975, 0.99)
    found = var.instrument_var(as_returns(spark, series), levels).collect()
    assert len(found) == len(series)
    for row in found:
        ordered = sorted(series[row["instrument_id"]])
        for level in levels:
            tag = level_tag(level)
            if len(ordered) < 30:
                assert row[f"var_{tag}_pct"] is None
                continue
            k = int((1 - level) * len(ordered))
            assert row[f"var_{tag}_pct"] == ordered[k]
            assert row[f"cvar_{tag}_pct"] == pytest.approx(sum(ordered[: k + 1]) / (k + 1))


def test_sorted_array_form_gives_the_same_var(spark):
    rng = random.Random(3)
    data = as_returns(spark, {f"i{n}": [rng.gauss(0, 1) for _ in range(n)] for n in (30, 40, 60, 99, 250)})
    arrays = data.groupBy("instrument_id").agg(F.sort_array(F.collect_list("daily_return")).alias("r"))
    expected = arrays.select(
        "instrument_id", F.get("r", F.floor(F.lit(1 - 0.95) * F.size("r")).cast("int")).alias("var_95_pct"))
    assert rows(var.instrument_var(data), "instrument_id", "var_95_pct") == rows(expected)


def test_long_format_agrees_with_wide(spark):
    data = as_returns(spark, {"A": range(40), "B": range(10)})
    wide = var.instrument_var(data).collect()
    expected = sorted(
        [(r["instrument_id"], level, r[f"var_{tag}_pct"])
         for r in wide for level, tag in ((0.95, "95"), (0.99, "99"))], key=nulls_last)
    assert rows(var.var_by_level(data), "instrument_id", "level", "var_pct") == expected


POSITION = "position_id string, as_of_date date, instrument_id string, book_id string, market_value decimal(18,2)"


def held(spark, *data):
    return spark.createDataFrame([(p, d, i, b, Decimal(v)) for p, d, i, b, v in data], POSITION)


def known_var(spark):
    return spark.createDataFrame(
        [("A", -0.1, -0.2, -0.15, -0.25), ("B", 0.05, -0.1, 0.01, -0.12)],
        "instrument_id string, var_95_pct double, var_99_pct double, cvar_95_pct double, cvar_99_pct double")


def positions(spark):
    return held(
        spark, ("old", day(0), "A", "x", 999), ("long", day(1), "A", "x", 100), ("short", day(1), "A", "y", -50),
        ("gain", day(1), "B", "y", 10), ("unknown", day(1), "C", "y", 70))


def test_position_var_of_the_newest_snapshot(spark):
    df = var.position_var(positions(spark), known_var(spark))
    assert rows(df, "position_id", "var_95", "var_99", "cvar_95") == [
        ("gain", 0.5, 1.0, pytest.approx(0.1)),
        ("long", 10.0, 20.0, 15.0),
        ("short", -5.0, -10.0, -7.5),
        ("unknown", None, None, None),
    ]


def test_position_var_of_a_given_date(spark):
    df = var.position_var(positions(spark), known_var(spark), as_of=day(0))
    assert rows(df, "position_id") == [("old",)]


def test_portfolio_totals(spark):
    row = var.portfolio_var(var.position_var(positions(spark), known_var(spark))).first()
    assert row["total_var_95"] == pytest.approx(5.5) and row["total_var_99"] == pytest.approx(11.0)
    assert row["total_market_value"] == Decimal(130) and row["as_of_date"] == day(1)
    assert row["calculated_at"] is not None


def test_gold_columns(spark):
    df = var.risk_metrics(var.position_var(positions(spark), known_var(spark)))
    assert df.columns == FCT_RISK_METRICS.fieldNames()
    row = df.filter("metric_id = 'long_var'").first()
    assert row["notional_exposure"] == row["market_exposure"] == Decimal(100)
    empty = ("counterparty_id", "cvar_95", "delta", "rho", "daily_pnl", "ytd_pnl", "credit_exposure")
    assert [row[c] for c in empty] == [None] * len(empty)
    types = dict(df.dtypes)
    assert types["cvar_95"] == "decimal(18,2)" and types["vega"] == "decimal(18,6)"


def test_book_summary_is_sorted_with_unknown_last(spark):
    more = positions(spark).unionByName(held(spark, ("none", day(1), "C", "z", 5)))
    df = var.book_summary(var.risk_metrics(var.position_var(more, known_var(spark))))
    assert [tuple(r) for r in df.collect()] == [
        ("x", 1, 10.0, 20.0, Decimal(100)),
        ("y", 3, pytest.approx(-4.5), pytest.approx(-9.0), Decimal(30)),
        ("z", 1, None, None, Decimal(5)),
    ]


def test_a_join_with_the_var_leaves_the_returns_as_they_are(spark):
    """A filter on the joined instruments would make the returns another plan than that of their newest date: both would run."""
    recent = returns.lookback_returns(prices(spark, {}, {"price_date": day(1)}))
    held = spark.createDataFrame([("A", Decimal(5))], "instrument_id string, market_value decimal(18,2)")
    for bucketed in (False, True):
        joined = var.attach_var(held, var.instrument_var(recent), bucketed=bucketed)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan and "isnotnull(instrument_id" not in plan.partition("Aggregate")[2]
