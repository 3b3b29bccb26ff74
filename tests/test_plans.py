"""What the plans of single operators must and must not hold, with their rows."""

from datetime import date
from decimal import Decimal as D
from types import SimpleNamespace

from builders import closes, day, rows
from pyspark.sql import functions as F

from tidemark.operators import returns, silver, var, views
from tidemark.plans import queries
from tidemark.sources import tables

T = date(2024, 1, 31)
SUMMARY = ("as_of_date", "asset_class", "sector", "instrument_count", "total_market_value",
           "total_unrealized_pnl", "avg_var_95", "total_daily_pnl")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def quoted(spark):
    return closes(spark, [(name, day(d), 100.0 + (d * k) % 17) for k, name in enumerate("ABCDE", 2) for d in range(40 + 9 * k)])


def test_tails_are_limited_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "returns")
    tables.overwrite(returns.daily_returns(quoted(spark)), path)
    stored = tables.read_table(spark, path)
    for levels in ((0.95, 0.99), (0.9, 0.5), (0.999,)):
        tail = var.instrument_var_tail(stored, levels, longest=100)
        assert rows(tail) == rows(var.instrument_var(stored, levels))
        plan = plan_of(tail)
        assert plan.count("WindowGroupLimit") == 2  # in the tasks that read, and after the shuffle
        assert plan.index("Window [") < plan.index("WindowGroupLimit")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucket_test")
    sizes = var.instrument_var(returns.daily_returns(quoted(spark)))
    held = spark.range(200).select(
        F.concat(F.lit("p"), "id").alias("position_id"), F.substring(F.lit("ABCDEZ"), (F.col("id") % 6 + 1).cast("int"), F.lit(1)).alias("instrument_id"),
        F.lit(T).alias("as_of_date"), F.col("id").cast("decimal(18,2)").alias("market_value"))
    for name, df in (("held", held), ("sizes", sizes)):
        tables.create_bucketed_table(df, f"bucket_test.{name}", "instrument_id", 4, path=str(tmp_path / name))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (tables.named_table(spark, f"bucket_test.{n}") for n in ("held", "sizes"))
        joined = var.attach_var(left, right, bucketed=True)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in plan_of(var.attach_var(left, right))
        per_day = joined.groupBy("instrument_id", "as_of_date").agg(F.sum("var_95").alias("var_95"))
        assert "Exchange" not in plan_of(per_day)
        assert rows(joined, "position_id", "var_95") == rows(var.attach_var(held, sizes), "position_id", "var_95")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP DATABASE bucket_test CASCADE")


def test_portfolio_view_reads_its_positions_once(spark, tmp_path):
    path = str(tmp_path / "level")
    level = spark.createDataFrame(
        [(T, "A", D(100), D(1), 10.0, D(3)), (T, "A", D(200), D(2), 30.0, None), (T, "B", D(50), None, None, D(4)),
         (T, "Z", D(5), D(5), 1.0, None), (T, None, D(1), D(1), 9.0, D(9)), (None, "A", D(7), D(7), 2.0, D(2))],
        "as_of_date date, instrument_id string, market_value decimal(18,2), unrealized_pnl decimal(18,2), var_95 double, daily_pnl decimal(18,2)")
    known = spark.createDataFrame(
        [("A", "EQ", "tech"), ("B", "EQ", "tech"), ("C", "FX", "g10")], "instrument_id string, asset_class string, sector string")
    tables.overwrite(level, path)
    stored = tables.read_table(spark, path)
    for fan_out, facts in ((True, views.portfolio_summary), (False, views.portfolio_summary_once)):
        one = views.portfolio_summary_of(stored, known, fan_out)
        assert rows(one, *SUMMARY) == rows(facts(stored, known, stored), *SUMMARY)
        plan = plan_of(one)
        assert plan.count("FileScan parquet") == 1 and plan.count("Join") <= 1


def test_a_sample_by_hash_is_the_same_on_any_partitioning(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("v"))
    first = rows(tables.sample_rows(df, 7, "k"))
    assert len(first) == 7 and rows(tables.sample_rows(df.repartition(13), 7, "k")) == first
    assert "TakeOrderedAndProject" in plan_of(tables.sample_rows(df, 7, "k"))


def test_model_views_are_seen_by_another_session(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS view_test")
    try:
        tables.create_model_tables(spark, "view_test", path=str(tmp_path / "model"))
        for _ in range(2):  # created, then replaced
            tables.create_model_views(spark, "view_test")
        other = spark.newSession()
        assert tables.named_table(other, "view_test.vw_portfolio_summary").columns == list(SUMMARY)
        assert tables.named_table(other, "view_test.vw_counterparty_risk").count() == 0
    finally:
        spark.sql("DROP DATABASE view_test CASCADE")


def test_prices_of_the_daily_positions_are_shuffled_once(spark, monkeypatch):
    """The stored price months are the clean prices, written where they were cleaned (advanced_positions_job)."""
    trades = spark.createDataFrame(
        [(f"t{n}", day(n), day(n + 2), f"i{n % 3}", "c", "buy", D(n), D("2.5"), "usd", "x", "b", "open") for n in range(1, 9)],
        "trade_id string, trade_date date, settlement_date date, instrument_id string, counterparty_id string, "
        "trade_type string, quantity decimal(18,4), price decimal(18,4), currency string, trader_id string, book_id string, status string")
    quotes = [(f"p{n}", day(n // 2), f"i{n % 3}", D(n + 3), D(n + 1), D(n + 2) * (-1 if n == 7 else 1)) for n in range(80)]
    prices = spark.createDataFrame(
        quotes + quotes[:9],
        "price_id string, price_date date, instrument_id string, high_price decimal(18,4), low_price decimal(18,4), close_price decimal(18,4)")
    inputs = SimpleNamespace(spark=spark, raw_trades=lambda: trades, raw_prices=lambda: prices, last_day=day(39))
    written, write = [], tables.replace_partitioned

    def seen(df, path, *more, **named):
        write(df, path, *more, **named)
        written.append((df, path, named.get("together", False)))

    monkeypatch.setattr(tables, "replace_partitioned", seen)
    queries._advanced_positions(inputs)
    df, path, together = written[1]
    assert together and plan_of(df).count("Exchange") == 1
    stored = tables.read_table(spark, path).select(prices.columns)
    assert rows(stored) == rows(silver.silver_prices(prices))
