"""Every operator as a query over the tables of one folder.

Timestamps and file paths are left out of the results, money and ratios are rounded: the
results are compared with SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import (
    clean_code,
    clean_status,
    is_valid_trade,
    lookup_join,
    notional,
    period_end,
    period_start,
    settlement_days,
    with_lineage,
)
from tidemark.operators import demo, exposure, pnl, positions, quality, returns, silver, var, views
from tidemark.plans import daily, ingest, jobs, lane
from tidemark.plans.inputs import Tables
from tidemark.schemas import MODEL, conform
from tidemark.sources import batches, files, tables
from tidemark.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles of fixed precision; decimals are rounded while still exact."""
    return df.withColumns({c: F.round(c, digits).cast("double") for c in columns})


# --- derived frames shared by several queries -------------------------------------------


def _silver_trades(t: Tables) -> DataFrame:
    return silver.silver_trades(t.raw_trades())


def _silver_prices(t: Tables) -> DataFrame:
    return silver.silver_prices(t.raw_prices())


def _current_positions(t: Tables) -> DataFrame:
    return positions.snapshot_at(_silver_trades(t), _silver_prices(t), t.last_day)


def _snapshots(t: Tables, frequency: str = "month", stretches: bool = False) -> DataFrame:
    return positions.position_snapshots(_silver_trades(t), _silver_prices(t), t.last_day, frequency, stretches)


def _recent_returns(t: Tables) -> DataFrame:
    return returns.lookback_returns(t.daily_prices())


def _position_var(t: Tables) -> DataFrame:
    return var.position_var(
        _current_positions(t), var.instrument_var(_recent_returns(t)), as_of=t.last_day
    )


def _trade_risk(t: Tables) -> DataFrame:
    """Risk rows that do name a counterparty: one per trade, dated at the month's end."""
    trades = _silver_trades(t).select(
        F.last_day("trade_date").alias("as_of_date"),
        "instrument_id",
        "counterparty_id",
        F.col("notional_value").alias("credit_exposure"),
    )
    size = var.instrument_var(_recent_returns(t)).select("instrument_id", F.abs("var_95_pct").alias("size"))
    return lookup_join(trades, size, "instrument_id").withColumn(
        "var_95", F.col("credit_exposure").cast("double") * F.col("size")
    )


_VAR_COLUMNS = ("var_95_pct", "cvar_95_pct", "var_99_pct", "cvar_99_pct")
_POSITION_VAR_COLUMNS = ("var_95", "cvar_95", "var_99", "cvar_99")
_POSITION_MONEY = ("quantity", "cost_basis", "market_value", "unrealized_pnl")
_SUMMARY_MONEY = ("total_market_value", "total_unrealized_pnl", "avg_var_95", "total_daily_pnl")


# --- returns and VaR --------------------------------------------------------------------


@query
def daily_returns(t: Tables) -> DataFrame:
    df = returns.daily_returns(t.daily_prices())
    return _rounded(df, 6, "daily_return")


@query
def lookback_filter(t: Tables) -> DataFrame:
    df = returns.within_lookback(returns.daily_returns(t.daily_prices()))
    return _rounded(df, 6, "daily_return")


@query
def lookback_returns(t: Tables) -> DataFrame:
    return _rounded(_recent_returns(t), 6, "daily_return")


@query
def instrument_var(t: Tables) -> DataFrame:
    return _rounded(var.instrument_var(_recent_returns(t)), 6, *_VAR_COLUMNS)


@query
def instrument_var_full_history(t: Tables) -> DataFrame:
    recent = returns.within_lookback(returns.daily_returns(t.daily_prices()))
    return _rounded(var.instrument_var(recent), 6, *_VAR_COLUMNS)


@query
def instrument_var_short_history(t: Tables) -> DataFrame:
    """Parts as instruments: too few returns for most of them, so VaR is NULL."""
    recent = returns.lookback_returns(t.daily_prices("l_partkey"))
    return _rounded(var.instrument_var(recent), 6, *_VAR_COLUMNS)


@query
def instrument_var_from_tails(t: Tables) -> DataFrame:
    return _rounded(var.instrument_var_tail(_recent_returns(t)), 6, *_VAR_COLUMNS)


@query
def var_by_level(t: Tables) -> DataFrame:
    df = var.var_by_level(_recent_returns(t), (0.9, 0.95, 0.975, 0.99))
    return _rounded(df, 6, "var_pct", "cvar_pct")


@query
def position_var(t: Tables) -> DataFrame:
    df = _position_var(t).select(
        "position_id", "as_of_date", "instrument_id", "book_id", "market_value", *_POSITION_VAR_COLUMNS
    )
    return _rounded(df, 2, "market_value", *_POSITION_VAR_COLUMNS)


@query
def portfolio_var(t: Tables) -> DataFrame:
    df = var.portfolio_var(_position_var(t)).drop("calculated_at")
    return _rounded(df, 2, "total_var_95", "total_var_99", "total_market_value")


@query
def risk_metrics(t: Tables) -> DataFrame:
    df = var.risk_metrics(_position_var(t)).drop("created_at")
    numeric = [c for c in df.columns if c not in ("metric_id", "as_of_date", "instrument_id", "book_id")]
    return _rounded(df, 2, *[c for c in numeric if c != "counterparty_id"])


@query
def complete_risk_metrics(t: Tables) -> DataFrame:
    """Month-end snapshots, so that the P&L columns have a history to come from."""
    newest = pnl.pnl_at(_snapshots(t), F.last_day(F.lit(t.last_day)))
    level = var.attach_var(newest, var.instrument_var(_recent_returns(t)))
    df = var.complete_risk_metrics(level).drop("created_at", "counterparty_id")
    keep = ("metric_id", "as_of_date", "instrument_id", "book_id")
    return _rounded(df, 2, *[c for c in df.columns if c not in keep])


@query
def book_var_summary(t: Tables) -> DataFrame:
    df = var.book_summary(var.risk_metrics(_position_var(t)))
    return _rounded(df, 2, "total_var_95", "total_var_99", "total_exposure")


# --- trades and prices ------------------------------------------------------------------


@query
def normalized_trades(t: Tables) -> DataFrame:
    df = silver.normalize_trades(t.raw_trades())
    return _rounded(df, 4, "quantity", "price", "notional_value")


@query
def trade_expressions(t: Tables) -> DataFrame:
    """The scalar expressions one by one, with the partition columns."""
    return t.raw_trades().select(
        "trade_id",
        "settlement_date",
        "instrument_id",
        clean_code("trade_type").alias("clean_type"),
        clean_code("currency").alias("clean_currency"),
        clean_status("status").alias("clean_status"),
        settlement_days().alias("settlement_days"),
        F.round(notional(), 4).cast("double").alias("notional_value"),
        F.year("trade_date").alias("year"),
        F.month("trade_date").alias("month"),
    )


@query
def distinct_trades(t: Tables) -> DataFrame:
    df = silver.distinct_trades(t.raw_trades())
    return _rounded(df, 4, "quantity", "price", "notional_value")


@query
def silver_trades(t: Tables) -> DataFrame:
    return _rounded(_silver_trades(t), 4, "quantity", "price", "notional_value")


@query
def validity_flags(t: Tables) -> DataFrame:
    """How trades fall by type and validity before copies are removed."""
    df = t.raw_trades().withColumn("trade_type", clean_code("trade_type"))
    flagged = df.select("trade_type", is_valid_trade().alias("is_valid"))
    return flagged.groupBy("trade_type", "is_valid").agg(F.count(F.lit(1)).alias("trades"))


@query
def trade_summary(t: Tables) -> DataFrame:
    df = silver.trade_summary(_silver_trades(t))
    return _rounded(_rounded(df, 2, "total_notional"), 4, "avg_price")


@query
def silver_prices(t: Tables) -> DataFrame:
    prices = ("open_price", "high_price", "low_price", "close_price", "bid_price", "ask_price")
    return _rounded(_silver_prices(t), 4, *prices)


# --- positions, P&L, exposure, views ----------------------------------------------------


@query
def current_positions(t: Tables) -> DataFrame:
    return _rounded(_current_positions(t), 2, *_POSITION_MONEY)


@query
def position_snapshots(t: Tables) -> DataFrame:
    return _rounded(_snapshots(t), 2, *_POSITION_MONEY)


@query
def latest_snapshot(t: Tables) -> DataFrame:
    """The newest date of a stored table of snapshots: its partition alone is read."""
    held = scratch_folder(t.spark, "snapshots")
    tables.append_partitioned(_snapshots(t), held, ["as_of_date"])
    return _rounded(var.latest_snapshot(tables.read_table(t.spark, held)), 2, *_POSITION_MONEY)


@query
def position_pnl(t: Tables) -> DataFrame:
    df = pnl.position_pnl(_snapshots(t)).drop("quantity", "cost_basis", "market_value")
    return _rounded(df, 2, "unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")


@query
def latest_pnl(t: Tables) -> DataFrame:
    weekly = _snapshots(t, "week")
    newest = period_end(period_start(F.lit(t.last_day), "week"), "week")
    df = pnl.pnl_at(weekly, newest).drop("quantity", "cost_basis", "market_value")
    return _rounded(df, 2, "unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")


@query
def book_pnl_daily(t: Tables) -> DataFrame:
    every_day = pnl.position_pnl(_snapshots(t, "day", stretches=True))
    return _rounded(pnl.book_pnl(every_day), 2, "daily_pnl", "mtd_pnl", "ytd_pnl")


@query
def book_pnl_weekly(t: Tables) -> DataFrame:
    weekly = pnl.position_pnl(_snapshots(t, "week"))
    return _rounded(pnl.book_pnl(weekly), 2, "daily_pnl", "mtd_pnl", "ytd_pnl")


@query
def instrument_exposure(t: Tables) -> DataFrame:
    return _rounded(exposure.instrument_exposure(_current_positions(t)), 2, "net_exposure", "gross_exposure")


@query
def sector_exposure(t: Tables) -> DataFrame:
    df = exposure.sector_exposure(_snapshots(t), t.instruments())
    return _rounded(df, 2, "net_exposure", "gross_exposure")


@query
def counterparty_exposure(t: Tables) -> DataFrame:
    df = exposure.counterparty_exposure(_silver_trades(t), t.counterparties())
    return _rounded(df, 2, "net_notional", "gross_notional")


def _with_daily_pnl(level: DataFrame) -> DataFrame:
    """The published gold rows have no P&L."""
    return level.withColumn("daily_pnl", F.lit(None).cast("decimal(18,2)"))


@query
def portfolio_summary(t: Tables) -> DataFrame:
    df = views.portfolio_summary_of(_with_daily_pnl(_position_var(t)), t.instruments())
    return _rounded(df, 2, *_SUMMARY_MONEY)


@query
def portfolio_summary_once(t: Tables) -> DataFrame:
    df = views.portfolio_summary_of(_with_daily_pnl(_position_var(t)), t.instruments(), fan_out=False)
    return _rounded(df, 2, *_SUMMARY_MONEY)


@query
def portfolio_summary_of_facts(t: Tables) -> DataFrame:
    """The view over two facts of their own, stacked into one aggregate."""
    df = views.portfolio_summary(_current_positions(t), t.instruments(), var.risk_metrics(_position_var(t)))
    return _rounded(df, 2, *_SUMMARY_MONEY)


@query
def portfolio_history(t: Tables) -> DataFrame:
    """The view over all month ends, with P&L and today's VaR returns applied to each."""
    level = var.attach_var(pnl.position_pnl(_snapshots(t)), var.instrument_var(_recent_returns(t)), bucketed=True)
    return _rounded(views.portfolio_summary_of(level, t.instruments()), 2, *_SUMMARY_MONEY)


@query
def counterparty_risk(t: Tables) -> DataFrame:
    df = views.counterparty_risk(_trade_risk(t), t.counterparties())
    return _rounded(df, 2, "total_credit_exposure", "avg_var_95")


@query
def counterparty_risk_unnamed(t: Tables) -> DataFrame:
    """Over the published gold rows, whose counterparty is NULL."""
    df = views.counterparty_risk(var.risk_metrics(_position_var(t)), t.counterparties())
    return _rounded(df, 2, "total_credit_exposure", "avg_var_95")


# --- data quality -----------------------------------------------------------------------


@query
def bronze_validation(t: Tables) -> DataFrame:
    checked = {"trades": t.raw_trades(), "prices": t.raw_prices()}
    return quality.checkpoint_report(checked, "bronze_validation")


@query
def silver_validation(t: Tables) -> DataFrame:
    return quality.checkpoint_report({"trades": _silver_trades(t)}, "silver_validation")


@query
def gold_validation(t: Tables) -> DataFrame:
    return quality.checkpoint_report({"risk_metrics": var.risk_metrics(_position_var(t))}, "gold_validation")


@query
def threshold_gate(t: Tables) -> DataFrame:
    df = quality.threshold_gate(t.raw_trades(), "trade_id", ("trade_id", "instrument_id", "status"))
    return _rounded(df, 6, "value", "threshold")


@query
def trade_warnings(t: Tables) -> DataFrame:
    return quality.trade_warnings(t.raw_trades())


@query
def price_warnings(t: Tables) -> DataFrame:
    return quality.price_warnings(t.raw_prices())


@query
def duplicate_trade_ids(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.raw_trades(), "trade_id")


@query
def validity_counts(t: Tables) -> DataFrame:
    return quality.validity_counts(silver.distinct_trades(t.raw_trades()))


@query
def table_row_counts(t: Tables) -> DataFrame:
    held = demo.demo_positions(t.demo_trades())
    risk = demo.demo_risk_metrics(held, t.demo_prices())
    return quality.row_counts(
        {"trades": t.demo_trades(), "prices": t.demo_prices(), "positions": held, "risk": risk}
    )


@query
def null_instruments(t: Tables) -> DataFrame:
    return quality.null_count(t.demo_trades(), "instrument", "null_instrument")


# --- demo lane --------------------------------------------------------------------------


@query
def demo_positions(t: Tables) -> DataFrame:
    return _rounded(demo.demo_positions(t.demo_trades()), 6, "position_qty", "avg_price")


@query
def demo_risk_metrics(t: Tables) -> DataFrame:
    df = demo.demo_risk_metrics(demo.demo_positions(t.demo_trades()), t.demo_prices())
    return _rounded(df, 4, "position_qty", "last_price", "pnl_mock")


@query
def demo_risk_metrics_at_last_price(t: Tables) -> DataFrame:
    held = demo.demo_positions(t.demo_trades())
    df = demo.demo_risk_metrics_at_last_price(held, t.demo_prices())
    return _rounded(df, 4, "position_qty", "last_price", "pnl_mock")


# --- sources and sinks: written under the shared scratch folder and read back -------------


def _landed_csv(t: Tables, df: DataFrame, purpose: str) -> str:
    """The given rows as headered, compressed CSV files, the form in which input arrives."""
    folder = scratch_folder(t.spark, purpose)
    whitespace = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    compressed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    df.write.options(header=True, **compressed, **whitespace).csv(folder)
    return folder


def _table_name(purpose: str) -> str:
    return f"{purpose}_{datetime.now():%Y%m%d%H%M%S%f}"


@query
def bronze_trades_from_csv(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.raw_trades(), "trades-csv")
    df = with_lineage(files.read_raw_trades(t.spark, f"{source}/*.csv.gz"), "trade_date")
    stamped = (F.col("source_file").endswith(".csv.gz") & F.col("ingestion_timestamp").isNotNull()).alias("stamped")
    df = df.select("*", stamped).drop("source_file", "ingestion_timestamp")
    return _rounded(df, 4, "quantity", "price")


@query
def bronze_prices_from_csv(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.raw_prices(), "prices-csv")
    df = with_lineage(files.read_raw_prices(t.spark, f"{source}/*.csv.gz"), "price_date")
    prices = ("open_price", "high_price", "low_price", "close_price", "bid_price", "ask_price")
    return _rounded(df.drop("source_file", "ingestion_timestamp"), 4, *prices)


@query
def ingest_trades_job(t: Tables) -> DataFrame:
    """The second of two batches of the same files: bronze holds both, the warnings only its own."""
    source = _landed_csv(t, t.raw_trades(), "trades-csv")
    bronze = scratch_folder(t.spark, "bronze-trades")
    jobs.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    warnings = jobs.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    stored = tables.read_table(t.spark, bronze).agg(
        F.lit("stored_rows").alias("check"), F.count(F.lit(1)).alias("failed")
    )
    return warnings.unionByName(stored)


@query
def ingest_prices_job(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.raw_prices(), "prices-csv")
    return jobs.ingest_prices(t.spark, f"{source}/*.csv.gz", scratch_folder(t.spark, "bronze-prices"))


@query
def refine_trades_job(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.raw_trades(), "trades-csv")
    bronze = scratch_folder(t.spark, "bronze-trades")
    jobs.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    df = jobs.refine_trades(t.spark, bronze, scratch_folder(t.spark, "silver-trades"))
    return _rounded(_rounded(df, 2, "total_notional"), 4, "avg_price")


@query
def refine_prices_job(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.raw_prices(), "prices-csv")
    bronze = scratch_folder(t.spark, "bronze-prices")
    jobs.ingest_prices(t.spark, f"{source}/*.csv.gz", bronze)
    df = jobs.refine_prices(t.spark, bronze, scratch_folder(t.spark, "silver-prices"))
    return _rounded(df.select("price_id", "price_date", "instrument_id", "close_price"), 4, "close_price")


def _published_positions(t: Tables) -> str:
    """The position table written by its job from stored silver tables, twice: a rerun changes nothing."""
    trades, prices, held = (scratch_folder(t.spark, p) for p in ("trades", "prices", "positions"))
    tables.overwrite(_silver_trades(t), trades)
    tables.overwrite(_silver_prices(t), prices)
    jobs.publish_positions(t.spark, trades, prices, held, t.last_day)
    jobs.publish_positions(t.spark, trades, prices, held, t.last_day, rerunnable=True)
    return held


@query
def publish_positions_job(t: Tables) -> DataFrame:
    df = tables.read_table(t.spark, _published_positions(t)).drop("created_at")
    return _rounded(df, 2, *_POSITION_MONEY)


@query
def publish_risk_metrics_job(t: Tables) -> DataFrame:
    """Stored prices and positions, gold written twice: the rerun replaces its own partition."""
    prices, gold = scratch_folder(t.spark, "prices"), scratch_folder(t.spark, "gold")
    tables.overwrite(t.daily_prices(), prices)
    held = _published_positions(t)
    jobs.publish_risk_metrics(t.spark, prices, held, gold)
    df = jobs.publish_risk_metrics(t.spark, prices, held, gold, rerunnable=True)
    return _rounded(df, 2, "total_var_95", "total_var_99", "total_exposure")


@query
def appended_risk_metrics_job(t: Tables) -> DataFrame:
    """Gold written twice by appending: the second run returns its own rows, not the sum of both."""
    prices, gold = scratch_folder(t.spark, "prices"), scratch_folder(t.spark, "gold")
    tables.overwrite(t.daily_prices(), prices)
    held = _published_positions(t)
    jobs.publish_risk_metrics(t.spark, prices, held, gold)
    df = jobs.publish_risk_metrics(t.spark, prices, held, gold)
    return _rounded(df, 2, "total_var_95", "total_var_99", "total_exposure")


# --- published batches ---------------------------------------------------------------------------


def _broken_trades(t: Tables) -> str:
    """Trade files in which some lines have a date or a quantity that is none."""
    df = t.raw_trades()
    return _landed_csv(
        t,
        df.withColumns(
            {
                "trade_date": F.when(F.col("trade_id").endswith("-5"), "soon").otherwise(F.col("trade_date").cast("string")),
                "quantity": F.when(F.col("trade_id").endswith("5-1") | F.col("trade_id").endswith("5-5"), "many").otherwise(
                    F.col("quantity").cast("string")),
            }
        ),
        "broken-trades-csv",
    )


@query
def quarantined_trades(t: Tables) -> DataFrame:
    """All lines of files that do not parse in part: the good ones, and the others with file and reason."""
    source, bronze = _broken_trades(t), scratch_folder(t.spark, "bronze-trades")
    ingest.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    good = ingest.bronze_rows(t.spark, bronze).select("trade_id", F.lit(None).cast("string").alias("reason"), "source_file")
    bad = ingest.quarantined_rows(t.spark, bronze).select("trade_id", "reason", "source_file")
    return good.unionByName(bad).select("trade_id", "reason", F.col("source_file").endswith(".csv.gz").alias("has_file"))


@query
def ingested_once_job(t: Tables) -> DataFrame:
    """Bronze after the same files twice, others once, and a batch that was staged but never published."""
    source, bronze = _landed_csv(t, t.raw_trades(), "trades-csv"), scratch_folder(t.spark, "bronze-trades")
    ingest.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    ingest.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    batches.stage(ingest.bronze_rows(t.spark, bronze).withColumn("unread", F.lit(0)), bronze, ingest.LAYOUT)
    df = ingest.bronze_rows(t.spark, bronze).drop("source_file", "ingestion_timestamp", "year", "month")
    return _rounded(df, 4, "quantity", "price")


@query
def gated_refine_job(t: Tables) -> DataFrame:
    """Silver published through its gate, and left as it was by a run that the gate refuses."""
    source, bronze, target = _broken_trades(t), scratch_folder(t.spark, "bronze-trades"), scratch_folder(t.spark, "silver")
    ingest.ingest_trades(t.spark, f"{source}/*.csv.gz", bronze)
    ingest.refine_trades(t.spark, bronze, target)
    one_currency = quality.Gate(min_rows=0, rules=(quality.InSet("one_currency", "currency", ("USD",)),))
    try:
        ingest.refine_trades(t.spark, bronze, target, one_currency)
    except batches.Refused as refused:
        reasons = len(refused.reasons)
    else:
        reasons = 0
    df = ingest.silver_rows(t.spark, target).select("trade_id", "notional_value", F.lit(reasons).alias("refusals"))
    return _rounded(df, 4, "notional_value")


# --- jobs that continue from stored state -------------------------------------------------------


def _extended_prices(t: Tables) -> tuple[str, str]:
    """The enriched price table and its carries after four runs, the last one repeating some months."""
    bronze, target, carry = (scratch_folder(t.spark, p) for p in ("bronze-prices", "enriched-prices", "price-carry"))
    dated = t.raw_prices().withColumns({"year": F.year("price_date"), "month": F.month("price_date")})
    tables.replace_partitioned(dated, bronze, ["year", "month"])
    for until in (date(1996, 12, 31), date(1997, 6, 30), t.last_day):
        daily.extend_prices(t.spark, bronze, target, carry, until)
    daily.extend_prices(t.spark, bronze, target, carry, date(1997, 9, 30), since=date(1997, 8, 3))
    return target, carry


@query
def extended_prices_job(t: Tables) -> DataFrame:
    """Stored prices with their returns, extended month by month from each instrument's last close."""
    target, _ = _extended_prices(t)
    df = tables.read_table(t.spark, target).select(
        "instrument_id", "price_date", "close_price", "prev_close", "daily_return")
    return _rounded(_rounded(df, 4, "close_price", "prev_close"), 6, "daily_return")


@query
def stored_instrument_var(t: Tables) -> DataFrame:
    """VaR from the months of the lookback window alone, without a lag."""
    recent = daily.stored_returns(t.spark, *_extended_prices(t))
    return _rounded(var.instrument_var_tail(recent), 6, *_VAR_COLUMNS)


def _advanced_positions(t: Tables) -> tuple[str, list[date]]:
    """The position table after four daily runs: the first from all trades, the others from the day before."""
    trades, prices, state, held = (scratch_folder(t.spark, p) for p in ("trades", "prices", "position-state", "positions"))
    dated = _silver_trades(t).withColumns({"year": F.year("trade_date"), "month": F.month("trade_date")})
    tables.replace_partitioned(dated, trades, ["year", "month"])
    # Prices are cleaned where their months are brought together for the write: one shuffle and one sort of them.
    by_month = silver.silver_prices_by_month(t.raw_prices())
    dated = by_month.withColumns({"year": F.year("price_date"), "month": F.month("price_date")})
    tables.replace_partitioned(dated, prices, ["year", "month"], together=True)
    days = [t.last_day - timedelta(days=n) for n in (3, 2, 1, 0)]
    for day in days:
        daily.advance_positions(t.spark, trades, prices, state, held, day)
    return held, days


@query
def advanced_positions_job(t: Tables) -> DataFrame:
    held, _ = _advanced_positions(t)
    return _rounded(tables.read_table(t.spark, held).drop("created_at"), 2, *_POSITION_MONEY)


@query
def advanced_pnl_job(t: Tables) -> DataFrame:
    """P&L of three days, each from the state of the day before and the stored snapshot."""
    held, days = _advanced_positions(t)
    state, target = scratch_folder(t.spark, "pnl-state"), scratch_folder(t.spark, "pnl")
    history = positions.position_snapshots(_silver_trades(t), _silver_prices(t), days[0], "day")
    daily.start_pnl(t.spark, history, state, days[0])
    for day in days[1:]:
        daily.advance_pnl(t.spark, held, state, target, day)
    df = tables.read_table(t.spark, target).drop("created_at", "quantity", "cost_basis", "market_value")
    return _rounded(df, 2, "unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")


@query
def appended_partitions(t: Tables) -> DataFrame:
    """Two appends and a replacement: row counts per partition of a year/month table."""
    path = scratch_folder(t.spark, "appended")
    dated = t.raw_prices().select(
        "price_id", F.year("price_date").alias("year"), F.month("price_date").alias("month")
    )
    tables.append_partitioned(dated, path, ["year", "month"])
    tables.append_partitioned(dated, path, ["year", "month"])
    tables.replace_touched_partitions(dated.filter("year = 1996"), path, ["year", "month"])
    stored = tables.read_table(t.spark, path)
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("stored_rows"))


@query
def replaced_table(t: Tables) -> DataFrame:
    """A full partitioned replacement with another schema leaves nothing of the old rows."""
    path = scratch_folder(t.spark, "replaced")
    dated = t.raw_prices().withColumns({"year": F.year("price_date"), "month": F.month("price_date")})
    tables.append_partitioned(dated.select("price_id", "year", "month"), path, ["year", "month"])
    wider = dated.select("price_id", "instrument_id", "year", "month")
    tables.replace_partitioned(wider, path, ["year", "month"])
    return tables.read_table(t.spark, path)


@query
def staged_demo_tables(t: Tables) -> DataFrame:
    """Staged CSV with detected types, read back by name."""
    source = _landed_csv(t, t.demo_prices(), "demo-prices-csv")
    name = _table_name("stg_prices")
    files.stage_csv(t.spark, source, name)
    return tables.named_table(t.spark, name).withColumn("close", F.round("close", 2))


@query
def demo_prices_job(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.demo_prices(), "demo-prices-csv")
    df = jobs.ingest_demo_prices(t.spark, source, scratch_folder(t.spark, "demo-prices"), infer=True)
    return df.withColumn("close", F.round("close", 2))


@query
def demo_positions_job(t: Tables) -> DataFrame:
    source = _landed_csv(t, t.demo_trades(), "demo-trades-csv")
    df = jobs.build_demo_positions(t.spark, source, scratch_folder(t.spark, "demo-positions"))
    return _rounded(df, 6, "position_qty", "avg_price")


@query
def demo_risk_job(t: Tables) -> DataFrame:
    """A stored table replaced by a later run, then kept by a run that only creates if absent."""
    held, prices, empty, target = (
        scratch_folder(t.spark, p) for p in ("demo-positions", "demo-prices", "demo-empty", "demo-risk")
    )
    tables.overwrite(demo.demo_positions(t.demo_trades()), held)
    tables.overwrite(t.demo_prices(), prices)
    tables.overwrite(t.demo_prices().filter(F.lit(False)), empty)
    name = _table_name("risk_metrics")
    jobs.publish_demo_risk_metrics(t.spark, held, empty, name, path=target)
    jobs.publish_demo_risk_metrics(t.spark, held, prices, name, path=target)
    df = jobs.publish_demo_risk_metrics(t.spark, held, empty, name, path=target, keep_existing=True)
    df = _kept(t, _rounded(df, 4, "position_qty", "last_price", "pnl_mock"), "demo-risk-rows")
    t.spark.sql(f"DROP TABLE {name}")
    return df


@contextmanager
def _database(t: Tables, purpose: str) -> Iterator[tuple[str, str]]:
    """(name, folder) of a database of this run alone, dropped afterwards; its files stay in the scratch folder."""
    name, path = _table_name(purpose), scratch_folder(t.spark, purpose)
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/warehouse'")
    try:
        yield name, path
    finally:
        t.spark.sql(f"DROP DATABASE {name} CASCADE")


def _kept(t: Tables, df: DataFrame, purpose: str) -> DataFrame:
    """The rows stored, for a result that outlives the tables it is read from."""
    path = scratch_folder(t.spark, purpose)
    tables.overwrite(df, path)
    return tables.read_table(t.spark, path)


def _filled_model(t: Tables, database: str, path: str, names: Collection[str] = tuple(MODEL)) -> dict[str, DataFrame]:
    """The model tables, those of the given names filled, each from what is stored of the ones before it."""
    tables.create_model_tables(t.spark, database, path=path)
    model = {name: f"{database}.{name}" for name in MODEL}

    def filled(name: str, df: DataFrame) -> DataFrame:
        if name not in names:
            return df
        tables.insert_rows(conform(df, MODEL[name][0]), model[name])
        return tables.named_table(t.spark, model[name])

    trades = filled("dim_trades", _silver_trades(t))
    filled("dim_instruments", t.instruments())
    filled("dim_counterparties", t.counterparties())
    prices = filled("fct_market_prices", _silver_prices(t))
    held = filled("fct_positions", positions.snapshot_at(trades, prices, t.last_day))
    level = var.position_var(held, var.instrument_var(_recent_returns(t)), as_of=t.last_day)
    filled("fct_risk_metrics", var.risk_metrics(level))
    return {name: tables.named_table(t.spark, model[name]) for name in MODEL}


# table -> its key, a date, two texts and two numbers, as model_tables shows them
_SHOWN = {
    "dim_trades": ("trade_id", "trade_date", "trade_type", "status", "quantity", "price"),
    "dim_instruments": ("instrument_id", "maturity_date", "asset_class", "sector", "coupon_rate", "coupon_rate"),
    "dim_counterparties": ("counterparty_id", None, "counterparty_name", "credit_rating", None, None),
    "fct_market_prices": ("price_id", "price_date", "instrument_id", "source", "close_price", "volume"),
    "fct_positions": ("position_id", "as_of_date", "book_id", "currency", "quantity", "unrealized_pnl"),
    "fct_risk_metrics": ("metric_id", "as_of_date", "instrument_id", "book_id", "var_95", "market_exposure"),
}


@query
def model_tables(t: Tables) -> DataFrame:
    """The rows of the six typed tables, created, filled from the derived frames and read by name."""
    with _database(t, "model") as (database, path):
        parts = []
        for name, df in _filled_model(t, database, path).items():
            key, day, *texts, first, second = (F.lit(None) if c is None else F.col(c) for c in _SHOWN[name])
            parts.append(
                df.select(
                    F.lit(name).alias("table_name"), key.alias("row_key"), day.cast("date").alias("row_date"),
                    *[c.cast("string").alias(f"text_{i}") for i, c in enumerate(texts, 1)],
                    F.round(first, 2).cast("double").alias("number_1"), F.round(second, 2).cast("double").alias("number_2"),
                )
            )
        return _kept(t, reduce(DataFrame.unionByName, parts), "model-rows")


def _view_rows(views_by_name: dict[str, DataFrame]) -> DataFrame:
    """Both views in common columns."""
    portfolio = views_by_name["vw_portfolio_summary"].select(
        F.lit("portfolio").alias("view_name"), "as_of_date", F.col("asset_class").alias("name_1"),
        F.col("sector").alias("name_2"), F.col("instrument_count").cast("double").alias("instruments"),
        F.col("total_market_value").cast("double").alias("amount"), F.col("total_unrealized_pnl").cast("double").alias("pnl"),
        F.round(F.col("avg_var_95").cast("double"), 2).alias("avg_var_95"),
    )
    counterparty = views_by_name["vw_counterparty_risk"].select(
        F.lit("counterparty").alias("view_name"), "as_of_date", F.col("counterparty_id").alias("name_1"),
        F.col("credit_rating").alias("name_2"), F.lit(None).cast("double").alias("instruments"),
        F.col("total_credit_exposure").cast("double").alias("amount"), F.lit(None).cast("double").alias("pnl"),
        F.round(F.col("avg_var_95").cast("double"), 2).alias("avg_var_95"),
    )
    return portfolio.unionByName(counterparty)


@query
def reporting_views(t: Tables) -> DataFrame:
    """Both views created over the model tables, and read by name in another session."""
    with _database(t, "views") as (database, path):
        _filled_model(t, database, path, ("dim_instruments", "dim_counterparties", "fct_positions", "fct_risk_metrics"))
        tables.create_model_views(t.spark, database)
        other = t.spark.newSession()
        shown = {n: tables.named_table(other, f"{database}.{n}") for n in ("vw_portfolio_summary", "vw_counterparty_risk")}
        target = scratch_folder(t.spark, "view-rows")
        tables.overwrite(_view_rows(shown), target)
        return tables.read_table(t.spark, target)


@query
def files_to_views_job(t: Tables) -> DataFrame:
    """A whole run from landing files to both views, read by name."""
    trades, prices = _landed_csv(t, t.raw_trades(), "trades-csv"), _landed_csv(t, t.raw_prices(), "prices-csv")
    with _database(t, "lane") as (database, path):
        shown = lane.files_to_views(
            t.spark, f"{trades}/*.csv.gz", f"{prices}/*.csv.gz", path, database, t.last_day, t.instruments(), t.counterparties())
        return _kept(t, _view_rows(shown), "lane-rows")


@query
def demo_lane_job(t: Tables) -> DataFrame:
    """The demo lane from files to its catalog tables: mock P&L rows, with the sizes of all four tables."""
    trades, prices = _landed_csv(t, t.demo_trades(), "demo-trades-csv"), _landed_csv(t, t.demo_prices(), "demo-prices-csv")
    with _database(t, "demo") as (database, path):
        found = lane.demo_lane(t.spark, trades, prices, path, database)
        sizes = tables.fetch_row(quality.row_counts(found))
        df = found["risk"].withColumns({name: F.lit(size) for name, size in sizes.items()})
        return _kept(t, _rounded(df, 4, "position_qty", "last_price", "pnl_mock"), "demo-lane-rows")


@query
def bucketed_position_var(t: Tables) -> DataFrame:
    """Positions and VaR stored in the same buckets by instrument, joined where they lie."""
    with _database(t, "buckets") as (database, path):
        stored = {"held": _current_positions(t), "sizes": var.instrument_var(_recent_returns(t))}
        for name, df in stored.items():
            tables.create_bucketed_table(df, f"{database}.{name}", "instrument_id", 8, path=f"{path}/{name}")
        held, sizes = (tables.named_table(t.spark, f"{database}.{n}") for n in stored)
        df = var.attach_var(held, sizes, bucketed=True).select(
            "position_id", "as_of_date", "instrument_id", "book_id", "market_value", *_POSITION_VAR_COLUMNS)
        return _kept(t, _rounded(df, 2, "market_value", *_POSITION_VAR_COLUMNS), "bucketed-rows")


@query
def bronze_sample(t: Tables) -> DataFrame:
    """Ten rows to look at, as the ingest job shows them: those whose ids have the smallest hashes."""
    df = tables.sample_rows(t.raw_prices(), key="price_id").select("price_id", "price_date", "instrument_id", "close_price")
    return _rounded(df, 4, "close_price")


@query
def bronze_sample_size(t: Tables) -> DataFrame:
    return tables.sample_rows(t.raw_prices()).agg(F.count(F.lit(1)).alias("sampled_rows"))
