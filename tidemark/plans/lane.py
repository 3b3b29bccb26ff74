"""Whole runs: from landing files to reporting views, and the demo lane from files to its four tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import months_between
from tidemark.operators import demo, quality, var
from tidemark.plans import daily, ingest, jobs
from tidemark.schemas import MODEL, conform
from tidemark.sources import files, tables


def files_to_views(
    spark: SparkSession,
    trade_files: str,
    price_files: str,
    root: str,
    database: str,
    day: date,
    instruments: DataFrame,
    counterparties: DataFrame,
    fmt: str = tables.DEFAULT_FORMAT,
) -> dict[str, DataFrame]:
    """One day's run: ingest, refine, positions, P&L, exposures, VaR, model tables and views; returns the views.

    Every step reads what the one before has stored under ``root``, and raises if its gate refuses; the
    steps after it then do not run. The model tables get the day's trades, prices, positions and metrics. The
    views are read by name from ``database``, which must exist.
    A first run starts the P&L from the snapshot of the day before.
    """
    place = {name: f"{root.rstrip('/')}/{name}" for name in (
        "bronze-trades", "bronze-prices", "silver-trades", "prices", "price-carry", "position-state", "positions",
        "pnl-state", "pnl", "exposures", "gold", "model")}
    ingest.ingest_trades(spark, trade_files, place["bronze-trades"], fmt=fmt)
    ingest.ingest_prices(spark, price_files, place["bronze-prices"], fmt=fmt)
    ingest.refine_trades(spark, place["bronze-trades"], place["silver-trades"], fmt=fmt)
    trades = ingest.silver_rows(spark, place["silver-trades"], fmt)
    quotes = ingest.bronze_rows(spark, place["bronze-prices"], fmt)
    daily.extend_prices(spark, quotes, place["prices"], place["price-carry"], day, fmt=fmt)

    days = [day] if tables.table_exists(spark, place["pnl-state"]) else [day - timedelta(days=1), day]
    for when in days:
        daily.advance_positions(
            spark, trades, place["prices"], place["position-state"], place["positions"], when, fmt=fmt)
        level = daily.advance_pnl(spark, place["positions"], place["pnl-state"], place["pnl"], when, fmt=fmt)
    daily.publish_exposures(spark, place["positions"], instruments, place["exposures"], day, fmt)

    recent = daily.stored_returns(spark, place["prices"], place["price-carry"], fmt=fmt)
    metrics = var.complete_risk_metrics(var.attach_var(level, var.instrument_var_tail(recent)))
    gold = conform(metrics, MODEL["fct_risk_metrics"][0])
    tables.replace_touched_partitions(gold, place["gold"], ["as_of_date"], fmt)

    content = {
        "dim_trades": trades.filter(F.col("trade_date") == F.lit(day)),
        "dim_instruments": instruments,
        "dim_counterparties": counterparties,
        "fct_market_prices": tables.read_table(spark, place["prices"], fmt).filter(
            months_between(day, day) & (F.col("price_date") == F.lit(day))),
        "fct_positions": level,
        "fct_risk_metrics": tables.read_table(spark, place["gold"], fmt).filter(F.col("as_of_date") == F.lit(day)),
    }
    tables.create_model_tables(spark, database, fmt, place["model"])
    for name, df in content.items():
        tables.insert_rows(conform(df, MODEL[name][0]), f"{database}.{name}")
    tables.create_model_views(spark, database)
    return {name: tables.named_table(spark, f"{database}.{name}") for name in ("vw_portfolio_summary", "vw_counterparty_risk")}


def demo_lane(
    spark: SparkSession, trade_files: str, price_files: str, root: str, database: str, fmt: str = tables.DEFAULT_FORMAT
) -> dict[str, DataFrame]:
    """The demo lane: staged trades and prices, positions and mock P&L as catalog tables; returns them by name.

    Raises ``ValueError`` if a table is empty or a staged trade has no instrument.
    """
    place = {name: f"{root.rstrip('/')}/{name}" for name in ("stg_prices", "positions")}
    jobs.ingest_demo_prices(spark, price_files, place["stg_prices"], fmt)
    jobs.build_demo_positions(spark, trade_files, place["positions"], fmt)
    tables.create_or_replace_table(files.read_demo_trades(spark, trade_files), f"{database}.stg_trades", fmt)
    tables.create_or_replace_table(tables.read_table(spark, place["stg_prices"], fmt), f"{database}.stg_prices", fmt)
    tables.create_or_replace_table(tables.read_table(spark, place["positions"], fmt), f"{database}.positions", fmt)
    held, prices = (tables.named_table(spark, f"{database}.{n}") for n in ("positions", "stg_prices"))
    tables.create_or_replace_table(demo.demo_risk_metrics(held, prices), f"{database}.risk_metrics", fmt)
    names = {"trades": "stg_trades", "prices": "stg_prices", "positions": "positions", "risk": "risk_metrics"}
    found = {k: tables.named_table(spark, f"{database}.{n}") for k, n in names.items()}
    counts = tables.fetch_row(quality.row_counts(found))
    nulls = tables.fetch_row(quality.null_count(found["trades"], "instrument", "nulls"))["nulls"]
    if not all(counts.values()) or nulls:
        raise ValueError(f"the demo lane ends with {counts} and {nulls} trades without an instrument")
    return found
