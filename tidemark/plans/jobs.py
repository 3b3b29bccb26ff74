"""The batch jobs: read, transform with the operators, write, return what a caller looks at.

Each job writes its table once and computes its checks or summary from the written
columns, so nothing upstream of the write is evaluated again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions import with_lineage
from tidemark.operators import demo, pnl, positions, quality, returns, silver, var
from tidemark.schemas import DEMO_PRICES, FCT_POSITIONS, FCT_RISK_METRICS, conform
from tidemark.sources import files, tables

YEAR_MONTH = ("year", "month")


def _ingest(
    scan: DataFrame,
    date_column: str,
    path: str,
    checks: Callable[[DataFrame], DataFrame],
    fmt: str,
    ingested_at: datetime | None,
) -> DataFrame:
    """Append a batch; its checks open only the months it has dates in, and the one of unreadable dates.

    The months are collected while the batch is written, so its files are read once.
    """
    batch = ingested_at or datetime.now(timezone.utc)
    seen, month = Observation(), 12 * F.col("year") + F.col("month")
    landing = with_lineage(scan, date_column, batch).observe(seen, F.collect_set(month).alias("months"))
    tables.append_partitioned(landing, path, YEAR_MONTH, fmt)
    landed = tables.read_table(scan.sparkSession, path, fmt)
    months = F.col("year").isNull() | month.isin(*seen.get["months"])
    return checks(landed.filter(months & (F.col("ingestion_timestamp") == F.lit(batch))))


def ingest_trades(
    spark: SparkSession,
    source: str,
    bronze: str,
    fmt: str = tables.DEFAULT_FORMAT,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Append trade files to bronze; returns the batch's warnings."""
    scan = files.read_raw_trades(spark, source)
    return _ingest(scan, "trade_date", bronze, quality.trade_warnings, fmt, ingested_at)


def ingest_prices(
    spark: SparkSession,
    source: str,
    bronze: str,
    fmt: str = tables.DEFAULT_FORMAT,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Append price files to bronze; returns the batch's warnings."""
    scan = files.read_raw_prices(spark, source)
    return _ingest(scan, "price_date", bronze, quality.price_warnings, fmt, ingested_at)


def refine_trades(
    spark: SparkSession, bronze: str, target: str, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Rewrite silver trades from bronze; returns the summary per type, currency and status."""
    refined = silver.stamp_processed(silver.silver_trades(tables.read_table(spark, bronze, fmt), by=YEAR_MONTH))
    tables.replace_partitioned(refined, target, YEAR_MONTH, fmt, together=True)
    return silver.trade_summary(tables.read_table(spark, target, fmt))


def refine_prices(
    spark: SparkSession, bronze: str, target: str, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Rewrite silver prices from bronze; returns the written table."""
    refined = silver.silver_prices_by_month(tables.read_table(spark, bronze, fmt))
    tables.replace_partitioned(refined, target, YEAR_MONTH, fmt, together=True)
    return tables.read_table(spark, target, fmt)


def publish_positions(
    spark: SparkSession,
    trades: str,
    prices: str,
    target: str,
    as_of: date,
    rerunnable: bool = False,
    fmt: str = tables.DEFAULT_FORMAT,
) -> DataFrame:
    """Add the snapshot of one date to the position table; returns what this run has written."""
    held = positions.snapshot_at(
        tables.read_table(spark, trades, fmt), tables.read_table(spark, prices, fmt), as_of
    )
    return _published(conform(held, FCT_POSITIONS), target, as_of, rerunnable, fmt)


def _published(df: DataFrame, target: str, as_of: date | None, rerunnable: bool, fmt: str) -> DataFrame:
    """Write one snapshot under the run's own time and read the rows of that run back."""
    run = F.lit(datetime.now(timezone.utc))
    write = tables.replace_touched_partitions if rerunnable else tables.append_partitioned
    write(df.withColumn("created_at", run), target, ["as_of_date"], fmt)
    snapshot = var.latest_snapshot(tables.read_table(df.sparkSession, target, fmt), as_of)
    return snapshot.filter(F.col("created_at") == run)


def publish_risk_metrics(
    spark: SparkSession,
    prices: str,
    held_positions: str,
    gold: str,
    lookback_days: int = returns.LOOKBACK_DAYS,
    as_of: date | None = None,
    rerunnable: bool = False,
    complete: bool = False,
    fmt: str = tables.DEFAULT_FORMAT,
) -> DataFrame:
    """Compute VaR for one snapshot and add it to gold; returns the run's own summary per book.

    The snapshot is the newest of the positions unless ``as_of`` names one, whatever gold holds.
    ``rerunnable`` replaces the snapshot's partition where the default appends to it;
    ``complete`` fills in CVaR and P&L, which are otherwise NULL. Figures are computed as
    doubles and stored in the decimal types of the gold table.
    """
    recent = returns.lookback_returns(tables.read_table(spark, prices, fmt), lookback_days, as_of)
    held = tables.read_table(spark, held_positions, fmt)
    if as_of is None:
        as_of = tables.fetch_row(held.agg(F.max("as_of_date").alias("day")))["day"]
    day = F.lit(as_of).cast("date")
    if complete:
        held = pnl.pnl_at(held, day)
    level = var.position_var(held, var.instrument_var(recent), as_of=day)
    metrics = var.complete_risk_metrics(level) if complete else var.risk_metrics(level)
    return var.book_summary(_published(conform(metrics, FCT_RISK_METRICS), gold, as_of, rerunnable, fmt))


def ingest_demo_prices(
    spark: SparkSession, source: str, target: str, fmt: str = tables.DEFAULT_FORMAT, infer: bool = False
) -> DataFrame:
    """Replace the demo price table. A schema is given unless types are to be inferred."""
    scan = files.read_demo_prices(spark, source, None if infer else DEMO_PRICES)
    tables.overwrite(scan, target, fmt)
    return tables.read_table(spark, target, fmt)


def build_demo_positions(
    spark: SparkSession, source: str, target: str, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Replace the demo position table from trade files."""
    tables.overwrite(demo.demo_positions(files.read_demo_trades(spark, source)), target, fmt)
    return tables.read_table(spark, target, fmt)


def publish_demo_risk_metrics(
    spark: SparkSession,
    held_positions: str,
    prices: str,
    table: str,
    fmt: str = tables.DEFAULT_FORMAT,
    path: str | None = None,
    keep_existing: bool = False,
) -> DataFrame:
    """Store the mock P&L as a catalog table, replacing it or (``keep_existing``) only if absent."""
    metrics = demo.demo_risk_metrics(
        tables.read_table(spark, held_positions, fmt), tables.read_table(spark, prices, fmt)
    )
    store = tables.create_table_if_absent if keep_existing else tables.create_or_replace_table
    store(metrics, table, fmt, path)
    return tables.named_table(spark, table)
