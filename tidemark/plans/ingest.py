"""Ingestion that can be repeated, and refinement that can be refused.

Landing files become batches of a bronze table, each file once. A batch is written, checked and counted
in one pass over its files; lines that do not parse are stored beside the others with file and reason.
Silver is a batch that replaces the one before, if its gate lets it through.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions import with_lineage
from tidemark.operators import quality, silver
from tidemark.schemas import RAW_PRICES, RAW_TRADES
from tidemark.sources import batches, files, tables

YEAR_MONTH = ("year", "month")
LAYOUT = ("unread", *YEAR_MONTH)  # of bronze: lines that do not parse apart from the others
TRADES_GATE = quality.Gate(critical=("trade_id", "trade_date", "instrument_id"), min_rows=1)
PRICES_GATE = quality.Gate(critical=("price_id", "price_date", "instrument_id", "close_price"), min_rows=1)
SILVER_GATE = quality.Gate(critical=("trade_id", "instrument_id"))


def _ingest(
    spark: SparkSession,
    source: str,
    bronze: str,
    schema: StructType,
    date_column: str,
    gate: quality.Gate,
    warnings: Mapping[str, Column],
    fmt: str,
) -> DataFrame:
    """Publish the files not yet taken as one batch; returns (check, failed) counts of what this run added."""
    counters = {"unread_lines": F.count(files.REASON), **gate.counters(), **warnings}
    sources = batches.new_files(spark, source, bronze)
    if sources:
        scan = files.read_checked_csv(spark, [s["source_file"] for s in sources], schema)
        # The lineage first: the file's name is known to the scan itself only.
        landing = with_lineage(scan, date_column, datetime.now(timezone.utc)).withColumn(
            files.REASON, files.parse_reason(schema))
        landing = landing.withColumn("unread", F.col(files.REASON).isNotNull().cast("int"))
        counts = batches.add_batch(landing, bronze, LAYOUT, counters, gate.refusals, sources, fmt=fmt).counts
    else:
        counts = {batches.ROWS: 0} | dict.fromkeys(counters, 0)
    return spark.createDataFrame([(k, v) for k, v in counts.items()], "check string, failed bigint")


def ingest_trades(
    spark: SparkSession, source: str, bronze: str, gate: quality.Gate = TRADES_GATE, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Publish new trade files; returns the batch's counts. Raises ``batches.Refused`` if the gate is closed."""
    return _ingest(spark, source, bronze, RAW_TRADES, "trade_date", gate, {}, fmt)


def ingest_prices(
    spark: SparkSession, source: str, bronze: str, gate: quality.Gate = PRICES_GATE, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Publish new price files; returns the batch's counts. Raises ``batches.Refused`` if the gate is closed."""
    warnings = {
        "negative_close": F.count_if(quality.negative_close()), "high_below_low": F.count_if(quality.inverted_range())}
    return _ingest(spark, source, bronze, RAW_PRICES, "price_date", gate, warnings, fmt)


def bronze_rows(spark: SparkSession, bronze: str, fmt: str = tables.DEFAULT_FORMAT) -> DataFrame:
    """The published rows that were read whole, with their lineage."""
    return batches.read_batches(spark, bronze, fmt=fmt).filter("unread = 0").drop("batch", "unread", files.LINE, files.REASON)


def quarantined_rows(spark: SparkSession, bronze: str, fmt: str = tables.DEFAULT_FORMAT) -> DataFrame:
    """The published lines that do not parse: what was read of them, the line, its file and the reason."""
    return batches.read_batches(spark, bronze, fmt=fmt).filter("unread = 1").drop("batch", "unread", "year", "month")


def refine_trades(
    spark: SparkSession, bronze: str, target: str, gate: quality.Gate = SILVER_GATE, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Replace silver trades if the gate allows it; returns the summary per type, currency and status.

    A refused run (``batches.Refused``) leaves what was published before.
    """
    refined = silver.stamp_processed(silver.silver_trades(bronze_rows(spark, bronze, fmt), by=YEAR_MONTH))
    batches.add_batch(
        refined, target, YEAR_MONTH, gate.counters(), gate.refusals, replaces=True, fmt=fmt, together=True)
    return silver.trade_summary(silver_rows(spark, target, fmt))


def silver_rows(spark: SparkSession, target: str, fmt: str = tables.DEFAULT_FORMAT) -> DataFrame:
    return batches.read_batches(spark, target, fmt=fmt).drop("batch")
