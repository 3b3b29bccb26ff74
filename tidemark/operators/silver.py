"""Bronze to silver: normalised, deduplicated, valid trades and clean prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import clean_code, clean_status, clustered, is_valid_trade, notional, settlement_days
from tidemark.operators.quality import inverted_range, negative_close


def latest_copy(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the latest ingested, ties broken by every other column.

    The order is total up to identical rows, so the survivor does not depend on
    partitioning. Spark applies the rank limit before the shuffle as well
    (WindowGroupLimit), so each task sends at most one row per key however many
    copies it holds.
    """
    first = ["ingestion_timestamp"] if "ingestion_timestamp" in df.columns else []
    rest = [c for c in df.columns if c not in {*key, *first}]
    order = [F.col(c).desc_nulls_last() for c in first + rest]
    ranked = df.withColumn("_copy", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("_copy") == 1).drop("_copy")


def clean_trades(bronze_trades: DataFrame) -> DataFrame:
    """Codes trimmed and in capitals."""
    return bronze_trades.withColumns(
        {
            "trade_type": clean_code("trade_type"),
            "currency": clean_code("currency"),
            "status": clean_status("status"),
        }
    )


def with_figures(cleaned_trades: DataFrame) -> DataFrame:
    """Add settlement days, notional value and the validity flag."""
    return cleaned_trades.withColumns(
        {
            "settlement_days": settlement_days(),
            "notional_value": notional(),
            "is_valid": is_valid_trade(),
        }
    )


def normalize_trades(bronze_trades: DataFrame) -> DataFrame:
    """Clean codes and add settlement days, notional value and the validity flag."""
    return with_figures(clean_trades(bronze_trades))


def distinct_trades(bronze_trades: DataFrame) -> DataFrame:
    """Normalised trades, one per trade_id, valid or not.

    Copies are removed before the derived columns exist, which keeps the shuffle narrow,
    and before the validity filter, so an invalid latest copy hides a valid older one.
    """
    return normalize_trades(latest_copy(bronze_trades, ["trade_id"]))


def silver_trades(bronze_trades: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The valid ones of ``distinct_trades``, brought together by the columns a table is partitioned by.

    That shuffle, if any, stands before the derived columns, as the one for the copies does.
    """
    if not by:
        return distinct_trades(bronze_trades).filter("is_valid")
    valid = clean_trades(latest_copy(bronze_trades, ["trade_id"])).filter(is_valid_trade())
    return with_figures(clustered(valid, by))


def stamp_processed(silver: DataFrame) -> DataFrame:
    return silver.withColumn("silver_processed_at", F.current_timestamp())


def trade_summary(silver: DataFrame) -> DataFrame:
    """Count, total notional and average price per trade type, currency and status."""
    return (
        silver.groupBy("trade_type", "currency", "status")
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            F.sum("notional_value").alias("total_notional"),
            F.avg("price").alias("avg_price"),
        )
        .orderBy("trade_type", "currency")
    )


PRICE_KEY = ("instrument_id", "price_date")
MONTH_PARTS = 8  # in how many parts at most a month of prices is cleaned and written


def sound_prices(bronze_prices: DataFrame) -> DataFrame:
    """Prices without negative closes and inverted ranges."""
    failed = F.coalesce(negative_close(), F.lit(False)) | F.coalesce(inverted_range(), F.lit(False))
    return bronze_prices.filter(~failed)


def silver_prices(bronze_prices: DataFrame) -> DataFrame:
    """Prices without negative closes and inverted ranges, one per instrument and date."""
    return latest_copy(sound_prices(bronze_prices), PRICE_KEY)


def silver_prices_by_month(bronze_prices: DataFrame) -> DataFrame:
    """``silver_prices``, its rows together by month for a table partitioned so: one shuffle serves both.

    Copies of a price share its month. A month is cut by instrument into ``MONTH_PARTS`` parts, so that
    several tasks clean and write it. Copies are not reduced before that shuffle.
    """
    place = {
        "_month": F.trunc("price_date", "month"),
        "_part": F.pmod(F.xxhash64("instrument_id"), F.lit(MONTH_PARTS)),
    }
    placed = sound_prices(bronze_prices).withColumns(place).repartition(*place)
    return latest_copy(placed, [*PRICE_KEY, *place]).drop(*place)
