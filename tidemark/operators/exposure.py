"""Net and gross exposure per instrument, sector and counterparty, each currency for itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import signed


def instrument_exposure(positions: DataFrame) -> DataFrame:
    return positions.groupBy("as_of_date", "instrument_id", "currency").agg(
        F.sum("market_value").alias("net_exposure"),
        F.sum(F.abs("market_value")).alias("gross_exposure"),
        F.count(F.lit(1)).alias("position_count"),
    )


def sector_exposure(positions: DataFrame, instruments: DataFrame) -> DataFrame:
    """Positions shrink to one row per instrument, currency and date before the dimension is joined."""
    return (
        instrument_exposure(positions)
        .join(instruments.select("instrument_id", "asset_class", "sector"), "instrument_id", "left")
        .groupBy("as_of_date", "asset_class", "sector", "currency")
        .agg(*[F.sum(c).alias(c) for c in ("net_exposure", "gross_exposure", "position_count")])
    )


def counterparty_exposure(trades: DataFrame, counterparties: DataFrame) -> DataFrame:
    """Signed (net) and absolute (gross) trade notional per counterparty and currency."""
    notional = signed("notional_value")
    per_counterparty = trades.groupBy("counterparty_id", "currency").agg(
        F.sum(notional).alias("net_notional"),
        F.sum(F.abs(notional)).alias("gross_notional"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    known = counterparties.select("counterparty_id", "counterparty_name", "credit_rating")
    return per_counterparty.join(known, "counterparty_id", "left")
