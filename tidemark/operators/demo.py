"""The small demo lane: instrument, quantity and price only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import lookup_join


def demo_positions(trades: DataFrame) -> DataFrame:
    """Net quantity and the plain (unweighted) average price of buys and sells together."""
    return trades.groupBy("instrument").agg(
        F.sum("qty").alias("position_qty"), F.avg("price").alias("avg_price")
    )


def _valued(joined: DataFrame) -> DataFrame:
    return joined.select(
        "instrument",
        "position_qty",
        F.col("close").alias("last_price"),
        (F.col("position_qty") * F.col("close")).alias("pnl_mock"),
    )


def demo_risk_metrics(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Mock P&L against every price of the instrument: n price dates give n rows."""
    return _valued(lookup_join(prices, positions, "instrument", "inner"))


def demo_risk_metrics_at_last_price(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """Mock P&L against the newest price only, one row per instrument."""
    newest = prices.groupBy("instrument").agg(F.max_by("close", "date").alias("close"))
    return _valued(lookup_join(positions, newest, "instrument", "inner"))
