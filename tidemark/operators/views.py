"""Reporting views over the dimensional model.

The portfolio view sets two facts beside each other that repeat their key. Both are stacked and summed per
key in one hash aggregate, which knows how often either would repeat the other: nothing is joined but
one row per key to the instruments, and a hot key costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_FACT_KEY = ["instrument_id", "as_of_date"]
_GROUP = ["as_of_date", "asset_class", "sector"]


def _per_key(facts: DataFrame) -> DataFrame:
    """Sums and row counts of stacked facts; ``held`` and ``risked`` mark what a row is."""
    return facts.groupBy(*_FACT_KEY).agg(
        F.count("held").alias("held_rows"),
        F.count("risked").alias("risk_rows"),
        F.sum("market_value").alias("market_value"),
        F.sum("unrealized_pnl").alias("unrealized_pnl"),
        F.sum("var_95").alias("var_95"),
        F.count("var_95").alias("var_95_rows"),
        F.sum("daily_pnl").alias("daily_pnl"),
    )


def _grouped(per_key: DataFrame, instruments: DataFrame, fan_out: bool) -> DataFrame:
    def repeated(column: str, times: str) -> Column:
        """The sum of a column whose every row the row-level join would repeat."""
        if not fan_out:
            return F.sum(column)
        return F.sum(F.col(column) * F.greatest(F.col(times), F.lit(1)))

    return (
        per_key.filter(F.col("held_rows") > 0)
        .join(instruments.select("instrument_id", "asset_class", "sector"), "instrument_id", "left")
        .groupBy(*_GROUP)
        .agg(
            F.countDistinct("instrument_id").alias("instrument_count"),
            repeated("market_value", "risk_rows").alias("total_market_value"),
            repeated("unrealized_pnl", "risk_rows").alias("total_unrealized_pnl"),
            F.try_divide(repeated("var_95", "held_rows"), repeated("var_95_rows", "held_rows")).alias(
                "avg_var_95"
            ),
            repeated("daily_pnl", "held_rows").alias("total_daily_pnl"),
        )
    )


def _summary(positions: DataFrame, instruments: DataFrame, risk: DataFrame, fan_out: bool) -> DataFrame:
    held = positions.select(*_FACT_KEY, "market_value", "unrealized_pnl", F.lit(1).alias("held"))
    # A risk row without a key would be joined to nothing, but grouping puts missing keys together.
    risked = risk.filter(F.col("instrument_id").isNotNull() & F.col("as_of_date").isNotNull()).select(
        *_FACT_KEY, "var_95", "daily_pnl", F.lit(1).alias("risked")
    )
    return _grouped(_per_key(held.unionByName(risked, allowMissingColumns=True)), instruments, fan_out)


def portfolio_summary_of(level: DataFrame, instruments: DataFrame, fan_out: bool = True) -> DataFrame:
    """Portfolio view where each position carries its own risk row: ``var_95`` and ``daily_pnl`` beside it.

    The result of ``portfolio_summary`` (or, without ``fan_out``, of ``portfolio_summary_once``) over the
    positions and the risk rows made from them, with these evaluated once.
    """
    keyed = F.col("instrument_id").isNotNull() & F.col("as_of_date").isNotNull()
    facts = level.select(
        *_FACT_KEY,
        "market_value",
        "unrealized_pnl",
        F.lit(1).alias("held"),
        F.when(keyed, 1).alias("risked"),
        *[F.when(keyed, F.col(c)).alias(c) for c in ("var_95", "daily_pnl")],
    )
    return _grouped(_per_key(facts), instruments, fan_out)


def portfolio_summary(positions: DataFrame, instruments: DataFrame, risk: DataFrame) -> DataFrame:
    """Portfolio view as published, with the results of joining positions to risk row by row.

    That join ignores the book: with k books holding an instrument every position meets all
    k risk rows, so sums are inflated k-fold. Here the multiplicities are multiplied in
    instead of producing the k * k pairs.
    """
    return _summary(positions, instruments, risk, fan_out=True)


def portfolio_summary_once(positions: DataFrame, instruments: DataFrame, risk: DataFrame) -> DataFrame:
    """Portfolio view that counts every position and every risk row exactly once."""
    return _summary(positions, instruments, risk, fan_out=False)


def counterparty_risk(risk: DataFrame, counterparties: DataFrame) -> DataFrame:
    """Credit exposure and average VaR per date and counterparty.

    Risk rows without a known counterparty form one group per date whose descriptive
    columns are all NULL.
    """
    per_counterparty = risk.groupBy("as_of_date", F.col("counterparty_id").alias("risk_counterparty")).agg(
        F.sum("credit_exposure").alias("credit_exposure"),
        F.sum("var_95").alias("var_95"),
        F.count("var_95").alias("var_95_rows"),
    )
    known = counterparties.select("counterparty_id", "counterparty_name", "credit_rating")
    return (
        per_counterparty.join(known, F.col("risk_counterparty") == F.col("counterparty_id"), "left")
        .groupBy("as_of_date", "counterparty_id", "counterparty_name", "credit_rating")
        .agg(
            F.sum("credit_exposure").alias("total_credit_exposure"),
            F.try_divide(F.sum("var_95"), F.sum("var_95_rows")).alias("avg_var_95"),
        )
    )
