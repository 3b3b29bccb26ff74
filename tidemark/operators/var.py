"""Historical-simulation VaR and CVaR per instrument, position, book and portfolio."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import level_tag, lookup_join
from tidemark.operators.returns import LOOKBACK_DAYS
from tidemark.schemas import FCT_RISK_METRICS

LEVELS = (0.95, 0.99)
MIN_RETURNS = 30


def instrument_var(
    returns: DataFrame, levels: Sequence[float] = LEVELS, min_returns: int = MIN_RETURNS
) -> DataFrame:
    """VaR and CVaR return per instrument for any list of confidence levels.

    With n returns sorted ascending, VaR is the one at 0-based position floor((1 - level) * n)
    and CVaR the mean of those up to and including it; both are NULL under ``min_returns``.
    This is an index rule, not a percentile function: those differ when (1 - level) * n is
    whole. All levels come from one sort.
    """
    by_return = Window.partitionBy("instrument_id").orderBy("daily_return")
    whole = by_return.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = returns.select(
        "instrument_id",
        "daily_return",
        (F.row_number().over(by_return) - 1).alias("position"),
        F.count("daily_return").over(whole).alias("n"),
    )
    # The id comes as an aggregate: a join with the result then adds no filter on it to the returns, and returns whose
    # newest date is a scalar of their own plan are the same plan in both places, which is run once.
    told = ranked.groupBy(F.col("instrument_id").alias("_key")).agg(
        F.max("instrument_id").alias("instrument_id"), *_level_columns(levels, min_returns), F.count(F.lit(1)).alias("returns"))
    return told.drop("_key")


def _level_columns(levels: Sequence[float], min_returns: int) -> list[Column]:
    """VaR and CVaR of each level from rows with a return, its 0-based position and the count ``n``."""
    columns = []
    for level in levels:
        cut = F.floor(F.lit(1 - level) * F.col("n"))
        enough = F.col("n") >= min_returns
        value = F.col("daily_return")
        columns += [
            F.max(F.when(enough & (F.col("position") == cut), value)).alias(f"var_{level_tag(level)}_pct"),
            F.avg(F.when(enough & (F.col("position") <= cut), value)).alias(f"cvar_{level_tag(level)}_pct"),
        ]
    return columns


def instrument_var_tail(
    returns: DataFrame,
    levels: Sequence[float] = LEVELS,
    min_returns: int = MIN_RETURNS,
    longest: int = LOOKBACK_DAYS + 1,
) -> DataFrame:
    """The rows of ``instrument_var`` where no instrument has more than ``longest`` returns, from their tails.

    A lookback window holds one return per day, so the largest position any level reaches is known
    beforehand. The rank limit it gives is applied by every task before the shuffle (WindowGroupLimit):
    what is sent and sorted is the tail of each instrument, beside a count that is combined on the map
    side. For a table of returns, which is cheap to read twice; ``instrument_var`` reads its input once.
    """
    reach = max(math.floor((1 - level) * longest) for level in levels) + 1
    by_return = Window.partitionBy("instrument_id").orderBy("daily_return")
    tail = returns.select(
        "instrument_id", "daily_return", F.row_number().over(by_return).alias("rank")
    ).filter(F.col("rank") <= reach)
    counts = returns.groupBy("instrument_id").agg(F.count("daily_return").alias("n"), F.count(F.lit(1)).alias("returns"))
    # Both sides are partitioned by instrument already, with a bounded number of rows for each.
    ranked = tail.withColumn("position", F.col("rank") - 1).join(counts, "instrument_id")
    return ranked.groupBy("instrument_id").agg(
        *_level_columns(levels, min_returns), F.max("returns").alias("returns"))


def var_by_level(
    returns: DataFrame, levels: Sequence[float] = LEVELS, min_returns: int = MIN_RETURNS
) -> DataFrame:
    """One row per instrument and confidence level instead of one column pair per level."""
    wide = instrument_var(returns, levels, min_returns)
    entries = [
        F.struct(
            F.lit(float(level)).alias("level"),
            F.col(f"var_{level_tag(level)}_pct").alias("var_pct"),
            F.col(f"cvar_{level_tag(level)}_pct").alias("cvar_pct"),
        )
        for level in levels
    ]
    return wide.select("instrument_id", "returns", F.inline(F.array(*entries)))


def latest_snapshot(positions: DataFrame, as_of: date | Column | None = None) -> DataFrame:
    """Positions of one date: the given one, or the newest in the table.

    The newest date is a scalar subquery inside the plan, so on a table partitioned by
    as_of_date it prunes partitions without a detour over the driver.
    """
    day = positions.agg(F.max("as_of_date")).scalar() if as_of is None else F.lit(as_of)
    return positions.filter(F.col("as_of_date") == day)


def attach_var(
    positions: DataFrame, var: DataFrame, levels: Sequence[float] = LEVELS, bucketed: bool = False
) -> DataFrame:
    """Position VaR and CVaR: market value times the size of the instrument's return.

    A position without VaR stays, with NULL. A short position yields a negative figure. ``bucketed`` is for
    positions that lie together by instrument, those of ``position_snapshots`` or two tables stored in the
    same buckets: they are joined where they lie, and an instrument's rows stay in one task.
    """
    value = F.col("market_value").cast("double")
    tags = [f"{kind}_{level_tag(level)}" for level in levels for kind in ("var", "cvar")]
    sizes = var.select("instrument_id", *[f"{t}_pct" for t in tags])
    if bucketed:
        joined = positions.join(sizes, "instrument_id", "left")
    else:
        joined = lookup_join(positions, sizes, "instrument_id")
    return joined.withColumns({t: value * F.abs(F.col(f"{t}_pct")) for t in tags})


def position_var(
    positions: DataFrame,
    var: DataFrame,
    levels: Sequence[float] = LEVELS,
    as_of: date | Column | None = None,
) -> DataFrame:
    """VaR of the positions of one snapshot, the newest unless a date is given."""
    return attach_var(latest_snapshot(positions, as_of), var, levels)


def portfolio_var(position_level: DataFrame) -> DataFrame:
    """Totals over all positions. Adding VaR up treats positions as fully dependent."""
    return position_level.agg(
        F.sum("var_95").alias("total_var_95"),
        F.sum("var_99").alias("total_var_99"),
        F.sum("market_value").alias("total_market_value"),
        F.max("as_of_date").alias("as_of_date"),
    ).withColumn("calculated_at", F.current_timestamp())


def _gold_columns(position_level: DataFrame, *extra: str) -> DataFrame:
    """Project onto the gold schema; columns without a calculation become typed NULLs."""
    computed = {
        "metric_id": F.concat("position_id", F.lit("_var")),
        "notional_exposure": F.col("market_value"),
        "market_exposure": F.col("market_value"),
        "created_at": F.current_timestamp(),
    }
    for name in ("as_of_date", "instrument_id", "book_id", "var_95", "var_99", *extra):
        computed[name] = F.col(name)
    return position_level.select(
        *[computed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in FCT_RISK_METRICS.fields]
    )


def risk_metrics(position_level: DataFrame) -> DataFrame:
    """The 21 gold columns as published: CVaR, Greeks, P&L and credit exposure are typed NULLs."""
    return _gold_columns(position_level)


def complete_risk_metrics(position_level: DataFrame) -> DataFrame:
    """The gold columns with CVaR and P&L filled in.

    Expects the positions to carry P&L, as those of ``pnl.position_pnl`` do.
    """
    return _gold_columns(position_level, "cvar_95", "cvar_99", "daily_pnl", "mtd_pnl", "ytd_pnl")


def book_summary(metrics: DataFrame) -> DataFrame:
    """Positions, VaR and exposure per book, largest 99% VaR first."""
    return (
        metrics.groupBy("book_id")
        .agg(
            F.count(F.lit(1)).alias("position_count"),
            F.sum("var_95").alias("total_var_95"),
            F.sum("var_99").alias("total_var_99"),
            F.sum("market_exposure").alias("total_exposure"),
        )
        .orderBy(F.desc_nulls_last("total_var_99"))
    )
