"""Jobs that continue from stored state: each reads what is new and the state of the day before.

A state is a table partitioned by its date, and a run replaces the partition it writes: a run that was
killed, or is repeated, leaves what one run leaves.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import months_between
from tidemark.operators import exposure, pnl, positions, returns, silver
from tidemark.schemas import FCT_POSITIONS, conform
from tidemark.sources import tables

YEAR_MONTH = ("year", "month")


def _next_month(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1)


def _rows_of(spark: SparkSession, source: str | DataFrame, fmt: str) -> DataFrame:
    return source if isinstance(source, DataFrame) else tables.read_table(spark, source, fmt)


# --- enriched prices ----------------------------------------------------------------------------


def extend_prices(
    spark: SparkSession,
    bronze: str | DataFrame,
    target: str,
    carry: str,
    until: date,
    since: date | None = None,
    fmt: str = tables.DEFAULT_FORMAT,
) -> DataFrame:
    """Refine the months up to ``until`` with ``prev_close`` and ``daily_return``; returns the months written.

    ``carry`` holds each instrument's last close before the first day of a month (column ``before``), one
    partition per run. A run starts where the newest of them ends; with late prices, ``since`` is their
    first date, and the run starts from the newest carry before it. It then goes on to the last month
    ever written, and renews the carries in between, since later returns depend on earlier closes.
    """
    until, start, later = _next_month(until), None, []
    if tables.table_exists(spark, carry):
        known = tables.read_table(spark, carry, fmt).select("before").distinct().collect()  # a date per run
        ends = sorted(row["before"] for row in known)
        usable = [day for day in ends if since is None or day <= since]
        start = usable[-1] if usable else None
        later = [day for day in ends if start is None or day > start]
    before = None if start is None else tables.read_table(spark, carry, fmt).filter(F.col("before") == start)
    ends = sorted({*later, until})
    if start is not None and ends[-1] <= start:
        ends = []  # all of it is written already
    last = (ends[-1] if ends else start) - timedelta(days=1)
    written = months_between(start, last)
    if ends:
        # Together by instrument once: copies are removed, and returns continued, without another shuffle.
        months = _rows_of(spark, bronze, fmt).filter(written).repartition("instrument_id")
        enriched = returns.continue_returns(silver.silver_prices(months), before)
        tables.replace_touched_partitions(enriched, target, YEAR_MONTH, fmt)
    stored = tables.read_table(spark, target, fmt).filter(written)
    for day in ends:
        state = returns.carry_before(day, stored, before).withColumn("before", F.lit(day))
        tables.replace_touched_partitions(state, carry, ["before"], fmt)
    return stored


def stored_returns(
    spark: SparkSession,
    prices: str,
    carry: str,
    lookback_days: int = returns.LOOKBACK_DAYS,
    fmt: str = tables.DEFAULT_FORMAT,
) -> DataFrame:
    """The lookback window of ``extend_prices``' table, read from its own months.

    The date of the newest return comes from the last carry, one row per instrument.
    """
    state = tables.read_table(spark, carry, fmt)
    newest_carry = tables.newest_partition(spark, carry, "before", fmt=fmt)
    newest = tables.fetch_row(
        state.filter(F.col("before") == F.lit(newest_carry)).agg(F.max("return_date").alias("day")))["day"]
    stored = tables.read_table(spark, prices, fmt)
    if newest is None:  # no instrument has had a return yet
        return returns.stored_lookback(stored, newest_carry, lookback_days).filter(F.lit(False))
    return returns.stored_lookback(stored, newest, lookback_days)


# --- positions ----------------------------------------------------------------------------------


def _between(df: DataFrame, column: str, after: date | None, until: date) -> DataFrame:
    """Rows dated after one day and up to another; of a table by year and month only these months are read."""
    if set(YEAR_MONTH) <= set(df.columns):
        df = df.filter(months_between(after, until))
    rows = df.filter(F.col(column) <= F.lit(until))
    return rows if after is None else rows.filter(F.col(column) > F.lit(after))


def advance_positions(
    spark: SparkSession,
    trades: str | DataFrame,
    prices: str | DataFrame,
    state: str,
    target: str,
    day: date,
    since: date | None = None,
    fmt: str = tables.DEFAULT_FORMAT,
) -> DataFrame:
    """Store the snapshot of a day from the state of an earlier one and what came since; returns it.

    The state (``state``/holdings and ``state``/closes) is that of the last day before ``day``, or before
    ``since``, the first date of trades or prices that came late. Without one, all trades are added up once.
    """
    holdings, closes = f"{state.rstrip('/')}/holdings", f"{state.rstrip('/')}/closes"
    # The closes are stored last: a day that has them has its holdings.
    base = tables.newest_partition(spark, closes, "as_of_date", min(day, since) if since else day, fmt)

    def stored(path: str, when: date | None) -> DataFrame | None:
        return None if when is None else tables.read_table(spark, path, fmt).filter(F.col("as_of_date") == F.lit(when))

    new_trades = _between(_rows_of(spark, trades, fmt), "trade_date", base, day)
    new_prices = _between(_rows_of(spark, prices, fmt), "price_date", base, day)
    for path, advanced in (
        (holdings, positions.advanced_holdings(stored(holdings, base), new_trades)),
        (closes, positions.advanced_closes(stored(closes, base), new_prices)),
    ):
        tables.replace_touched_partitions(advanced.withColumn("as_of_date", F.lit(day)), path, ["as_of_date"], fmt)
    snapshot = positions.snapshot_of(
        stored(holdings, day).drop("as_of_date"), stored(closes, day).drop("as_of_date"), day)
    written = conform(snapshot, FCT_POSITIONS).withColumn("created_at", F.current_timestamp())
    tables.replace_touched_partitions(written, target, ["as_of_date"], fmt)
    return stored(target, day)


# --- P&L ----------------------------------------------------------------------------------------


def start_pnl(spark: SparkSession, snapshots: DataFrame, state: str, day: date, fmt: str = tables.DEFAULT_FORMAT) -> None:
    """Store the running state after a day from the snapshots up to it."""
    tables.replace_touched_partitions(pnl.pnl_state_at(snapshots, day), state, ["as_of_date"], fmt)


def advance_pnl(
    spark: SparkSession, held: str, state: str, target: str, day: date, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Store a day's P&L from the state of the last day before it and the day's snapshot; returns it.

    Of the position table one partition is read, of the state another. The snapshot and its P&L are
    stored before the state, so a day with a state has its P&L.
    """
    base = tables.newest_partition(spark, state, "as_of_date", day, fmt)
    snapshot = tables.read_table(spark, held, fmt).filter(F.col("as_of_date") == F.lit(day))
    if base is None:
        before = pnl.pnl_state_at(snapshot.filter(F.lit(False)), day)
    else:
        before = tables.read_table(spark, state, fmt).filter(F.col("as_of_date") == F.lit(base))
    advanced = pnl.advanced_pnl(before, snapshot, day)
    tables.replace_touched_partitions(pnl.pnl_rows(advanced), target, ["as_of_date"], fmt)
    tables.replace_touched_partitions(pnl.pnl_state(advanced), state, ["as_of_date"], fmt)
    return tables.read_table(spark, target, fmt).filter(F.col("as_of_date") == F.lit(day))


# --- exposure -----------------------------------------------------------------------------------


def publish_exposures(
    spark: SparkSession, held: str, instruments: DataFrame, target: str, day: date, fmt: str = tables.DEFAULT_FORMAT
) -> DataFrame:
    """Store a day's net and gross exposure per instrument and sector; returns the sectors'."""
    snapshot = tables.read_table(spark, held, fmt).filter(F.col("as_of_date") == F.lit(day))
    for name, df in (
        ("instruments", exposure.instrument_exposure(snapshot)), ("sectors", exposure.sector_exposure(snapshot, instruments))
    ):
        tables.replace_touched_partitions(df, f"{target.rstrip('/')}/{name}", ["as_of_date"], fmt)
    return tables.read_table(spark, f"{target.rstrip('/')}/sectors", fmt).filter(F.col("as_of_date") == F.lit(day))
