"""Daily returns and the lookback window.

Prices are expected to hold one row per (instrument_id, price_date), which
``silver.silver_prices`` guarantees. An instrument then has at most one row per calendar
day, and at most ``lookback_days + 1`` inside a lookback window: the per-instrument
windows below stay that small however unevenly the raw data is spread.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import months_between, simple_return

LOOKBACK_DAYS = 252  # calendar days

_FIRST_DAY = "0001-01-02"  # earlier than any price; one day remains in front of it


def _with_return(prices: DataFrame) -> DataFrame:
    by_date = Window.partitionBy("instrument_id").orderBy("price_date")
    close = F.col("close_price").cast("double")
    # The lag is a column of its own: written twice inside one expression it would be
    # evaluated as two window functions.
    return (
        prices.withColumn("prev_close", F.lag(close, 1).over(by_date))
        .withColumn("daily_return", simple_return(close, F.col("prev_close")))
        .filter(F.col("daily_return").isNotNull())
    )


def daily_returns(prices: DataFrame) -> DataFrame:
    """(instrument_id, price_date, close_price, prev_close, daily_return) over the whole history.

    The first price of an instrument and prices after a missing or zero one have no return.
    """
    return _with_return(
        prices.select("instrument_id", "price_date", "close_price").filter(F.col("price_date").isNotNull())
    )


def within_lookback(returns: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Returns dated at most ``lookback_days`` calendar days before the newest return."""
    newest = returns.agg(F.max("price_date")).scalar()
    return returns.filter(F.col("price_date") >= F.date_sub(newest, lookback_days))


def _window_start(prices: DataFrame, lookback_days: int) -> Column:
    """A day no later than the first day of the lookback window, from one hash aggregate.

    An instrument with two price dates and no missing or zero close certainly has a return
    on its last date, so the newest return is at least that recent. Where no instrument
    qualifies, the whole history is kept.
    """
    per_instrument = prices.groupBy("instrument_id").agg(
        F.min("price_date").alias("first"),
        F.max("price_date").alias("last"),
        F.count_if(F.col("close_price").isNull() | (F.col("close_price") == 0)).alias("unusable"),
    )
    certain = per_instrument.filter((F.col("first") < F.col("last")) & (F.col("unusable") == 0))
    return F.coalesce(
        F.date_sub(certain.agg(F.max("last")).scalar(), lookback_days), F.lit(_FIRST_DAY).cast("date")
    )


def lookback_returns(
    prices: DataFrame, lookback_days: int = LOOKBACK_DAYS, as_of: date | Column | None = None
) -> DataFrame:
    """The same rows as ``within_lookback(daily_returns(prices))`` without sorting all history.

    A date filter cannot pass below the lag, because the first return in the window needs
    the price before it. So every price older than the window is folded into one carry row
    per instrument, its latest: the fold is a hash aggregate whose map side already drops
    all but one old row per instrument and task, and only window-sized groups reach the
    shuffle and the sort. ``as_of`` caps the prices used.
    """
    prices = prices.select("instrument_id", "price_date", "close_price").filter(
        F.col("price_date").isNotNull() if as_of is None else F.col("price_date") <= F.lit(as_of)
    )
    folded = (
        prices.withColumn("carry_day", F.date_sub(_window_start(prices, lookback_days), 1))
        .withColumn("slot", F.greatest("price_date", "carry_day"))
        .groupBy("instrument_id", "slot", "carry_day")
        .agg(F.max_by("close_price", "price_date").alias("close_price"))
    )
    returns = _with_return(folded.withColumnRenamed("slot", "price_date")).filter(
        F.col("price_date") > F.col("carry_day")
    )
    return within_lookback(returns.drop("carry_day"), lookback_days)


# --- returns that continue from a stored carry ------------------------------------------------


def continue_returns(prices: DataFrame, carry: DataFrame | None) -> DataFrame:
    """The prices with ``prev_close`` and ``daily_return``, their first row continuing from ``carry``.

    ``carry`` holds one row per instrument, its last close before the given prices; without it the first
    price of an instrument has no return. All rows stay: one without a return has NULL. The window
    is as long as the stretch of prices given, never the history before it. The carry is joined where the window
    has brought an instrument's rows together; they are not shuffled for it again.
    """
    by_date = Window.partitionBy("instrument_id").orderBy("price_date")
    close = F.col("close_price").cast("double")
    lagged = prices.filter(F.col("price_date").isNotNull()).withColumns(
        {"_lag": F.lag(close, 1).over(by_date), "_first": F.row_number().over(by_date) == 1}
    )
    if carry is None:
        joined = lagged.withColumn("prev_close", F.col("_lag"))
    else:
        before = carry.select("instrument_id", F.col("close_price").alias("_carried"))
        joined = lagged.join(before, "instrument_id", "left").withColumn(
            "prev_close", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))
        )
    return joined.select(*prices.columns, "prev_close", simple_return(close, F.col("prev_close")).alias("daily_return"))


def carry_before(day: date | Column, prices: DataFrame, carry: DataFrame | None) -> DataFrame:
    """(instrument_id, price_date, close_price, return_date): each instrument's last price before a day.

    From the prices of ``continue_returns`` and the carry they continued from; ``return_date`` is the last
    date with a return. The close may be NULL: the next price then has no return.
    """
    last = prices.filter(F.col("price_date") < F.lit(day)).select(
        "instrument_id",
        "price_date",
        F.col("close_price").cast("double").alias("close_price"),
        F.when(F.col("daily_return").isNotNull(), F.col("price_date")).alias("return_date"),
    )
    if carry is not None:
        last = last.unionByName(carry.select(*last.columns))
    # A NULL close must win over an older one, so the close travels inside a struct.
    newest = F.max_by(F.struct("close_price"), "price_date")["close_price"]
    return last.groupBy("instrument_id").agg(
        F.max("price_date").alias("price_date"),
        newest.alias("close_price"),
        F.max("return_date").alias("return_date"),
    )


def stored_lookback(
    stored: DataFrame, newest: date, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """The lookback window of stored returns, read from its own months only.

    ``stored`` is a table written from ``continue_returns`` with year and month partitions, ``newest`` the date
    of its newest return. No lag: the returns are columns of the table.
    """
    first = newest - timedelta(days=lookback_days)
    return stored.filter(months_between(first, newest)).filter(
        F.col("price_date").between(first, newest) & F.col("daily_return").isNotNull()
    ).select("instrument_id", "price_date", "close_price", "prev_close", "daily_return")
