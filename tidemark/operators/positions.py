"""Position snapshots from trades and prices.

A position is one instrument in one book and currency: amounts in different currencies
are never added.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import lookup_join, period_end, period_start, signed

POSITION_KEY = ("instrument_id", "book_id", "currency")

# Wider than the stored decimal(18,2): sums over a hot position must not overflow on the way.
MONEY = "decimal(28,2)"


def _movements(trades: DataFrame, *groups: str | Column) -> DataFrame:
    """Signed quantity and cost summed per position; combined on the map side, so hot positions shrink there."""
    return trades.groupBy(*POSITION_KEY, *groups).agg(
        F.sum(signed("quantity")).alias("quantity"),
        F.sum(signed(F.col("quantity") * F.col("price"))).alias("cost_basis"),
    )


def position_id() -> Column:
    """The key as one text. Marks in the parts are escaped, so different keys never share an id."""
    escaped = [F.replace(F.replace(k, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for k in POSITION_KEY]
    return F.concat_ws("|", *[F.coalesce(k, F.lit("\\N")) for k in escaped])


def _valued(positions: DataFrame, *extra: str) -> DataFrame:
    quantity = F.col("quantity").cast("decimal(28,4)")
    close = F.col("close_price").cast("decimal(18,4)")
    # The product of two decimal(18,4) is exact; a larger quantity's is good to six digits.
    value = F.coalesce(
        F.round(quantity.try_cast("decimal(18,4)") * close, 2).cast(MONEY), F.round(quantity * close, 2).cast(MONEY))
    cost = F.round("cost_basis", 2)
    return positions.select(
        "position_id" if "position_id" in positions.columns else position_id().alias("position_id"),
        "as_of_date",
        "instrument_id",
        "book_id",
        quantity.alias("quantity"),
        cost.cast(MONEY).alias("cost_basis"),
        value.cast(MONEY).alias("market_value"),
        (value - cost).cast(MONEY).alias("unrealized_pnl"),
        "currency",
        *extra,
    )


def _priced(prices: DataFrame) -> DataFrame:
    return prices.filter(F.col("close_price").isNotNull())


def snapshot_at(trades: DataFrame, prices: DataFrame, as_of: date | Column) -> DataFrame:
    """All positions on one date: trades up to it, valued at the last close up to it."""
    day = F.lit(as_of)
    held = _movements(trades.filter(F.col("trade_date") <= day))
    closes = (
        _priced(prices)
        .filter(F.col("price_date") <= day)
        .groupBy("instrument_id")
        .agg(F.max_by("close_price", "price_date").alias("close_price"))
    )
    return _valued(lookup_join(held, closes, "instrument_id").withColumn("as_of_date", day))


# How much finer the shuffle is cut than the session's: rows are repeated for every period after it, and what sorts them
# then should find a task's share in memory. Adaptive execution would join partitions by their size before that.
_FINER = {"day": 8, "week": 2, "month": 1, "stretch": 2}


def _by_instrument(df: DataFrame, frequency: str) -> DataFrame:
    """All rows of an instrument in one partition, equally many partitions for every frame."""
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(_FINER[frequency] * shuffled, "instrument_id")


def _periods_between(first: Column, later: Column, frequency: str) -> Column:
    """How many periods two period starts are apart."""
    if frequency == "month":
        return 12 * (F.year(later) - F.year(first)) + F.month(later) - F.month(first)
    days = F.datediff(later, first)
    return days if frequency == "day" else F.floor(days / 7).cast("int")


def _close_series(closes: DataFrame, frequency: str) -> DataFrame:
    """(instrument_id, first_period, series): every period's close from an instrument's first to its last.

    ``closes`` holds one row per instrument and period with a close; a period without one repeats the close
    before it. A series is as long as the calendar.
    """
    known = F.sort_array(F.collect_list(F.struct("period", "close_price")))

    def repeated(entry: Column, i: Column) -> Column:
        following = F.get(F.col("known"), i + 1)["period"]
        times = F.coalesce(_periods_between(entry["period"], following, frequency), F.lit(1))
        return F.array_repeat(entry["close_price"], times)

    return closes.groupBy("instrument_id").agg(known.alias("known")).select(
        "instrument_id",
        F.col("known")[0]["period"].alias("first_period"),
        F.flatten(F.transform("known", repeated)).alias("series"),
    )


def _close_stretches(closes: DataFrame, last: Column) -> DataFrame:
    """(instrument_id, first_day, stretches, place): the days up to ``last`` on which an instrument's close stays.

    ``closes`` as in ``_close_series``, by day. A stretch (``since``, ``upto``, ``close_price``) lies within a month; the
    first is the time before the first close. ``place`` has, for every day from the first close, its stretch.
    """
    known = F.sort_array(F.collect_list(F.struct("period", "close_price")))

    def by_month(entry: Column, i: Column) -> Column:
        upto = F.coalesce(F.date_sub(F.get(F.col("known"), i + 1)["period"], 1), last)
        months = F.sequence(F.trunc(entry["period"], "month").cast("date"), upto, F.expr("interval 1 month"))
        return F.transform(months, lambda month: F.struct(
            F.greatest(month, entry["period"]).alias("since"),
            F.least(F.last_day(month), upto).alias("upto"),
            entry["close_price"].alias("close_price"),
        ))

    first = F.col("known")[0]["period"]
    unknown = F.struct(
        F.lit(None).cast("date").alias("since"), F.date_sub(first, 1).alias("upto"),
        F.lit(None).cast(closes.schema["close_price"].dataType).alias("close_price"))
    series = closes.groupBy("instrument_id").agg(known.alias("known")).select(
        "instrument_id", first.alias("first_day"), unknown.alias("unknown"),
        F.flatten(F.transform("known", by_month)).alias("held"),
    )
    days = F.transform("held", lambda s, i: F.array_repeat(i + 2, F.datediff(s["upto"], s["since"]) + 1))
    return series.select(
        "instrument_id", "first_day", F.concat(F.array("unknown"), "held").alias("stretches"), F.flatten(days).alias("place"))


def _stretches(held: DataFrame, closes: DataFrame, last: Column) -> DataFrame:
    """The positions of ``held``, from ``period`` to ``until``, cut where their close changes or a month ends."""
    def place(day: str) -> Column:
        since = F.datediff(day, "first_day")
        return F.when(since < 0, 1).otherwise(F.get("place", since))

    unpriced = F.array(F.struct(
        F.lit(None).cast("date").alias("since"), F.lit(None).cast("date").alias("upto"),
        F.lit(None).cast(closes.schema["close_price"].dataType).alias("close_price")))
    touched = F.slice("stretches", place("period"), place("until") - place("period") + 1)
    every = held.join(_close_stretches(closes, last), "instrument_id", "left").withColumn(
        "stretch", F.explode(F.coalesce(touched, unpriced)))
    return every.withColumns(
        {
            "close_price": F.col("stretch")["close_price"],
            "as_of_date": F.greatest("period", F.col("stretch")["since"]),
            "until": F.least("until", F.col("stretch")["upto"]),
        }
    )


def position_snapshots(
    trades: DataFrame,
    prices: DataFrame,
    as_of: date | Column | None = None,
    frequency: str = "month",
    stretches: bool = False,
) -> DataFrame:
    """Positions at the end of every day, week or month from their first trade to ``as_of``.

    Quantity and cost run over all trades to date; the value uses the last close on or
    before the date and is NULL until the instrument has one. ``as_of`` defaults to the
    newest trade or price date.

    Only periods in which something changed are shuffled and sorted. An instrument's closes become one
    row, its series; a position's changes meet it where they lie, are repeated for every period
    until the next change, and look the period's close up. The result stays partitioned by instrument, so
    what groups it by position shuffles nothing.

    With ``stretches`` the daily snapshots that equal the one before them are told, not repeated: a row stands for
    the days from ``as_of_date`` to ``until``. Rows that have a value lie within a month, so that the P&L of
    the month and the year stays on their days as well. ``every_day`` repeats them.
    """
    if stretches and frequency != "day":
        raise ValueError("stretches are of days")
    cut = "stretch" if stretches else frequency
    if as_of is None:
        as_of = F.greatest(
            trades.agg(F.max("trade_date")).scalar(), prices.agg(F.max("price_date")).scalar()
        )
    day = F.lit(as_of)
    last = period_start(day, frequency)

    deltas = _movements(
        trades.filter(F.col("trade_date") <= day),
        period_start(F.col("trade_date"), frequency).alias("period"),
    )
    by_period = Window.partitionBy(*POSITION_KEY).orderBy("period")
    to_date = by_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = _by_instrument(deltas, cut).select(
        *POSITION_KEY,
        position_id().alias("position_id"),
        "period",
        F.sum("quantity").over(to_date).alias("quantity"),
        F.sum("cost_basis").over(to_date).alias("cost_basis"),
        F.coalesce(F.date_sub(F.lead("period").over(by_period), 1), last).alias("until"),
    )

    last_closes = (
        _priced(prices)
        .filter((F.col("price_date") <= day) & F.col("instrument_id").isNotNull())
        .groupBy("instrument_id", period_start(F.col("price_date"), frequency).alias("period"))
        .agg(F.max_by("close_price", "price_date").alias("close_price"))
    )
    last_closes = _by_instrument(last_closes, cut)
    if stretches:
        return _valued(_stretches(held, last_closes, last), "until")
    series = _close_series(last_closes, frequency)

    step = F.expr(f"interval 1 {frequency}")
    every = held.join(series, "instrument_id", "left").withColumn(
        "period", F.explode(F.sequence("period", "until", step)))
    place = _periods_between(F.col("first_period"), F.col("period"), frequency)
    # A negative place, before the first close, finds none; one after the last change finds the last close.
    close = F.get("series", F.least(place, F.size("series") - 1))
    return _valued(
        every.withColumn("close_price", close).withColumn("as_of_date", period_end(F.col("period"), frequency)))


def every_day(stretches: DataFrame) -> DataFrame:
    """The daily snapshots that rows of ``position_snapshots`` with ``stretches`` stand for."""
    days = F.explode(F.sequence("as_of_date", "until"))
    return stretches.withColumn("as_of_date", days).drop("until")


# --- positions as a fold over stored state ------------------------------------------------------


def advanced_holdings(state: DataFrame | None, trades: DataFrame) -> DataFrame:
    """(key, quantity, cost_basis): stored holdings with the movements of later trades added, exactly.

    The state keeps the cost unrounded, so that adding day by day gives what one sum gives.
    """
    columns = [*POSITION_KEY, F.col("quantity").cast("decimal(28,4)"), F.col("cost_basis").cast("decimal(38,8)")]
    held = _movements(trades).select(*columns)
    if state is None:
        return held
    both = state.select(*columns).unionByName(held)
    return both.groupBy(*POSITION_KEY).agg(
        F.sum("quantity").cast("decimal(28,4)").alias("quantity"),
        F.sum("cost_basis").cast("decimal(38,8)").alias("cost_basis"),
    )


def advanced_closes(state: DataFrame | None, prices: DataFrame) -> DataFrame:
    """(instrument_id, price_date, close_price): the last known close, from the state or later prices."""
    columns = ["instrument_id", "price_date", "close_price"]
    known = _priced(prices).filter(F.col("price_date").isNotNull()).select(*columns)
    if state is not None:
        known = state.select(*columns).unionByName(known)
    return known.groupBy("instrument_id").agg(
        F.max("price_date").alias("price_date"), F.max_by("close_price", "price_date").alias("close_price")
    )


def snapshot_of(holdings: DataFrame, closes: DataFrame, day: date | Column) -> DataFrame:
    """The snapshot of one day, in the columns of ``snapshot_at``, from the state of that day."""
    known = closes.select("instrument_id", "close_price")
    return _valued(lookup_join(holdings, known, "instrument_id").withColumn("as_of_date", F.lit(day)))
