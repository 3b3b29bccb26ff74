"""P&L from position snapshots.

Every window runs over the snapshots of one position, so its size is the number of
snapshot dates, not of trades.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.operators.positions import MONEY, POSITION_KEY


def position_pnl(snapshots: DataFrame) -> DataFrame:
    """The snapshots with daily, month-to-date and year-to-date P&L added.

    Daily P&L is the change of unrealised P&L since the last snapshot that had one (zero
    before the first), so the daily figures of a position add up to its latest unrealised
    P&L. A snapshot without a value has no daily P&L and leaves the running sums as they were.
    """
    # A running sum of daily P&L is the last known value less the one known before the sum began, which its first row
    # has at hand. The parts of a position's key go with its id: snapshots that lie together by a part of it, as those
    # of ``position_snapshots`` do, stay there.
    key = [*(c for c in POSITION_KEY if c in snapshots.columns), "position_id"]
    position = Window.partitionBy(*key).orderBy("as_of_date")
    earlier = position.rowsBetween(Window.unboundedPreceding, -1)
    to_date = position.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value, year, month = F.col("unrealized_pnl"), F.year("as_of_date"), F.month("as_of_date")

    def began(unit: str) -> Column:
        return F.coalesce(F.col(f"_{unit}") != F.col(f"_{unit}_before"), F.lit(True))

    numbered = snapshots.withColumns(
        {"_year": F.coalesce(year, F.lit(-1)), "_month": F.coalesce(12 * year + month, F.lit(-1))})
    seen = numbered.withColumns(
        {
            "_previous": F.coalesce(F.last(value, ignorenulls=True).over(earlier), F.lit(0).cast(MONEY)),
            "_year_before": F.last("_year").over(earlier),
            "_month_before": F.last("_month").over(earlier),
        }
    )
    based = seen.withColumns(
        {
            **{f"_{u}_base": F.last(F.when(began(u), F.col("_previous")), ignorenulls=True).over(to_date) for u in ("month", "year")},
            **{f"_{u}_known": F.last(F.when(value.isNotNull(), F.col(f"_{u}")), ignorenulls=True).over(to_date) for u in ("month", "year")},
        }
    )

    def since(unit: str) -> Column:
        gained = F.coalesce(value, "_previous") - F.col(f"_{unit}_base")
        return F.when(F.col(f"_{unit}_known") == F.col(f"_{unit}"), gained).cast(MONEY)

    return based.select(
        *snapshots.columns,
        (value - F.col("_previous")).cast(MONEY).alias("daily_pnl"),
        since("month").alias("mtd_pnl"),
        since("year").alias("ytd_pnl"),
    )


def pnl_at(snapshots: DataFrame, as_of: date | Column) -> DataFrame:
    """The rows of ``position_pnl`` for one date, from one aggregate instead of windows.

    Daily P&L telescopes: a running sum is the last known unrealised P&L minus the one
    known before the sum began. So a daily job needs four values per position, which are
    combined on the map side; history is neither sorted nor kept, and the date's own row is
    picked up in the same aggregate. The parts of a position's key go with its id.
    """
    day = F.lit(as_of)
    when, known = F.col("as_of_date"), F.col("unrealized_pnl")
    begins = {"day": day, "month": F.trunc(day, "month"), "year": F.trunc(day, "year")}
    base = {
        unit: F.max_by(known, F.when(known.isNotNull() & (when < begin), when)).alias(f"before_{unit}")
        for unit, begin in begins.items()
    }
    seen = {
        unit: F.count(F.when(when >= begins[unit], known)).alias(f"known_in_{unit}") for unit in ("month", "year")
    }
    keys = [c for c in ("position_id", "instrument_id", "book_id", "currency") if c in snapshots.columns]
    own = [c for c in snapshots.columns if c not in (*keys, "as_of_date")]
    history = (
        snapshots.filter(when <= day)
        .groupBy(*keys)
        .agg(
            F.max_by(known, F.when(known.isNotNull(), when)).alias("newest"),
            *base.values(),
            *seen.values(),
            F.count(F.when(when == day, 1)).alias("held"),
            *[F.max(F.when(when == day, F.col(c))).alias(c) for c in own],
        )
        .filter(F.col("held") > 0)
    )

    def since(unit: str) -> Column:
        return F.col("newest") - F.coalesce(f"before_{unit}", F.lit(0).cast(MONEY))

    profit = {
        "daily_pnl": F.when(known.isNotNull(), since("day")),
        "mtd_pnl": F.when(F.col("known_in_month") > 0, since("month")),
        "ytd_pnl": F.when(F.col("known_in_year") > 0, since("year")),
    }
    return history.withColumn("as_of_date", day).select(
        *snapshots.columns, *[c.cast(MONEY).alias(name) for name, c in profit.items()]
    )


# --- P&L from running state ---------------------------------------------------------------------

_STATE = ("known", "before_month", "before_year")


def pnl_state_at(snapshots: DataFrame, day: date | Column) -> DataFrame:
    """The running state after a day: per position the last known value and those known before month and year.

    (position_id, as_of_date, known, before_month, before_year, in_month, in_year); ``in_month`` says
    whether a value became known in the day's month, which sets a sum of zero apart from none.
    """
    day = F.lit(day)
    when, known = F.col("as_of_date"), F.col("unrealized_pnl")

    def last(begin: Column | None, name: str) -> Column:
        counts = known.isNotNull() if begin is None else known.isNotNull() & (when < begin)
        return F.max_by(known, F.when(counts, when)).cast(MONEY).alias(name)

    month, year = F.trunc(day, "month"), F.trunc(day, "year")
    return snapshots.filter(when <= day).groupBy("position_id").agg(
        last(None, "known"),
        last(month, "before_month"),
        last(year, "before_year"),
        (F.count(F.when(when >= month, known)) > 0).alias("in_month"),
        (F.count(F.when(when >= year, known)) > 0).alias("in_year"),
    ).withColumn("as_of_date", day)


def advanced_pnl(state: DataFrame, snapshot: DataFrame, day: date | Column) -> DataFrame:
    """One row per position of the state or of the day's snapshot: the new state and the day's P&L.

    ``state`` is that of an earlier day. State and snapshot meet in one hash aggregate of their union, a row
    of each per position. Where a month or year has ended in between, the last known value becomes
    its base. ``held`` is the snapshot's row, NULL for a position that is not in it.
    """
    day = F.lit(day)
    held = F.struct(*snapshot.columns)
    absent = F.lit(None)
    told = state.select(
        "position_id", F.struct("as_of_date", *_STATE, "in_month", "in_year").alias("was"),
        absent.cast(snapshot.select(held.alias("held")).schema["held"].dataType).alias("held"),
    )
    seen = snapshot.select("position_id", absent.cast(told.schema["was"].dataType).alias("was"), held.alias("held"))
    both = told.unionByName(seen).groupBy("position_id").agg(
        F.first("was", ignorenulls=True).alias("was"), F.first("held", ignorenulls=True).alias("held")
    )
    was, value = F.col("was"), F.col("held")["unrealized_pnl"]

    def same(unit: str) -> Column:
        return F.coalesce(F.trunc(was["as_of_date"], unit) == F.trunc(day, unit), F.lit(False))

    known = F.coalesce(value, was["known"])
    advanced = both.select(
        "position_id",
        "held",
        day.alias("as_of_date"),
        known.alias("known"),
        *[F.when(same(u), was[f"before_{u}"]).otherwise(was["known"]).alias(f"before_{u}") for u in ("month", "year")],
        *[
            (value.isNotNull() | F.coalesce(same(u) & was[f"in_{u}"], F.lit(False))).alias(f"in_{u}")
            for u in ("month", "year")
        ],
        (value - F.coalesce(was["known"], F.lit(0).cast(MONEY))).cast(MONEY).alias("daily_pnl"),
    )

    def since(unit: str) -> Column:
        gained = F.col("known") - F.coalesce(f"before_{unit}", F.lit(0).cast(MONEY))
        return F.when(F.col(f"in_{unit}"), gained).cast(MONEY)

    return advanced.withColumns({"mtd_pnl": since("month"), "ytd_pnl": since("year")})


def pnl_state(advanced: DataFrame) -> DataFrame:
    """The state to store after ``advanced_pnl``."""
    return advanced.select("position_id", "as_of_date", *_STATE, "in_month", "in_year")


def pnl_rows(advanced: DataFrame) -> DataFrame:
    """The day's snapshot with its P&L, as ``position_pnl`` has it."""
    held = advanced.filter(F.col("held").isNotNull())
    return held.select("held.*", "daily_pnl", "mtd_pnl", "ytd_pnl")


_PNL = ("daily_pnl", "mtd_pnl", "ytd_pnl")


def book_pnl(pnl: DataFrame) -> DataFrame:
    """P&L of whole books per snapshot date.

    Stretches of days (a column ``until``) are taken as whole histories, as ``position_snapshots`` makes them: without
    gaps up to a last day, and with a value from a first one on. A book's daily P&L then is zero but where a
    stretch begins, and its sums to date are those of its daily P&L, as the sum of running sums is the running
    sum of sums. So the positions are added up once per stretch, and only the books are repeated for every day.
    """
    if "until" in pnl.columns:
        return _book_pnl_of_stretches(pnl)
    return pnl.groupBy("book_id", "currency", "as_of_date").agg(*[F.sum(c).alias(c) for c in _PNL])


def _book_pnl_of_stretches(pnl: DataFrame) -> DataFrame:
    book = ("book_id", "currency")
    begun = pnl.groupBy(*book, "as_of_date").agg(
        F.sum("daily_pnl").alias("gained"), F.count("daily_pnl").alias("valued"), F.max("until").alias("until"))
    by_day = Window.partitionBy(*book).orderBy("as_of_date")
    following = F.lead("as_of_date").over(by_day)
    last = F.max("until").over(Window.partitionBy(*book))
    changes = begun.withColumn("until", F.coalesce(F.date_sub(following, 1), last))
    every_day = changes.withColumn("day", F.explode(F.sequence("as_of_date", "until"))).select(
        *book,
        F.col("day").alias("as_of_date"),
        *[F.when(F.col("day") == F.col("as_of_date"), F.col(c)).alias(c) for c in ("gained", "valued")],
        F.year("day").alias("year"),
        F.month("day").alias("month"),
    )
    year = Window.partitionBy(*book, "year").orderBy("month", "as_of_date")
    month = Window.partitionBy(*book, "year", "month").orderBy("as_of_date")
    by_date = Window.partitionBy(*book).orderBy("year", "month", "as_of_date")

    def to_date(column: str, window: WindowSpec) -> Column:
        return F.coalesce(
            F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0).cast(MONEY))

    sums = {"daily_pnl": F.coalesce("gained", F.lit(0).cast(MONEY)), "mtd_pnl": to_date("gained", month), "ytd_pnl": to_date("gained", year)}
    known = every_day.withColumns({**sums, "valued": to_date("valued", by_date)})
    return known.select(
        *book, "as_of_date", *[F.when(F.col("valued") > 0, F.col(c)).cast("decimal(38,2)").alias(c) for c in _PNL])
