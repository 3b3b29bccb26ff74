"""Column expressions shared by the operators. All built-in: no UDF anywhere."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

__all__ = [
    "clean_code",
    "clean_status",
    "double_of",
    "is_valid_trade",
    "level_tag",
    "months_between",
    "notional",
    "period_end",
    "period_start",
    "settlement_days",
    "signed",
    "simple_return",
    "with_lineage",
]

BUY, SELL = "BUY", "SELL"
OPEN = "OPEN"


def clean_code(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def clean_status(name: str) -> Column:
    """NULL means open; an empty string stays empty."""
    return F.coalesce(clean_code(name), F.lit(OPEN))


def double_of(name: str) -> Column:
    """A number out of text; NULL where it is not one (a plain cast raises under ANSI)."""
    return F.col(name).try_cast("double")


def settlement_days(settled: str = "settlement_date", traded: str = "trade_date") -> Column:
    """Calendar days between trade and settlement."""
    return F.datediff(F.col(settled), F.col(traded))


def notional(quantity: str = "quantity", price: str = "price") -> Column:
    return F.col(quantity) * F.col(price)


def is_valid_trade() -> Column:
    """True only when every condition holds; any NULL makes the trade invalid."""
    holds = (
        (F.col("quantity") > 0)
        & (F.col("price") > 0)
        & F.col("trade_type").isin(BUY, SELL)
        & (F.col("settlement_date") >= F.col("trade_date"))
    )
    return F.coalesce(holds, F.lit(False))


def signed(amount: Column | str) -> Column:
    """The amount of a purchase, the negative amount of a sale, NULL otherwise.

    Negating keeps a decimal's scale; a product with a sign would lose digits of a wide one.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(F.col("trade_type") == BUY, amount).when(F.col("trade_type") == SELL, -amount)


def simple_return(close: Column, previous: Column) -> Column:
    """Relative change; NULL when either price is missing or the previous one is zero."""
    return F.try_divide(close - previous, previous)


def level_tag(level: float) -> str:
    """Column suffix of a confidence level: 0.95 -> "95", 0.975 -> "97_5"."""
    return f"{level * 100:.6g}".replace(".", "_")


def with_lineage(scan: DataFrame, date_column: str, ingested_at: datetime | None = None) -> DataFrame:
    """Stamp a file scan with ingestion time, source file and the year/month partition columns."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return scan.select(
        "*",
        stamp.alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        F.year(date_column).alias("year"),
        F.month(date_column).alias("month"),
    )


def months_between(first: date | None, last: date | None) -> Column:
    """On year and month partitions: whether a month is in the range that two dates span, open where one is missing."""
    month = 12 * F.col("year") + F.col("month")
    holds = F.col("year").isNotNull()
    if first is not None:
        holds = holds & (month >= 12 * first.year + first.month)
    if last is not None:
        holds = holds & (month <= 12 * last.year + last.month)
    return holds


# frequency -> (first day of a date's period, last day of the period starting on a date)
_PERIODS = {
    "day": (lambda date: date, lambda start: start),
    "week": (lambda date: F.trunc(date, "week"), lambda start: F.date_add(start, 6)),
    "month": (lambda date: F.trunc(date, "month"), F.last_day),
}


def period_start(date: Column, frequency: str) -> Column:
    if frequency not in _PERIODS:
        raise ValueError(f"frequency must be one of {sorted(_PERIODS)}, not {frequency!r}")
    return _PERIODS[frequency][0](date)


def period_end(start: Column, frequency: str) -> Column:
    return _PERIODS[frequency][1](start)
