"""Data-quality rules and checks, each a distributed aggregate that ends in a few rows.

A report has one row per rule: (table, rule, evaluated, failed, passed). NULLs are
skipped by every rule but ``not_null``; a pair with either side NULL is skipped too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str

    def evaluated(self) -> Column:
        return F.count(self.column)

    def failed(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Unique(Rule):
    """``failed`` counts the values that occur more than once (see ``report``)."""


@dataclass(frozen=True)
class NotNull(Rule):
    def evaluated(self) -> Column:
        return F.count(F.lit(1))

    def failed(self) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class InSet(Rule):
    allowed: tuple[str, ...]

    def failed(self) -> Column:
        return F.count_if(~F.col(self.column).isin(*self.allowed))


@dataclass(frozen=True)
class Between(Rule):
    """Both bounds belong to the allowed range."""

    low: float
    high: float

    def failed(self) -> Column:
        return F.count_if(~F.col(self.column).between(self.low, self.high))


@dataclass(frozen=True)
class GreaterThan(Rule):
    """Strictly greater than the other column."""

    other: str

    def _holds(self) -> Column:
        return F.col(self.column) > F.col(self.other)

    def evaluated(self) -> Column:
        return F.count(self._holds())

    def failed(self) -> Column:
        return F.count_if(~self._holds())


# Rule names, columns, value sets and bounds are fixed values.
RULES: dict[str, tuple[Rule, ...]] = {
    "trades": (
        Unique("trades_unique_id", "trade_id"),
        NotNull("trades_no_null_id", "trade_id"),
        InSet("trades_valid_type", "trade_type", ("BUY", "SELL")),
        Between("trades_positive_quantity", "quantity", 0, 1_000_000),
        Between("trades_positive_price", "price", 0, 100_000),
    ),
    "prices": (
        Unique("prices_unique_id", "price_id"),
        NotNull("prices_no_null_close", "close_price"),
        Between("prices_positive_close", "close_price", 0, 1_000_000),
        GreaterThan("prices_high_low_check", "high_price", "low_price"),
    ),
    "risk_metrics": (
        Between("var_95_bounds", "var_95", 0, 100_000_000),
        GreaterThan("var_99_greater_than_95", "var_99", "var_95"),
        Between("pnl_reasonable_bounds", "daily_pnl", -50_000_000, 50_000_000),
    ),
}

# checkpoint -> the tables it covers, each judged by the rules of the same name
CHECKPOINTS: dict[str, tuple[str, ...]] = {
    "bronze_validation": ("trades", "prices"),
    "silver_validation": ("trades",),
    "gold_validation": ("risk_metrics",),
}


def _totals(df: DataFrame, flat: Sequence[Rule], unique: Unique | None) -> DataFrame:
    """One row holding e_<rule> and f_<rule> for the given rules, in one pass over the data.

    With a uniqueness rule the rows are first counted per key: map-side combining
    reduces a key that holds a large share of the rows before anything is shuffled,
    and the other rules' counters ride along instead of costing a second scan.
    """
    counters = {f"e_{r.name}": r.evaluated() for r in flat} | {f"f_{r.name}": r.failed() for r in flat}
    if unique is None:
        return df.agg(*[c.alias(k) for k, c in counters.items()])
    per_key = df.groupBy(F.col(unique.column).alias("key")).agg(
        F.count(F.lit(1)).alias("copies"), *[c.alias(k) for k, c in counters.items()]
    )
    present = F.col("key").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(present, F.col("copies"))), F.lit(0)).alias(f"e_{unique.name}"),
        F.count_if(present & (F.col("copies") > 1)).alias(f"f_{unique.name}"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in counters],
    )


def _rows(totals: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(r.name).alias("rule"),
            F.col(f"e_{r.name}").alias("evaluated"),
            F.col(f"f_{r.name}").alias("failed"),
            (F.col(f"f_{r.name}") == 0).alias("passed"),
        )
        for r in rules
    ]
    return totals.select(F.inline(F.array(*entries)))


def report(df: DataFrame, table: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Evaluate rules on a table; without ``rules`` those registered for the table's name."""
    rules = RULES[table] if rules is None else rules
    flat = [r for r in rules if not isinstance(r, Unique)]
    keys = [r for r in rules if isinstance(r, Unique)]
    passes = [(flat, keys[0] if keys else None)] + [([], k) for k in keys[1:]]
    return reduce(
        DataFrame.unionByName,
        [_rows(_totals(df, f, u), table, ([u] if u else []) + list(f)) for f, u in passes],
    )


def checkpoint_report(tables: Mapping[str, DataFrame], checkpoint: str) -> DataFrame:
    """Run every rule set of a checkpoint and stack the results into one report."""
    parts = [report(tables[name], name) for name in CHECKPOINTS[checkpoint]]
    return reduce(DataFrame.unionByName, parts).select(F.lit(checkpoint).alias("checkpoint"), "*")


def threshold_gate(
    df: DataFrame,
    key: str,
    critical: Sequence[str],
    max_null_ratio: float = 0.05,
    min_rows: int = 100,
    max_duplicate_ratio: float = 0.01,
) -> DataFrame:
    """Table-level thresholds as (metric, value, threshold, passed).

    The null ratio is NULL cells over all cells of the critical columns, the duplicate
    ratio the surplus copies of non-NULL keys over all rows.
    """
    nulls = reduce(Column.__add__, [F.count_if(F.col(c).isNull()) for c in critical])
    per_key = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"), nulls.alias("nulls"))
    surplus = F.when(F.col("key").isNotNull(), F.col("copies") - 1)
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(surplus), F.lit(0)).alias("surplus"),
    )

    def ratio(part: str, width: int) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col("rows") * width), F.lit(0.0))

    measured = [
        ("null_ratio", ratio("nulls", len(critical)), max_null_ratio, Column.__le__),
        ("row_count", F.col("rows").cast("double"), min_rows, Column.__ge__),
        ("duplicate_ratio", ratio("surplus", 1), max_duplicate_ratio, Column.__le__),
    ]
    entries = [
        F.struct(
            F.lit(metric).alias("metric"),
            value.alias("value"),
            F.lit(float(bound)).alias("threshold"),
            compare(value, F.lit(float(bound))).alias("passed"),
        )
        for metric, value, bound, compare in measured
    ]
    return totals.select(F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Gate:
    """Thresholds that a batch meets or is refused by, judged from counters collected while it is written.

    ``rules`` must hold for every row; uniqueness is none of them, as it needs the rows by key.
    """

    critical: tuple[str, ...] = ()
    max_null_ratio: float = 0.05
    min_rows: int = 100
    rules: tuple[Rule, ...] = ()

    def counters(self) -> dict[str, Column]:
        """Plain aggregates for an observation: NULL cells of the critical columns, failures of the rules."""
        if any(isinstance(r, Unique) for r in self.rules):
            raise ValueError("a uniqueness rule cannot be counted row by row")
        nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in self.critical}
        return nulls | {f"failed_{r.name}": r.failed() for r in self.rules}

    def refusals(self, counts: Mapping[str, object]) -> list[str]:
        """Why a batch with these counts (``rows`` among them) is not to be published; empty if it may be."""
        rows = counts["rows"]
        cells = rows * len(self.critical)
        nulls = sum(counts[f"null_{c}"] for c in self.critical)
        reasons = []
        if rows < self.min_rows:
            reasons.append(f"{rows} rows, at least {self.min_rows} wanted")
        if cells and nulls / cells > self.max_null_ratio:
            reasons.append(f"{nulls} of {cells} critical cells are NULL, more than {self.max_null_ratio:.6g}")
        return reasons + [f"{counts[k]} rows fail {r.name}" for r in self.rules if counts[k := f"failed_{r.name}"]]


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, with their number of copies."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def _check_rows(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    entries = [F.struct(F.lit(n).alias("check"), F.col(n).alias("failed")) for n in names]
    return counts.select(F.inline(F.array(*entries)))


def trade_warnings(bronze_trades: DataFrame) -> DataFrame:
    """Row count, repeated trade_ids (NULL is a value here) and NULLs in the critical fields."""
    critical = ("trade_id", "trade_date", "instrument_id")
    per_key = bronze_trades.groupBy("trade_id").agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
    )
    names = ["rows", "duplicate_trade_id", *[f"null_{c}" for c in critical]]
    counts = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count_if(F.col("copies") > 1).alias("duplicate_trade_id"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names[2:]],
    )
    return _check_rows(counts, names)


def negative_close() -> Column:
    return F.col("close_price") < 0


def inverted_range() -> Column:
    """High below low; NULL when either is missing."""
    return F.col("high_price") < F.col("low_price")


def price_warnings(bronze_prices: DataFrame) -> DataFrame:
    """Row count, negative closes and inverted high/low ranges."""
    counts = bronze_prices.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(negative_close()).alias("negative_close"),
        F.count_if(inverted_range()).alias("high_below_low"),
    )
    return _check_rows(counts, ["rows", "negative_close", "high_below_low"])


def validity_counts(normalized_trades: DataFrame) -> DataFrame:
    """How many normalised trades will be kept and how many dropped."""
    return normalized_trades.agg(
        F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the size of every table, as <name>_cnt."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(
        *[df.agg(F.count(F.lit(1))).scalar().alias(f"{name}_cnt") for name, df in tables.items()]
    )


def null_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias(alias))
